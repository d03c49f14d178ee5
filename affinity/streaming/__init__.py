"""Structured Streaming form of the click-log apply step.

The reference has no streaming operator. Its only "apply fitted state to new rows" step is
the pass over the unlabeled test file (scaling, vocabulary codes, one-hot offsets, FM lines);
``features`` runs that same transform on click files as they arrive.
"""

from affinity.streaming.features import fitted_click_encoder, stream_fm_lines, start_text_sink

__all__ = ["fitted_click_encoder", "stream_fm_lines", "start_text_sink"]
