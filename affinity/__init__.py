"""affinity: recommender and click-log feature jobs written as Spark DataFrame plans.

Every public operator takes DataFrames and returns a DataFrame. Nothing is collected to the
driver; the caller decides when to act. Sub-packages:

* ``sources``   - table adapters, text readers and writers (CSV, TSV, libsvm/FM/FFM lines)
* ``functions`` - column expressions shared by the operators (hash buckets, number text, ...)
* ``operators`` - splits, histories, similarity, recommendation, evaluation, co-occurrence,
                  feature encoding, embedding pooling
* ``plans``     - the registered queries over the test tables and their SQL oracles
* ``streaming`` - the fitted feature transform applied to an arriving file stream
"""

from affinity.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
