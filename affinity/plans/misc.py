"""Embedding queries (F11-F13, J12) over the ``embeddings`` and ``events`` tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.functions.columns import trim_decimal
from affinity.operators import embed, features
from affinity.plans.registry import query
from affinity.sources import tables


@query("emb_dense_to_sparse", """SELECT vec_id, CAST(i - 1 AS INTEGER) AS idx, round(CAST(embedding[i] AS DOUBLE), 6) AS value
FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
WHERE embedding[i] <> 0""")
def q_emb_dense_to_sparse(spark, sf):
    e = tables.embedding_table(spark, sf)
    sp = embed.dense_to_sparse(e, "vec_id", "embedding")
    return sp.select("vec_id", "idx", F.round(F.col("value").cast("double"), 6).alias("value"))


@query("emb_bag_sum", """WITH ids AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT i.user_id, CAST(u.i - 1 AS INTEGER) AS dim, round(sum(CAST(u.x AS DOUBLE)), 6) AS value
FROM ids i JOIN (SELECT vec_id, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) u
  ON u.vec_id = i.k
WHERE i.k IS NOT NULL AND i.k <> 0
GROUP BY i.user_id, u.i""")
def q_emb_bag_sum(spark, sf):
    return embed.bag_sum(tables.event_ids(spark, sf), tables.embedding_table(spark, sf))


@query("emb_value_weighted", """SELECT e.event_id, e.field,
       array_to_string(list_transform(m.embedding, lambda x:
           regexp_replace(CAST(CAST(round(CAST(x AS DOUBLE) * e.value, 6) AS DECIMAL(38,6)) AS VARCHAR), '\\.?0+$', '')), ',') AS weighted
FROM (SELECT event_id, value, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS field FROM events
      WHERE event_type IS NOT NULL) e JOIN embeddings m ON m.vec_id = e.field""")
def q_emb_value_weighted(spark, sf):
    """The field of an event is its type's place in alphabetical order; field f uses embedding row f."""
    ev = features.label_encode(tables.load(spark, sf, "events").select("event_id", "event_type", "value"),
                               "event_type", "field")
    w = embed.value_weighted(ev, tables.embedding_table(spark, sf), "event_id", "field", "value")
    return w.select("event_id", F.col("field").cast("int").alias("field"),
                    F.array_join(F.transform("weighted", lambda x: trim_decimal(x)), ",").alias("weighted"))
