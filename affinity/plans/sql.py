"""Building blocks of the DuckDB oracle SQL (common table expressions).

Written independently of the Spark plans: plain joins, GROUP BY and window functions over the
whole tables, the textbook form of each formula.
"""

from __future__ import annotations


def bucket(cols: str, n: int = 10) -> str:
    return f"(('0x' || substr(md5(concat_ws('-', {cols})), 1, 8))::BIGINT % {n})"


INTER = """interactions AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(max(ceil(l_quantity / 10)) AS INTEGER) AS rating, max(o_orderdate) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""

SPLIT = INTER + f""",
bucketed AS (SELECT *, {bucket('user_id, item_id')} AS bucket FROM interactions),
train AS (SELECT user_id, item_id, rating, ts FROM bucketed WHERE bucket < 7),
test AS (SELECT user_id, item_id, rating, ts FROM bucketed WHERE bucket >= 7)"""


def sims(entity: str, context: str, p: float, normalize: bool, name: str = "sims") -> str:
    """CTEs ending in ``name(<entity>, neighbor_id, sim, n_common, ord)`` over ``train``; ``ord`` ranks a row."""
    damp = "1.0" if p == 0 else f"power(ln(1 + a.n), {float(p)})"
    norm_sim = (
        f"SELECT {entity}, neighbor_id, round(CASE WHEN mx = 0 THEN 0.0 ELSE sim / mx END, 6) AS sim, n_common, round(sim, 10) AS ord "
        f"FROM (SELECT *, max(sim) OVER (PARTITION BY {entity}) AS mx FROM {name}_m)"
        if normalize
        else f"SELECT {entity}, neighbor_id, round(sim, 6) AS sim, n_common, round(sim, 6) AS ord FROM {name}_m"
    )
    return f"""{name}_gs AS (SELECT {context}, count(*) AS n FROM train GROUP BY {context}),
{name}_r AS (SELECT t.{context}, t.{entity}, CAST(t.rating AS DOUBLE) AS r, g.n
             FROM train t JOIN {name}_gs g ON g.{context} = t.{context} WHERE g.n > 1),
{name}_pp AS (SELECT a.{entity} AS a, b.{entity} AS b, sum(a.r * b.r / {damp}) AS dot, count(*) AS n_common
              FROM {name}_r a JOIN {name}_r b ON a.{context} = b.{context} AND a.{entity} < b.{entity}
              GROUP BY a.{entity}, b.{entity}),
{name}_nrm AS (SELECT {entity}, sqrt(sum(CAST(rating AS DOUBLE) * rating)) AS norm FROM train GROUP BY {entity}),
{name}_c AS (SELECT a, b, CASE WHEN na.norm * nb.norm = 0 THEN 0.0 ELSE dot / (na.norm * nb.norm) END AS sim, n_common
             FROM {name}_pp JOIN {name}_nrm na ON na.{entity} = a JOIN {name}_nrm nb ON nb.{entity} = b),
{name}_m AS (SELECT a AS {entity}, b AS neighbor_id, sim, n_common FROM {name}_c
             UNION ALL SELECT b, a, sim, n_common FROM {name}_c),
{name} AS ({norm_sim})"""


def topk(entity: str, k: int, src: str = "sims", name: str = "topk") -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {entity}
                ORDER BY ord DESC, neighbor_id ASC) AS INTEGER) AS rank FROM {src}) WHERE rank <= {k})"""


ELIG_ICF = """elig AS (SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM train))"""
ELIG_UCF = """elig AS (SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM topk))"""


def icf_scores(src: str = "topk", name: str = "scores", by: str = "") -> str:
    b = f"{by}, " if by else ""
    return f"""{name}_c AS (SELECT {b}t.user_id, k.neighbor_id AS item_id, sum(k.sim * t.rating) AS total
             FROM train t JOIN {src} k ON k.item_id = t.item_id
             WHERE t.user_id IN (SELECT user_id FROM elig) GROUP BY {b}t.user_id, k.neighbor_id),
{name} AS (SELECT {b}user_id, item_id, round(total, 6) AS score FROM {name}_c c
           WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = c.user_id AND s.item_id = c.item_id))"""


def ucf_scores(src: str = "topk", name: str = "scores", normalize: bool = False, by: str = "") -> str:
    b = f"{by}, " if by else ""
    score = ("round(total / CASE WHEN sim_sum = 0 THEN 1e-10 ELSE sim_sum END, 6)" if normalize
             else "round(total, 6)")
    return f"""{name}_c AS (SELECT {b}k.user_id, t.item_id, sum(k.sim * t.rating) AS total, sum(k.sim) AS sim_sum
             FROM {src} k JOIN train t ON t.user_id = k.neighbor_id
             WHERE k.user_id IN (SELECT user_id FROM elig) GROUP BY {b}k.user_id, t.item_id),
{name} AS (SELECT {b}user_id, item_id, {score} AS score FROM {name}_c c
           WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = c.user_id AND s.item_id = c.item_id))"""


def topn(n: int = 50, tie: str = "item_asc", src: str = "scores", name: str = "recs", by: str = "") -> str:
    tie_sql = "item_id ASC" if tie == "item_asc" else "('item_' || item_id) DESC"
    part = f"{by}, user_id" if by else "user_id"
    return f"""{name} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {part}
               ORDER BY score DESC, {tie_sql}) AS INTEGER) AS rank FROM {src}) WHERE rank <= {n})"""


HITS = """hits AS (SELECT r.*, CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END AS hit,
                  CAST(coalesce(t.rating, 0) AS DOUBLE) AS test_rating
           FROM recs r LEFT JOIN test t ON t.user_id = r.user_id AND t.item_id = r.item_id)"""


def icf_pipeline(k: int = 10, n: int = 50, p: float = 2) -> str:
    return ",\n".join([SPLIT, sims("item_id", "user_id", p, True), topk("item_id", k), ELIG_ICF,
                       icf_scores(), topn(n, "item_asc"), HITS])


def ucf_pipeline(k: int = 10, n: int = 50, p: float = 2, normalize: bool = False, elig: str = ELIG_UCF) -> str:
    return ",\n".join([SPLIT, sims("user_id", "item_id", p, False), topk("user_id", k), elig,
                       ucf_scores(normalize=normalize), topn(n, "key_desc"), HITS])


def catalog_items(catalog: str) -> str:
    return ("SELECT DISTINCT item_id FROM train WHERE user_id IN (SELECT user_id FROM elig)" if catalog == "train"
            else "SELECT DISTINCT item_id FROM test WHERE user_id IN (SELECT user_id FROM train)")


def popularity(distinct: bool) -> str:
    n = "count(DISTINCT user_id)" if distinct else "count(*)"
    return f"pop AS (SELECT item_id, {n} AS popularity FROM train GROUP BY item_id)"


def metrics(n: int = 50, catalog: str = "train", pop_distinct: bool = True) -> str:
    """One-row precision / recall / coverage / popularity over ``recs`` / ``elig``."""
    cat = catalog_items(catalog)
    return f"""{popularity(pop_distinct)},
m_hits AS (SELECT coalesce(sum(hit), 0) AS hits, count(*) AS n_rec, count(DISTINCT item_id) AS rec_items,
                  sum(ln(1 + coalesce(p.popularity, 0))) AS pop
           FROM hits h LEFT JOIN pop p USING (item_id)),
m_fixed AS (SELECT (SELECT count(*) FROM elig) AS n_users,
                   (SELECT count(*) FROM test WHERE user_id IN (SELECT user_id FROM elig)) AS n_test,
                   (SELECT count(*) FROM ({cat})) AS cat_items),
metrics AS (SELECT round(CASE WHEN n_users = 0 THEN 0.0 ELSE hits / (n_users * {n}.0) END, 6) AS precision,
                   round(CASE WHEN n_test = 0 THEN 0.0 ELSE hits / CAST(n_test AS DOUBLE) END, 6) AS recall,
                   round(CASE WHEN cat_items = 0 THEN 0.0 ELSE rec_items / CAST(cat_items AS DOUBLE) END, 6) AS coverage,
                   round(CASE WHEN n_rec = 0 THEN 0.0 ELSE coalesce(pop, 0.0) / n_rec END, 6) AS popularity
            FROM m_hits, m_fixed)"""


CLICKS = """clicks AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
         CAST(l_returnflag = 'R' AS INTEGER) AS label,
         CASE WHEN l_linenumber <> 7 THEN CAST(floor(l_quantity) AS INTEGER) END AS i1,
         CAST(floor(l_extendedprice) AS INTEGER) AS i2,
         CAST(floor(o_totalprice) AS INTEGER) AS i3,
         CAST(floor(p_size) AS INTEGER) AS i4,
         CASE WHEN l_linenumber <> 6 THEN p_brand END AS c1,
         p_type AS c2, p_name AS c3, o_orderpriority AS c4, c_mktsegment AS c5
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey)"""

NUMS = ["i1", "i2", "i3", "i4"]
CATS = ["c1", "c2", "c3", "c4", "c5"]
CLIPS = [48, 99730, 475383, 48]

MINMAX = "mm AS (SELECT " + ", ".join(
    f"min(least({c}, {k})) AS {c}_min, max(least({c}, {k})) AS {c}_max" for c, k in zip(NUMS, CLIPS)
) + " FROM clicks)"


def scaled(c: str) -> str:
    return (f"(CASE WHEN {c} IS NULL THEN 0.0 WHEN {c}_max = {c}_min THEN 0.0 "
            f"ELSE (CAST({c} AS DOUBLE) - {c}_min) / CAST({c}_max - {c}_min AS DOUBLE) END)")


def trim(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(38,6)) AS VARCHAR), '\\.?0+$', '')"


def double_text(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DOUBLE) AS VARCHAR), '\\.0$', '')"


SCALED = "scaled AS (SELECT clicks.*, " + ", ".join(f"{scaled(c)} AS {c}_s" for c in NUMS) + " FROM clicks, mm)"


def vocab(cutoff: int, name: str = "vocab") -> str:
    longs = " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value FROM clicks" for c in CATS)
    return f"""{name}_vc AS (SELECT field, value, count(*) AS count FROM ({longs}) l
               WHERE value IS NOT NULL AND value <> '' GROUP BY field, value),
{name} AS (SELECT field, value, count,
           CAST(CASE WHEN value = '<unk>' THEN 0 ELSE row_number() OVER (PARTITION BY field ORDER BY count DESC, value ASC) END AS BIGINT) AS code
           FROM {name}_vc WHERE count >= {cutoff})"""


def offsets(src: str = "vocab", name: str = "offs") -> str:
    vals = ", ".join(f"('{c}', {i})" for i, c in enumerate(CATS))
    return f"""{name}_sz AS (SELECT f.field, CAST(f.field_idx AS INTEGER) AS field_idx, CAST(coalesce(v.n, 0) + 1 AS BIGINT) AS size
              FROM (VALUES {vals}) f(field, field_idx)
              LEFT JOIN (SELECT field, count(*) AS n FROM {src} WHERE value <> '<unk>' GROUP BY field) v ON v.field = f.field),
{name} AS (SELECT field, field_idx, size,
           CAST(coalesce(sum(size) OVER (ORDER BY field_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
           FROM {name}_sz)"""


def coded(src: str = "scaled", voc: str = "vocab", offs: str = "offs", name: str = "coded") -> str:
    """Rows of ``src`` with <c>_code and <c>_idx (code + offset + numeric width) per category."""
    joins = " ".join(
        f"LEFT JOIN {voc} v{i} ON v{i}.field = '{c}' AND v{i}.value = s.{c}" for i, c in enumerate(CATS)
    )
    codes = ", ".join(f"CAST(coalesce(v{i}.code, 0) AS BIGINT) AS {c}_code" for i, c in enumerate(CATS))
    idxs = ", ".join(
        f"CAST(coalesce(v{i}.code, 0) + (SELECT \"offset\" FROM {offs} WHERE field = '{c}') + {len(NUMS)} AS BIGINT) AS {c}_idx"
        for i, c in enumerate(CATS)
    )
    return f"{name} AS (SELECT s.*, {codes}, {idxs} FROM {src} s {joins})"
