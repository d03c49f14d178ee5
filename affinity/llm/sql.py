"""DuckDB SQL of the queries that SQL can express, written from their contracts.

The classifiers, XXH64 fingerprints, the tokenizer and the ring's overflow have none; their tests are
in tests/llm.
"""

from affinity.llm.quality_rules import ALPHA, DELTA, GRID, STEPS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = rf"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

OP6 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents
), s AS (
  SELECT rid, doc_id, stratum, t,
    list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, key) AS n
  FROM (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS key
        FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM s WHERE len(w) >= 5))
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM win WHERE n > 1) GROUP BY rid
), st AS (
  SELECT s.rid, doc_id, stratum, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM s LEFT JOIN rep ON s.rid = rep.rid
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM st
), v AS (
  SELECT *, {STEPS} - greatest(
    len(list_filter({GRID["symbols"]}, lambda c: c < CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END)),
    len(list_filter({GRID["dup_lines"]}, lambda c: c < CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END)),
    len(list_filter({GRID["repeats"]}, lambda c: c < CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END)),
    len(list_filter({GRID["word_length"]}, lambda c: c < CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END))) AS kept_steps
  FROM b
), g AS (
  SELECT stratum, kept_steps FROM v WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1)
), k AS (
  SELECT stratum, step, count(*) AS n, count(*) FILTER (kept_steps <= step) AS k FROM g, (SELECT unnest(range(0, {STEPS})) AS step) GROUP BY ALL
), p AS (
  SELECT *, CASE WHEN k > n * {ALPHA} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j: exp(
    lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({ALPHA}) + (n - j) * ln(1 - {ALPHA})))) END AS tail
  FROM k
), cut AS (
  SELECT stratum, coalesce(min(step) FILTER (tail > {DELTA} / (SELECT count(DISTINCT stratum) FROM g)), {STEPS}) AS steps FROM p GROUP BY stratum
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND kept_steps >= coalesce(steps, 0) AS kept
FROM v LEFT JOIN cut ON v.stratum = cut.stratum
"""

OP7 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
    label IS NOT NULL AND coalesce(len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS usable
  FROM embeddings
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

_KEY = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_ASSIGN = _KEY + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _op9_kind(kind: str, number: int, pattern: str, group: int, least: int) -> str:
    return f"""SELECT rid, {number} AS k, '{kind}' AS kind, s AS start, s + length(m) AS stop FROM (
      SELECT rid, ms[i] AS m,
        (coalesce(list_sum(list_transform(ps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
      FROM (SELECT rid, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps FROM d)))
      WHERE length(regexp_extract(m, '{pattern}', {group})) >= {least}"""


OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
spans AS (
  {_op9_kind('assign', 0, _ASSIGN, 2, 12)}
  UNION ALL {_op9_kind('access', 1, 'AKIA[A-Z0-9]+', 0, 18)}
  UNION ALL {_op9_kind('hex', 2, '[0-9a-f]+', 0, 16)}
), a AS (
  SELECT rid, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS j
  FROM spans GROUP BY rid
)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
  sha256(coalesce(j, '')) AS base_sha256, coalesce(j, '') AS spans
FROM d LEFT JOIN a ON d.rid = a.rid
"""

OP10 = """
WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (
  SELECT source, rate, greatest(1, ceil(rate / 400))::INT AS parts, rate / greatest(1, ceil(rate / 400)) AS lam
  FROM (SELECT source, (SELECT count(*) FROM documents)::DOUBLE * 1.0 / (SELECT count(*) FROM c) / n AS rate FROM c)
), cdf AS (
  SELECT source, lam, 0 AS k, exp(-lam) AS term, exp(-lam) AS p FROM r
  UNION ALL SELECT source, lam, k + 1, term * lam / (k + 1), p + term * lam / (k + 1) FROM cdf WHERE k < ceil(lam + 12 * sqrt(lam) + 30)
), d AS (
  SELECT row_number() OVER () AS rid, *, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key FROM documents
), draws AS (
  SELECT rid, d.source, ('0x' || substr(md5('10:' || part || ':' || key), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM (SELECT d.rid, d.source, d.key, unnest(range(1, r.parts + 1)) AS part FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source) d
), n AS (
  SELECT rid, count(*) AS n FROM draws JOIN cdf ON draws.source IS NOT DISTINCT FROM cdf.source AND cdf.p <= u GROUP BY rid
)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
  ('0x' || substr(md5('10-order:' || copy || ':' || key), 1, 15))::BIGINT AS shuffle_key
FROM (SELECT d.*, unnest(range(1, n.n + 1)) AS copy FROM d JOIN n ON d.rid = n.rid)
"""

ORACLES = {
    "op4_url_filter": OP4,
    "op6_quality_rules": OP6,
    "op7_embedding_dedup": OP7,
    "op9_secret_scan": OP9,
    "op10_poisson_mixing": OP10,
}
