"""The conversation trie, embedding whitening and SentencePiece codec against brute force and the library."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
import sentencepiece

import public_tokenizers
from affinity.llm import pieces, trie, whitening
from affinity.llm.queries import PIECES, QUERIES

SF = "/root/testdata/sf0.01"


def brute_trie(rows, graft=True):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((t is not None, t or 0, digest, role, text))
    seq = {c: [turn[3:] for turn in sorted(v)] for c, v in own.items()}
    if graft:
        size = {c: zlib.crc32(str(c).encode()) % 9 for c in seq}
        seq = {c: seq.get(c - c % 5, [])[:size[c]] + v[size[c]:] for c, v in seq.items()}
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for c, v in seq.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return collections.Counter((
        min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
        hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seq[c]) == len(p)).encode()).hexdigest(),
    ) for p, m in members.items())


def as_rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(QUERIES["op11_conversation_trie"](spark, SF)) == brute_trie(rows)


def test_trie_edges(spark):
    rng = random.Random(3)
    rows = [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice(["", "hi", "é日", None, "long " * 2000]))
        for c in range(60) for t in range(rng.randrange(9))
    ]
    rows += [(200 + c, t, "user", "same") for c in range(100) for t in range(3)]  # a group of copies over many shards
    rows += [(400 + c, t, "user", f"turn {t}") for c in (0, 1, 5) for t in range(100)]  # more turns than a block of columns
    rows += [(410 + c, t, "user", f"turn {t}" if t < 70 else f"{c}") for c in (0, 5) for t in range(72)]
    rows += [(500, None, "user", "first"), (500, 1, "a", "b"), (500, 1, "a", "b"), (500, 1, "ab", ""), (None, 1, "x", "y"), (-7, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    clash = df.selectExpr("*", "1 AS seq", "2 AS name", "3 AS depth", "4 AS key", "5 AS shard", "6 AS turns", "7 AS numbered")
    for table in (df, clash):
        got = as_rows(trie.trie(trie.grafted(trie.sequences(table)), shard_turns=40))
        assert got == brute_trie(rows)
    assert as_rows(trie.trie(trie.sequences(df))) == brute_trie(rows, graft=False)
    assert trie.trie(trie.grafted(trie.sequences(df.limit(0)))).count() == 0


def test_trie_of_turnless_conversations(spark):
    # 13: h is 5, its base 10 is absent and it has one turn, so nothing is left of it
    rows = [(c, 0, "user", "gone") for c in range(1000) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = as_rows(trie.trie(trie.grafted(trie.sequences(df))))
    assert got == brute_trie(rows) and len(got) == 1


@pytest.mark.parametrize("values", [
    list(range(1, 40)),
    [1 + 1e-9 * k for k in range(8)] + [2, 3, 4],  # clusters that float32 can't tell apart
    [1 + 1e-12 * k for k in range(4)] + [5 + 1e-7 * k for k in range(4)] + [3.0],
    [1, 1, 1, 2, 2, 3.0],
    [0, 0, 0, 1.0],
])
def test_refinement(values):
    wide = np.longdouble
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(0).normal(size=(n, n)))[0].astype(wide)
    for _ in range(3):
        q = q + q @ (np.eye(n) - q.T @ q) / 2
    a = (q * np.array(values, dtype=wide)) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.refined(a)
    assert np.abs(a @ x - x * e).max() < 1e-16 * max(values) and np.abs(x.T @ x - np.eye(n)).max() < 1e-15
    assert np.abs(e - np.sort(np.array(values, dtype=wide))[::-1]).max() < 1e-16 * max(values)


def brute_whitening(vectors):
    x = np.floor(np.stack(vectors).astype(float) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return x, n, s, e[::-1], u[:, ::-1]


def test_whitening_query(spark):
    data = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x, n, s, e, u = brute_whitening(data["embedding"])
    got = {(r.vec_id, r.component): r for r in QUERIES["op12_embedding_whitening"](spark, SF).collect()}
    assert len(got) == 4 * len(data)
    white = np.array([[got[i, c].whitened for c in (1, 2, 3, 4)] for i in data["vec_id"]])
    want = (x - s / n) @ u[:, :4] / np.sqrt(e[:4])
    sign = np.sign((white * want).sum(axis=0))
    assert np.abs(white * sign - want).max() < 1e-10
    for i, row in zip(data["vec_id"], x.astype(object)):
        r = got[i, 1]
        assert (r.n, r.deviation) == (n, sum((n * a - b) ** 2 for a, b in zip(row, s.tolist())))
    assert all(abs(r.explained - e[c - 1] / e.sum()) < 1e-12 and r.identity_error < 1e-10 for (_, c), r in got.items())


def test_whitening_edges(spark):
    kind = "vec_id long, embedding array<float>, label int"
    rng = np.random.default_rng(1)
    good = [(k, [float(v) for v in rng.normal(size=5)], 0) for k in range(40)]
    bad = [(100, None, 0), (101, [], 0), (102, [1.0, None, 0.0, 0.0, 0.0], 0), (103, [float("nan")] * 5, 0), (104, [float("inf")] * 5, 0),
           (105, [1e30] * 5, 0), (106, [1.0, 2.0], 0)]
    rows = good + good[:1] * 30 + [(None, good[1][1], None)] + bad
    df = spark.createDataFrame(rows, kind).selectExpr("*", "1 AS x", "2 AS n", "3 AS dim", "4 AS p", "5 AS at", "6 AS vector")
    out = whitening.whiten(df).collect()
    assert collections.Counter(r.vec_id for r in out) == collections.Counter({k: 4 for k in range(40)} | {0: 31 * 4, None: 4})
    assert {r.n for r in out} == {40} and max(r.identity_error for r in out) < 1e-10
    assert len({r.whitened for r in out if r.vec_id == 0}) == 4
    assert whitening.whiten(df.where("vec_id > 99")).where("vec_id <> 106").count() == 0
    empty = whitening.whiten(df.limit(0))
    assert empty.count() == 0 and empty.columns == whitening.whiten(df).columns
    same = whitening.whiten(spark.createDataFrame([(k, [0.5, -0.0, 2.0], 0) for k in range(6)], kind)).collect()
    assert len(same) == 18 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, 0.0, 0.0, 0.0)}


def test_whitening_of_large_entries(spark):
    """Entries beyond the exact products, deviations beyond a long, and zero variance in some dimensions."""
    rng = np.random.default_rng(2)
    vectors = [[float(v) for v in np.append(rng.integers(-2**40, 2**40, 3), [7.0, 7.0])] for _ in range(50)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    x, n, s, e, u = brute_whitening(vectors)
    out = whitening.whiten(df).collect()
    assert all(r.deviation is None for r in out) and max(r.identity_error for r in out) < 1e-10
    got = {(r.vec_id, r.component): r.whitened for r in out}
    want = (x - s / n) @ u[:, :3] / np.sqrt(e[:3])
    white = np.array([[got[k, c] for c in (1, 2, 3)] for k in range(50)])
    assert np.abs(np.abs(white) - np.abs(want)).max() < 1e-8
    assert {v for (_, c), v in got.items() if c == 4} == {0.0}
    near = [(1 << 31) + d for d in (-3, 0, 5)]  # sums of squares on both sides of 2^63
    assert whitening._deviations(np.array([[v, v] for v in near]), 1, [0, 0]) == [2 * near[0] ** 2, None, None]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))


@pytest.fixture(scope="module")
def encoder():
    return pieces.public_encoder(PIECES)


def assert_like_library(encoder, library, texts):
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode(text or "", add_eos=True)
        assert encoder.decode(ids) == library.decode(ids.tolist())


def test_piece_query(spark, library):
    got = {r.doc_id: r for r in QUERIES["op13_piece_codec"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_eos=True)
        r = got[doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_like_the_library(encoder, library):
    rng = random.Random(5)
    edge = ["", None, " ", "  ", "▁", "▁a", "a▁", " a  b ", "\n\n", "<s></s><0x41>", "é日 😀 \x00  ", "a" * 9999, " " * 5000 + "x", "ab" * 50_000]
    assert_like_library(encoder, library, edge)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert_like_library(encoder, library, ["".join(every[i:i + 400]) for i in range(0, len(every), 400)])
    known = [p for p, k in zip(encoder.pieces, encoder.kind) if k == pieces.NORMAL]
    odd = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x3000), rng.randrange(0x4E00, 0x9FFF), rng.randrange(0x10000, 0x1FFFF)]))
    assert_like_library(encoder, library, [
        "".join(rng.choice([rng.choice(known), odd(), "er", " "]) for _ in range(rng.randrange(50))) for _ in range(1500)
    ])
    # words without spaces, also beyond the size that is merged alone
    assert_like_library(encoder, library, ["".join(rng.choices("aehinorstxz", k=k)) for k in (5, 50, 500, 3000, 20_000) for _ in range(6)])


def test_pieces_decode_any_ids(encoder, library):
    rng = random.Random(6)
    for _ in range(400):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randrange(8))]
        assert encoder.decode(ids) == library.decode(ids)
    with pytest.raises(ValueError):
        encoder.decode([32_000])


def naive_bpe(word, score):
    parts = list(word)
    while True:
        best = max(((score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score), default=None)
        if best is None:
            return parts
        i = -best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_merge_rounds_of_any_vocabulary():
    """Vocabularies in no merge order, with equal scores: a merge may make a pair that comes before those left."""
    rng = random.Random(7)
    for _ in range(150):
        vocab = list(dict.fromkeys("".join(rng.choices("abc", k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 25))))
        scores = np.array([float(-rng.randrange(12)) for _ in vocab])
        rounds = pieces.MergeRounds(vocab, scores, np.ones(len(vocab), dtype=bool))
        words = ["".join(rng.choices("abcd", k=rng.randrange(1, 40))) for _ in range(30)]
        symbol, count = rounds.merge(words)
        name = lambda s: vocab[s] if s < len(vocab) else chr(s - len(vocab))
        score = dict(zip(vocab, scores))
        for word, part in zip(words, np.split(symbol, np.cumsum(count)[:-1])):
            assert [name(s) for s in part.tolist()] == naive_bpe(word, score)


def test_piece_columns(spark, encoder, library):
    from pyspark.sql import functions as F

    rows = [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' AS ids", "1 AS n_tokens")
    out = pieces.encode(df, encoder).withColumn("back", pieces.decode(F.col("ids"), encoder)).collect()
    assert collections.Counter((r.doc_id, r.text, r.back) for r in out) == collections.Counter((i, t, t or "") for i, t in rows)
    assert all(r.ids == library.encode(r.text or "", add_eos=True) for r in out)
    assert pieces.encode(df.limit(0), encoder).count() == 0
    bare = pieces.encode(df, encoder, end=False).where("doc_id = 2").first().ids
    assert list(bare) == []


def test_refused_models():
    with pytest.raises(ValueError):
        pieces.Encoder(b"\x0a\x05\x0a\x01a\x18\x01")  # a unigram model of one piece


def test_frames_of_a_shard_keep_every_row():
    conv = np.arange(300)
    seqs = [bytes([k % 7]) * trie.RECORD + bytes([k % 3]) * trie.RECORD for k in conv]
    rows = pd.concat(trie.shard_rows(conv, seqs, 4))
    nodes = rows[rows.kind == trie.NODE]
    paths = rows[(rows.kind == trie.PATH) & ~rows.shared.fillna(False).astype(bool)]
    assert len(nodes) + len(paths) == 1 + 7 + 21 and set(rows.shard) == {4}
