"""Sums per (key, member) over packed lists, a key's best members kept, with Arrow and numpy inside the tasks.

Neighbors and recommendations are both sums of weight x value per (key, member), of which a key keeps its k best. The rows, each a key, a
weight and a packed list of (value, member), are dealt by key by Spark and sorted by it; a task then sums whole keys at a time (sort by
(key, member), ``reduceat``) and passes on one row per key. Of a key only members that may be among its k best pass, with a margin for the rounding
that ranks; Spark ranks them exactly, so ties, nulls and NaN are ordered as by a window. Rows that don't lie by key yet travel in
blocks: the rows of a task for one task of the next stage are one compressed Arrow batch, column after column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# List entries that a task sums at once, if they aren't all of one key.
CHUNK_ENTRIES = 250_000
# List entries of a task that are dealt to blocks at once, and that one task gets in blocks (about 6 bytes each).
BLOCK_ENTRIES = 4_000_000
TASK_ENTRIES = 8_000_000
# Keys of more list entries aren't summed in one go: the callers deal theirs by (key, member).
KEY_ENTRIES = 2_000_000
# Jobs of fewer entries in all stay with Spark's own aggregates: no Python worker is started for them.
FEW_ENTRIES = 2_000_000
# Members of a longest list; shorter blocks keep an Arrow batch small.
LIST_ROWS = 512

# Sums of a task that are passed on at once, one row each.
FLAT_ROWS = 100_000

_SUMS = "key bigint, members array<bigint>, sums array<double>, counts array<bigint>"
_STEPS = "key bigint, step int, members array<bigint>, sums array<double>, counts array<bigint>"
_FLAT = "key bigint, member bigint, sum double, count bigint, best double"
_OF_KEY = ("key", "weight", "mark_out", "own_place")  # arrays of them, where a list is for several keys
_NO_MEMBER = np.iinfo(np.int64).min  # stands for a null member inside a task


def _n_packed(columns: list[str], name: str) -> int:
    return 2 if f"{name}_1" in columns else 1


def _halves(batch: pa.Table, name: str, n: int) -> tuple[list[np.ndarray], np.ndarray | None]:
    """The flat values of the packed columns of ``name`` and which of them are null (None: none)."""
    values, gone = [], None
    for i in range(n):
        flat = pa.concat_arrays([c.flatten() for c in batch.column(f"{name}_{i}").chunks])
        if flat.null_count:
            null = flat.is_null().to_numpy(zero_copy_only=False)
            gone = null if gone is None else gone | null
            flat = flat.fill_null(0)
        values.append(flat.to_numpy(zero_copy_only=False))
    return values, gone


def _whole(values: list[np.ndarray]) -> np.ndarray:
    """The whole numbers of one packed column, or of a high and a low one."""
    high, *low = values
    if not low:
        return high.astype(np.int64)
    bits = 8 * low[0].dtype.itemsize
    return (high.astype(np.int64) << bits) | (low[0].astype(np.int64) & ((1 << bits) - 1))


def _numbers(batch: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray | None]:
    """``pairs.unpack`` of a packed column of doubles, in halves or of a narrow kind."""
    values, gone = _halves(batch, name, _n_packed(batch.column_names, name))
    unit = 1e6 if name == "sim" else 1.0
    if values[-1].dtype != np.float64:
        return _whole(values) / unit, gone
    first, rest = values
    return (first / unit if name == "sim" else first.astype(np.float64)) + rest, gone


def _members(batch: pa.Table, name: str) -> np.ndarray:
    values, gone = _halves(batch, name, _n_packed(batch.column_names, name))
    ids = _whole(values)
    return ids if gone is None else np.where(gone, _NO_MEMBER, ids)


def _column(batch: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray | None]:
    col = batch.column(name)
    if not col.null_count:
        return col.to_numpy(), None
    return pc.fill_null(col, 0).to_numpy(), pc.is_null(col).to_numpy()


def plain_value(cols: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray | None]:
    return cols[0]


def normed_value(cols: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray | None]:
    """r / sqrt(sq) of (r, sq); 0 where the norm is 0 or missing, as ``safe_div``."""
    (r, r_gone), (sq, sq_gone) = cols
    norm = np.sqrt(sq)
    zero = norm == 0 if sq_gone is None else (norm == 0) | sq_gone
    value = np.divide(r, norm, out=np.zeros_like(norm), where=~zero)
    return value, None if r_gone is None else r_gone & ~zero


def inverse_value(cols: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray | None]:
    """1 / x, of an x that isn't 0."""
    x, gone = cols[0]
    return 1.0 / (x if gone is None else np.where(gone, 1.0, x)), gone


def _among_best(group: np.ndarray, rank: np.ndarray, k: int, margin: float) -> np.ndarray:
    """Which entries may be among the k largest of their group."""
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    least = np.full(len(edge) - 1, -np.inf)
    for g in np.flatnonzero(np.diff(edge) > k):
        least[g] = np.partition(rank[edge[g]:edge[g + 1]], -k)[-k]
    slack = np.where(np.isfinite(least), margin + 1e-9 * np.abs(np.nan_to_num(least, posinf=0.0, neginf=0.0)), 0.0)
    return rank >= np.repeat(least - slack, np.diff(edge))


def _listed(keys: np.ndarray, group: np.ndarray, b: np.ndarray, sums: np.ndarray, n_rows: np.ndarray, empty: np.ndarray | None) -> list[pa.Array]:
    """The columns key, members, sums and counts of one row per group."""
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(edge, len(group)).astype(np.int32))
    values = [pa.array(b, mask=b == _NO_MEMBER), pa.array(sums, mask=empty), pa.array(n_rows.astype(np.int64))]
    return [pa.array(keys[group[edge]]), *[pa.ListArray.from_arrays(offsets, v) for v in values]]


def _step_sums(keys: np.ndarray, group: np.ndarray, b: np.ndarray, alive: np.ndarray, starts: np.ndarray, product: np.ndarray, known: np.ndarray,
               step: np.ndarray, steps: int, k: int, margin: float) -> pa.RecordBatch:
    """One row per step and key, of the sums over the entries up to that step; members of which none is known are left out."""
    parts = []
    for s in range(steps if len(starts) else 0):
        inside = known & (step <= s)
        n_rows = np.add.reduceat(inside, starts, dtype=np.int64)[alive]
        sums = np.add.reduceat(np.where(inside, product, 0.0), starts)[alive]
        some = n_rows > 0
        g, m, sums, n_rows = group[some], b[some], sums[some], n_rows[some]
        if len(g):
            best = _among_best(g, np.where(np.isnan(sums), np.inf, sums), k, margin)
            columns = _listed(keys, g[best], m[best], sums[best], n_rows[best], None)
            parts.append(pa.RecordBatch.from_arrays([columns[0], pa.array(np.full(len(columns[0]), s, np.int32)), *columns[1:]],
                                                    ["key", "step", "members", "sums", "counts"]))
    if not parts:
        return pa.RecordBatch.from_pylist([], pa.schema([("key", pa.int64()), ("step", pa.int32()), ("members", pa.list_(pa.int64())),
                                                         ("sums", pa.list_(pa.float64())), ("counts", pa.list_(pa.int64()))]))
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _sum_keys(batch: pa.Table, cols: list[str], member: str, value: Callable, k: int | None, margin: float, flat: bool = False,
              steps: int | None = None) -> pa.RecordBatch:
    """One row per key of ``batch``, whose rows of a key lie together, or with ``flat`` one per key and member, or one per key and each of ``steps``."""
    keys = batch.column("key").to_numpy()
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    code = np.cumsum(new) - 1
    lengths = pc.fill_null(pc.list_value_length(batch.column(f"{member}_0")), 0).to_numpy()
    row = np.repeat(np.arange(len(keys)), lengths)
    b = _members(batch, member)
    weight, weight_gone = _column(batch, "weight")
    x, gone = value([_numbers(batch, c) for c in cols])
    if weight_gone is not None:
        gone = weight_gone[row] if gone is None else gone | weight_gone[row]
    product = weight[row] * x
    if gone is not None:
        product[gone] = 0.0
    out = batch.column("all_out").to_numpy()[row]
    entry_code = code[row]
    if "own_place" in batch.column_names:  # an entry that the key doesn't take, wherever else its member stands
        place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        others = place != batch.column("own_place").to_numpy()[row]
        entry_code, b, product, out, gone = entry_code[others], b[others], product[others], out[others], None if gone is None else gone[others]
    # marked members join as entries of their own
    mark, no_mark = _column(batch, "mark_out")
    marked = np.arange(len(keys)) if no_mark is None else np.flatnonzero(~no_mark)
    group = np.concatenate((entry_code, code[marked]))
    b = np.concatenate((b, mark[marked]))
    product = np.concatenate((product, np.zeros(len(marked))))
    out = np.concatenate((out, np.ones(len(marked), bool)))
    counted = None if gone is None else np.concatenate((~gone, np.zeros(len(marked), bool)))
    if not len(b):
        group, b = group.astype(np.int64), b.astype(np.int64)
    low = int(b.min()) if len(b) else 0
    span = int(b.max()) - low + 1 if len(b) else 1
    if span * (int(code[-1]) + 1) < 1 << 62:
        order = np.argsort(group * span + (b - low))
    else:
        order = np.lexsort((b, group))
    group, b = group[order], b[order]
    starts = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (b[1:] != b[:-1])))) if len(b) else np.zeros(0, np.int64)
    kept, n_rows = starts, np.diff(np.append(starts, len(b)))
    if len(starts):
        alive = ~np.logical_or.reduceat(out[order], starts)
        kept = starts[alive]
        sums, n_rows = np.add.reduceat(product[order], starts)[alive], n_rows[alive]
        empty = None if counted is None else ~np.logical_or.reduceat(counted[order], starts)[alive]
    else:
        sums, empty = np.zeros(0), None
    group, b = group[kept], b[kept]
    if steps is not None:
        of_entry = _halves(batch, "step", 1)[0][0] if "step_0" in batch.column_names else _column(batch, "step")[0][row]
        step = np.concatenate((of_entry, np.zeros(len(marked), np.int8)))[order]
        known = np.ones(len(order), bool) if counted is None else counted[order]
        return _step_sums(keys[new], group, b, alive if len(starts) else kept, starts, product[order], known, step, steps, k, margin)
    if k is not None and len(group):
        rank = np.where(np.isnan(sums), np.inf, sums)
        if empty is not None:
            rank[empty] = -np.inf
        best = _among_best(group, rank, k, margin)
        group, b, sums, n_rows = group[best], b[best], sums[best], n_rows[best]
        empty = None if empty is None else empty[best]
    if flat:
        edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
        known = sums if empty is None else np.where(empty, -np.inf, sums)
        best = np.maximum.reduceat(known, edge) if len(edge) else np.zeros(0)  # NaN is the largest, as in Spark
        of = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(group))))
        none = None if empty is None or not len(edge) else np.logical_and.reduceat(empty, edge)[of]
        columns = [pa.array(keys[new][group]), pa.array(b, mask=b == _NO_MEMBER), pa.array(sums, mask=empty), pa.array(n_rows.astype(np.int64)),
                   pa.array(best[of], mask=none)]
        return pa.RecordBatch.from_arrays(columns, ["key", "member", "sum", "count", "best"])
    return pa.RecordBatch.from_arrays(_listed(keys[new], group, b, sums, n_rows, empty), ["key", "members", "sums", "counts"])


def _arrow_type(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow_type(kind[6:-1]))
    return {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64(),
            "boolean": pa.bool_()}[kind]


def _entries(batch: pa.RecordBatch | pa.Table, member: str) -> int:
    return (pc.sum(pc.list_value_length(batch.column(f"{member}_0"))).as_py() or 0) + batch.num_rows


def _cut(batches: Iterator[pa.RecordBatch], member: str, listed: bool) -> Iterator[pa.Table]:
    """The rows in tables of about ``BLOCK_ENTRIES`` entries, a list counted once per key it is for."""
    held, size = [], 0
    for batch in batches:
        each = 1 + pc.fill_null(pc.list_value_length(batch.column(f"{member}_0")), 0).to_numpy().astype(np.int64)
        upto = np.cumsum(each * pc.list_value_length(batch.column("key")).to_numpy() if listed else each)
        at, before = 0, 0
        while at < len(upto):
            end = max(at + 1, int(np.searchsorted(upto, before + BLOCK_ENTRIES - size, "right")))
            held.append(batch.slice(at, end - at))
            size += int(upto[end - 1]) - before
            at, before = end, int(upto[end - 1])
            if size >= BLOCK_ENTRIES or at < len(upto):
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _pieces(data: pa.Buffer, edges: list[int]) -> pa.Array:
    """The bytes between each two neighboring ``edges``, not copied (an array made of memoryviews would never be freed by Arrow)."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(np.array(edges, np.int32)), data])


def in_blocks(rows: DataFrame, member: str, n: int) -> DataFrame:
    """(at, block): ``rows`` dealt by ``key`` to ``n`` tasks, those that a task has for another as one compressed Arrow batch.

    A list for several keys comes once, with arrays of its keys and their weights (and ``mark_out`` or ``own_place``, where there is one); it is copied to
    each key's row here.
    """
    kinds = dict(rows.dtypes)
    listed = kinds["key"].startswith("array<")
    own = [c for c in _OF_KEY if c in kinds]
    schema = pa.schema([(c, _arrow_type(k[6:-1] if listed and c in own else k)) for c, k in rows.dtypes])

    def blocks(table: pa.Table) -> pa.RecordBatch:
        def flat(c: str) -> pa.Array:
            return pa.concat_arrays([x.flatten() if listed else x for x in table.column(c).chunks])

        at = flat("at").to_numpy()
        order = np.argsort(at, kind="stable")
        at = at[order]
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        row = np.repeat(np.arange(len(table)), pc.list_value_length(table.column("key")).to_numpy())[order] if listed else order
        copied = table.select([c for c in schema.names if c not in own]).combine_chunks().take(pa.array(row)).combine_chunks()
        columns = [flat(f.name).take(pa.array(order)) if f.name in own else copied.column(f.name).chunk(0) for f in schema]
        batch = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as out:
            out.write_batch(batch.slice(0, 0))  # the schema is written with the first batch and not sent
            edges = [sink.tell()]
            for lo, hi in zip(starts, np.append(starts[1:], len(at))):
                out.write_batch(batch.slice(lo, hi - lo))
                edges.append(sink.tell())
        return pa.RecordBatch.from_arrays([pa.array(at[starts], pa.int32()), _pieces(sink.getvalue(), edges)], ["at", "block"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _cut((b for b in batches if b.num_rows), member, listed):
            yield blocks(table)

    def place(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    at = F.transform("key", place) if listed else place(F.col("key"))
    return rows.select("*", at.alias("at")).mapInArrow(dealt, "at int, block binary").repartitionById(n, F.col("at"))


def list_sums(rows: DataFrame, cols: list[str], member: str, value: Callable = plain_value, k: int | None = None, digits: int = 6,
              n: int | None = None, flat: bool = False, steps: int | None = None) -> DataFrame:
    """(key, members, sums, counts), one row per key: the sums of weight x value per member, and how many entries each has.

    With ``flat``, (key, member, sum, count, best), one row per key and member, with ``best`` the key's largest sum. With ``steps``, (key, step, members, sums,
    counts), one row per key and step from 0, of the entries whose ``step`` (packed like them, or one of the row) is no larger, without sums of which no product is known.

    ``rows``, dealt by ``key`` (long, not null), or with ``n`` to be dealt by it to so many tasks (see ``in_blocks``), hold ``weight`` (double), the
    packed ``cols`` (doubles) and ``member`` (long), ``mark_out``, a member that the key doesn't take (or null; without the column, the key itself), and
    ``all_out``, whether it takes none of the list's. A column ``own_place`` has instead the place of the one entry that the key doesn't take (-1: none). A sum is null if none of its products is known. With ``k``, members that can't be among
    the k largest sums, rounded to ``digits`` places, are left out.
    """
    margin = 2.0 * 10.0 ** -digits
    packed = [f"{c}_{i}" for c in [*cols, member] for i in range(_n_packed(rows.columns, c))]
    packed += [c for c in ("step", "step_0") if c in rows.columns]
    marked = [c for c in ("mark_out", "own_place") if c in rows.columns]
    rows = rows.select("key", "weight", *marked, "all_out", *packed)
    schema = pa.schema([(c, _arrow_type(kind[6:-1] if c in _OF_KEY and kind.startswith("array<") else kind)) for c, kind in rows.dtypes])

    def of(table: pa.Table) -> pa.RecordBatch:
        if "mark_out" not in marked:
            table = table.append_column("mark_out", pa.nulls(len(table), pa.int64()) if marked else table.column("key"))
        return _sum_keys(table, cols, member, value, k, margin, flat, steps)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in sums_of(batches):
            for at in range(0, done.num_rows, FLAT_ROWS) if flat else [0]:
                yield done.slice(at, FLAT_ROWS) if flat else done

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += _entries(batch, member)
            if size >= CHUNK_ENTRIES:
                table = pa.Table.from_batches(held)
                keys = table.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield of(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = sum(_entries(t, member) for t in held)
        if held:
            yield of(pa.Table.from_batches(held))

    def sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [pa.ipc.read_record_batch(pa.py_buffer(b.as_py()), schema) for batch in batches for b in batch.column("block")]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        step = max(1, len(order) * CHUNK_ENTRIES // (4 * _entries(table, member)))
        for at in range(0, len(order), step):
            yield from table.take(pa.array(order[at:at + step])).to_batches()

    out = _FLAT if flat else _STEPS if steps else _SUMS
    if n is None:
        return rows.sortWithinPartitions("key").mapInArrow(summed, out)
    return in_blocks(rows, member, n).mapInArrow(lambda batches: summed(sorted_rows(batches)), out)


def best_of(lists: DataFrame, key: str, member: str, score: Callable[[Column], Column], order: Callable[[Column, Column], list[Column]], k: int,
            names: dict, by: tuple = ()) -> DataFrame:
    """The k first members of each list, by ``order(score, member)`` descending: (by, key, member, <names>, rank, best) with ``best`` the largest sum kept.

    ``names``: what ``score``, ``sum`` and ``count`` are called in the result.
    """
    entries = F.transform(F.arrays_zip("members", "sums", "counts"), lambda e: F.struct(
        *[o.alias(f"o{i}") for i, o in enumerate(order(score(e["sums"]), e["members"]))],
        score(e["sums"]).alias("score"), e["members"].alias("member"), e["sums"].alias("sum"), e["counts"].alias("count")))
    cut = lists.select(*by, F.col("key").alias(key), F.slice(F.sort_array(entries, asc=False), 1, k).alias("_e"))
    flat = cut.select(*by, key, F.array_max(F.col("_e.sum")).alias("best"), F.posexplode("_e").alias("_at", "_b"))
    return flat.select(*by, key, F.col("_b.member").alias(member), *[F.col(f"_b.{c}").alias(n) for c, n in names.items()],
                       (F.col("_at") + 1).alias("rank"), "best")
