"""Embedding whitening by mixed-precision refinement of the covariance's eigenvectors.

1. Entries become whole numbers of 1/256 (``whole_vectors``); the fit list is each distinct vector once, a grouped
   aggregate over the vectors, so one that a third of all rows share is one point.
2. ``moments`` counts and sums the fit list, then sums the products of its entries less the rounded mean, block by
   block in the workers; Spark adds the blocks up as decimals. Entries are whole, so products and sums are exact
   whatever the partitions, and the covariance is right to the last bit of the driver's precision. (Entries
   more than 2^26 from the mean are multiplied in double precision instead.)
3. ``refined`` takes float32 eigenvectors and corrects them by Ogita and Aishima's iteration, matrix products in
   extended precision that square the error each round. Eigenvalues closer than the round can tell apart form a
   cluster, whose columns are only made orthogonal and then turned by the eigenvectors of the small
   matrix that they span, shifted by its mean.
4. Every row is projected by a map over the table.

The driver holds matrices of dimension x dimension, whatever the number of rows; the dimension is the table's
most common vector length (the longer on ties), meant to be at most about a thousand.

Defined results: rows whose vector is null, empty, of another length, or holds null, non-finite or larger entries than
``LARGEST`` / 256 are left out; null and repeated ids keep their rows; a table without vectors gives no rows.
Components that vary by no more than rounding (all vectors equal, a constant dimension) are whitened to 0, explain 0 of
a zero trace, and take no part in identity_error. A deviation beyond a long is null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import materialize

UNIT = 256
LARGEST = float(1 << 60)
#: Entries this far from the mean at most are multiplied exactly.
EXACT = 1 << 26
ROUNDS = 40
#: Precision of the refinement: 64 bits of mantissa on x86.
WIDE = np.longdouble


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the rows that remain."""
    slim = rows.select(F.col(vec_id).alias("vec_id"), (F.col(vector)).cast("array<double>").alias("vector"))
    fits = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * UNIT) <= LARGEST))
    usable = slim.where(F.coalesce((F.size("vector") > 0) & fits, F.lit(False)))
    return usable.select("vec_id", F.transform("vector", lambda c: F.floor(c * UNIT).cast("long")).alias("x"))


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.concatenate([np.zeros((0, dim), dtype=np.int64), *[np.stack(column.to_numpy())][:len(column)]])


def moments(points: DataFrame, dim: int):
    """(n, sums S, covariance) of ``points(x)``: an int, a list of ints, a matrix in ``WIDE`` precision."""

    def sums(batches):
        n, high, low, far = 0, np.zeros(dim, dtype=np.int64), np.zeros(dim, dtype=np.int64), np.zeros(dim, dtype=np.int64)
        for batch in batches:  # halves of 32 bits: no sum leaves a long
            x = _matrix(batch["x"], dim)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            far = np.maximum(far, np.abs(x).max(axis=0, initial=0))
        yield pd.DataFrame({"dim": range(dim), "n": n, "high": high, "low": low, "far": far})

    total = points.mapInPandas(sums, "dim int, n long, high long, low long, far long").groupBy("dim").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")], F.max("far").alias("far")
    ).orderBy("dim").collect()  # a row per dimension
    n = int(total[0].n) if total else 0
    if not n:
        return 0, [], np.zeros((dim, dim), dtype=WIDE)
    s = [(int(r.high) << 32) + int(r.low) for r in total]
    centre = np.array([(2 * v + n) // (2 * n) for v in s], dtype=np.int64)
    far = max(int(r.far) + abs(int(c)) for r, c in zip(total, centre))
    exact = far <= EXACT
    step = max(1, (1 << 52) // max(1, far * far)) if exact else 1 << 14
    upper = np.triu_indices(dim)

    def products(batches):
        whole, real, load = np.zeros((dim, dim), dtype=np.int64), np.zeros((dim, dim)), 0
        for batch in batches:
            y = (_matrix(batch["x"], dim) - centre).astype(np.float64)
            for lo in range(0, len(y), min(step, 1 << 14)):
                part = y[lo:lo + min(step, 1 << 14)]
                if not exact:
                    real += part.T @ part
                    continue
                if load + len(part) * far * far >= 1 << 62:
                    yield pd.DataFrame({"i": upper[0], "j": upper[1], "whole": whole[upper], "real": 0.0})
                    whole, load = np.zeros((dim, dim), dtype=np.int64), 0
                whole += (part.T @ part).astype(np.int64)  # below 2^53: exact in double precision
                load += len(part) * far * far
        yield pd.DataFrame({"i": upper[0], "j": upper[1], "whole": whole[upper], "real": real[upper]})

    cells = points.mapInPandas(products, "i int, j int, whole long, real double").groupBy("i", "j").agg(
        F.sum(F.col("whole").cast("decimal(20,0)")).alias("whole"), F.sum("real").alias("real")
    ).collect()  # a row per pair of dimensions
    v = np.zeros((dim, dim), dtype=WIDE)
    rest = [a - n * int(c) for a, c in zip(s, centre)]  # sums about the centre
    for r in cells:
        if exact:
            cell = WIDE(n * int(r.whole) - rest[r.i] * rest[r.j]) / WIDE(n) / WIDE(n)
        else:
            cell = WIDE(r.real) / n - WIDE(rest[r.i]) / n * (WIDE(rest[r.j]) / n)
        v[r.i, r.j] = v[r.j, r.i] = cell
    return n, s, v


def clusters(values: np.ndarray, width) -> list[np.ndarray]:
    """Numbers of the values, in runs of two or more that are no further than ``width`` from the next one."""
    order = np.argsort(values, kind="stable")
    runs = np.split(order, np.flatnonzero(np.diff(values[order]) > width) + 1)
    return [r for r in runs if len(r) > 1]


def refined(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; eigenvectors as columns) of a symmetric matrix, in ``WIDE`` precision."""
    a = np.asarray(a, dtype=WIDE)
    scale = np.abs(a).max(initial=0)
    if not scale:
        return np.zeros(len(a), dtype=WIDE), np.eye(len(a), dtype=WIDE)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    size = np.sqrt((a * a).sum())
    eps = np.finfo(WIDE).eps * len(a)
    last = np.inf
    stalled = 0
    for _ in range(ROUNDS):
        r = np.eye(len(a), dtype=WIDE) - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # their last bits, divided by a small gap, would spoil orthogonality
        value = np.diag(s) / (1 - np.diag(r))
        rest = s - np.diag(value)
        width = 2 * (np.sqrt((rest * rest).sum()) + size * np.sqrt((r * r).sum()))
        gap = value[None, :] - value[:, None]
        near = np.abs(gap) <= width
        e = np.where(near, r / 2, (s + value[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ e
        turned = 0.0
        for j in clusters(value, width):  # a sub-solve: the eigenvectors of the matrix that the cluster's columns span
            y = x[:, j]
            t = y.T @ (a @ y) - value[j].mean() * (y.T @ y)
            t = (t + t.T) / 2
            spread = np.abs(t).max()
            if spread > eps:
                q = np.linalg.eigh((t / spread).astype(np.float64))[1].astype(WIDE)
                for _ in range(2):  # orthogonal to the last bit
                    q = q + q @ (np.eye(len(j), dtype=WIDE) - q.T @ q) / 2
                x[:, j] = y @ q
                turned = max(turned, np.abs(np.abs(q).max(axis=0) - 1).max())
        change = max(np.abs(e).max(), turned)
        stalled = stalled + 1 if change >= last / 2 else 0
        if change <= eps or stalled == 3:  # done, or down to what the gaps let the precision tell
            break
        last = change
    for _ in range(2):  # very small gaps leave orthogonality short of the last bits
        x = x + x @ (np.eye(len(a), dtype=WIDE) - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(axis=0))
    value = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-value, kind="stable")
    x = x[:, order]
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(a))])
    return value[order] * scale, x * sign


def _deviations(x: np.ndarray, n: int, s: list[int]) -> list:
    """Sum over dimensions of (n * x - S)^2 of each row, exact; None beyond a long."""
    limit = 1 << 63
    reach = n * int(np.abs(x).max(initial=0)) + max(abs(v) for v in s)
    if reach < limit:
        d = n * x - np.array(s, dtype=np.int64)
        if len(s) * reach * reach < limit:
            return (d * d).sum(axis=1).tolist()
        about = (d.astype(np.float64) ** 2).sum(axis=1)
    else:
        d, about = x, np.zeros(len(x))
    out = []
    for row, sure in zip(d, about > 1.01 * limit):
        total = limit if sure else sum(v * v for v in (row.tolist() if reach < limit else [n * int(c) - t for c, t in zip(row, s)]))
        out.append(total if total < limit else None)
    return out


def whiten(rows: DataFrame, components: int = 4, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per remaining row and component.

    Components are unit eigenvectors of the fit list's covariance, numbered from 1 by falling eigenvalue, signed so that
    their largest entry is positive. ``identity_error``: the largest entry of the whitened fit list's covariance less the identity.
    """
    spark = rows.sparkSession
    out = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    x = materialize(whole_vectors(rows, vec_id, vector), "whitening-rows")
    length = x.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if length is None:
        return x.select("vec_id", F.inline(F.array().cast(f"array<struct<{out.replace(' ', ':').replace(',:', ',')}>>")))
    dim = length.dim
    x = x.where(F.size("x") == dim)
    points = materialize(x.select("x").distinct(), "whitening-points")
    n, s, v = moments(points, dim)
    values, vectors = refined(v)
    trace = np.trace(v)
    top = min(components, dim)
    moving = values[:top] > trace * dim * np.finfo(np.float64).eps
    axes = (np.where(moving, vectors[:, :top], 0) / np.sqrt(np.where(moving, values[:top], 1))).astype(np.float64)
    mean = np.array([WIDE(t) / n for t in s]).astype(np.float64)
    explained = [float(value / trace) if trace > 0 else 0.0 for value in values[:top]]

    def spread(batches):
        first, second = np.zeros(top), np.zeros((top, top))
        for batch in batches:
            w = (_matrix(batch["x"], dim) - mean) @ axes
            first += w.sum(axis=0)
            second += w.T @ w
        cells = [(i, j, second[i, j]) for i in range(top) for j in range(top)] + [(i, -1, first[i]) for i in range(top)]
        yield pd.DataFrame(cells, columns=["i", "j", "v"])

    cell = {(r.i, r.j): r.v for r in points.mapInPandas(spread, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    error = max([
        abs(cell[i, j] / n - cell[i, -1] / n * cell[j, -1] / n - (i == j)) for i in range(top) for j in range(top) if moving[i] and moving[j]
    ], default=0.0)

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(xs: pd.Series) -> pd.DataFrame:
        m = _matrix(xs, dim)
        return pd.DataFrame({"deviation": pd.array(_deviations(m, n, s), dtype="Int64"), "whitened": list((m - mean) @ axes)})

    projected = x.select("vec_id", project("x").alias("p")).select("vec_id", "p.deviation", F.posexplode("p.whitened").alias("at", "whitened"))
    share = F.element_at(F.array(*[F.lit(e) for e in explained]), F.col("at") + 1)
    return projected.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
