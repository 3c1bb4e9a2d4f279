"""Whitening of vectors: components of their covariance by QDWH spectral divide and conquer, then one broadcast projection.

Entries become integers, x = floor(scale * c) + offset, so counts and sums are exact.  The covariance (divisor n,
centred by the exact mean before multiplying) comes from one matrix a task, added up in two rounds of groups of
bounded size.  The driver holds matrices of dimension x dimension only (``MAX_DIMS``).

The polar factor U of the shifted covariance V - sI is the sign of its eigenvalues: (U + I) / 2 projects on those above s.  U comes
from the dynamically weighted Halley iteration (by QR while the matrix is ill-conditioned, then by Cholesky).
Orthonormal bases of the projector's range and of its complement split V into two smaller blocks, each again
split, until blocks are single entries or multiples of the identity.  Of a block below enough components nothing more is asked.

Cases: vectors that are null, empty, or hold null or non-finite entries take no part, nor do vectors of another length than the most
frequent one (of equally frequent ones the longest); repeated rows count each; components without variance (eigenvalue
at rounding level) are left out, so equal vectors, a single one, or an empty table give no components; vectors of equal eigenvalues are some
orthonormal basis of their space; entries whose integer is over 2**53 and deviations over 64 bits are
errors; the input's columns, of any name, come back in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.llm.topk import usable

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
MAX_DIMS, SLICE_CELLS, GROUPS = 4096, 1 << 21, 1024
EPS = float(np.finfo(float).eps)
EXACT = float(1 << 53)


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by the QDWH iteration."""
    n, eye = len(a), np.eye(len(a))
    x = a / np.linalg.norm(a, 1)
    low = EPS / n  # a lower bound of the least singular value; the iteration's weights follow from it alone
    for _ in range(30):
        sq = low * low
        d = np.cbrt(4 * (1 - sq) / (sq * sq))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - sq) / (sq * root))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            z = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(z, x.T)
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(z.T, half).T
        x = (x + x.T) / 2
        low = min(1.0, low * (wa + wb * sq) / (1 + wc * sq))
        if low > 1 - 10 * EPS and np.linalg.norm(x - before) <= np.cbrt(4 * EPS) * np.sqrt(n):
            break
    return x


def _shifts(a: np.ndarray, spread: float) -> list[float]:
    """Where to split: the middle of the diagonal; the mean always lies between two different eigenvalues."""
    mean = float(np.trace(a)) / len(a)
    return [float(np.median(np.diag(a))), mean, *[mean + f * spread for f in (-.05, .05, -.3, .3, -.01, .01, -.7, .7)]]


def _split(a: np.ndarray, size: float) -> tuple[np.ndarray, int]:
    """Orthogonal matrix whose first columns span the upper invariant subspace, and their number."""
    m = len(a)
    spread = float(np.linalg.norm(a - np.eye(m) * (np.trace(a) / m))) / np.sqrt(m)
    best = None
    for shift in _shifts(a, spread):
        p = (polar(a - shift * np.eye(m)) + np.eye(m)) / 2
        k = int(round(float(np.trace(p))))
        if not 0 < k < m:
            continue
        y = p @ np.random.default_rng(m).standard_normal((m, k))
        for _ in range(2):
            y = p @ np.linalg.qr(y)[0]
        q = np.linalg.qr(y, "complete")[0]
        left = float(np.linalg.norm(q[:, :k].T @ a @ q[:, k:]))
        if best is None or left < best[0]:
            best = left, q, k
        if left <= 4 * m * EPS * size:
            break
    if best is None or best[0] > 1e-9 * size:
        raise ArithmeticError("the spectrum could not be split")
    return best[1], best[2]


def spectrum(a: np.ndarray, want: int | None = None, size: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues (all by default), falling, and unit eigenvectors as columns."""
    m = len(a)
    want = m if want is None else min(want, m)
    size = float(np.linalg.norm(a)) if size is None else size
    if m == 1 or np.linalg.norm(a - np.eye(m) * (np.trace(a) / m)) <= EPS * size:
        values, vectors = np.diag(a).copy(), np.eye(m)
    else:
        q, k = _split(a, size)
        parts = []
        for cols, n in ((q[:, :k], want), (q[:, k:], max(0, want - k))):
            if n:
                block = cols.T @ a @ cols
                e, v = spectrum((block + block.T) / 2, n, size)
                parts.append((e, cols @ v))
        values, vectors = np.concatenate([e for e, _ in parts]), np.hstack([v for _, v in parts])
    order = np.argsort(-values, kind="stable")[:want]
    return values[order], vectors[:, order]


@dataclass
class Fit:
    """What the driver knows of the fit: the sums are exact; ``directions`` has a column for each component."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def _points(column: pa.Array, scale: int, offset: int):
    """Integer vectors of consecutive rows, by slices: first row, rows x dimension."""
    lens = column.value_lengths().to_numpy()
    step = max(1, SLICE_CELLS // max(1, int(lens.max(initial=1))))
    for lo in range(0, len(column), step):
        part = column.slice(lo, step)
        x = np.floor(part.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
        if x.size and np.abs(x).max() >= EXACT:
            raise ValueError("an entry is over 2**53 after scaling")
        yield lo, x.astype(np.int64) + offset, lens[lo:lo + step]


def _totals(vectors: DataFrame, scale: int, offset: int) -> tuple[int, int, list[int]]:
    """Most frequent length, number of such vectors, their exact sums by dimension."""
    def run(batches):
        sums: dict[int, list] = {}
        for b in batches:
            for _, flat, lens in _points(b.column(0), scale, offset):
                owner = np.repeat(lens, lens)
                for dim in np.unique(lens).tolist():
                    got = sums.setdefault(dim, [0, [0] * dim])
                    high, low = np.divmod(flat[owner == dim].reshape(-1, dim), 1 << 31)  # no 64-bit sum overflows
                    got[0] += int((lens == dim).sum())
                    got[1] = [s + (int(h) << 31) + int(x) for s, h, x in zip(got[1], high.sum(0), low.sum(0))]
        for dim, (n, total) in sums.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([dim] * dim, pa.int32()), "at": pa.array(range(dim), pa.int32()), "n": pa.array([n] * dim, pa.int64()),
                "total": pa.array(total, pa.decimal128(38, 0))})

    rows = vectors.mapInArrow(run, "dim int, at int, n long, total decimal(38,0)").groupBy("dim", "at").agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
    top = rows.where("at = 0").agg(F.max(F.struct("n", "dim")).alias("m")).first()["m"]
    if top is None:
        return 0, 0, []
    if top["dim"] > MAX_DIMS:
        raise ValueError(f"vectors have {MAX_DIMS} dimensions at most")
    got = rows.where(F.col("dim") == top["dim"]).orderBy("at").collect()  # one row a dimension
    return top["dim"], top["n"], [int(r["total"]) for r in got]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n: whole part of the mean first, which is exact."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s - n * (s // n)) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def _gram(vectors: DataFrame, size: int, rows_of) -> np.ndarray:
    """Sum of the outer products of the rows that ``rows_of(batch)`` gives: a matrix a task, added up in two rounds."""
    schema = "i int, part long, v array<double>"

    def table(i, part, matrix):
        flat = pa.array(np.ascontiguousarray(matrix).reshape(-1))
        return [pa.array(i, pa.int32()), pa.array(part, pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, size * len(i) + 1, size), pa.int32()), flat)]

    def run(batches):
        from pyspark import TaskContext

        total, any_ = np.zeros((size, size)), False
        for b in batches:
            for y in rows_of(b.column(0)):
                total += y.T @ y
                any_ = True
        if any_:
            part = TaskContext.get().partitionId() % GROUPS
            yield pa.RecordBatch.from_arrays(table(range(size), [part] * size, total), ["i", "part", "v"])

    def add(key, got):
        v = got["v"].combine_chunks().flatten().to_numpy().reshape(-1, size)
        order = np.lexsort(v.T[::-1]) if len(v) > 1 else slice(None)  # the same sum whatever order they arrive in
        return pa.table(table([key[0].as_py()], [0], v[order].sum(0)), ["i", "part", "v"])

    rows = vectors.mapInArrow(run, schema).groupBy("i", "part").applyInArrow(add, schema).groupBy("i").applyInArrow(add, schema)
    out = np.zeros((size, size))
    for r in rows.collect():  # one row a dimension
        out[r["i"]] = r["v"]
    return (out + out.T) / 2


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int | None = COMPONENTS, scale: int = SCALE,
        offset: int = OFFSET) -> Fit | None:
    """Exact sums, the largest ``components`` (all if None) and how far whitened vectors are from unit covariance."""
    src = vectors.where(usable(F.col(f"`{vector_col}`"))).select(F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    dim, n, sums = _totals(src, scale, offset)
    if not n:
        return None
    src = src.where(F.size("v") == dim)

    def centred(column):
        return (_centred(x.reshape(-1, dim), n, sums) for _, x, _ in _points(column, scale, offset))

    v = _gram(src, dim, centred) / n
    total = float(np.trace(v))
    values, directions = spectrum(v, components) if total > 0 else (np.zeros(0), np.zeros((dim, 0)))
    some = values > dim * EPS * values.max(initial=0.0)
    values, directions = values[some], directions[:, some]
    out = Fit(n, sums, values, directions / np.sqrt(values), values / total if total > 0 else values)
    if len(values):
        w = out.directions
        out.identity_error = float(np.abs(_gram(src, len(values), lambda c: (x @ w for x in centred(c))) / n - np.eye(len(values))).max())
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Sum over dimensions of (n * x - sums)^2, exactly."""
    rough = ((x.astype(np.float64) * n - np.array(sums, np.float64)) ** 2).sum(1)
    if np.abs(x).max(initial=0) * float(n) < 2.0**61 and max(map(abs, sums)) < 1 << 61 and rough.max(initial=0) < 2.0**62:
        diff = x * n - np.array(sums, np.int64)
        return (diff * diff).sum(1)
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    if max(exact) >= 1 << 63:
        raise OverflowError("a deviation is over 64 bits")
    return np.array(exact, np.int64)


def whiten(vectors: DataFrame, model: Fit | None, vector_col: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``row`` (struct of the input's columns), ``deviation`` and ``whitened`` (an entry for each component)."""
    col = F.col(f"`{vector_col}`")
    dim = len(model.sums) if model else -1
    src = vectors.where(usable(col) & (F.size(col) == dim)).select(
        F.struct(F.struct("*")).alias("row"), col.cast("array<double>").alias("v"))
    schema = T.StructType([src.schema["row"], *T.StructType.fromDDL("deviation long, whitened array<double>").fields])
    sent = vectors.sparkSession.sparkContext.broadcast(model)  # dimension x components: size checked

    def run(batches):
        m = sent.value
        if m is None:  # no vectors
            return
        k = m.directions.shape[1]
        for b in batches:
            for lo, x, lens in _points(b.column(1), scale, offset):
                x = x.reshape(-1, dim)
                y = np.ascontiguousarray(_centred(x, m.n, m.sums) @ m.directions).reshape(-1)
                at = pa.array(np.arange(0, k * len(x) + 1, k) if k else np.zeros(len(x) + 1), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(lens)), pa.array(_deviations(x, m.n, m.sums)),
                                                  pa.ListArray.from_arrays(at, pa.array(y))], schema.names)

    inner = schema["row"].dataType.names[0]  # nested: no name of the input can clash
    return src.mapInArrow(run, schema).select(F.col("row").getField(inner).alias("row"), "deviation", "whitened")
