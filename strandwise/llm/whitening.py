"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows ``C`` stay where they are. Each step is two passes over them, ``C v`` and
``C' u``; what comes back are sums as long as a row. The left vectors ``u`` are as long as
the table and never stored: every one is ``C w`` for a short ``w``, so a task makes its own
part of all of them from its rows again, and a lost executor loses nothing. Both sides are
orthogonalised against all earlier vectors, twice. The singular values and right vectors of
the small bidiagonal matrix give the deviations and the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import written

#: x = floor(SCALE * c) + SHIFT
SCALE, SHIFT = 64, 1_000_000
#: Rows in one stored block.
BLOCK = 4096
#: A vector is done when what the bidiagonal matrix leaves open is less, as a share of the largest singular value.
DONE = 1e-14
#: Less than this, as a share of the largest singular value, is no direction of its own.
NOTHING = 1e-12
SEED = 42


def whole_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is not null and holds only finite numbers, with ``_x``, the vector as longs."""
    value = F.col(vector).cast("array<double>")
    fine = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.where(F.col(vector).isNotNull() & fine)
    return kept.withColumn("_x", F.transform(value, lambda c: F.floor(c * SCALE) + F.lit(SHIFT)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def _sums(rows: DataFrame, kind: str, start: Callable[[], np.ndarray], add: Callable[[np.ndarray, pa.RecordBatch], None]) -> np.ndarray:
    """Adds up one array over all tasks of ``rows``; its entries are summed by Spark, the driver gets the sums."""
    size = start().size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = start()
        for batch in batches:
            add(total, batch)
        yield pa.record_batch([pa.array(np.arange(size)), pa.array(total.ravel())], ["at", "value"])

    got = rows.mapInArrow(run, f"at long, value {kind}").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = start()
    out.ravel()[got["at"].to_numpy()] = got["value"].to_numpy()
    return out


@dataclass
class Centred:
    """``n`` rows of ``d`` longs in blocks, their sums and the exact sum of ``(n x - sum)^2``."""

    blocks: DataFrame
    n: int
    sums: np.ndarray

    @property
    def d(self) -> int:
        return len(self.sums)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred before anything is multiplied; exact up to the one division."""
        return (x * self.n - self.sums) / self.n

    def products(self, basis: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """With ``U = C basis`` and ``u`` its last column: ``C' u`` (where ``back``) and ``U' u``."""
        d, k = basis.shape

        def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
            for block in batch.column(0):
                c = self.rows(np.frombuffer(block.as_buffer(), "<i8").reshape(-1, d))
                left = c @ basis
                if back:
                    total[:d] += left[:, -1] @ c
                total[d:] += left[:, -1] @ left

        blocks, self.blocks = self.blocks, None  # the function goes to the tasks with this object
        try:
            total = _sums(blocks, "double", lambda: np.zeros(d + k), add)
        finally:
            self.blocks = blocks
        return total[:d], total[d:]


def centred(x: DataFrame) -> Centred:
    """``x`` has one column of arrays of longs, all of one length."""
    name = x.columns[0]
    shape = x.agg(F.count("*").alias("n"), F.min(F.size(name)).alias("low"), F.max(F.size(name)).alias("d")).first()
    if shape.n and shape.low != shape.d:
        raise ValueError(f"vectors of {shape.low} and of {shape.d} numbers in one table")
    d = shape.d or 0

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        total += _matrix(batch.column(0), d).sum(axis=0)

    sums = _sums(x, "long", lambda: np.zeros(d, np.int64), add) if d else np.zeros(0, np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = _matrix(batch.column(0).slice(first, BLOCK), d)
                yield pa.record_batch([pa.array([np.ascontiguousarray(part, "<i8").tobytes()], pa.binary())], ["block"])

    return Centred(written(x.mapInArrow(pack, "block binary")) if d else x.select(F.lit(b"").alias("block")), shape.n, sums)


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def bidiagonalise(rows: Centred, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of the centred rows, ``wanted`` at most and none that is nothing, and their right vectors as columns.

    ``C V = U B`` with ``B`` upper bidiagonal grows by a column each step, until the wanted
    values no longer depend on what is left out or the rows' dimension is reached. Where a
    direction is used up, a new random one begins the next block.
    """
    d, random = rows.d, np.random.default_rng(SEED)

    def fresh(basis: list[np.ndarray]) -> np.ndarray:
        v = _orthogonal(random.standard_normal(d), basis)
        return v / np.linalg.norm(v)

    v, left, back = [fresh([])], np.zeros((d, 0)), np.zeros((d, 0))
    alpha, beta, scale = [], [], 0.0
    while True:
        k = len(v) - 1
        w = v[k] - (beta[-1] * left[:, -1] if beta and beta[-1] else 0)
        _, dots = rows.products(np.column_stack([left, w]), back=False)
        w = w - left @ dots[:-1]
        t, dots = rows.products(np.column_stack([left, w]), back=True)
        w, t = w - left @ dots[:-1], t - back @ dots[:-1]
        a = float(np.sqrt(max(dots[-1] - dots[:-1] @ dots[:-1], 0.0)))
        scale = max(scale, a, beta[-1] if beta else 0.0)
        if a <= NOTHING * scale:
            a, w, t = 0.0, np.zeros(d), np.zeros(d)
        else:
            w, t = w / a, t / a
        left, back = np.column_stack([left, w]), np.column_stack([back, t])
        alpha.append(a)
        following = _orthogonal(t - a * v[k], v)
        b = float(np.linalg.norm(following))
        p, sigma, q = np.linalg.svd(np.diag(alpha) + np.diag(beta, 1))
        open_ = np.abs(p[-1]) * b
        if len(v) == d or (len(v) >= wanted and b > NOTHING * scale and (open_[:wanted] <= DONE * sigma[0]).all()):
            break
        if b <= NOTHING * scale:
            beta.append(0.0)
            v.append(fresh(v))
        else:
            beta.append(b)
            v.append(following / b)
    kept = int((sigma[:wanted] > NOTHING * max(sigma[0], np.finfo(float).tiny)).sum())
    return sigma[:kept], np.column_stack(v) @ q[:kept].T


def whiten(rows: DataFrame, components: int = 32, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each vector and component.

    An entry c becomes ``floor(64 c) + 1000000``. Components are the unit eigenvectors of the
    covariance (divisor n) of these, numbered from 1 by falling eigenvalue; ``whitened`` is
    the centred vector's projection over the eigenvalue's root, ``explained`` the
    eigenvalue's share of the trace, ``deviation`` the vector's exact sum of ``(n x - S)^2``,
    ``identity_error`` the largest entry by which the covariance of ``whitened`` over all
    vectors misses the identity.

    Vectors that are null or hold null or non-finite entries are left out. Repeated rows
    and ids count as vectors of their own; further columns are ignored. Directions in which
    nothing varies have no whitened value: they get no rows, so equal vectors alone, a
    single vector, vectors without entries and an empty table give none. Vectors of
    different lengths raise ``ValueError``; entries or deviations beyond a long raise.
    """
    kept = written(whole_vectors(rows.select(vec_id, vector), vector).select(F.col(vec_id).alias("_id"), "_x"))
    c = centred(kept.select("_x"))
    kind = dict(rows.dtypes)[vec_id]
    sigma, right = bidiagonalise(c, min(components, c.d)) if c.n and c.d else (np.zeros(0), np.zeros((0, 0)))
    d, k, n = c.d, len(sigma), c.n
    project = right / (sigma / np.sqrt(n)) if k else right
    centre = Centred(None, n, c.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                x = _matrix(part.column(1), d)
                far = x * n - centre.sums
                if d * float(np.abs(far).max()) ** 2 >= 2.0**62:
                    far = far.astype(object)  # whole numbers of any size; pyarrow refuses what is no long
                z = centre.rows(x) @ project
                ends = np.arange(0, z.size + 1, k, dtype=np.int32)
                yield pa.record_batch(
                    [part.column(0), pa.array((far * far).sum(axis=1).tolist(), pa.int64()), pa.ListArray.from_arrays(ends, z.ravel())],
                    ["id", "deviation", "z"])

    white = kept.limit(0) if not k else kept
    white = written(white.mapInArrow(run, f"id {kind}, deviation long, z array<double>"))
    worst, trace = 0.0, 1.0
    if k:
        def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
            z = _matrix(batch.column(0), k)
            total[0] += z.sum(axis=0)
            total[1:] += z.T @ z

        moments = _sums(white.select("z"), "double", lambda: np.zeros((k + 1, k)), add) / n
        worst = float(np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(k)).max())
        trace = float(white.agg(F.sum(F.col("deviation").cast("decimal(38,0)"))).first()[0]) / n**3
    share = F.array(*[F.lit(float(s)) for s in sigma**2 / n / trace]) if k else F.array().cast("array<double>")
    return white.select("*", F.posexplode("z").alias("at", "whitened")).select(
        F.col("id").alias(vec_id), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(worst).alias("identity_error"))
