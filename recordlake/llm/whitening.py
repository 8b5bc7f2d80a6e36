"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The rows stay in a stored table of blocks. A step is one pass over them: with A the centred rows, a
task multiplies its block by a vector from the driver, y = A p, and that again by the block's
transpose, so what is summed up has as many numbers as a row. A left vector has an entry per row
and is never stored: it is A p for a vector p as long as a row, which the driver keeps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from recordlake.llm.batches import pa_type, quoted, stored

#: Bytes of a block of rows as 64-bit numbers.
BLOCK_BYTES = 1 << 22
#: Tasks that add the blocks' sums up.
SUM_TASKS = 8
#: Eigenvalues below this share of the largest count as zero: their components cannot be scaled.
RANK = 1e-10
#: What counts as nothing beside the largest singular value.
ROUNDING = 1e-13


def usable(vector: Column) -> Column:
    """Whether a vector is there, has entries, and has none that is null or not finite."""
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < infinite), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def fixed_point(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """Entries as whole numbers, floor(scale * c) + shift: their sums are exact in any order."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("bigint"))


def row_blocks(df: DataFrame, vector: str, key: str, scale: int, shift: int) -> DataFrame:
    """Usable vectors in fixed point, as a stored table of blocks: ``keys``, ``dims``, ``data``."""
    column = F.col(quoted(vector))
    rows = df.select(F.col(quoted(key)).alias("key"), column.alias("vector")).where(usable(F.col("vector")))
    rows = rows.select("key", fixed_point(F.col("vector"), scale, shift).alias("x"))
    key_type = df.schema[key].dataType
    fields = [("keys", ArrayType(key_type)), ("dims", IntegerType()), ("data", BinaryType())]
    schema = StructType([StructField(*field) for field in fields])
    arrow = pa.schema([(field.name, pa_type(field)) for field in schema])

    def run(batches):
        for batch in batches:
            keys, vectors = batch.column(0), batch.column(1)
            at = 0
            while at < batch.num_rows:
                dims = len(vectors[at])
                some = vectors.slice(at, max(1, BLOCK_BYTES // (8 * dims)))
                sizes = np.diff(some.offsets.to_numpy())
                same = int(np.argmax(sizes != dims)) or len(some)
                data = some.slice(0, same).flatten().to_numpy()
                row = {"keys": keys.slice(at, same).to_pylist(), "dims": dims, "data": data.tobytes()}
                yield pa.RecordBatch.from_pylist([row], arrow)
                at += same

    return stored(rows.mapInArrow(run, schema), "row-blocks")


@dataclass(frozen=True)
class Center:
    """Number of rows, and sums, least and greatest entries by dimension, all exact."""

    n: int
    sums: list[int]
    least: list[int]
    most: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        if self.n * max(map(abs, [*self.least, *self.most])) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n

    def squares(self, x: np.ndarray) -> list[int]:
        """The sum of squares of :meth:`deviations` of every row, exact."""
        off = self.deviations(x)
        reach = max(
            max(self.n * high - s, s - self.n * low)
            for s, low, high in zip(self.sums, self.least, self.most)
        )
        if len(self.sums) * reach * reach >= 1 << 63:
            off = off.astype(object)
        return (off * off).sum(1).tolist()


def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """Blocks one at a time: their row, its number in the batch, and the matrix."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k] for name in ("dims", "data")}
            data = np.frombuffer(row["data"].as_buffer(), np.int64)
            yield batch, k, data.reshape(-1, row["dims"].as_py())


def center_of(blocks: DataFrame) -> Center | None:
    """The exact centre of all rows, in one pass; None without rows."""

    def run(batches):
        total: dict[int, list] = {}
        for _, _, x in arrays(batches):
            found = [len(x), x.astype(object).sum(0), x.min(0), x.max(0)]
            if held := total.get(x.shape[1]):
                found = [held[0] + found[0], held[1] + found[1], np.minimum(held[2], found[2]), np.maximum(held[3], found[3])]
            total[x.shape[1]] = found
        for dims, (n, sums, least, most) in total.items():
            rows = {
                "dims": [dims] * dims, "place": list(range(dims)), "n": [n] * dims,
                "total": list(map(str, sums)), "least": least.tolist(), "most": most.tolist(),
            }
            yield pa.RecordBatch.from_pydict(rows, schema=arrow)

    arrow = pa.schema(
        [("dims", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("total", pa.string()),
         ("least", pa.int64()), ("most", pa.int64())]
    )
    found = blocks.select("dims", "data").mapInArrow(
        run, "dims int, place int, n bigint, total string, least bigint, most bigint"
    )
    lengths = found.select("dims").distinct().limit(2).collect()
    if len(lengths) > 1:
        raise ValueError("vectors of different lengths")
    if not lengths:
        return None
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    rows = (
        found.groupBy("place")
        .agg(F.sum("n").alias("n"), total, F.min("least").alias("least"), F.max("most").alias("most"))
        .orderBy("place")
        .collect()
    )
    return Center(rows[0]["n"], [int(r["total"]) for r in rows], [r["least"] for r in rows], [r["most"] for r in rows])


def summed(blocks: DataFrame, numbers: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of what ``numbers`` gives for each, a fixed count of numbers.

    A task adds its blocks up and sends one row per number; a few tasks add those.
    """

    def run(batches):
        total = None
        for _, _, x in arrays(batches):
            found = numbers(x)
            total = found if total is None else total + found
        if total is not None:
            columns = [pa.array(np.arange(len(total))), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "value"])

    found = blocks.select("dims", "data").mapInArrow(run, "place bigint, value double")
    rows = found.repartition(SUM_TASKS, "place").groupBy("place").agg(F.sum("value")).collect()
    return np.array([value for _, value in sorted(map(tuple, rows))])


@dataclass(frozen=True)
class Bidiagonal:
    """A V = U B with orthonormal columns, B upper bidiagonal; columns of U may be zero."""

    right: np.ndarray
    diagonal: np.ndarray
    above: np.ndarray

    def matrix(self) -> np.ndarray:
        return np.diag(self.diagonal) + np.diag(self.above, 1)


def orthogonal(w: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The part of a vector that is orthogonal to the columns of a basis; twice is enough."""
    for _ in range(2):
        w = w - basis @ (basis.T @ w)
    return w


def bidiagonalised(blocks: DataFrame, center: Center, wanted: int, complete: bool = True) -> tuple[Bidiagonal, float]:
    """Golub-Kahan-Lanczos steps with full reorthogonalisation of both kinds of vectors.

    Every step is a pass: y = A p, the products of y with all left vectors, and A'y. Where the
    vectors run out before the space does, as with eigenvalues of equal size, a new random
    direction starts anew. The steps end when no variance is left outside; or when the leading
    ``wanted`` singular triplets have converged, and all variance outside is less than the last
    of them, so that no direction was overlooked. ``complete=False`` leaves the latter away, which
    saves steps for long vectors and may miss one of several equal eigenvalues.

    Returns the bidiagonal form and the sum of squares of A.
    """
    d, rng = len(center.sums), np.random.default_rng(0)
    right, left, pulled = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    diagonal, above, squares = [], [], 0.0

    def fresh():
        w = orthogonal(rng.standard_normal(d), right)
        return w / np.linalg.norm(w)

    v, p = fresh(), None
    while True:
        p = v if p is None else p
        first = right.shape[1] == 0

        def products(x, p=p, left=left, first=first):
            a = center.centred(x)
            y = a @ p
            total = (a * a).sum() if first else 0.0
            return np.r_[total, y @ y, (a @ left).T @ y, a.T @ y]

        found = summed(blocks, products)
        if first:
            squares = found[0]
            if squares <= 0:
                return Bidiagonal(right, np.zeros(0), np.zeros(0)), 0.0
        k = right.shape[1]
        share, z = found[2 : 2 + k], found[2 + k :]
        right = np.c_[right, v]
        # The products with earlier left vectors should be zero: what is not is taken away.
        length = np.sqrt(max(0.0, found[1] - share @ share))
        floor = ROUNDING * np.sqrt(squares)
        if length > floor:
            p, z = (p - left @ share) / length, (z - pulled @ share) / length
        else:
            length, p, z = 0.0, np.zeros(d), np.zeros(d)
        diagonal.append(length)
        left, pulled = np.c_[left, p], np.c_[pulled, z]
        form = Bidiagonal(right, np.array(diagonal), np.array(above))
        outside = squares - np.square(diagonal).sum() - np.square(above).sum()
        if right.shape[1] == d or outside <= ROUNDING * squares:
            return form, squares
        w = orthogonal(z - length * v, right)
        beta = float(np.linalg.norm(w))
        if right.shape[1] >= wanted:
            u, sizes, _ = np.linalg.svd(form.matrix())
            converged = beta * np.abs(u[-1, :wanted]).max() <= ROUNDING * sizes[0]
            if converged and (not complete or outside < sizes[wanted - 1] ** 2):
                return form, squares
        if beta > floor:
            v, before = w / beta, p
            above.append(beta)
            p = v - beta * before
        else:
            above.append(0.0)
            v, p = fresh(), None


@dataclass(frozen=True)
class Whitening:
    """Centre, eigenvalues by falling size, unit components as columns, and the whole variance."""

    center: Center
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.center.centred(x) @ self.components / np.sqrt(self.eigenvalues)


def fitted(blocks: DataFrame, components: int = 32, complete: bool = True) -> Whitening | None:
    """The whitening of all rows of the blocks; None without rows.

    As many components as are asked for, or as have an eigenvalue above 1e-10 of the largest.
    """
    center = center_of(blocks)
    if center is None:
        return None
    wanted = min(components, len(center.sums))
    form, squares = bidiagonalised(blocks, center, wanted, complete)
    if not len(form.diagonal):
        return Whitening(center, np.zeros(0), np.zeros((len(center.sums), 0)), 0.0)
    _, sizes, turned = np.linalg.svd(form.matrix())
    eigenvalues = sizes[:wanted] ** 2 / center.n
    held = int((eigenvalues > RANK * eigenvalues[0]).sum())
    return Whitening(center, eigenvalues[:held], form.right @ turned[:held].T, squares / center.n)


def identity_error(blocks: DataFrame, whitening: Whitening) -> float:
    """The largest difference between the covariance of the whitened rows and the identity."""
    r, n = len(whitening.eigenvalues), whitening.center.n

    def numbers(x):
        w = whitening.project(x)
        return np.r_[w.sum(0), (w.T @ w).ravel()]

    found = summed(blocks, numbers)
    mean, second = found[:r] / n, found[r:].reshape(r, r) / n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(r)).max())


def whitened(
    df: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    components: int = 32,
    scale: int = 64,
    shift: int = 1_000_000,
    complete: bool = True,
) -> DataFrame:
    """Whitened coordinates of every usable vector, a row per vector and component.

    Vectors that are null or empty, or hold an entry that is null or not finite, are left out. The
    others enter as whole numbers x = floor(scale * c) + shift, so that sums over them are exact; an
    entry too large for a long fails the job, and so do vectors of different lengths.
    Components are unit eigenvectors of the covariance V of all x (divisor n), numbered from 1 by
    falling eigenvalue e; those with an eigenvalue below 1e-10 of the largest are left out, so a
    table without rows, with one row or with equal rows only has no rows in the result.

    Returns the key, ``component``, ``n``, ``deviation`` (sum over dimensions of (n*x - S)^2, exact,
    else the job fails; it fits a long while the root mean square of n*x - S over dimensions does a
    share of 3e9), ``whitened`` ((x - S/n) on the component, over sqrt(e)), ``explained``
    (e / trace(V)) and ``identity_error`` (largest entry of the whitened covariance minus the
    identity). Keys may be null or repeated: every row counts. Other columns are not read.

    What the driver holds and sends is bounded by the square of the vectors' length.
    """
    blocks = row_blocks(df, vector, key, scale, shift)
    fit = fitted(blocks, components, complete)
    key_field = StructField("key", df.schema[key].dataType)
    names = [("component", IntegerType()), ("n", LongType()), ("deviation", LongType())]
    names += [(name, DoubleType()) for name in ("whitened", "explained", "identity_error")]
    schema = StructType([key_field, *[StructField(*field) for field in names]])
    if fit is None or not len(fit.eigenvalues):
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    error, r, n = identity_error(blocks, fit), len(fit.eigenvalues), fit.center.n
    explained = fit.eigenvalues / fit.trace
    arrow = pa.schema([(field.name, pa_type(field)) for field in schema])

    def run(batches):
        for batch, k, x in arrays(batches):
            m = len(x)
            columns = [
                batch.column("keys")[k].values.take(pa.array(np.repeat(np.arange(m), r))),
                pa.array(np.tile(np.arange(1, r + 1, dtype=np.int32), m)),
                pa.array(np.full(m * r, n)),
                pa.array(fit.center.squares(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), r))),
                pa.array(fit.project(x).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * r, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return blocks.mapInArrow(run, schema).withColumnRenamed("key", key)
