"""Whitening of embeddings by shifted CholeskyQR (operator 12).

Entries become whole numbers, ``x = floor(1024 c) + 100000``, so that counts, sums and
deviations are exact. The centred rows ``A`` are factored as ``A = Q R`` without ever
holding more than a batch of them: a pass over the rows sums their Gram matrix, its
Cholesky factor is a first ``R``, and the next pass sums the Gram matrix of the rows after
a triangular solve with it, which is nearly that of orthonormal rows. The first Gram matrix
is shifted, so that its factor exists for badly conditioned rows too; two more passes
restore orthogonality to double precision (shifted CholeskyQR3), and ``R`` is the product of
the factors. The singular values of ``R`` are those of ``A``, the roots of ``n`` times the
eigenvalues of the covariance; its right singular vectors are the components. What leaves
a pass are partial sums of one matrix for each task, added by key; the driver holds single
matrices whose side is the dimension of the vectors.

Cases: a row is left out if its vector is null or empty or has an entry that is null or
not finite, or if it has not the length that most of the others have (of equally frequent
lengths the longest). Repeated rows and rows without an id count and return as often as
they come. A component without variance (below the rounding of the others) has no unit
scale and is not returned; so a table of equal rows, a single row or no row gives an empty
table. Of equal eigenvalues, any orthonormal components serve. A deviation that a long cannot hold is
null in ``deviation`` and stands in ``exact_deviation``; entries whose ``x`` does not fit a long
are beyond this operator. Other columns are not read.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickermood.llm.common import saved

COMPONENTS = 8
SCALE, LIFT = 1024, 100_000


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the rows that stay; ``x`` is an array of longs."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fine = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    fine = fine.where((F.size("embedding") > 0) & finite)
    x = F.transform("embedding", lambda c: F.floor(c * SCALE).cast("long") + F.lit(LIFT).cast("long"))
    rows = fine.select("vec_id", x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1).select("d").first()
    return rows.where(F.size("x") == (usual["d"] if usual else 0))


def matrix_of(column: pa.Array, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)


def sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and exact sum of each dimension."""
    found = (
        rows.select(F.posexplode("x").alias("i", "x")).groupBy("i")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("total")).orderBy("i").collect()
    )
    return (found[0]["n"] if found else 0), np.array([r["total"] for r in found], np.int64)


def added(rows: DataFrame, of_batch) -> np.ndarray:
    """The sum over all rows of the symmetric matrices that ``of_batch`` gives for a batch of ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(matrix_of(batch.column(0), np.float64))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "g": pa.array(total[i, j])})

    cells = rows.select("x").mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect()
    side = max((c["j"] for c in cells), default=-1) + 1
    found = np.zeros((side, side))
    for c in cells:
        found[c["i"], c["j"]] = found[c["j"], c["i"]] = c["g"]
    return found


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows @ inv(r)`` for an upper triangular ``r``, column after column."""
    out = np.empty_like(rows)
    for j in range(r.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def factor(gram: np.ndarray, shift=0.0) -> np.ndarray:
    """Upper Cholesky factor of ``gram`` and ``shift`` on its diagonal; raised as far as a factor asks for."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 1e-15 * max(1.0, np.trace(gram)))


def first_shift(gram: np.ndarray, n: int) -> float:
    """The shift of CholeskyQR3; its bound passes the matrix itself for very many rows, where far less is enough."""
    d, unit = len(gram), np.finfo(float).eps / 2
    return min(11 * (n * d + d * (d + 1)) * unit * np.linalg.norm(gram, 2), 1e-8 * np.trace(gram) / d)


def triangular(rows: DataFrame, n: int, mean: np.ndarray) -> np.ndarray:
    """R of the QR factors of the centred rows."""

    def gram(x: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
        q = x - mean
        for r in factors:
            q = solved(q, r)
        return q.T @ q

    factors: list[np.ndarray] = []
    for step in range(3):
        found = added(rows, partial(gram, factors=list(factors)))
        factors.append(factor(found, 0.0 if step else first_shift(found, n)))
    r = factors[0]
    for later in factors[1:]:
        r = later @ r
    return r


def components(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(unit components in rows, their eigenvalues, trace of the covariance)."""
    _, singular, vectors = np.linalg.svd(r)
    eigen = singular**2 / n
    real = singular > singular[0] * 1e-7
    return vectors[:most][real[:most]], eigen[:most][real[:most]], float(eigen.sum())


def projected(x: np.ndarray, mean: np.ndarray, vectors: np.ndarray, eigen: np.ndarray) -> np.ndarray:
    return (x - mean) @ vectors.T / np.sqrt(eigen)


def whitened(vectors: DataFrame, most=COMPONENTS) -> DataFrame:
    """A row for each vector and component: ``whitened`` is the vector's coordinate, the rest as the module says."""
    spark = vectors.sparkSession
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
        "exact_deviation decimal(38,0)"
    )
    rows = saved(whole_vectors(vectors), "whole-vectors")
    n, total = sums(rows)
    if not n:
        return spark.createDataFrame([], schema)
    mean = total / n
    r = triangular(rows, n, mean)
    # The rows are whole numbers: any variance at all gives them squares of a half and more.
    if (r * r).sum() < 0.25:
        return spark.createDataFrame([], schema)
    axes, eigen, trace = components(r, n, most)

    # The covariance of what is returned, centred first: its mean comes in the last column.
    def moments(x):
        w = np.concatenate([projected(x, mean, axes, eigen), np.ones((len(x), 1))], axis=1)
        return w.T @ w

    centre = added(rows, moments)[:-1, -1] / n

    def spread(x):
        w = projected(x, mean, axes, eigen) - centre
        return w.T @ w

    error = float(np.abs(added(rows, spread) / n - np.eye(len(eigen))).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            each = pa.array(np.repeat(np.arange(batch.num_rows), len(eigen)))
            yield pa.record_batch({
                "vec_id": batch.column(0).take(each),
                "component": pa.array(np.tile(np.arange(1, len(eigen) + 1, dtype=np.int32), batch.num_rows)),
                "exact": batch.column(2).take(each),
                "whitened": pa.array(projected(matrix_of(batch.column(1), np.float64), mean, axes, eigen).ravel()),
                "explained": pa.array(np.tile(eigen / trace, batch.num_rows)),
            })

    # Exact, in decimals of the JVM.
    whole = "decimal(38,0)"
    total_sql = "array(" + ", ".join(f"{t}BD" for t in total.tolist()) + ")"
    apart = f"zip_with(x, {total_sql}, (a, s) -> cast({n}BD * a - s as {whole}))"
    squares = f"aggregate({apart}, cast(0 as {whole}), (t, v) -> cast(t + v * v as {whole}))"
    ready = rows.select(F.col("vec_id").cast("long"), "x", F.expr(squares).alias("exact"))
    out = ready.mapInArrow(project, f"vec_id long, component int, exact {whole}, whitened double, explained double")
    return out.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), F.col("exact").try_cast("long").alias("deviation"),
        "whitened", "explained", F.lit(error).alias("identity_error"), F.col("exact").alias("exact_deviation"),
    )
