"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers x = floor(64 c) + 1000000.  The fit list holds each
distinct vector once, as packed chunks in the shared folder; X is that list with its
mean taken away, as (n x - S) / n from exact whole numbers.  The method alternates

    u = X v - beta u_before,    v = X'u - alpha v_before

with both sides reorthogonalised against all former vectors.  Vectors v have the dimension's
length and stay on the driver.  Vectors u are as long as the list and are never
gathered: each is X p for a short p, rows compute their part of u from it, and one pass
over the chunks returns the sums U'u and X'u.  A second pass refines a u that lost
much of its length to the correction.  Where X'u vanishes, the next v is a
fresh direction, so repeated and zero eigenvalues are found as well; after as many steps as
dimensions the small bidiagonal matrix holds the whole spectrum, and its singular value
decomposition gives components and deviations to double precision.

A pass costs rows times dimension times steps so far; what returns to the driver is two short vectors.

Cases: rows whose vector is null or holds a null or non-finite entry, or an entry beyond 2**46 in size, are
dropped; the commonest length (the longest of equals) is the dimension, rows of any
other length are dropped, empty vectors too; repeated rows and null ids keep a row
each per component; components of eigenvalue 0 (to rounding) are not returned, so one distinct
vector, or an empty table, gives no rows; ``deviation`` is null where it exceeds a long; other columns
never matter.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

from .catalog import query, table
from .text import release

SHIFT, SCALE, COMPONENTS = 1_000_000, 64, 16
LARGEST = float(1 << 46)
LOST = 0.5  # of a vector's length, from which it is refined once more
FLAT = 1e-13  # relative to the largest value met: nothing left


def whole_numbers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Columns id and x (array of longs) of the rows that count."""
    c = F.col("c")
    wide = rows.select(rows[id_col].alias("id"), rows[vector_col].cast("array<double>").alias("c"))
    sound = wide.where(c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & (F.abs(e) <= F.lit(LARGEST))))
    return sound.select("id", F.transform(c, lambda e: F.floor(e * F.lit(float(SCALE))) + F.lit(SHIFT)).alias("x"))


def fit_chunks(rows: DataFrame, dimension: int) -> DataFrame:
    """Every distinct x once, packed by rows of a batch; written to the shared folder."""

    def run(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.int64).tobytes()], pa.binary())], ["chunk"])
            release()

    distinct = rows.where(F.size("x") == dimension).select("x").distinct()
    return stage(distinct.mapInArrow(run, "chunk binary"), "vectors")


def sums(chunks: DataFrame, width: int, part, whole: bool = False) -> np.ndarray:
    """Sum over all chunks of ``part(whole-number rows)``, an array of ``width`` numbers; tasks add up their own first."""

    def run(batches):
        total = None
        for batch in batches:
            for chunk in batch.column(0):
                own = part(np.frombuffer(chunk.as_buffer(), np.int64))
                total = own if total is None else total + own
        if total is not None:
            values = pa.array([Decimal(v) for v in total.tolist()], pa.decimal128(38, 0)) if whole else pa.array(total, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), values], ["place", "value"])

    made = chunks.mapInArrow(run, f"place int, value {'decimal(38,0)' if whole else 'double'}")
    out = np.array([0] * width, dtype=object if whole else np.float64)
    for row in made.groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[row.place] = int(row.value) if whole else row.value
    return out


def column_sums(x: np.ndarray, dimension: int) -> np.ndarray:
    """Exact sums of whole-number rows, and their number."""
    rows = x.reshape(-1, dimension)
    if rows.size and max(abs(int(rows.min())), abs(int(rows.max()))) * len(rows) >= 1 << 62:
        rows = rows.astype(object)
    return np.append(rows.sum(axis=0), len(rows)).astype(object)


class Fit:
    """Size, sums and spectrum of the fit list."""

    def __init__(self, chunks: DataFrame, dimension: int):
        self.dimension = dimension
        first = sums(chunks, dimension + 1, lambda x: column_sums(x, dimension), True)
        self.n, self.total = int(first[-1]), [int(s) for s in first[:-1]]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S as whole numbers."""
        rows = x.reshape(-1, self.dimension)
        least, most = (int(f(rows)) if rows.size else 0 for f in (np.min, np.max))
        if self.n * max(abs(least), abs(most)) + max(abs(s) for s in self.total) < 1 << 62:
            return rows * np.int64(self.n) - np.array(self.total, dtype=np.int64)
        return rows.astype(object) * self.n - np.array(self.total, dtype=object)

    def real(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x).astype(np.float64) / self.n


def bidiagonalise(chunks: DataFrame, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (a row each) and the upper bidiagonal matrix of X = U B V."""
    d = fit.dimension
    v_all, p_all, z_all = np.zeros((0, d)), np.zeros((0, d)), np.zeros((0, d))
    matrix = np.zeros((d, d))
    scale, beta, fresh = 0.0, 0.0, 0
    v = np.random.default_rng(13).normal(size=d)
    v /= np.linalg.norm(v)
    for j in range(d):
        p = v - (beta * p_all[-1] if j and beta else 0.0)
        alpha, z = 0.0, np.zeros(d)
        for _ in range(3):
            before = p_all.copy()

            def part(x, p=p, before=before):
                rows = fit.real(x)
                u = rows @ p
                return np.concatenate([(rows @ before.T).T @ u, rows.T @ u, [u @ u], np.zeros(d - len(before))])

            found = sums(chunks, 2 * d + 1, part)
            h, z, square = found[:j], found[j : j + d], found[j + d]
            rest = max(square - h @ h, 0.0)
            p, z = p - h @ before, z - h @ z_all
            alpha = np.sqrt(rest)
            if np.sqrt(square) <= FLAT * max(scale, 1e-300) or rest >= LOST**2 * square:
                break
        scale = max(scale, alpha)
        if alpha <= FLAT * scale or alpha == 0:  # v lies where X is 0
            alpha, p, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            p, z = p / alpha, z / alpha
        v_all, p_all, z_all = np.vstack([v_all, v]), np.vstack([p_all, p]), np.vstack([z_all, z])
        matrix[j, j] = alpha
        if j + 1 == d:
            break
        w = z - alpha * v
        for _ in range(2):
            w = w - (w @ v_all.T) @ v_all
        beta = np.linalg.norm(w)
        scale = max(scale, beta)
        if beta <= FLAT * scale or beta == 0:
            beta = 0.0
            while True:  # a fresh direction
                w = np.random.default_rng((13, fresh)).normal(size=d)
                fresh += 1
                for _ in range(3):
                    w = w - (w @ v_all.T) @ v_all
                if np.linalg.norm(w) > 1e-6:
                    break
        v = w / np.linalg.norm(w)
        v = v - (v @ v_all.T) @ v_all
        v /= np.linalg.norm(v)
        matrix[j, j + 1] = beta
    return v_all, matrix


def spectrum(chunks: DataFrame, fit: Fit, count: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``count`` unit components (a row each) and their eigenvalues, falling, all above 0."""
    v_all, matrix = bidiagonalise(chunks, fit)
    _, deviation, right = np.linalg.svd(matrix)
    keep = np.flatnonzero(deviation > FLAT * 10 * max(deviation[0], 1e-300))[:count]
    components = right[keep] @ v_all
    components /= np.linalg.norm(components, axis=1, keepdims=True)
    return components, deviation[keep] ** 2 / fit.n


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """Columns id, component (from 1), n, deviation, whitened, explained, identity_error; a row for each vector and component."""
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    x = whole_numbers(rows, id_col, vector_col)
    sizes = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    d = sizes["d"]
    chunks = fit_chunks(x, d)
    fit = Fit(chunks, d)
    trace = sums(chunks, 1, lambda part: np.array([(fit.real(part) ** 2).sum()]))[0] / fit.n
    if not trace > 0:
        return spark.createDataFrame([], schema)
    components, values = spectrum(chunks, fit, count)
    turn = (components / np.sqrt(values)[:, None]).T
    k = len(values)

    def products(part):
        white = fit.real(part) @ turn
        return np.concatenate([(white.T @ white).ravel(), white.sum(axis=0)])

    found = sums(chunks, k * k + k, products) / fit.n
    covariance = found[: k * k].reshape(k, k) - np.outer(found[k * k :], found[k * k :])
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = values / trace

    def run(batches):
        for batch in batches:
            m = batch.num_rows
            exact = fit.centred(batch.column(1).flatten().to_numpy(zero_copy_only=False))
            white = exact.astype(np.float64) / fit.n @ turn
            deviation = squares(exact)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, fit.n)),
                    pa.array([v for v in deviation for _ in range(k)], pa.int64()), pa.array(white.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x.where(F.size("x") == d).select("id", "x").mapInArrow(run, schema)


def squares(exact: np.ndarray) -> list[int | None]:
    """Sum of squares of each row of whole numbers, None beyond a long."""
    most = max((abs(int(f(exact))) for f in (np.min, np.max)), default=0) if exact.size else 0
    if exact.dtype != object and most * most * exact.shape[1] < 1 << 63:
        return (exact * exact).sum(axis=1).tolist()
    wide = exact.astype(object)
    return [v if v < 1 << 63 else None for v in (wide * wide).sum(axis=1).tolist()]


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
