"""Whitening of embeddings by a randomised range finder.

A few random directions more than components are wanted are multiplied by the covariance, again and again, each time in one
pass over all centred rows; the Rayleigh-Ritz values and vectors of the space that they span are the components. Where
their residuals don't fall below the tolerance within `passes` passes, the space becomes the full dimension and the
components are the eigenvectors of the whole covariance.

No row leaves the executors: a pass sends sums for each entry of a matrix of dimension x directions, which Spark adds up.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import stored

#: An eigenvalue under this share of the largest can't be told from rounding, and its direction isn't whitened.
LEAST_SHARE = 1e-12
DIGITS = 38


@dataclass
class Whitening:
    """n: vectors of the fit list; sums: of each dimension, exact; values, vectors: eigenvalues, falling, and unit vectors
    in columns; trace: of the covariance; full: whether the whole covariance was needed; passes: over the fit list;
    identity_error: largest absolute entry of the whitened fit list's covariance minus the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    full: bool
    passes: int
    identity_error: float = 0.0

    @property
    def centre(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) - self.centre) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int] | np.ndarray:
        """Sum over dimensions of (n * x - sum) ** 2, exactly."""
        if not x.size:
            return np.zeros(len(x), np.int64)
        largest = self.n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(s) for s in self.sums)
        if largest**2 * x.shape[1] < 2**63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1)
        return [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]


def quantised(table: DataFrame, id_column: str, vector_column: str, steps: int) -> DataFrame:
    """vec_id, x: each finite vector of the usual size (the most frequent; ties: the longest) as longs, floor(steps * c)."""
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & fine)
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["size"] if sizes else 0)).select("vec_id", F.transform("v", lambda c: F.floor(c * float(steps)).cast("long")).alias("x"))


def longs(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def summed(fit: DataFrame, size: int, shape: tuple[int, ...], of: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all rows of what `of` makes of a batch, an array of `shape`. A task sends one number for each entry."""
    numbers, count = (np.float64, np.int64)[kind != "double"], int(np.prod(shape))

    def run(batches):
        total = np.zeros(shape, numbers)
        for batch in batches:
            if batch.num_rows:
                total = total + of(longs(batch.column("x"), size))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count, dtype=np.int32)), pa.array(total.ravel())], ["place", "value"])

    added = fit.select("x").mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)") if kind != "double" else F.col("value")).alias("value"))
    out = np.zeros(count, object if kind != "double" else np.float64)
    for r in added.collect():
        out[r["place"]] = r["value"] if kind == "double" else int(r["value"])
    return out.reshape(shape)


def fit_whitening(fit: DataFrame, size: int, n: int, k: int = 4, oversampling: int = 8, passes: int = 8, tolerance: float = 1e-12, seed: int = 11) -> Whitening:
    """The k components of largest variance of the n rows of `fit` (x array<long> of `size` entries).

    A component is taken once its residual is at most `tolerance` times its distance to the other values, which bounds
    its angle to the true one. As soon as the residuals fall too slowly to get there within `passes` passes, the whole
    covariance is computed, in one more pass.
    """
    #: Two halves of 32 bits, so that no sum of longs overflows.
    halves = summed(fit, size, (2, size), lambda x: np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)]), "long")
    sums = [(int(a) << 32) + int(b) for a, b in zip(*halves, strict=True)]
    centre = np.array([s / n for s in sums])
    width = min(size, k + oversampling)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, width)))[0] if width < size else np.eye(size)
    trace = float(summed(fit, size, (1,), lambda x: np.array([((x - centre) ** 2).sum()]))[0] / n)
    done, before = 1, None
    while True:
        full = q.shape[1] == size

        def multiplied(x: np.ndarray, q=q) -> np.ndarray:
            c = x - centre
            return c.T @ (c @ q)

        z = summed(fit, size, (size, q.shape[1]), multiplied) / n
        done += 1
        small = q.T @ z
        values, rotation = np.linalg.eigh((small + small.T) / 2)
        values, rotation = values[::-1], rotation[:, ::-1]
        vectors = q @ rotation
        residual = np.linalg.norm(z @ rotation - vectors * values, axis=0)
        top = np.arange(min(k, len(values)))
        apart = np.array([min((abs(values[i] - values[j]) - residual[j] for j in range(len(values)) if j != i), default=values[i]) for i in top])
        if full or trace == 0 or (residual[top] <= tolerance * apart).all():
            break
        end = residual[top] if before is None else residual[top] * np.minimum(residual[top] / np.maximum(before, 1e-300), 1) ** (passes + 1 - done)
        hopeless = done > passes or (before is not None and (end > tolerance * apart).any())
        q, before = np.eye(size) if hopeless else np.linalg.qr(z)[0], residual[top]
    some = [i for i in top if values[i] > LEAST_SHARE * max(values[0], 0.0) and values[i] > 0]
    out = Whitening(n, sums, values[some], vectors[:, some], trace, full, done)
    if some:

        def products(x: np.ndarray) -> np.ndarray:
            w = out.project(x)
            return np.vstack([w.T @ w, w.sum(0)])

        total = summed(fit, size, (len(some) + 1, len(some)), products) / n
        out.identity_error = float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(len(some))).max())
    return out


def whiten(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", steps: int = 256, k: int = 4, oversampling: int = 8, passes: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    Vectors are quantised to floor(steps * entry); the covariance is that of the distinct quantised vectors, n of them, so
    copies, however many, weigh once. Components are numbered from 1 by falling variance; there are at most k, and fewer
    where the rank is lower (none for an empty table, one vector, or copies of one: the result is empty then). deviation
    is exact, a decimal, and null beyond 38 digits. Null vectors, those with null or non-finite entries, empty ones and
    those of another size than the most frequent take no part. Rows with a null id and repeated rows have their rows each;
    other columns are left out, whatever they are called.
    """
    spark, kinds = table.sparkSession, "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = stored(quantised(table, id_column, vector_column, steps), "quantised")
    size = rows.agg(F.max(F.size("x"))).first()[0]
    if not size:
        return spark.createDataFrame([], kinds)
    fit = stored(rows.select("x").distinct(), "fit")
    model = fit_whitening(fit, size, fit.count(), k, oversampling, passes)
    if not len(model.values):
        return spark.createDataFrame([], kinds)

    def run(batches):
        many, explained = len(model.values), model.values / model.trace
        for batch in batches:
            x = longs(batch.column("x"), size)
            exact = model.deviations(x)
            if isinstance(exact, list):
                exact = pa.array([v if v < 10**DIGITS else None for v in exact], pa.decimal128(DIGITS))
            else:
                exact = pa.array(exact).cast(pa.decimal128(DIGITS))
            each = pa.array(np.repeat(np.arange(len(x)), many))
            yield pa.RecordBatch.from_arrays(
                [
                    pc.take(batch.column("vec_id"), each),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n)),
                    pc.take(exact, each),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), model.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, kinds)
