"""Whitening of embeddings by a covariance that weighs every distinct vector by its multiplicity.

Entries become integers x = floor(64 c) + 1000000. Equal x-vectors are grouped, and a group counts as often as it has rows
(or once, ``weights="one"``). The covariance is a weighted product of centred
matrices, one per task, added by matrix row. Each distinct vector is projected on the unit
eigenvectors, over the square roots of their eigenvalues, once, and the result is joined back to its rows.

Sums are exact integers, and a vector is centred as (n x - S) / n, an exact integer
over n. Only sums of the vectors' length and matrices of length by length come to the driver.

Cases: rows with a null vector or null or non-finite entries are dropped; of vectors of several
lengths only the commonest length stays (:func:`vectors.usable`). Null and repeated ids are rows
like others. Components whose eigenvalue is nothing but rounding, as with fewer
distinct vectors than components, have a null ``whitened`` and do not count for the identity error; if
all vectors are equal, ``explained`` is null too. Entries beyond 2^40 in size count as 2^40. A
deviation that a long cannot hold is null. An empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .vectors import matrix, usable

SCALE = 64
SHIFT = 1_000_000
LIMIT = float(1 << 40)
COMPONENTS = 32
LONG = np.iinfo(np.int64).max
# Vectors of a matrix product.
BLOCK = 4096


def distinct_vectors(rows: DataFrame, weights: str = "counts") -> DataFrame:
    """(k1, k2, x, weight): every x-vector once, with its key and how often it counts."""
    weight = {"counts": F.count(F.lit(1)), "one": F.lit(1).cast("bigint")}[weights]
    return rows.groupBy("k1", "k2", "x").agg(weight.alias("weight"))


def exact_sums(distinct: DataFrame, length: int) -> tuple[int, list[int]]:
    """The weighted count and the weighted sum of every dimension, as integers of any size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = 0, np.zeros(length, object)
        for batch in batches:
            x, w = matrix(batch["x"], length, "int64"), batch["weight"].to_numpy()
            count += int(w.sum())
            # Longs hold the sum of a block whose largest product is small; else Python's integers do.
            large = float(np.abs(x).max(initial=0)) * float(w.sum()) >= 2.0**62
            total = total + (w.astype(object) @ x.astype(object) if large else (w @ x).astype(object))
        yield pd.DataFrame({"dimension": np.arange(-1, length, dtype="int32"), "total": [str(v) for v in [count, *total]]})

    partial = distinct.select("x", "weight").mapInPandas(run, "dimension int, total string")
    sums = partial.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    found = {row["dimension"]: int(row["total"]) for row in sums}
    return found.get(-1, 0), [found.get(i, 0) for i in range(length)]


class Centre:
    """Deviations of integer vectors from their mean."""

    def __init__(self, count: int, sums: list[int]):
        self.count, self.sums = count, sums

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly; as Python's integers where longs might overflow."""
        most = float(np.abs(x).max(initial=0)) * self.count + max(map(abs, self.sums), default=0)
        if most < 2.0**62:
            return x * np.int64(self.count) - np.array(self.sums, np.int64)
        return x.astype(object) * self.count - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.numerators(x) / self.count).astype("float64")

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of the squared numerators of every vector; None if a long cannot hold it."""
        numerators = self.numerators(x)
        if numerators.dtype != object and float(np.abs(numerators).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (numerators**2).sum(axis=1).tolist()
        values = (numerators.astype(object) ** 2).sum(axis=1).tolist()
        return [int(v) if v <= LONG else None for v in values]


def weighted_product(distinct: DataFrame, column: str, length: int, count: int, centred) -> np.ndarray:
    """The sum over all rows of weight times the outer product of the centred vector, over ``count``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((length, length))
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.iloc[at : at + BLOCK]
                values = centred(part[column])
                total += (values * part["weight"].to_numpy("float64")[:, None]).T @ values
        yield pd.DataFrame({"dimension": np.arange(length, dtype="int32"), "line": list(total)})

    def add(key: tuple, lines: pd.DataFrame) -> pd.DataFrame:
        # By size, so that the order of the tasks does not change the last bits.
        stacked = np.sort(np.stack(lines["line"]), axis=0)
        return pd.DataFrame({"dimension": [key[0]], "line": [stacked.sum(axis=0)]})

    schema = "dimension int, line array<double>"
    partial = distinct.select(column, "weight").mapInPandas(run, schema)
    out = np.zeros((length, length))
    for row in partial.groupBy("dimension").applyInPandas(add, schema).collect():
        out[row["dimension"]] = row["line"]
    return (out + out.T) / 2 / count


def principal(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    return values[order], vectors[:, order]


def identity_error(whitened: DataFrame, width: int, count: int) -> float | None:
    """The largest entry of the weighted covariance of ``values`` minus the identity, in size."""
    if not width:
        return None

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width)
        for batch in batches:
            total += batch["weight"].to_numpy("float64") @ matrix(batch["values"], width)
        yield pd.DataFrame({"dimension": np.arange(width, dtype="int32"), "total": total})

    added = whitened.select("values", "weight").mapInPandas(sums, "dimension int, total double")
    mean = np.zeros(width)
    for row in added.groupBy("dimension").agg(F.sum("total").alias("total")).collect():
        mean[row["dimension"]] = row["total"] / count
    covariance = weighted_product(whitened, "values", width, count, lambda column: matrix(column, width) - mean)
    return float(np.abs(covariance - np.eye(width)).max())


def whiten(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, weights: str = "counts"
) -> DataFrame:
    """(vec_id, n, deviation, whitened, explained, identity_error) of every usable row; ``whitened`` and
    ``explained`` are arrays by component."""
    kept, length = usable(df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")), "vector")

    def entry(c):
        scaled = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c.cast("double") * SCALE))
        return F.floor(scaled).cast("bigint") + SHIFT

    rows = kept.select("vec_id", F.transform("vector", entry).alias("x"))
    rows = rows.select("vec_id", "x", F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(1), "x").alias("k2"))
    distinct = written(distinct_vectors(rows, weights))
    count, sums = exact_sums(distinct, length)
    centre = Centre(count, sums)
    width = min(components, length)
    values, vectors, explained = np.zeros(0), np.zeros((length, 0)), []
    if count:
        covariance = weighted_product(distinct, "x", length, count, lambda column: centre.centred(matrix(column, length, "int64")))
        values, vectors = principal(covariance, width)
        trace = float(np.trace(covariance))
        explained = [float(v) / trace if trace > 0 else None for v in values]
    sound = int((values > length * np.finfo(float).eps * max(values.max(initial=0.0), 1e-300)).sum())
    scaled = vectors[:, :sound] / np.sqrt(values[:sound])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = matrix(batch["x"], length, "int64")
            out = batch[["k1", "k2", "weight"]].copy()
            out["deviation"] = pd.array(centre.deviations(x), dtype="Int64")
            out["values"] = list(centre.centred(x) @ scaled)
            yield out

    schema = "k1 bigint, k2 bigint, weight bigint, deviation bigint, values array<double>"
    once = written(distinct.mapInPandas(run, schema))
    error = identity_error(once, sound, count) if count else None
    joined = rows.select("vec_id", "k1", "k2").join(once.drop("weight"), ["k1", "k2"])
    nulls = F.array_repeat(F.lit(None).cast("double"), width - sound)
    return joined.select(
        "vec_id",
        F.lit(count).cast("bigint").alias("n"),
        "deviation",
        F.concat("values", nulls).alias("whitened"),
        F.array(*[F.lit(v).cast("double") for v in explained]).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
