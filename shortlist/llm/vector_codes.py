"""Product codes of vectors: each part of a vector becomes the number of its nearest codebook entry.

Components become integers, floor(256 x). Vectors are cut into ``parts`` consecutive
parts, and each part position has a codebook of up to ``entries`` entries, that part of the smallest ids at first.
Each round assigns all parts to their nearest entries and moves each entry to
the floored mean of its parts. Nearest means squared Euclidean distance, of equals the lower index.

The nearest entry is found through a GNAT over the codebook. A node has a few split
points; every other entry belongs to the child of its nearest split point. The node stores for each split point and child the
smallest and largest distance from that point to the child's entries. By the triangle inequality a
child whose range lies strictly beyond the query's distance plus or minus the best distance so far cannot
hold the nearest entry. Ranges and distances are rounded outwards, so rounding eliminates nothing; what remains is compared by
exact integer distances and indices.

A codebook has a fixed size, so it is the driver's; parts are assigned and summed in tasks, one
row per task, part and entry. An executor that is lost costs the tasks it ran.

Cases: rows with a null vector or null or non-finite components are dropped; of vectors of
several lengths only the commonest length stays (:func:`vectors.usable`). A length that ``parts`` does not divide gives
parts whose lengths differ by one. Null ids come last; rows that repeat an id are ordered by
their vector. Fewer vectors than entries give fewer entries. Components beyond 2^20 in
size count as 2^20, which keeps every sum in a long. Null labels are one label. An empty table
gives no row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import checked
from .vectors import matrix, usable

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LIMIT = 1 << 28
# Split points of a GNAT node; a node of at most so many entries has no children.
ARITY = 8
# Relative margin for the rounding of square roots, sums and differences of doubles.
MARGIN = 1e-12


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to the rows of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    for column in range(a.shape[1]):
        out += (a[:, column, None] - b[None, :, column]) ** 2
    return out


class Gnat:
    """Nearest of the integer ``entries`` by exact distance and index."""

    def __init__(self, entries: np.ndarray, indices: np.ndarray | None = None, arity: int = ARITY):
        if indices is None:
            # Of equal entries only the first is ever the nearest.
            indices = np.sort(np.unique(entries, axis=0, return_index=True)[1]) if entries.shape[1] else np.arange(min(1, len(entries)))
            entries = entries[indices]
        self.children: list[Gnat] = []
        self.low = self.high = np.zeros((0, arity))
        if len(entries) <= arity:
            self.points, self.indices = entries, indices
            return
        # Split points far from each other: each next one is the farthest from those before.
        chosen = [0]
        nearest = squared(entries, entries[:1])[:, 0]
        while len(chosen) < arity:
            chosen.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, squared(entries, entries[chosen[-1:]])[:, 0])
        chosen.sort()
        self.points, self.indices = entries[chosen], indices[chosen]
        rest = np.setdiff1d(np.arange(len(entries)), chosen)
        between = squared(entries[rest], self.points)
        owner = between.argmin(axis=1)
        distance = np.sqrt(between.astype("float64"))
        lows, highs = [], []
        for point in range(len(chosen)):
            own = rest[owner == point]
            if len(own):
                lows.append(distance[owner == point].min(axis=0) * (1 - MARGIN))
                highs.append(distance[owner == point].max(axis=0) * (1 + MARGIN))
                self.children.append(Gnat(entries[own], indices[own], arity))
        self.low, self.high = np.array(lows), np.array(highs)

    def search(self, queries: np.ndarray, best: np.ndarray, index: np.ndarray, rows: np.ndarray) -> int:
        """Improve the best squared distance and index of ``rows``; returns the distances that were computed."""
        exact = squared(queries[rows], self.points)
        # Points are in the order of their indices, so argmin takes the lower of equals.
        place = exact.argmin(axis=1)
        found, number = exact[np.arange(len(rows)), place], self.indices[place]
        better = (found < best[rows]) | ((found == best[rows]) & (number < index[rows]))
        best[rows[better]], index[rows[better]] = found[better], number[better]
        counted = exact.size
        distance = np.sqrt(exact.astype("float64"))
        for child, low, high in zip(self.children, self.low, self.high):
            radius = np.sqrt(best[rows].astype("float64"))[:, None] * (1 + MARGIN)
            beyond = (distance * (1 - MARGIN) - radius > high * (1 + MARGIN)) | (distance * (1 + MARGIN) + radius < low * (1 - MARGIN))
            left = rows[~beyond.any(axis=1)]
            if len(left):
                counted += child.search(queries, best, index, left)
        return counted

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of every query."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), np.iinfo(np.int64).max)
        self.search(queries, best, index, np.arange(len(queries)))
        return index, best


def integers(column: pd.Series, length: int) -> np.ndarray:
    return np.floor(matrix(column, length) * SCALE).clip(-LIMIT, LIMIT).astype(np.int64)


def cut_points(length: int, parts: int) -> list[int]:
    return [length * p // parts for p in range(parts + 1)]


def _moved(kept: DataFrame, vector: str, length: int, books: list[np.ndarray], cuts: list[int]) -> list[np.ndarray]:
    """The codebooks after one round."""
    most = max(b - a for a, b in zip(cuts, cuts[1:]))
    names = [f"s{i}" for i in range(most)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = [Gnat(book) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros((len(book), most), np.int64) for book in books]
        for batch in batches:
            values = integers(batch[vector], length)
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                index, _ = trees[p].nearest(values[:, a:b])
                counts[p] += np.bincount(index, minlength=len(books[p]))
                np.add.at(sums[p], (index, slice(0, b - a)), values[:, a:b])
        for p, (count, total) in enumerate(zip(counts, sums)):
            entry = np.flatnonzero(count)
            frame = pd.DataFrame({"part": np.full(len(entry), p, "int32"), "entry": entry.astype("int32"), "n": count[entry]})
            yield frame.assign(**{name: total[entry, i] for i, name in enumerate(names)})

    schema = ", ".join(["part int, entry int, n bigint", *(f"{name} bigint" for name in names)])
    partial = kept.select(vector).mapInPandas(run, schema)
    books = [book.copy() for book in books]
    for row in partial.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect():
        width = cuts[row["part"] + 1] - cuts[row["part"]]
        books[row["part"]][row["entry"]] = [row[name] // row["n"] for name in names[:width]]
    return books


def codebooks(
    kept: DataFrame, vec_id: str, vector: str, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> list[np.ndarray]:
    """The codebook of every part position after ``rounds`` rounds over ``kept``."""
    cuts = cut_points(length, parts)
    firsts = kept.select(vec_id, vector).orderBy(F.col(vec_id).asc_nulls_last(), vector).limit(entries).collect()
    values = integers(pd.Series([row[1] for row in firsts], dtype=object), length)
    books = [values[:, a:b] for a, b in zip(cuts, cuts[1:])]
    for _ in range(rounds if len(values) else 0):
        books = _moved(kept, vector, length, books, cuts)
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def encode(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, label, indices, code, error, label_error, codebooks_sha256) of every usable row."""
    kept, length = usable(df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label")), vector="vector")
    books = codebooks(kept, "vec_id", "vector", length, parts, entries, rounds)
    cuts = cut_points(length, parts)

    @F.pandas_udf("indices array<int>, code string, error bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trees = [Gnat(book) for book in books]
        for batch in batches:
            values = integers(batch, length)
            found = [tree.nearest(values[:, a:b]) for tree, a, b in zip(trees, cuts, cuts[1:])]
            indices = np.stack([index for index, _ in found], axis=1).astype("int32")
            code = ["".join(f"{i:02x}" for i in row) for row in indices.tolist()]
            yield pd.DataFrame({"indices": list(indices), "code": code, "error": np.sum([d for _, d in found], axis=0)})

    coded = written(kept.withColumn("_c", run("vector")).select("vec_id", "label", "_c.*"))
    totals = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"))
    joined = coded.join(checked(totals), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return joined.withColumn("codebooks_sha256", F.lit(digest(books)))
