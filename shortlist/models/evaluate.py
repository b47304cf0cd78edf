"""Leaderboards, parameter search, refits and importances."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import mean_ndcg, mean_ndcg_of
from ..operators.ordering import HOT_ROWS, col, positions
from ..session import written

# A prime whose square times two fits a long.
SHUFFLE_PRIME = 1_048_573
SHUFFLE_ROUNDS = 16
NUMBER = "_number"

Score = Callable[[DataFrame], DataFrame]  # adds "prediction"


def ndcg_of(scored: DataFrame, group: str, gain: str, k: int = 5, on_short: str = "filter", tiebreak: Sequence[str] = ()) -> float:
    value = mean_ndcg(scored, group, "prediction", gain, k, tiebreak, on_short).first()["mean_ndcg"]
    return float(value) if value is not None else 0.0


def ndcg_of_all(
    scores: Sequence[Score], df: DataFrame, group: str, gain: str, k: int = 5, on_short: str = "filter", tiebreak: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> list[float]:
    """:func:`ndcg_of` for several scores of the same rows, side by side in one pass."""
    needed = dict.fromkeys([group, gain, *[t.removeprefix("-") for t in tiebreak]])
    rows, names = df, [f"_score_{i}" for i in range(len(scores))]
    for name, score in zip(names, scores):
        rows = score(rows).withColumnRenamed("prediction", name)
    values = mean_ndcg_of(rows.select(*[col(c) for c in [*needed, *names]]), group, names, gain, k, tiebreak, on_short, hot_rows)
    return [float(v) if v is not None else 0.0 for v in values]


def table(df: DataFrame, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A few driver-side results as a DataFrame."""
    entries = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return df.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*entries)))


def leaderboard(test: DataFrame, models: dict[str, Score], group: str, gain: str, k: int = 5, tiebreak: Sequence[str] = ()) -> DataFrame:
    """(model, ndcg), best first."""
    found = [(name, ndcg_of(score(test), group, gain, k, tiebreak=tiebreak)) for name, score in models.items()]
    return table(test, sorted(found, key=lambda r: -r[1]), ["model", "ndcg"])


def draw(space: dict, rng: random.Random) -> dict:
    """One point of a space of ("uniform", lo, hi), ("log", lo, hi), ("int", lo, hi) or a list."""
    out = {}
    for name, spec in space.items():
        if isinstance(spec, list):
            out[name] = rng.choice(spec)
        elif spec[0] == "uniform":
            out[name] = rng.uniform(spec[1], spec[2])
        elif spec[0] == "log":
            out[name] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
        elif spec[0] == "int":
            out[name] = rng.randint(spec[1], spec[2])
        else:
            raise ValueError(f"unknown distribution {spec[0]!r}")
    return out


def random_search(fit: Callable[..., Score], val: DataFrame, space: dict, group: str, gain: str, calls: int = 10, seed: int = 42, k: int = 5) -> list[dict]:
    """Fit ``calls`` seeded random points; best NDCG on validation rows first."""
    rng = random.Random(seed)
    points = [draw(space, rng) for _ in range(calls)]
    found = ndcg_of_all([fit(**params) for params in points], val, group, gain, k)
    out = [{**params, "ndcg": value} for params, value in zip(points, found)]
    return sorted(out, key=lambda r: -r["ndcg"])


def refit(
    df: DataFrame, fit: Callable[[DataFrame], Score], group: str, gain: str, split: str = "split", k: int = 5, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Fit on train and validation rows together; NDCG on them and on test rows."""
    both = df.filter(col(split).isin("train", "val"))
    score = fit(both)
    test = df.filter(col(split) == "test")
    found = [(name, ndcg_of(score(rows), group, gain, k, tiebreak=tiebreak)) for name, rows in (("train_val", both), ("test", test))]
    return table(df, found, ["split", "ndcg"])


def shuffle_rounds(seed: int, rounds: int = SHUFFLE_ROUNDS) -> list[tuple[int, int, int, int]]:
    """The constants of each round of a shuffle: a mirror and three multipliers below SHUFFLE_PRIME."""
    rng = random.Random(seed)
    return [(rng.randrange(1 << 40), *(rng.randrange(1, SHUFFLE_PRIME) for _ in range(3))) for _ in range(rounds)]


def shuffled_place(number: Column, size: int, rounds: Column) -> Column:
    """Where row ``number`` of ``size`` goes: a permutation of 0 .. size - 1 in plain integer arithmetic.

    Each round mirrors a number at a place that depends on the seed, and keeps the mirror image or the number by a bit
    that depends on the larger of the two, so that both move or none (the swap-or-not shuffle of
    Hoang, Morris and Rogaway, 2012). Every engine computes the same, and no row is sorted.
    """
    n, prime = F.lit(size).cast("bigint"), F.lit(SHUFFLE_PRIME).cast("bigint")

    def step(x: Column, r: Column) -> Column:
        mirrored = F.pmod(F.pmod(r[0], n) - x, n)
        larger = F.greatest(x, mirrored)
        mixed = (larger % prime) * r[1] + (F.floor(larger / prime) % prime) * r[2] + r[3]
        return F.when(mixed % prime % 2 == 1, mirrored).otherwise(x)

    return F.aggregate(rounds, number.cast("bigint"), step)


def shuffled_places(number: np.ndarray, size: int, rounds: Sequence[tuple[int, int, int, int]]) -> np.ndarray:
    """:func:`shuffled_place` of many numbers at once; the arithmetic stays below 2^63 and divides by one prime only."""
    x = number.astype(np.int64)
    for mirror, a, b, c in rounds:
        mirrored = mirror % size - x
        mirrored += size * (mirrored < 0)
        larger = np.maximum(x, mirrored)
        high = larger // SHUFFLE_PRIME
        mixed = (larger - high * SHUFFLE_PRIME) * a + high % SHUFFLE_PRIME * b + c
        x = np.where((mixed - mixed // SHUFFLE_PRIME * SHUFFLE_PRIME) & 1 == 1, mirrored, x)
    return x


def _sent(numbered: DataFrame, size: int, columns: Sequence[str], seeds: Sequence[Sequence[int]]) -> DataFrame:
    """(to, slot, value): every value of the columns with its place in each of the column's shuffles; slots are numbered on."""
    rounds = [shuffle_rounds(seed) for of_column in seeds for seed in of_column]
    names = [f"_c{i}" for i in range(len(columns))]
    rows = numbered.select(NUMBER, *[col(c).cast("double").alias(n) for c, n in zip(columns, names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(0).to_numpy()
            places = np.stack([shuffled_places(number, size, r) for r in rounds], axis=1)
            ends = pa.array(np.arange(len(number) + 1, dtype=np.int32) * len(rounds))
            listed = pa.ListArray.from_arrays(ends, pa.array(places.ravel()))
            yield pa.RecordBatch.from_arrays([listed, *batch.columns[1:]], names=["places", *names])

    placed = rows.mapInArrow(run, ", ".join(["places array<bigint>", *[f"{n} double" for n in names]]))
    values = [n for n, of_column in zip(names, seeds) for _ in of_column]
    sent = [F.struct(F.col("places")[s].alias("to"), F.lit(s).alias("slot"), F.col(n).alias("value")) for s, n in enumerate(values)]
    return placed.select(F.inline(F.array(*sent)))


def _numbered(df: DataFrame, row: str, hot_rows: int | None) -> tuple[DataFrame, int]:
    """Rows with a dense number in the order of ``row``, written once, and how many there are."""
    numbered = written(positions(df, [], [row], NUMBER, hot_rows))
    return numbered, numbered.count()


def _rounds(seed: int) -> Column:
    return F.array(*[F.array(*[F.lit(v).cast("bigint") for v in r]) for r in shuffle_rounds(seed)])


def permuted(df: DataFrame, column: str, row: str, seed: int, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Rows with one column shuffled over the whole table; the order of ``row`` numbers the rows."""
    numbered, size = _numbered(df, row, hot_rows)
    moved = numbered.select(shuffled_place(F.col(NUMBER), size, _rounds(seed)).alias(NUMBER), col(column).alias("_v"))
    return numbered.join(moved, [NUMBER]).withColumn(column, F.col("_v")).drop("_v", NUMBER)


def permutation_importance(
    df: DataFrame, score: Score, columns: Sequence[str], row: str, group: str, gain: str, repeats: int = 1, seed: int = 0, k: int = 5,
    tiebreak: Sequence[str] = (), on_short: str = "filter", hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """(feature, score, std): metric with the column shuffled less the metric without.

    Negative where shuffling hurts. ``row`` is unique. Mean and population deviation over the repeats. Shuffle r of column c
    has the seed ``seed`` + c * repeats + r. All shuffles are made at once: a row sends each of its values to the row that
    gets it in each repeat, one exchange by number brings them together in one row, which is scored once a variant, and one pass
    over the scores gives all metrics.
    """
    numbered, size = _numbered(df, row, hot_rows)
    base = ndcg_of(score(numbered), group, gain, k, on_short, tiebreak)
    slots = [(c, r) for c in columns for r in range(repeats)]
    seeds = [[seed + i * repeats + r for r in range(repeats)] for i in range(len(columns))]
    moved = _sent(numbered, size, columns, seeds).repartition("to")
    taken = moved.groupBy("to").agg(*[F.max(F.when(F.col("slot") == s, F.col("value"))).alias(f"_v{s}") for s in range(len(slots))])
    wide = numbered.join(taken, F.col(NUMBER) == F.col("to"))

    def shuffled(slot: int, column: str) -> Score:
        def run(rows: DataFrame) -> DataFrame:
            changed = rows.withColumns({"_own": col(column), column: F.col(f"_v{slot}")})
            return score(changed).withColumn(column, F.col("_own")).drop("_own")

        return run

    scores = [shuffled(s, c) for s, (c, _) in enumerate(slots)]
    found = ndcg_of_all(scores, wide, group, gain, k, on_short, tiebreak, hot_rows)
    metric = dict(enumerate(found))
    out = []
    for i, c in enumerate(columns):
        changes = [metric.get(i * repeats + r, 0.0) - base for r in range(repeats)]
        mean = sum(changes) / repeats
        out.append((c, mean, math.sqrt(sum((x - mean) ** 2 for x in changes) / repeats)))
    return table(df, sorted(out, key=lambda r: r[1]), ["feature", "score", "std"])


def drop_importance(
    df: DataFrame, test: DataFrame, fit: Callable[[DataFrame, Sequence[str]], Score], columns: Sequence[str], group: str, gain: str,
    k: int = 5, tiebreak: Sequence[str] = (),
) -> DataFrame:
    """(feature, score): metric with all columns less the metric of a refit without one."""
    scores = [fit(df, list(columns)), *[fit(df, [x for x in columns if x != c]) for c in columns]]
    base, *without = ndcg_of_all(scores, test, group, gain, k, tiebreak=tiebreak)
    out = [(c, base - value) for c, value in zip(columns, without)]
    return table(df, sorted(out, key=lambda r: -r[1]), ["feature", "score"])


def mean_attribution(df: DataFrame, names: Sequence[str], attribution: str = "attribution") -> DataFrame:
    """(feature, attribution): mean absolute attribution per feature."""
    long = df.select(F.posexplode(col(attribution)).alias("place", "value"))
    # Sums depend on the order of the rows in their last digits, which must not decide a tie of the sixth.
    means = long.groupBy("place").agg(F.round(F.avg(F.abs("value")), 12).alias("attribution"))
    name = F.get(F.array(*[F.lit(n) for n in names]), F.col("place"))
    return means.select(name.alias("feature"), "attribution")
