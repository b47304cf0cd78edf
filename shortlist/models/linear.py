"""Linear rankers from pairs of rows of one group, without forming the pairs.

The pairwise ranker minimises the squared error of all differences
(x_i - x_j) . w = 1 with gain_i > gain_j. Its normal equations need only counts
and sums per group and gain level (the idea of regularised least squares ranking
by Pahikkala et al., 2007), so a group of n rows costs n and not n * n.

The list-wise ranker weighs a pair by the change of NDCG@k on swapping it
(LambdaRank, Burges et al., 2006). That change is zero unless one of the two is
in the predicted top k, so each row meets at most k others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from ..operators.metrics import ideal_dcg
from ..operators.ordering import HOT_ROWS, attach, col, has_hot_group, running_total, top_k
from ..session import written
from .frames import whole_groups


@dataclass(frozen=True)
class LinearRanker:
    columns: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]

    def standard(self) -> list[Column]:
        """Standardised inputs; unknown values sit at the mean."""
        return [
            F.coalesce((col(c).cast("double") - F.lit(m)) / F.lit(s), F.lit(0.0))
            for c, m, s in zip(self.columns, self.means, self.scales)
        ]

    def score(self) -> Column:
        total = F.lit(0.0)
        for x, w in zip(self.standard(), self.weights):
            total = total + x * F.lit(float(w))
        return total

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.score())

    def attributions(self, df: DataFrame, name: str = "attribution") -> DataFrame:
        """Exact share of each feature in the score, against a mean row."""
        parts = [x * F.lit(float(w)) for x, w in zip(self.standard(), self.weights)]
        return df.withColumn(name, F.array(*parts))


def standardiser(df: DataFrame, columns: Sequence[str]) -> LinearRanker:
    """A ranker of weight zero that knows means and deviations."""
    row = df.agg(
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    n = range(len(columns))
    means = tuple(float(row[f"m{i}"] or 0.0) for i in n)
    scales = tuple(float(row[f"s{i}"] or 0.0) or 1.0 for i in n)
    return LinearRanker(tuple(columns), means, scales, tuple(0.0 for _ in n))


def _partial_sums(columns: list[str]):
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = shift = None
        for batch in batches:
            if len(batch) == 0:
                continue
            x = batch[columns].to_numpy(dtype=float)
            square = x.T @ (x * batch["w"].to_numpy(dtype=float)[:, None])
            linear = batch["c"].to_numpy(dtype=float) @ x
            gram = square if gram is None else gram + square
            shift = linear if shift is None else shift + linear
        if gram is not None:
            yield pd.DataFrame({"i": range(len(gram) + 1), "v": [*gram, shift]})

    return sums


def weighted_sums(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of w * x x' and of c * x over rows of the columns, w and c.

    Each task returns one matrix; they are added row by row in a second
    aggregate. The result has columns * columns numbers.
    """
    columns = list(columns)
    parts = df.select(*columns, "w", "c").mapInPandas(_partial_sums(columns), "i int, v array<double>")
    return _added(parts, len(columns))


def _added(parts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of matrices that tasks return by row (i, v); the row after the last is the vector."""
    rows = (
        parts.select("i", array_to_vector("v").alias("v"))
        .groupBy("i")
        .agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("v"))
        .collect()
    )
    found = {r["i"]: np.array(r["v"]) for r in rows}
    zero = np.zeros(size)
    return np.stack([found.get(i, zero) for i in range(size)]), found.get(size, zero)


def _group_sums(names: list[str], per_group: bool):
    """The sums of :func:`pair_normal` over whole groups, whose rows come in the order of group and gain."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, shift = np.zeros((len(names), len(names))), np.zeros(len(names))
        for frame in whole_groups(batches, "grp"):
            x, group, gain = frame[names].to_numpy(float), frame["grp"].to_numpy(), frame["g"].to_numpy()
            new_group = np.append(True, group[1:] != group[:-1])
            new_level = new_group | np.append(True, gain[1:] != gain[:-1])
            first, at = np.flatnonzero(new_group), np.flatnonzero(new_level)
            sizes, counts = np.diff(np.append(first, len(x))), np.diff(np.append(at, len(x)))
            owner = np.cumsum(new_group)[at] - 1
            lower = at - first[owner]
            pairs = np.bincount(owner, counts * lower.astype(float), minlength=len(first))
            omega = np.where(pairs > 0, 1.0 / np.maximum(pairs, 1.0) if per_group else 1.0, 0.0)
            weight, balance = omega[owner] * (sizes[owner] - counts), omega[owner] * (2.0 * lower + counts - sizes[owner])
            by_level, by_group = np.add.reduceat(x, at), np.add.reduceat(x, first)
            gram += x.T @ (x * np.repeat(weight, counts)[:, None])
            gram += by_level.T @ (by_level * omega[owner][:, None]) - by_group.T @ (by_group * omega[:, None])
            shift += balance @ by_level
        yield pd.DataFrame({"i": range(len(names) + 1), "v": [*gram, shift]})

    return run


def pair_levels(df: DataFrame, group: str, gain: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(group, gain, n, lower, higher, rows): sizes of a level and of the others.

    ``n * lower`` summed over a group is its number of ordered pairs. The level
    table has one row per group and distinct gain, and is walked in order of
    gain, so that gains may also be continuous.
    """
    levels = df.groupBy(col(group), col(gain)).agg(F.count(F.lit(1)).alias("n"))
    below = running_total(levels, [group], [gain], "n", "lower", hot_rows)
    totals = levels.groupBy(col(group)).agg(F.sum("n").alias("rows"))
    return attach(below, totals, [group], "inner").withColumn(
        "higher", F.col("rows") - F.col("lower") - F.col("n")
    )


def pair_differences(df: DataFrame, group: str, gain: str, columns: Sequence[str]) -> DataFrame:
    """Per group: the number of ordered pairs and the summed differences of columns.

    Equal to summing x_i - x_j over all pairs with gain_i > gain_j.
    """
    sums = df.groupBy(col(group), col(gain)).agg(
        F.count(F.lit(1)).alias("_m"), *[F.sum(col(c)).alias(c) for c in columns]
    )
    levels = pair_levels(df, group, gain)
    joined = levels.join(sums, [group, gain])
    return joined.groupBy(col(group)).agg(
        F.sum(F.col("n") * F.col("lower")).alias("pairs"),
        *[F.sum(col(c) * (F.col("lower") - F.col("higher"))).alias(f"diff_{c}") for c in columns],
    )


def pair_normal(
    df: DataFrame, group: str, gain: str, columns: Sequence[str], per_group: bool = True, hot_rows: int | None = HOT_ROWS
) -> tuple[LinearRanker, np.ndarray, np.ndarray]:
    """A standardiser, and the weighted sums of (x_i - x_j)(x_i - x_j)' and of x_i - x_j over all in-group pairs.

    Over the pairs of a group, the sum of (x_i - x_j)(x_i - x_j)' is that of
    x x' over its rows, weighted by the rows of other gains, less the outer
    product of the group's sum, plus those of the sums per gain. Without a group above
    ``hot_rows`` rows one shuffle by group serves all of them. Else all three are
    rows with a weight, added up in one pass. Rows without a group or gain are left out.
    """
    ranker = standardiser(df, columns)
    names = [f"x{i}" for i in range(len(ranker.columns))]
    rows = df.select(
        col(group).alias("grp"), col(gain).alias("g"), *[x.alias(n) for n, x in zip(names, ranker.standard())]
    )
    rows = rows.filter("grp is not null and g is not null")
    if hot_rows is None or not has_hot_group(rows, ["grp"], hot_rows):
        parts = rows.repartition("grp").sortWithinPartitions("grp", "g").mapInPandas(_group_sums(names, per_group), "i int, v array<double>")
        return ranker, *_added(parts, len(names))
    levels = pair_levels(rows.select("grp", "g"), "grp", "g", hot_rows)
    pairs = F.sum(F.col("n") * F.col("lower"))
    weight = safe_div(F.lit(1.0), F.col("pairs")) if per_group else F.lit(1.0)
    counted = attach(levels, levels.groupBy("grp").agg(pairs.alias("pairs")), ["grp"], "inner").filter("pairs > 0")
    weighed = written(
        counted.select(
            "grp",
            "g",
            weight.cast("double").alias("omega"),
            (weight * (F.col("rows") - F.col("n"))).cast("double").alias("w"),
            (weight * (F.col("lower") - F.col("higher"))).cast("double").alias("c"),
        )
    )
    met = attach(rows, weighed, ["grp", "g"], "inner", hot_rows)
    by_level = met.groupBy("grp", "g", "omega").agg(*[F.sum(n).alias(n) for n in names])
    by_group = by_level.groupBy("grp").agg(F.max("omega").alias("omega"), *[F.sum(n).alias(n) for n in names])
    nothing = F.lit(0.0).alias("c")
    parts = (
        met.select(*names, "w", "c")
        .unionByName(by_level.select(*names, F.col("omega").alias("w"), nothing))
        .unionByName(by_group.select(*names, (-F.col("omega")).alias("w"), nothing))
    )
    return ranker, *weighted_sums(parts, names)


def fit_pairwise(
    df: DataFrame,
    group: str,
    gain: str,
    columns: Sequence[str],
    penalty: float = 1e-3,
    per_group: bool = True,
    hot_rows: int | None = HOT_ROWS,
) -> LinearRanker:
    """Least squares on all in-group pairs; each group counts once with ``per_group``."""
    return solve_pairwise(pair_normal(df, group, gain, columns, per_group, hot_rows), penalty=penalty)


def solve_pairwise(
    sums: tuple[LinearRanker, np.ndarray, np.ndarray], columns: Sequence[str] | None = None, penalty: float = 1e-3
) -> LinearRanker:
    """The ranker of some of the columns, all by default, from the sums of :func:`pair_normal`.

    A column is standardised by itself, so the sums of fewer columns are a part of those of all.
    """
    ranker, normal, target = sums
    if columns is not None:
        kept = [ranker.columns.index(c) for c in columns]
        normal, target = normal[np.ix_(kept, kept)], target[kept]
        means, scales = (tuple(v[i] for i in kept) for v in (ranker.means, ranker.scales))
        ranker = LinearRanker(tuple(columns), means, scales, tuple(0.0 for _ in kept))
    ridge = penalty * max(np.trace(normal) / len(target), 1e-12)
    weights = np.linalg.solve(normal + ridge * np.eye(len(target)), target)
    return replace(ranker, weights=tuple(float(w) for w in weights))


def _pulled(x, s, g, ideal, row, ts, tg, tid, tx, discount):
    """The gradient of rows against the first k of their groups; ``tid`` is -1 where a group has fewer."""
    here = tid >= 0
    own = ((tid == row) * discount).sum(axis=1)[:, None]
    # A pair counts once, with the row behind the top row.
    behind = here & ((s < ts) | ((s == ts) & (row > tid)))
    sign = np.sign(tg - g)
    swing = np.abs(tg - g) * np.abs(discount[None, :] - own) / ideal
    margin = np.clip(sign * (ts - s), -50, 50)
    pull = np.where(behind, sign * swing / (1.0 + np.exp(margin)), 0.0)
    return np.einsum("np,npd->d", pull, tx) - pull.sum(axis=1) @ x


def _group_step(k: int, weights: np.ndarray):
    """The gradient over whole groups, and as last number how many of them have a gain."""
    discount = 1.0 / np.log2(np.arange(k) + 2.0)
    names = [f"x{i}" for i in range(len(weights))]

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(weights) + 1)
        for frame in whole_groups(batches, "grp"):
            code = pd.factorize(frame["grp"])[0]
            x, g, row = frame[names].to_numpy(float), frame["g"].to_numpy(float), frame["row"].to_numpy()
            sizes = np.bincount(code)
            starts, known = np.cumsum(sizes) - sizes, np.nan_to_num(g)
            best = np.lexsort([-known, code])
            place = np.arange(len(code)) - starts[code[best]]
            front = place < k
            ideal = np.bincount(code[best[front]], known[best[front]] * discount[place[front]], minlength=len(sizes))
            total[-1] += (ideal > 0).sum()
            s = np.zeros(len(x))
            for i, w in enumerate(weights):
                s = s + x[:, i] * w
            order = np.lexsort([row, -s, code])
            place = np.arange(len(code)) - starts[code[order]]
            front = place < k
            top = np.full((len(sizes), k), -1)
            top[code[order[front]], place[front]] = order[front]
            used = np.flatnonzero(ideal[code] > 0)
            if len(used) == 0:
                continue
            met = top[code[used]]
            tid = np.where(met >= 0, row[met], -1)
            total[:-1] += _pulled(
                x[used], s[used][:, None], g[used][:, None], ideal[code[used]][:, None], row[used][:, None], s[met], g[met], tid, x[met], discount
            )
        yield pd.DataFrame({"v": [total]})

    return step


def _lambda_step(k: int):
    discount = 1.0 / np.log2(np.arange(k) + 2.0)

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch) == 0:
                continue
            x, ts, tg, tid, tx = (np.stack(batch[c].to_numpy()) for c in ("x", "ts", "tg", "tid", "tx"))
            s, g, ideal = (batch[c].to_numpy(dtype=float)[:, None] for c in ("s", "g", "idcg"))
            row = batch["row"].to_numpy()[:, None]
            n, size = x.shape
            gradient = _pulled(x, s, g, ideal, row, ts, tg, tid, tx.reshape(n, k, size), discount)
            total = gradient if total is None else total + gradient
        if total is not None:
            yield pd.DataFrame({"v": [total]})

    return step


def _padded(entries: Column, k: int, filler: Column) -> Column:
    return F.concat(entries, F.array_repeat(filler, (F.lit(k) - F.size("top")).cast("int")))


def _joined_gradient(rows: DataFrame, k: int, hot_rows: int | None):
    """The gradient where a group may be of any size: rows are joined to the first k of their group."""
    ideal = ideal_dcg(rows, "grp", "g", k).filter(F.col("idcg") > 0)
    graded = written(attach(rows, ideal, ["grp"], "inner", hot_rows))
    groups = max(ideal.count(), 1)

    def gradient(weights: np.ndarray) -> tuple[np.ndarray | None, int]:
        terms = [F.get("x", F.lit(i)) * F.lit(float(w)) for i, w in enumerate(weights)]
        score = F.lit(0.0)
        for t in terms:
            score = score + t
        scored = graded.withColumn("s", score)
        top = (
            top_k(scored, ["grp"], ["-s", "row"], k)
            .groupBy("grp")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "g", "s", "row", "x"))).alias("top"))
        )
        nothing = F.array(*[F.lit(0.0)] * len(weights))
        top = top.select(
            "grp",
            _padded(F.col("top.s"), k, F.lit(0.0)).alias("ts"),
            _padded(F.col("top.g"), k, F.lit(0.0)).alias("tg"),
            _padded(F.col("top.row"), k, F.lit(-1).cast("bigint")).alias("tid"),
            F.flatten(_padded(F.col("top.x"), k, nothing)).alias("tx"),
        )
        joined = attach(scored, top, ["grp"], "inner", hot_rows, source=graded).drop("grp")
        parts = joined.mapInPandas(_lambda_step(k), "v array<double>")
        total = parts.agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).first()["v"]
        return (np.array(total) if total else None), groups

    return gradient


def fit_listwise(
    df: DataFrame,
    group: str,
    gain: str,
    columns: Sequence[str],
    k: int = 5,
    steps: int = 50,
    rate: float = 1.0,
    start: LinearRanker | None = None,
    tolerance: float = 0.02,
    hot_rows: int | None = HOT_ROWS,
) -> LinearRanker:
    """Gradient steps on NDCG@k-weighted pairs, from a start such as the pairwise ranker.

    Steps end once the gradient is ``tolerance`` times the first in size, or after ``steps``. Without a group above ``hot_rows``
    rows they are shuffled by group once and kept, and a step is a pass over them; else each step joins rows to the first k.
    """
    ranker = start or standardiser(df, columns)
    base = df.select(
        col(group).alias("grp"),
        col(gain).cast("double").alias("g"),
        F.array(*ranker.standard()).alias("x"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written once: row numbers must not change between steps.
    rows = written(base).filter("grp is not null")
    if hot_rows is None or not has_hot_group(rows, ["grp"], hot_rows):
        named = rows.select("grp", "g", "row", *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(len(ranker.weights))])
        kept = named.repartition("grp").sortWithinPartitions("grp").persist()

        def gradient(weights: np.ndarray) -> tuple[np.ndarray | None, int]:
            parts = kept.mapInPandas(_group_step(k, weights), "v array<double>")
            found = parts.agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).first()["v"]
            if not found or found[-1] == 0:
                return None, 1
            return np.array(found[:-1]), int(found[-1])
    else:
        kept = None
        gradient = _joined_gradient(rows, k, hot_rows)
    weights, first = np.array(ranker.weights), None
    for _ in range(steps):
        total, groups = gradient(weights)
        if total is None:
            break
        size = float(np.linalg.norm(total))
        first = size if first is None else first
        weights = weights + rate * total / groups
        if size <= tolerance * first:
            break
    if kept is not None:
        kept.unpersist()
    return replace(ranker, weights=tuple(float(w) for w in weights))

