"""Pairwise ranker with a margin: the squared hinge loss of all in-group pairs, without forming the pairs.

A pair of rows with gain_i > gain_j misses its margin if m = 1 - (s_i - s_j) is above 0,
and costs m^2 / 2. The derivative by a row's score is a sum of m over the other rows
that it misses its margin with, and these lie on one side of its score plus or minus one. So it
follows from running counts and running sums of scores per gain, along an order of
the group's rows by score in which every row also asks at its score plus one. A group of n rows costs n log n, and
one of any size is cut into ranges (:mod:`ordering`). A logistic loss would not split into such sums.

The Hessian of the loss is at most that of the squared error of all pairs, which :mod:`linear` gives from one pass. A step
that divides the gradient by it never raises the loss. Steps go on until NDCG@k of validation rows no longer rises.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from ..operators.metrics import mean_ndcg
from ..operators.ordering import HOT_ROWS, attach, col, has_hot_group, running_total
from ..session import written
from .frames import whole_groups
from .linear import LinearRanker, pair_levels, pair_normal

MAX_LEVELS = 16


def missed(rows: DataFrame, levels: Sequence[float], hot_rows: int | None) -> DataFrame:
    """``rows`` (grp, g, s, ...) with ``n`` and ``total``: how many rows of higher gain score below s + 1, and their scores' sum."""
    asking = rows.withColumns({"_key": F.col("s") + 1.0, "_ask": F.lit(True)})
    there = rows.select("grp", "g", "s", F.col("s").alias("_key"), F.lit(False).alias("_ask"))
    events = asking.unionByName(there, allowMissingColumns=True)
    # The lowest gain is higher than none.
    for i, level in enumerate(levels[1:]):
        counts = ~F.col("_ask") & (F.col("g") == F.lit(level))
        events = events.withColumns({f"_c{i}": F.when(counts, 1.0).otherwise(0.0), f"_s{i}": F.when(counts, F.col("s")).otherwise(0.0)})
    for i in range(len(levels) - 1):
        for name in (f"_c{i}", f"_s{i}"):
            events = running_total(events, ["grp"], ["_key", "_ask"], name, "_t" + name, hot_rows)

    def above(kind: str):
        parts = [F.when(F.col("g") < F.lit(level), F.col(f"_t_{kind}{i}")).otherwise(0.0) for i, level in enumerate(levels[1:])]
        return sum(parts, F.lit(0.0))

    return events.filter("_ask").select(*[col(c) for c in rows.columns], above("c").alias("n"), above("s").alias("total"))


def _missed_in(code: np.ndarray, g: np.ndarray, s: np.ndarray, levels: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """``n`` and ``total`` of :func:`missed` for rows of whole groups numbered by ``code``."""
    size = len(s)
    order = np.lexsort([np.repeat([1, 0], size), np.append(s + 1.0, s), np.append(code, code)])
    asks, at = order < size, order % size
    group, row = code[at], at[asks]
    first = np.searchsorted(group, group)
    n, total = np.zeros(size), np.zeros(size)
    for level in levels[1:]:
        counts = ~asks & (g[at] == level)
        lower = g[row] < level
        for out, value in ((n, np.where(counts, 1.0, 0.0)), (total, np.where(counts, s[at], 0.0))):
            run = np.append(0.0, np.cumsum(value))
            out[row] += np.where(lower, (run[:-1] - run[first])[asks], 0.0)
    return n, total


def _group_gradient(weights: np.ndarray, levels: tuple[float, ...], per_group: bool):
    names = [f"x{i}" for i in range(len(weights))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gradient = np.zeros(len(weights))
        for frame in whole_groups(batches, "grp"):
            x, g, code = frame[names].to_numpy(float), frame["g"].to_numpy(float), pd.factorize(frame["grp"])[0]
            s = np.zeros(len(x))
            for i, w in enumerate(weights):
                s = s + x[:, i] * w
            omega = np.ones(len(x))
            if per_group:
                groups = int(code.max()) + 1
                rest = np.bincount(code, minlength=groups) * 1.0
                pairs = rest * (rest - 1) / 2
                for level in levels:
                    held = np.bincount(code[g == level], minlength=groups)
                    pairs -= held * (held - 1) / 2
                omega = np.where(pairs > 0, 1.0 / np.maximum(pairs, 1.0), 0.0)[code]
            # A row of lower gain, and mirrored one of higher gain.
            for sign, gains, scores, steps in ((1.0, g, s, levels), (-1.0, -g, -s, tuple(-v for v in reversed(levels)))):
                n, total = _missed_in(code, gains, scores, steps)
                gradient += (sign * omega * (n * (1.0 + scores) - total)) @ x
        yield pd.DataFrame({"i": np.arange(len(gradient)), "v": gradient})

    return run


@dataclass(frozen=True)
class Pairs:
    """Rows ready for gradients: grp, g, x (standardised array), omega (weight of the group's pairs).

    Where no group is hot, ``rows`` are kept by group instead, as grp, g and a column per input, and a gradient is a pass over them.
    """

    rows: DataFrame
    levels: tuple[float, ...]
    size: int
    hot_rows: int | None
    per_group: bool = True

    def close(self) -> None:
        """Forget kept rows."""
        self.rows.unpersist()

    def gradient(self, weights: Sequence[float]) -> np.ndarray:
        """Of the loss over all pairs, by the weights."""
        if self.hot_rows is None:
            run = _group_gradient(np.array(weights, float), self.levels, self.per_group)
            parts = self.rows.mapInPandas(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
            found = {r["i"]: r["v"] for r in parts}
            return np.array([found.get(i, 0.0) for i in range(self.size)])
        terms = [F.get("x", F.lit(i)) * F.lit(float(w)) for i, w in enumerate(weights)]
        scored = self.rows.withColumn("s", sum(terms, F.lit(0.0)))
        # A row of lower gain, and mirrored one of higher gain.
        mirrored = scored.withColumns({"s": -F.col("s"), "g": -F.col("g")})
        both = None
        for sign, rows, levels in ((1.0, scored, self.levels), (-1.0, mirrored, tuple(-v for v in reversed(self.levels)))):
            found = missed(rows, levels, self.hot_rows)
            pull = F.lit(sign) * F.col("omega") * (F.col("n") * (1.0 + F.col("s")) - F.col("total"))
            part = found.agg(*[F.coalesce(F.sum(pull * F.get("x", F.lit(i))), F.lit(0.0)).alias(f"d{i}") for i in range(self.size)])
            both = part if both is None else both.unionByName(part)
        return np.array([[row[f"d{i}"] for i in range(self.size)] for row in both.collect()]).sum(axis=0)


def pairs_of(
    df: DataFrame, group: str, gain: str, ranker: LinearRanker, per_group: bool = True, hot_rows: int | None = HOT_ROWS
) -> Pairs:
    """The rows of groups, shuffled by group once for all steps; with a hot group, those that have a pair, written once."""
    rows = df.select(col(group).alias("grp"), col(gain).cast("double").alias("g"), F.array(*ranker.standard()).alias("x"))
    rows = rows.filter(F.col("g").isNotNull())
    levels = [r["g"] for r in rows.select("g").distinct().limit(MAX_LEVELS + 1).collect()]
    if len(levels) > MAX_LEVELS:
        raise ValueError(f"more than {MAX_LEVELS} different gains: grade them first")
    # Two events a row meet in a group.
    if hot_rows is None or not has_hot_group(rows, ["grp"], max(1, hot_rows // 2)):
        inputs = [F.get("x", F.lit(i)).alias(f"x{i}") for i in range(len(ranker.columns))]
        kept = rows.filter("grp is not null").select("grp", "g", *inputs).repartition("grp").sortWithinPartitions("grp").persist()
        return Pairs(kept, tuple(sorted(levels)), len(ranker.columns), None, per_group)
    sizes = pair_levels(rows.select("grp", "g"), "grp", "g", hot_rows)
    counted = sizes.groupBy("grp").agg(F.sum(F.col("n") * F.col("lower")).cast("double").alias("pairs")).filter("pairs > 0")
    omega = safe_div(F.lit(1.0), F.col("pairs")) if per_group else F.lit(1.0)
    kept = written(attach(rows, counted, ["grp"], "inner", hot_rows).withColumn("omega", omega).drop("pairs"))
    return Pairs(kept, tuple(sorted(levels)), len(ranker.columns), hot_rows, per_group)


def fit_margin(
    df: DataFrame,
    val: DataFrame,
    group: str,
    gain: str,
    columns: Sequence[str],
    penalty: float = 1e-3,
    per_group: bool = True,
    steps: int = 50,
    patience: int = 3,
    k: int = 5,
    tiebreak: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> LinearRanker:
    """The ranker of the step with the best NDCG@k of ``val``, from least squares on.

    Stops ``patience`` steps after the best one.
    """
    ranker, normal, target = pair_normal(df, group, gain, columns, per_group, hot_rows)
    ridge = penalty * max(np.trace(normal) / len(target), 1e-12)
    bound = normal + ridge * np.eye(len(target))
    pairs = pairs_of(df, group, gain, ranker, per_group, hot_rows)
    weights, best, since = np.linalg.solve(bound, target), (-1.0, None), 0
    for step in range(steps + 1):
        now = replace(ranker, weights=tuple(float(w) for w in weights))
        found = mean_ndcg(now.transform(val), group, "prediction", gain, k, tiebreak, "filter", hot_rows=hot_rows).first()["mean_ndcg"] or 0.0
        best, since = ((found, now), 0) if found > best[0] else (best, since + 1)
        if since >= patience or step == steps:
            break
        weights = weights - np.linalg.solve(bound, pairs.gradient(weights) + ridge * weights)
    pairs.close()
    return best[1]
