"""Ranking, rating and class metrics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import log_discount, safe_div
from .frames import whole_groups
from .ordering import HOT_ROWS, col, has_hot_group, prefixed, running_total, same_keys, top_k, window


def _discounted(gain: str, rank: str = "rank", k: int | None = None) -> Column:
    """Discounted gain of a group, of ranks up to ``k``; an unknown gain adds nothing."""
    part = safe_div(col(gain).cast("double"), log_discount(rank))
    return F.coalesce(F.sum(part if k is None else F.when(col(rank) <= k, part)), F.lit(0.0))


def _first(score: str, ascending: bool) -> str:
    return score if ascending else "-" + score


def _keys(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def dcg(
    df: DataFrame, group: str | Sequence[str], score: str, gain: str, k: int = 5, tiebreak: Sequence[str] = (), ascending: bool = False
) -> DataFrame:
    """Discounted gain of the first ``k`` rows of each group, with their number."""
    keys = _keys(group)
    top = top_k(df, keys, [_first(score, ascending), *tiebreak], k)
    return top.groupBy(*[col(c) for c in keys]).agg(_discounted(gain).alias("dcg"), F.count(F.lit(1)).alias("depth"))


def ideal_dcg(df: DataFrame, group: str | Sequence[str], gain: str, k: int = 5) -> DataFrame:
    """Best discounted gain that the rows of a group allow."""
    keys = _keys(group)
    top = top_k(df.select(*[col(c) for c in [*keys, gain]]), keys, ["-" + gain], k)
    return top.groupBy(*[col(c) for c in keys]).agg(_discounted(gain).alias("idcg"))


def _both_orders(df: DataFrame, keys: list[str], order: list[str], gain: str, k: int) -> DataFrame:
    """Predicted and ideal gain from one shuffle, for groups that fit a task."""
    ranked = df.select(
        *[col(c) for c in [*keys, gain]],
        F.row_number().over(window(keys, order)).alias("_rank"),
        F.row_number().over(window(keys, ["-" + gain])).alias("_ideal"),
    )
    return ranked.groupBy(*[col(c) for c in keys]).agg(
        _discounted(gain, "_rank", k).alias("dcg"),
        _discounted(gain, "_ideal", k).alias("idcg"),
        F.least(F.count(F.lit(1)), F.lit(k)).alias("depth"),
    )


def _limited_orders(df: DataFrame, keys: list[str], score: str, gain: str, k: int, tiebreak: Sequence[str], ascending: bool) -> DataFrame:
    """Predicted and ideal gain for groups of any size.

    Each order is cut to k rows per group by every task before its shuffle, and
    both come out partitioned by group, so joining them moves nothing.
    """
    predicted = dcg(df, keys, score, gain, k, tiebreak, ascending)
    ideal = prefixed(ideal_dcg(df, keys, gain, k), keys, "_i_")
    return predicted.join(ideal, same_keys(keys, "_i_"), "inner")


def ndcg(
    df: DataFrame,
    group: str | Sequence[str],
    score: str,
    gain: str,
    k: int = 5,
    tiebreak: Sequence[str] = (),
    on_short: str = "error",
    ascending: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """NDCG@k per group; 0 where no row has a gain.

    ``on_short`` says what happens to groups of fewer than k rows: "error"
    fails the job, "filter" leaves them out, "keep" scores them.
    """
    if on_short not in ("error", "filter", "keep"):
        raise ValueError("on_short is 'error', 'filter' or 'keep'")
    keys = _keys(group)
    needed = dict.fromkeys([*keys, score, gain, *[t.removeprefix("-") for t in tiebreak]])
    rows = df.select(*[col(c) for c in needed])
    if hot_rows is not None and has_hot_group(rows, keys, hot_rows):
        both = _limited_orders(rows, keys, score, gain, k, tiebreak, ascending)
    else:
        both = _both_orders(rows, keys, [_first(score, ascending), *tiebreak], gain, k)
    if on_short == "filter":
        both = both.filter(F.col("depth") >= k)
    value = F.when(F.col("idcg") == 0, F.lit(0.0)).otherwise(safe_div("dcg", "idcg"))
    if on_short == "error":
        message = F.format_string(f"a group has %d rows, fewer than {k}", F.col("depth"))
        value = F.when(F.col("depth") < k, F.raise_error(message)).otherwise(value)
    return both.select(*[col(c) for c in keys], value.cast("double").alias("ndcg"))


def mean_ndcg(
    df: DataFrame,
    group: str,
    score: str,
    gain: str,
    k: int = 5,
    tiebreak: Sequence[str] = (),
    on_short: str = "error",
    by: str | None = None,
    ascending: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Mean over groups; groups without a gain count as 0.

    With ``by`` (such as a split) there is one row per value.
    """
    keys = [group] if by is None else [group, by]
    scores = ndcg(df, keys, score, gain, k, tiebreak, on_short, ascending, hot_rows)
    means = [F.avg("ndcg").alias("mean_ndcg"), F.count(F.lit(1)).alias("groups")]
    return scores.agg(*means) if by is None else scores.groupBy(col(by)).agg(*means)


def mean_ndcg_of(
    df: DataFrame, group: str, scores: Sequence[str], gain: str, k: int = 5, tiebreak: Sequence[str] = (), on_short: str = "filter",
    hot_rows: int | None = HOT_ROWS,
) -> list[float | None]:
    """:func:`mean_ndcg` of each of several score columns, from one shuffle of the rows.

    ``tiebreak`` are numeric columns. With a group above ``hot_rows`` rows, or ``on_short="error"``, each score has its own pass.
    """
    if on_short == "error" or (hot_rows is not None and has_hot_group(df, [group], hot_rows)):
        each = [mean_ndcg(df, group, s, gain, k, tiebreak, on_short, hot_rows=hot_rows).first() for s in scores]
        return [r["mean_ndcg"] for r in each]
    shown = [f"s{i}" for i in range(len(scores))]
    ties = [f"t{i}" for i in range(len(tiebreak))]
    unknown, most = F.lit(float("-inf")), F.lit(float("inf"))
    rows = df.select(
        col(group).alias("grp"),
        F.coalesce(col(gain).cast("double"), F.lit(0.0)).alias("g"),
        # Unknown gains and scores come last, NaN first, as in Spark's descending order.
        *[F.coalesce(F.nanvl(col(s).cast("double"), most), unknown).alias(n) for s, n in zip(scores, shown)],
        *[(-col(t[1:]) if t.startswith("-") else col(t)).alias(n) for t, n in zip(tiebreak, ties)],
    )
    discount = 1 / np.log2(np.arange(k) + 2.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, groups = np.zeros(len(shown)), 0
        for frame in whole_groups(batches, "grp"):
            code = pd.factorize(frame["grp"], use_na_sentinel=False)[0]
            sizes = np.bincount(code)
            starts, gains = np.cumsum(sizes) - sizes, frame["g"].to_numpy()
            tie = [frame[t].to_numpy() for t in reversed(ties)]

            def gained(key: np.ndarray) -> np.ndarray:
                order = np.lexsort([*tie, key, code])
                place = np.arange(len(code)) - starts[code[order]]
                front = place < k
                return np.bincount(code[order[front]], gains[order[front]] * discount[place[front]], minlength=len(sizes))

            kept = sizes >= k if on_short == "filter" else sizes > 0
            ideal = gained(-gains)[kept]
            for i, name in enumerate(shown):
                found = gained(-frame[name].to_numpy())[kept]
                total[i] += np.divide(found, ideal, out=np.zeros(len(found)), where=ideal != 0).sum()
            groups += int(kept.sum())
        yield pd.DataFrame({"place": np.arange(len(total)), "total": total, "n": groups})

    parts = rows.repartition("grp").sortWithinPartitions("grp").mapInPandas(run, "place int, total double, n bigint")
    found = parts.groupBy("place").agg(F.try_divide(F.sum("total"), F.sum("n")).alias("mean")).collect()
    means = {r["place"]: r["mean"] for r in found}
    return [means.get(i) for i in range(len(shown))]


def rating_errors(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    error = col(truth) - col(predicted)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(col(truth).alias("truth"), col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy, balanced accuracy and macro precision, recall and F1.

    All from one small confusion table. Precision of a class never predicted,
    and F1 of a class never hit, count as 0; balanced accuracy and macro recall
    differ only for classes that are predicted but never true.
    """
    cells = confusion(df, truth, predicted)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("truth").alias("label"),
                    F.col("n").alias("true_n"),
                    F.lit(0).cast("bigint").alias("pred_n"),
                    F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("bigint").alias("true_n"),
                    F.col("n").alias("pred_n"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    per_class = sides.groupBy("label").agg(
        F.sum("true_n").alias("true_n"), F.sum("pred_n").alias("pred_n"), F.sum("hit").alias("hit")
    )
    zero = F.lit(0.0)
    recall = F.coalesce(safe_div("hit", "true_n"), zero)
    precision = F.coalesce(safe_div("hit", "pred_n"), zero)
    f1 = F.coalesce(safe_div(F.lit(2.0) * F.col("hit"), F.col("true_n") + F.col("pred_n")), zero)
    return per_class.agg(
        safe_div(F.sum("hit"), F.sum("true_n")).alias("accuracy"),
        F.avg(safe_div("hit", "true_n")).alias("balanced_accuracy"),
        F.avg(precision).alias("macro_precision"),
        F.avg(recall).alias("macro_recall"),
        F.avg(f1).alias("macro_f1"),
    )


def auc_per_class(df: DataFrame, truth: str, probabilities: dict) -> DataFrame:
    """Area under the ROC curve of each class against the rest.

    ``probabilities`` maps a class to its score column. Rows are first counted
    per distinct score; ties share their rank, as in the rank-sum form.
    """
    parts = None
    for label, score in probabilities.items():
        hit = F.when(col(truth) == F.lit(label), 1).otherwise(0)
        counts = df.groupBy(col(score).alias("_s")).agg(
            F.count(F.lit(1)).alias("_n"), F.sum(hit).alias("_pos")
        ).withColumn("_neg", F.col("_n") - F.col("_pos"))
        placed = running_total(counts, [], ["_s"], "_neg", "_below")
        area = F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2))
        pairs = F.sum("_pos").cast("double") * F.sum("_neg")
        row = placed.agg(safe_div(area, pairs).alias("auc")).select(F.lit(label).alias("label"), "auc")
        parts = row if parts is None else parts.unionByName(row)
    return parts
