"""Summaries, histograms and correlations of columns."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .ordering import HOT_ROWS, col, exact_quantiles, positions, running_total

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
PAIRS_PER_PASS = 1500
# A sketch errs by at most one in ACCURACY of the rows; a bracket reaches BRACKET times as far to each side.
ACCURACY = 1000
BRACKET = 1.5


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value), one row per cell."""
    numeric = df.select(*[col(c).cast("double").alias(c) for c in columns])
    return numeric.unpivot([], list(columns), "column", "value")


def _entries(columns: Sequence[str], values: Sequence[dict]) -> Column:
    """A few driver-side numbers per column as an array of structs."""
    return F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.lit(v).cast(kind).alias(k) for k, (v, kind) in one.items()])
            for c, one in zip(columns, values)
        ]
    )


def _inside(df: DataFrame, numbers: Sequence[Column], brackets: dict[tuple[int, int], tuple[float, float]]) -> DataFrame:
    """(column, share, value, c): per task the values in each bracket with their counts, and the count below it under a null value."""
    used = sorted({i for i, _ in brackets})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        below = dict.fromkeys(brackets, 0)
        for batch in batches:
            values = {i: batch[f"v{i}"].to_numpy(float) for i in used}
            for (i, q), (lo, hi) in brackets.items():
                below[i, q] += int((values[i] < lo).sum())
                held, counts = np.unique(values[i][(values[i] >= lo) & (values[i] <= hi)], return_counts=True)
                yield pd.DataFrame({"column": i, "share": q, "value": held, "c": counts})
        yield pd.DataFrame([(i, q, None, c) for (i, q), c in below.items()], columns=["column", "share", "value", "c"])

    narrow = df.select(*[numbers[i].alias(f"v{i}") for i in used])
    return narrow.mapInPandas(run, "column int, share int, value double, c bigint")


def summary(df: DataFrame, columns: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    The first scan gives the moments and, from sketches, two values around each
    quartile; the second how many values lie below, and those between, which are few. If the quartile is proven
    to lie between, its place among them decides; else all values of that column are counted one by one.
    """
    columns = list(columns)
    stats = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    numbers = [col(c).cast("double") for c in columns]
    shares = list(QUARTILES.values())
    around = [min(1.0, max(0.0, s + side * BRACKET / ACCURACY)) for s in shares for side in (-1, 1)]
    row = df.agg(
        *[f(x).alias(f"{s}{i}") for i, x in enumerate(numbers) for s, f in stats.items()],
        *[F.percentile_approx(x, around, ACCURACY).alias(f"a{i}") for i, x in enumerate(numbers)],
    ).first()
    brackets = {
        (i, q): (row[f"a{i}"][2 * q], row[f"a{i}"][2 * q + 1]) for i in range(len(columns)) if row[f"n{i}"] for q in range(len(shares))
    }
    values = [{s: (row[f"{s}{i}"], "bigint" if s == "n" else "double") for s in stats} for i in range(len(columns))]
    moments = df.sparkSession.range(1, numPartitions=1).select(F.inline(_entries(columns, values)))
    if not brackets:
        return moments.select("*", *[F.lit(None).cast("double").alias(q) for q in QUARTILES])
    found = written(_inside(df, numbers, brackets))
    below = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("c"))), F.lit(0))
    inside = F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("c"))), F.lit(0))
    counts = {
        (r["column"], r["share"]): (r["below"], r["inside"])
        for r in found.groupBy("column", "share").agg(below.alias("below"), inside.alias("inside")).collect()
    }

    def proven(i: int, q: int) -> bool:
        place, (before, count) = shares[q] * (row[f"n{i}"] - 1), counts[i, q]
        return before <= int(place) and -(-place // 1) < before + count

    held = [i for i in range(len(columns)) if row[f"n{i}"] and all(proven(i, q) for q in range(len(shares)))]
    parts = []
    if held:
        each = found.filter(F.col("value").isNotNull() & F.col("column").isin(held))
        each = each.groupBy("column", "share", "value").agg(F.sum("c").alias("_c"))
        placed = running_total(each, ["column", "share"], ["value"], "_c", "_start", hot_rows)
        known = F.lit(None).cast("struct<start:bigint,place:double>")
        for i in held:
            for q, share in enumerate(shares):
                here = F.struct(F.lit(counts[i, q][0]).cast("bigint").alias("start"), F.lit(share * (row[f"n{i}"] - 1)).alias("place"))
                known = F.when((F.col("column") == i) & (F.col("share") == q), here).otherwise(known)
        ranked = placed.withColumn("_k", known).withColumn("_from", F.col("_k.start") + F.col("_start"))
        picks = []
        for q, name in enumerate(QUARTILES):
            place = F.col("_k.place")

            def at(where: Column, q: int = q) -> Column:
                here = (F.col("share") == q) & (F.col("_from") <= where) & (where < F.col("_from") + F.col("_c"))
                return F.max(F.when(here, F.col("value")))

            low, high = at(F.floor(place)), at(F.ceil(place))
            part = F.max(F.when(F.col("share") == q, place - F.floor(place)))
            picks.append((low + (high - low) * part).alias(name))
        name = F.get(F.array(*map(F.lit, columns)), F.col("column"))
        picked = ranked.groupBy("column").agg(*picks)
        parts.append(picked.select(name.alias("column"), *QUARTILES))
    rest = [c for i, c in enumerate(columns) if row[f"n{i}"] and i not in held]
    if rest:
        parts.append(exact_quantiles(long_form(df, rest), ["column"], "value", QUARTILES, hot_rows))
    return moments.join(functools.reduce(DataFrame.unionByName, parts), ["column"], "left")


def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1-based bin of equal width; the upper end belongs to the last."""
    return F.least(F.floor((x - lo) / ((hi - lo) / bins)) + 1, F.lit(bins)).cast("bigint")


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """(bin, low, high, n): equal-width bins over [min, max], empty ones too."""
    x = col(column).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).select(
        # A single value gets a bin range of width one around it.
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    bucket = _bin(x, lo, hi, bins)
    counts = df.filter(x.isNotNull()).groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    numbered = ends.filter(F.col("lo").isNotNull()).select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    frame = numbered.select(
        F.col("bin").cast("bigint").alias("bin"),
        (F.col("lo") + (F.col("bin") - 1) * width).alias("low"),
        (F.col("lo") + F.col("bin") * width).alias("high"),
    )
    return frame.join(counts, ["bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def corr_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every pair of columns, over rows where both are known.

    All pairs of one pass share a single aggregate; many columns take several.
    """
    pairs = list(combinations(columns, 2))
    out = None
    for at in range(0, len(pairs), PAIRS_PER_PASS):
        part = pairs[at : at + PAIRS_PER_PASS]
        row = df.agg(
            *[F.corr(col(a).cast("double"), col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(part)]
        )
        entries = [
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("corr"))
            for i, (a, b) in enumerate(part)
        ]
        table = row.select(F.inline(F.array(*entries)))
        out = table if out is None else out.unionByName(table)
    return out


def corr_strength(corr: DataFrame) -> DataFrame:
    """(column, total, place): summed absolute correlation, weakest first.

    Each pair adds to both of its columns, once from either side, hence the
    factor 2. Undefined correlations add nothing.
    """
    ends = corr.select(F.explode(F.array("a", "b")).alias("column"), F.abs(F.col("corr")).alias("r"))
    totals = ends.groupBy("column").agg((F.lit(2.0) * F.coalesce(F.sum("r"), F.lit(0.0))).alias("total"))
    return positions(totals, [], ["total", "column"], "place", hot_rows=None)


def strongest_columns(corr: DataFrame, drop: int = 3, take: int = 20) -> DataFrame:
    """The ``take`` strongest columns after leaving out the ``drop`` very strongest."""
    ranked = corr_strength(corr)
    count = ranked.agg(F.count(F.lit(1)).alias("n")).scalar()
    last = count - F.lit(drop)
    return ranked.filter((F.col("place") < last) & (F.col("place") >= last - F.lit(take)))


def corr_report(df: DataFrame, columns: Sequence[str], drop: int = 3, take: int = 20) -> DataFrame:
    """Correlations among the strongest columns, as a long table."""
    corr = corr_long(df, columns)
    kept = strongest_columns(corr, drop, take).select("column")
    return corr.join(kept.withColumnRenamed("column", "a"), ["a"], "left_semi").join(
        kept.withColumnRenamed("column", "b"), ["b"], "left_semi"
    )


def column_profile(df: DataFrame, columns: Sequence[str], bins: int = 100) -> DataFrame:
    """Summary and histogram of each column in one long table."""
    base = summary(df, columns)
    stats = [c for c in base.columns if c != "column"]
    parts = base.select("column", *[col(s).cast("double").alias(s) for s in stats]).unpivot(
        ["column"], stats, "item", "value"
    )
    counts = _histograms(df, columns, bins).select(
        "column", F.concat(F.lit("bin_"), F.col("bin").cast("string")).alias("item"), F.col("n").cast("double").alias("value")
    )
    return parts.unionByName(counts)


def _histograms(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """(column, bin, n) of all columns, empty bins too: one scan for the ends and one for the counts.

    A column without a known value has no bins.
    """
    numbers = [col(c).cast("double") for c in columns]
    ends = df.agg(*[f(x).alias(f"{e}{i}") for i, x in enumerate(numbers) for e, f in (("lo", F.min), ("hi", F.max))]).first()
    entries, names = [], []
    for i, (c, x) in enumerate(zip(columns, numbers)):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None:
            continue
        names.append(c)
        lo, hi = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
        entries.append(F.struct(F.lit(c).alias("column"), _bin(x, F.lit(lo), F.lit(hi), bins).alias("bin")))
    if not entries:
        return df.select(F.lit("").alias("column"), F.lit(0).cast("bigint").alias("bin"), F.lit(0).cast("bigint").alias("n")).limit(0)
    counts = df.select(F.inline(F.array(*entries))).filter(F.col("bin").isNotNull())
    counts = counts.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(1, bins + 1).select(F.explode(F.array(*map(F.lit, names))).alias("column"), F.col("id").alias("bin"))
    return frame.join(counts, ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def family_importance(importance: DataFrame, feature: str = "feature", score: str = "score") -> DataFrame:
    """Importance by feature family; features of no family are left out."""
    from ..functions.columns import feature_family

    return (
        importance.select(feature_family(col(feature)).alias("family"), col(score).alias("score"))
        .filter(F.col("family") != "")
        .groupBy("family")
        .agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("features"))
    )
