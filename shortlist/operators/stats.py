"""Group statistics, join-back features and group-relative values.

Statistics are aggregated first (map-side combined) and joined back, rather than
computed in windows: a window would move every wide row by its key and hold a
whole group in one task. In the join-back a small table of statistics is
broadcast by its measured size, and hot keys are joined apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import safe_div
from .ordering import HOT_ROWS, attach, col, exact_quantiles, has_hot_group, hot_groups, prefixed, same_keys

REL_SHIFT = 1e-2  # keeps relative differences and log10 defined at zero
DEFAULT_AGGS = ("mean", "median", "min", "max")

AGGREGATES = {
    "mean": F.avg,
    "median": F.median,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "std": F.stddev_samp,
}


def key_known(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & col(k).isNotNull()
    return condition


def _measure(agg: str, value: str, approx_median: bool) -> Column:
    if agg == "median" and approx_median:
        return F.percentile_approx(col(value), 0.5)
    return AGGREGATES[agg](col(value))


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    wanted: dict[tuple[str, str], str],
    approx_median: bool = False,
    hot_rows: int | None = HOT_ROWS,
    cleared: list[set[str]] | None = None,
) -> DataFrame:
    """One row per known key; ``wanted`` maps (value, statistic) to a name.

    All values share one aggregate. An exact median keeps the distinct values
    of a group; for groups above ``hot_rows`` rows it is found from running
    counts of equal values instead.
    """
    keys = list(keys)
    key_cols = [col(k) for k in keys]
    values = list(dict.fromkeys(v for v, _ in wanted))
    rows = df.filter(key_known(keys)).select(*[col(c) for c in dict.fromkeys([*keys, *values])])

    def aggregate(part: DataFrame, medians: bool = True) -> DataFrame:
        measures = [
            _measure(a, v, approx_median).alias(n) for (v, a), n in wanted.items() if medians or a != "median"
        ]
        return part.groupBy(*key_cols).agg(*measures) if measures else part.select(*key_cols).distinct()

    split = any(a == "median" for _, a in wanted) and not approx_median and hot_rows is not None
    if not split or not has_hot_group(rows, keys, hot_rows, cleared):
        return aggregate(rows)
    listed = F.broadcast(prefixed(hot_groups(rows, keys, hot_rows).select(*key_cols), keys, "_h_"))
    large = rows.join(listed, same_keys(keys, "_h_"), "left_semi")
    small = rows.join(listed, same_keys(keys, "_h_"), "left_anti")
    hot = aggregate(large, medians=False)
    for (value, agg), name in wanted.items():
        if agg == "median":
            hot = hot.join(exact_quantiles(large, keys, value, {name: 0.5}, hot_rows), keys, "left")
    return aggregate(small).unionByName(hot)


def numeric_columns(df: DataFrame, except_: Iterable[str] = ()) -> list[str]:
    skip = set(except_)
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def zscore_by(
    df: DataFrame,
    group: str | Sequence[str],
    columns: Sequence[str] | None = None,
    suffix: str | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Standardise columns inside each group by mean and sample deviation.

    ``columns=None`` takes every numeric column but the group. With a suffix
    the result is added, without one it replaces the column.
    """
    keys = [group] if isinstance(group, str) else list(group)
    columns = list(columns) if columns is not None else numeric_columns(df, keys)
    stats = df.groupBy(*[col(k) for k in keys]).agg(
        *[F.avg(col(c)).alias(f"_mean_{c}") for c in columns],
        *[F.stddev_samp(col(c)).alias(f"_std_{c}") for c in columns],
    )
    joined = attach(df, stats, keys, hot_rows=hot_rows)
    scores = {
        c + (suffix or ""): safe_div(col(c) - col(f"_mean_{c}"), col(f"_std_{c}")) for c in columns
    }
    kept = [c for c in df.columns if c not in scores]
    return joined.select(*[col(c) for c in kept], *[v.alias(n) for n, v in scores.items()])


def normalize_by(
    df: DataFrame,
    group: str,
    value: str,
    log10: bool = False,
    source: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``{value}[_log10]_norm_by_{group}``; rows with an unknown group are dropped.

    ``source`` is a frame with the same rows to read the statistics from, when
    ``df`` has grown far from its table.
    """
    base = F.log10(col(value) + F.lit(REL_SHIFT)) if log10 else col(value)
    name = value + ("_log10" if log10 else "")
    rows = (df if source is None else source).filter(col(group).isNotNull())
    stats = rows.groupBy(col(group)).agg(F.avg(base).alias("_mean"), F.stddev_samp(base).alias("_std"))
    joined = attach(df, stats, [group], "inner", hot_rows, source)
    score = safe_div(base - F.col("_mean"), F.col("_std"))
    return joined.select(*[col(c) for c in df.columns], score.alias(f"{name}_norm_by_{group}"))


def stat_name(agg: str, value: str, keys: Sequence[str]) -> str:
    return f"{agg}_{value}_per_" + "_per_".join(keys)


def relative_columns(value: str, stats: Sequence[str], relative: bool, compare: Sequence[str]) -> dict[str, Column]:
    """Differences of a value to statistics; sums get none.

    A comparison column is set against the same statistic, and its relative
    difference is divided by the value column too.
    """
    out: dict[str, Column] = {}
    for stat in stats:
        if stat.startswith("sum_"):
            continue
        for column in [value, *compare]:
            difference = col(column) - col(stat)
            out[f"{column}_diff_to_{stat}"] = difference
            if relative:
                out[f"{column}_rel_diff_to_{stat}"] = safe_div(difference, col(value) + F.lit(REL_SHIFT))
    return out


def composite(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    aggs: Sequence[str] = DEFAULT_AGGS,
    relative: bool = True,
    compare: Sequence[str] = (),
    split: str | None = None,
    approx_median: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Group statistics of ``value`` per key set, with differences to them.

    With ``split`` the statistics stay inside each split: the split joins the
    key, so one pass serves all of them. Rows of an unknown split are dropped.
    """
    keys = list(keys)
    names = {a: stat_name(a, value, keys) for a in aggs}
    on = keys if split is None else [*keys, split]
    rows = df if split is None else df.filter(col(split).isNotNull())
    stats = group_stats(rows, on, {(value, a): n for a, n in names.items()}, approx_median, hot_rows)
    compare = [c for c in compare if c in df.columns]
    extra = relative_columns(value, list(names.values()), relative, compare)
    joined = attach(rows, stats, on, hot_rows=hot_rows)
    return joined.select(
        *[col(c) for c in df.columns],
        *[col(n) for n in names.values()],
        *[e.alias(n) for n, e in extra.items()],
    )


def block_names(keys: Sequence[str], columns: Sequence[str]) -> list[tuple[str, str, str]]:
    """(column, statistic, name) of the mean/min/max block."""
    return [(c, a, f"{a}_{c}_over_{k}") for k in keys for a in ("mean", "min", "max") for c in columns]


def block_stats(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Mean, minimum and maximum of many columns over several single keys.

    One aggregate per key, not one per key and statistic. Keys with a hot group
    come first, while rows are only scanned: joining them reads the rows twice.
    """
    out, cleared = df, []
    cool = {k for k in keys if hot_rows is None or not has_hot_group(df, [k], hot_rows, cleared)}
    for k in sorted(keys, key=lambda k: k in cool):
        stats = (
            df.filter(col(k).isNotNull())
            .groupBy(col(k))
            .agg(*[AGGREGATES[a](col(c)).alias(name) for c, a, name in block_names([k], columns)])
        )
        out = attach(out, stats, [k], hot_rows=None if k in cool else hot_rows, source=df)
    return out.select(*[col(c) for c in df.columns], *[col(n) for _, _, n in block_names(keys, columns)])


def block_rel_diff(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Block statistics and the relative difference of each value to them."""
    stats = block_stats(df, keys, columns, hot_rows)
    return stats.withColumns(
        {f"diff_to_{n}": safe_div(col(c) - col(n), col(n)) for c, _, n in block_names(keys, columns)}
    )


def grouped_share(df: DataFrame, key: str, condition: Column, name: str = "share") -> DataFrame:
    """Share of rows per key that meet a condition; unknown counts as no."""
    return df.groupBy(col(key)).agg(F.avg(F.coalesce(condition, F.lit(False)).cast("double")).alias(name))


def value_counts(df: DataFrame, column: str, count: str = "n", share: str = "share") -> DataFrame:
    """Rows per value and their share of all rows."""
    counts = df.groupBy(col(column)).agg(F.count(F.lit(1)).alias(count))
    total = df.agg(F.count(F.lit(1)).alias("_total")).scalar()
    return counts.withColumn(share, safe_div(F.col(count).cast("double"), total))


def count_align(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Add the value counts of two frames; a value missing on one side gives NULL."""
    left = a.groupBy(col(column)).agg(F.count(F.lit(1)).alias("_a"))
    right = b.groupBy(col(column)).agg(F.count(F.lit(1)).alias("_b"))
    return left.join(right, [column], "full_outer").select(col(column), (F.col("_a") + F.col("_b")).alias("n"))


def rate_by_category(df: DataFrame, category: str, flag: str, name: str = "rate") -> DataFrame:
    return df.groupBy(col(category)).agg(F.avg(col(flag).cast("double")).alias(name))


def segment_means(df: DataFrame, key: str, columns: Sequence[str], min_n: int = 10) -> DataFrame:
    """Means of per-key means, for keys seen often and keys seen rarely."""
    per_key = df.groupBy(col(key)).agg(
        F.count(F.lit(1)).alias("_n"), *[F.avg(col(c)).alias(c) for c in columns]
    )
    return per_key.groupBy((F.col("_n") >= min_n).alias("frequent")).agg(*[F.avg(col(c)).alias(c) for c in columns])
