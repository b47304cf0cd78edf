"""Row filters and fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import off_grid, safe_div
from .ordering import HOT_ROWS, attach, col, group_sizes

MISSING_CATEGORY = "NaN_category"  # fixed value


def outlier_by_key(
    df: DataFrame, key: str, value: str, z: float = 2.0, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Keep rows within ``z`` sample deviations of the mean of their key.

    A key with one row or without spread has no z-score; its rows are dropped.
    """
    stats = df.groupBy(col(key)).agg(F.avg(col(value)).alias("_mean"), F.stddev_samp(col(value)).alias("_std"))
    score = safe_div(col(value) - F.col("_mean"), F.col("_std"))
    return attach(df, stats, [key], "inner", hot_rows).filter(F.abs(score) < z).select(*[col(c) for c in df.columns])


def outlier_global(df: DataFrame, value: str, z: float = 2.0) -> DataFrame:
    """Keep rows less than ``z`` population deviations above the overall mean.

    One-sided. Unknown values are left out of mean and deviation, and dropped.
    """
    stats = df.agg(F.avg(col(value)).alias("mean"), F.stddev_pop(col(value)).alias("std"))
    score = safe_div(col(value) - stats.select("mean").scalar(), stats.select("std").scalar())
    return df.filter(score < z)


def off_grid_rows(df: DataFrame, value: str, step: float) -> DataFrame:
    return df.filter(off_grid(value, step))


def min_group_size(
    df: DataFrame, group: str, n: int, item: str | None = None, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Keep the rows of groups with at least ``n`` (known) items."""
    counted = F.count(col(item)) if item else F.count(F.lit(1))
    large = df.groupBy(col(group)).agg(counted.alias("_n")).filter(F.col("_n") >= n).select(col(group))
    return attach(df, large, [group], "left_semi", hot_rows)


def multi_row_groups(df: DataFrame, group: str) -> DataFrame:
    return min_group_size(df, group, 2)


def fill_category(df: DataFrame, columns: Sequence[str], value: str = MISSING_CATEGORY) -> DataFrame:
    """Categories as text, the unknown one under its own name."""
    return df.withColumns({c: F.coalesce(col(c).cast("string"), F.lit(value)) for c in columns})


def members(df: DataFrame, keys: DataFrame, on: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Rows whose key is listed."""
    return attach(df, keys.select(*[col(k) for k in on]).distinct(), on, "left_semi", hot_rows)


def non_members(df: DataFrame, keys: DataFrame, on: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Rows whose key is not listed."""
    return attach(df, keys.select(*[col(k) for k in on]).distinct(), on, "left_anti", hot_rows)


def sizes(df: DataFrame, group: str) -> DataFrame:
    """Rows per group."""
    return group_sizes(df, [group])


def named(df: DataFrame, column: str, prefix: str = "", suffix: str = "", contains: str = "", not_prefix: str = "") -> DataFrame:
    """Filter rows by what a name starts with, ends with or contains."""
    name = col(column)
    keep = F.lit(True)
    if prefix:
        keep = keep & name.startswith(prefix)
    if suffix:
        keep = keep & name.endswith(suffix)
    if contains:
        keep = keep & name.contains(contains)
    if not_prefix:
        keep = keep & ~name.startswith(not_prefix)
    return df.filter(keep)
