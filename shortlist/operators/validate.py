"""Checks of a ranked output against a sample of the expected form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import col


def _row_counts(sample: DataFrame, ours: DataFrame) -> DataFrame:
    count = F.count(F.lit(1)).alias("n")
    expected = sample.agg(count).select(F.col("n").alias("expected"))
    found = ours.agg(count).select(F.col("n").alias("_found")).scalar()
    return expected.withColumn("found", found).select(
        F.lit("row_count").alias("kind"), F.lit(None).cast("string").alias("key"), "expected", "found"
    )


def _group_counts(sample: DataFrame, ours: DataFrame, group: str) -> DataFrame:
    a = sample.groupBy(col(group)).agg(F.count(F.lit(1)).alias("expected"))
    b = ours.groupBy(col(group).alias("_g")).agg(F.count(F.lit(1)).alias("found"))
    both = a.join(b, col(group).eqNullSafe(F.col("_g")), "full_outer")
    return both.select(
        F.lit("group_count").alias("kind"),
        F.coalesce(col(group), F.col("_g")).cast("string").alias("key"),
        F.coalesce("expected", F.lit(0)).alias("expected"),
        F.coalesce("found", F.lit(0)).alias("found"),
    )


def _positions(sample: DataFrame, ours: DataFrame, group: str, position: str) -> DataFrame:
    a = sample.select(col(position).alias("_p"), col(group).alias("expected"), F.lit(1).alias("_in_a"))
    b = ours.select(col(position).alias("_q"), col(group).alias("found"), F.lit(1).alias("_in_b"))
    both = a.join(b, F.col("_p") == F.col("_q"), "full_outer")
    paired = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    return both.select(
        F.when(paired, "group_sequence").otherwise("index").alias("kind"),
        F.coalesce("_p", "_q").cast("string").alias("key"),
        F.col("expected").cast("bigint").alias("expected"),
        F.col("found").cast("bigint").alias("found"),
    )


def validate(sample: DataFrame, ours: DataFrame, group: str, position: str | None = None) -> DataFrame:
    """Table of violations (kind, key, expected, found); empty if all is well.

    Compares the number of rows, the rows of each group and, with a position
    column, the group at each position and the positions themselves.
    """
    checks = _row_counts(sample, ours).unionByName(_group_counts(sample, ours, group))
    if position:
        checks = checks.unionByName(_positions(sample, ours, group, position))
    return checks.filter(~F.col("expected").eqNullSafe(F.col("found")))


def rank_gaps(ranked: DataFrame, group: str, rank: str = "rank") -> DataFrame:
    """Groups whose ranks are not exactly 1..n."""
    each = ranked.groupBy(col(group), col(rank).alias("_r")).agg(F.count(F.lit(1)).alias("_c"))
    return (
        each.groupBy(col(group))
        .agg(F.sum("_c").alias("n"), F.min("_r").alias("first"), F.max("_r").alias("last"), F.max("_c").alias("copies"))
        .filter((F.col("first") != 1) | (F.col("last") != F.col("n")) | (F.col("copies") > 1))
    )
