"""Smallest sufficient type per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import col

# The signed integer types and their range.
INTEGERS = (
    ("tinyint", -(2**7), 2**7 - 1),
    ("smallint", -(2**15), 2**15 - 1),
    ("int", -(2**31), 2**31 - 1),
    ("bigint", -(2**63), 2**63 - 1),
)
INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def narrowable(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if isinstance(f.dataType, INTEGER_TYPES + FLOAT_TYPES)]


def _target(source: Column, lo: Column, hi: Column, nulls: Column, fractions: Column, mode: str) -> Column:
    fits = F.when(lo.isNull(), source)
    for name, low, high in INTEGERS[:-1]:
        fits = fits.when((lo >= low) & (hi <= high), name)
    # Doubles at the edge of 64 bits round up, so the last type needs strict bounds.
    fits = fits.when((lo > float(INTEGERS[-1][1])) & (hi < float(INTEGERS[-1][2])), "bigint").otherwise(source)
    floating = source.isin("float", "double")
    if mode == "simple":
        return F.when(floating | (nulls > 0), "float").otherwise(fits)
    return F.when(floating & (fractions > 0), "float").otherwise(fits)


def narrow_profile(df: DataFrame, mode: str = "exact") -> DataFrame:
    """(column, source_type, min, max, nulls, fractions, target_type).

    One aggregate over all numeric columns. In "exact" mode a floating column
    without fractional parts counts as integer; in "simple" mode floating
    columns and columns with nulls become float. Strings and other types stay.
    Values that fit no smaller type keep theirs; no column is dropped.
    """
    if mode not in ("exact", "simple"):
        raise ValueError("mode is 'exact' or 'simple'")
    fields = narrowable(df)
    aggs = []
    for i, f in enumerate(fields):
        x = col(f.name)
        aggs += [
            F.min(x).cast("double").alias(f"lo{i}"),
            F.max(x).cast("double").alias(f"hi{i}"),
            F.count_if(x.isNull()).alias(f"nulls{i}"),
            (F.count_if(x != F.floor(x)) if isinstance(f.dataType, FLOAT_TYPES) else F.lit(0).cast("bigint")).alias(f"part{i}"),
        ]
    row = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("source_type"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
            F.col(f"nulls{i}").alias("nulls"),
            F.col(f"part{i}").alias("fractions"),
        )
        for i, f in enumerate(fields)
    ]
    table = row.select(F.inline(F.array(*entries)))
    target = _target(F.col("source_type"), F.col("min"), F.col("max"), F.col("nulls"), F.col("fractions"), mode)
    return table.withColumn("target_type", target)


def narrow(df: DataFrame, mode: str = "exact") -> DataFrame:
    """Cast every numeric column to its target type; one row per column is read."""
    targets = {r["column"]: r["target_type"] for r in narrow_profile(df, mode).collect()}
    return df.select(*[col(c).cast(targets[c]).alias(c) if c in targets else col(c) for c in df.columns])
