"""Small expressions shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.DoubleType, T.FloatType)


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_div(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that gives NULL for a zero denominator."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def nan_to_null(value: str | Column) -> Column:
    return F.nanvl(as_column(value), F.lit(None).cast("double"))


def nans_to_nulls(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, once, at ingest."""
    return df.select(
        *[
            nan_to_null(F.col(f.name)).cast(f.dataType).alias(f.name)
            if isinstance(f.dataType, FRACTIONAL)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def row_min(columns: Iterable[str]) -> Column:
    """Smallest non-null value across columns of one row."""
    return F.least(*[F.col(c) for c in columns])


def flag(condition: Column) -> Column:
    """A condition as boolean, with unknown counted as false."""
    return F.coalesce(condition, F.lit(False))


def add_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns in one projection."""
    return df.withColumns(columns)


def graded_target(click: str, book: str) -> Column:
    """5 for a booking, 1 for a click, 0 otherwise; unknown flags count as 0."""
    return F.when(F.col(book) > 0, 5).when(F.col(click) > 0, 1).otherwise(0)


def business_trip(children: str, adults: str, saturday: str, stay: str, longest: int = 5) -> Column:
    """One adult without children, no Saturday night, a short stay."""
    return flag(
        (F.col(children) == 0)
        & (F.col(adults) == 1)
        & (F.col(saturday) == 0)
        & (F.col(stay) <= longest)
    )


def off_grid(value: str, step: float) -> Column:
    """Known values that are no multiple of ``step``."""
    return F.col(value).isNotNull() & (F.col(value) % F.lit(float(step)) != 0)


def class_score(label: str | Column, probabilities: str | Column) -> Column:
    """Orderable score of a class prediction: best probability times class.

    Class 0 counts as 0.01, so that rows of class 0 stay ordered too.
    """
    weight = F.when(as_column(label) == 0, F.lit(0.01)).otherwise(as_column(label).cast("double"))
    return F.array_max(as_column(probabilities)) * weight


def log_discount(rank: str | Column) -> Column:
    """Divisor of the gain at a 1-based rank."""
    return F.log2(as_column(rank) + F.lit(1))


def feature_family(name: str | Column) -> Column:
    """What follows the first ``per_`` of a feature name, further marks removed."""
    parts = F.split(as_column(name), "per_")
    return F.array_join(F.slice(parts, F.lit(2), F.size(parts)), "")


def draw(keys: Sequence[str], seed: int = 42) -> Column:
    """A random number in [0, 1) that depends on the key columns and the seed alone.

    It is taken from an md5 digest, which every engine computes alike. Unknown keys are left out of the digested text.
    """
    text = F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
