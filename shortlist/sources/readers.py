"""Readers. Every one returns a lazy, pruned scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nans_to_nulls
from ..operators.ordering import col, order_by
from ..session import written

NULL_MARK = "NULL"


def read_log(
    spark: SparkSession, path: str | list[str], schema: T.StructType, index_column: bool = False, null_mark: str = NULL_MARK
) -> DataFrame:
    """CSV with a header and a fixed schema; NaN becomes NULL.

    ``index_column`` skips a leading row-number column.
    """
    full = T.StructType([T.StructField("_index", T.LongType()), *schema.fields]) if index_column else schema
    df = spark.read.schema(full).csv(path, header=True, nullValue=null_mark, enforceSchema=True)
    return nans_to_nulls(df.drop("_index") if index_column else df)


@dataclass(frozen=True)
class CheckedScan:
    """Records that could be read, those that could not, and time texts that mean no time."""

    rows: DataFrame
    rejected: DataFrame  # record
    unreadable: DataFrame  # column, text, n

    def counts(self) -> DataFrame:
        """(kind, n): rows, rejected records and unreadable times."""
        parts = [
            self.rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("kind"), "n"),
            self.rejected.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected").alias("kind"), "n"),
            self.unreadable.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("unreadable").alias("kind"), "n"),
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


def header_faults(spark: SparkSession, path: str | list[str], schema: T.StructType, index_column: bool = False) -> list[str]:
    """How the header differs from the schema: missing, unexpected and misplaced columns. Names ignore case."""
    found = [c.lower() for c in spark.read.option("header", True).csv(path).columns][1 if index_column else 0 :]
    wanted = [f.name.lower() for f in schema.fields]
    out = [f"missing {c}" for c in wanted if c not in found] + [f"unexpected {c}" for c in found if c not in wanted]
    return out or [f"{c} is column {i + 1}" for i, c in enumerate(found) if wanted[i] != c]


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    index_column: bool = False,
    null_mark: str = NULL_MARK,
    time_format: str | None = None,
) -> CheckedScan:
    """CSV scan that keeps bad records and bad times apart instead of failing or dropping them.

    A header that differs from the schema raises an error before anything is read. A record that does not fit the
    schema, by a value or by its number of fields, is rejected whole. Times are read as text; a text that means no time
    becomes NULL in its row and is counted with its column. All three parts come from one written parse.
    """
    faults = header_faults(spark, path, schema, index_column)
    if faults:
        raise ValueError("the header does not fit the schema: " + ", ".join(faults))
    times = [f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
    fields = [T.StructField(f.name, T.StringType() if f.name in times else f.dataType) for f in schema.fields]
    before = [T.StructField("_index", T.LongType())] if index_column else []
    full = T.StructType([*before, *fields, T.StructField("_record", T.StringType())])
    options = {"header": True, "nullValue": null_mark, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record"}
    parsed = written(spark.read.schema(full).options(**options).csv(path))
    good = parsed.filter(F.col("_record").isNull())
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    form = [F.lit(time_format)] if time_format else []
    moments = {c: F.try_to_timestamp(col(c), *form) for c in times}
    rows = nans_to_nulls(good.select(*[moments[c].cast(kinds[c]).alias(c) if c in times else col(c) for c in schema.names]))
    entries = [F.struct(F.lit(c).alias("column"), col(c).alias("text"), moments[c].alias("_t")) for c in times]
    texts = good.select(F.inline(F.array(*entries).cast("array<struct<column:string,text:string,_t:timestamp>>")))
    unreadable = texts.filter("text is not null and _t is null").groupBy("column", "text").agg(F.count(F.lit(1)).alias("n"))
    return CheckedScan(rows, parsed.filter(F.col("_record").isNotNull()).select(F.col("_record").alias("record")), unreadable)


def read_sample(spark: SparkSession, path: str | list[str], schema: T.StructType, share: float = 0.1, seed: int = 42) -> DataFrame:
    """CSV scan that keeps each line with the given probability."""
    return read_log(spark, path, schema).sample(False, share, seed)


def read_columns(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Columnar scan of the listed columns only."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*[col(c) for c in columns]) if columns is not None else df


def first_rows(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First rows of a total order."""
    return df.orderBy(*order_by(order)).limit(n)


def parse_time(df: DataFrame, column: str, fmt: str | None = None, strict: bool = True) -> DataFrame:
    """Text to timestamp; with ``strict=False`` unreadable text becomes NULL."""
    parse = F.to_timestamp_ntz if strict else F.try_to_timestamp
    args = [col(column)] + ([F.lit(fmt)] if fmt else [])
    return df.withColumn(column, parse(*args).cast("timestamp_ntz"))


def read_table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    return read_columns(spark, f"{folder}/{name}.parquet", columns)
