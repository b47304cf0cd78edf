"""Register of the driver's queries: a Spark plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import col
from ..session import configure
from ..sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6
# A total order of lineitem needs all of these after the leading column.
LINE_TAIL = ["l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity"]
GAIN_SQL = "CASE l_returnflag WHEN 'R' THEN 5 WHEN 'A' THEN 1 ELSE 0 END"
LINE_TAIL_SQL = ", ".join(LINE_TAIL)


def query(name: str, sql: str | None = None, digits: int = DIGITS) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return settled(build(configure(spark), folder), digits)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def settled(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """One integer width and a fixed number of digits, so that engines compare.

    ``F.round`` goes through decimals and is several times slower than ``rint``,
    which sends halves to the even neighbour; a scale one step larger sends them
    away from zero.
    """
    scale = 10.0**digits
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.rint(c.cast("double") * F.lit(math.nextafter(scale, math.inf))) / F.lit(scale)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def lineitem(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return read_table(spark, folder, "lineitem", columns or None)


def graded_lines(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem with a graded gain per row: returned 5, accepted 1, else 0."""
    flag = F.col("l_returnflag")
    gain = F.when(flag == "R", 5).when(flag == "A", 1).otherwise(0)
    return lineitem(spark, folder).withColumn("gain", gain)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events")
