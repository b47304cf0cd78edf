"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import col, order_by


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, order: Sequence[str] = ()) -> None:
    """CSV with a header; a sorted output is range-partitioned, not gathered."""
    out = df.orderBy(*order_by(order)) if order else df
    if columns is not None:
        out = out.select(*[col(c) for c in columns])
    out.write.mode("overwrite").option("header", True).csv(path)


def write_ranked(ranked: DataFrame, path: str, group: str, item: str, rank: str = "rank") -> None:
    """Ranked output in order; the rank column keeps it across files."""
    write_csv(ranked, path, [group, item, rank], [group, rank])


def write_scores(ranked: DataFrame, path: str, group: str, item: str, score: str = "pred", rank: str = "rank") -> None:
    write_csv(ranked, path, [group, item, score], [group, rank])


def write_estimates(df: DataFrame, path: str, user: str, item: str, estimate: str) -> None:
    """Factor predictions under the exchange names."""
    out = df.select(
        col(user).alias("SearchId"), col(item).alias("PropertyId"), col(estimate).alias("Estimated")
    )
    write_csv(out, path, order=["SearchId", "-Estimated", "PropertyId"])


def write_columns(df: DataFrame, path: str, partition: str | None = "split") -> None:
    """Parquet, one folder per split."""
    writer = df.write.mode("overwrite")
    if partition and partition in df.columns:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def write_metrics(spark: SparkSession, values: dict[str, float], path: str) -> None:
    """Metrics as one JSON record."""
    row = spark.range(1, numPartitions=1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    row.write.mode("overwrite").json(path)


def write_params(spark: SparkSession, params: dict[str, object], path: str) -> None:
    """Parameters as text, one per line."""
    entries = F.array(*[F.struct(F.lit(k).alias("param"), F.lit(str(v)).alias("param_value")) for k, v in params.items()])
    row = spark.range(1, numPartitions=1).select(F.inline(entries))
    row.write.mode("overwrite").option("header", True).csv(path)


def as_json(df: DataFrame, columns: Sequence[str], name: str = "json") -> DataFrame:
    """Columns of each row as a JSON record."""
    return df.select(F.to_json(F.struct(*[col(c) for c in columns])).alias(name))
