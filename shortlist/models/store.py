"""Save models to a folder and load them again."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from .factors import ClusterMeans, CoClusters, FactorModel
from .linear import LinearRanker


def _contents(model) -> tuple[dict, dict[str, DataFrame]]:
    """Numbers and tables of one of our own models."""
    if isinstance(model, LinearRanker):
        return asdict(model), {}
    if isinstance(model, FactorModel):
        return {"mean": model.mean, "scale": model.scale}, {"users": model.users, "items": model.items}
    if isinstance(model, CoClusters):
        means = model.means
        numbers = {
            "mean": means.mean,
            "pairs": [[*k, v] for k, v in means.pairs.items()],
            "users": list(means.users.items()),
            "items": list(means.items.items()),
            "sizes": means.sizes,
            "scale": model.scale,
        }
        return numbers, {"users": model.users, "items": model.items}
    raise TypeError(f"no way to save a {type(model).__name__}")


def save(spark: SparkSession, model, path: str) -> None:
    """Write a ranker, a rating model or an MLlib model below ``path``."""
    kind = type(model).__name__
    if hasattr(model, "write"):
        numbers, tables = {}, {}
        model.write().overwrite().save(f"{path}/model")
        kind = "mllib"
    else:
        numbers, tables = _contents(model)
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    row = spark.createDataFrame([(kind, json.dumps(numbers))], "kind string, numbers string")
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/numbers")


def load(spark: SparkSession, path: str):
    """The model that ``save`` wrote."""
    row = spark.read.parquet(f"{path}/numbers").first()
    if row["kind"] == "mllib":
        metadata = DefaultParamsReader.loadMetadata(f"{path}/model", spark)
        if metadata["class"].endswith("PipelineModel"):
            return PipelineModel.load(f"{path}/model")
        return DefaultParamsReader.loadParamsInstance(f"{path}/model", spark)
    numbers = json.loads(row["numbers"])
    if row["kind"] == "LinearRanker":
        return LinearRanker(**{k: tuple(v) for k, v in numbers.items()})
    users, items = spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items")
    scale = tuple(numbers["scale"])
    if row["kind"] == "FactorModel":
        return FactorModel(numbers["mean"], users, items, scale)
    means = ClusterMeans(
        numbers["mean"],
        {(a, b): v for a, b, v in numbers["pairs"]},
        dict(map(tuple, numbers["users"])),
        dict(map(tuple, numbers["items"])),
        tuple(numbers["sizes"]),
    )
    return CoClusters(means, users, items, scale)
