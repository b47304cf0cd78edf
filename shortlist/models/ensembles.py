"""Boosted trees read from MLlib: staged scores, early stopping by NDCG, Shapley attributions.

An ensemble is a table of nodes of bounded size (trees times leaves), so every
task gets it whole. All trees are walked for a batch of rows at once, level by
level, and the running sums over the trees are the scores after each tree. One
pass over validation rows then gives NDCG@k after every tree.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import HOT_ROWS, col, has_hot_group
from ..session import shared_folder
from .frames import BATCH, whole_groups
from .trees import LABEL, centred_gain


@dataclass(frozen=True)
class Tree:
    """Nodes of a tree; node 0 is the root and a leaf is its own child.

    A row goes left if its feature is at most the threshold, or, at a node of ``categories``, one of them.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    categories: dict[int, tuple[float, ...]]

    @staticmethod
    def stump(feature: int, threshold: float, low: float, high: float) -> Tree:
        """One split with two leaves."""
        return Tree(
            np.array([feature, 0, 0]), np.array([threshold, 0.0, 0.0]), np.array([1, 1, 2]), np.array([2, 1, 2]),
            np.array([0.0, low, high]), {},
        )

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while len(rows):
            node = at[rows]
            value = x[rows, self.feature[node]]
            goes_left = value <= self.threshold[node]
            for place, members in self.categories.items():
                here = node == place
                goes_left[here] = np.isin(value[here], members)
            step = np.where(goes_left, self.left[node], self.right[node])
            at[rows] = step
            rows = rows[self.left[step] != step]
        return self.value[at]


@dataclass(frozen=True)
class Ensemble:
    trees: tuple[Tree, ...]
    weights: tuple[float, ...]

    def stages(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the score of each row after each tree."""
        out = np.empty((len(x), len(self.trees)))
        for i, (tree, weight) in enumerate(zip(self.trees, self.weights)):
            out[:, i] = weight * tree.predict(x)
        return np.cumsum(out, axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sum((w * t.predict(x) for t, w in zip(self.trees, self.weights)), np.zeros(len(x)))

    def first(self, count: int) -> Ensemble:
        return Ensemble(self.trees[:count], self.weights[:count])

    def transform(self, df: DataFrame, features: str = "features", name: str = "prediction") -> DataFrame:
        """``df`` with the score of every row."""

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(self.predict(np.stack(batch)) if len(batch) else np.zeros(0))

        return df.withColumn(name, run(vector_to_array(col(features))))


def read_ensemble(model) -> Ensemble:
    """The trees of an MLlib tree ensemble, from its public storage format."""
    spark = SparkSession.getActiveSession()
    path = f"{shared_folder(spark).rstrip('/')}/shortlist-trees-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes: dict[int, list] = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(row["treeID"], []).append(row["nodeData"])
    trees = []
    for number in sorted(nodes):
        table = sorted(nodes[number], key=lambda n: n["id"])
        place = {n["id"]: i for i, n in enumerate(table)}
        inner = [n["leftChild"] >= 0 for n in table]
        categorical = {
            i: tuple(n["split"]["leftCategoriesOrThreshold"])
            for i, n in enumerate(table)
            if inner[i] and n["split"]["numCategories"] >= 0
        }
        cuts = [
            n["split"]["leftCategoriesOrThreshold"][0] if inner[i] and i not in categorical else 0.0 for i, n in enumerate(table)
        ]
        trees.append(
            Tree(
                np.array([n["split"]["featureIndex"] if k else 0 for n, k in zip(table, inner)]),
                np.array(cuts, float),
                np.array([place[n["leftChild"]] if k else i for i, (n, k) in enumerate(zip(table, inner))]),
                np.array([place[n["rightChild"]] if k else i for i, (n, k) in enumerate(zip(table, inner))]),
                np.array([n["prediction"] for n in table], float),
                categorical,
            )
        )
    return Ensemble(tuple(trees), tuple(float(w) for w in model.treeWeights))


def _ranked(code: np.ndarray, keys: list[np.ndarray], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by group and ``keys`` (first is most important), and their place in the group."""
    order = np.lexsort([*reversed(keys), code])
    return order, np.arange(len(code)) - starts[code[order]]


def _stage_ndcg(
    frame: pd.DataFrame, ensemble: Ensemble, gain: str, k: int, ties: list[str], keep: bool
) -> tuple[np.ndarray, int] | np.ndarray:
    """Sums over the groups of ``frame`` of NDCG@k after every tree, and their number.

    With ``keep``: which rows are among the first k of a group after any tree, or in the best order.
    """
    code = pd.factorize(frame["_group"], use_na_sentinel=False)[0]
    sizes = np.bincount(code, minlength=1)
    starts = np.cumsum(sizes) - sizes
    gains = frame[gain].fillna(0).to_numpy(float)
    tie = [frame[t].to_numpy() for t in ties]
    discount = 1 / np.log2(np.arange(k) + 2.0)
    scores = ensemble.stages(np.stack(frame["_x"]))
    kept = np.zeros(len(frame), bool)

    def gained(keys: list[np.ndarray]) -> np.ndarray:
        order, place = _ranked(code, keys, starts)
        front = place < k
        kept[order[front]] = True
        return np.bincount(code[order[front]], gains[order[front]] * discount[place[front]], minlength=len(sizes))

    ideal = gained([-gains])
    full = sizes >= k
    sums = np.zeros(scores.shape[1])
    for stage in range(scores.shape[1]):
        found = gained([-scores[:, stage], *tie])
        sums[stage] = np.divide(found, ideal, out=np.zeros(len(found)), where=ideal > 0)[full].sum()
    return kept if keep else (sums, int(full.sum()))


def staged_ndcg(
    df: DataFrame,
    ensemble: Ensemble,
    group: str,
    gain: str,
    features: str = "features",
    k: int = 5,
    tiebreak: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """(trees, mean_ndcg, groups): mean NDCG@k of the scores after each tree, over groups of at least k rows.

    Features are shuffled by group once, not scores. In the presence of a group above ``hot_rows`` rows each task first
    drops the rows that are in no tree's first k of their group, which changes no result.
    """
    ties = [f"_t{i}" for i in range(len(tiebreak))]
    rows = df.select(
        col(group).alias("_group"),
        col(gain).cast("double").alias("_gain"),
        *[col(c).alias(t) for c, t in zip(tiebreak, ties)],
        vector_to_array(col(features)).alias("_x"),
    )

    def front(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                yield part[_stage_ndcg(part, ensemble, "_gain", k, ties, keep=True)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, groups = np.zeros(len(ensemble.trees)), 0
        for frame in whole_groups(batches, "_group"):
            sums, count = _stage_ndcg(frame, ensemble, "_gain", k, ties, keep=False)
            total, groups = total + sums, groups + count
        yield pd.DataFrame({"trees": np.arange(1, len(total) + 1), "total": total, "n": groups})

    if hot_rows is not None and has_hot_group(rows, ["_group"], hot_rows):
        rows = rows.mapInPandas(front, rows.schema)
    parts = rows.repartition("_group").sortWithinPartitions("_group").mapInPandas(run, "trees int, total double, n bigint")
    sums = parts.groupBy("trees").agg(F.sum("total").alias("total"), F.sum("n").alias("groups"))
    return sums.select("trees", F.try_divide("total", "groups").alias("mean_ndcg"), "groups")


@dataclass(frozen=True)
class BoostedRanker:
    ensemble: Ensemble
    history: tuple[float, ...]  # NDCG@k on validation rows after every tree that was fitted

    def transform(self, df: DataFrame, features: str = "features", name: str = "prediction") -> DataFrame:
        return self.ensemble.transform(df, features, name)


def fit_boosted(
    df: DataFrame,
    group: str,
    gain: str,
    features: str = "features",
    split: str = "split",
    rounds: int = 500,
    patience: int = 50,
    k: int = 5,
    tiebreak: Sequence[str] = (),
    **params,
) -> BoostedRanker:
    """Boosted trees on the centred gains of split "train", cut where NDCG@k of split "val" is best.

    Training stops once the best count of trees is ``patience`` trees back, or at ``rounds``. MLlib
    has no such stop, so a fit of few rounds is evaluated after every tree and, if it may still improve, replaced by
    one of twice the rounds; with one seed the longer fit begins with the same trees, so the
    result is that of a single run at no more than twice its cost.
    """
    rows = centred_gain(df.filter(col(split) == "train"), group, gain)
    val = df.filter(col(split) == "val")
    count = min(rounds, patience + patience // 4 + 1)
    while True:
        model = GBTRegressor(featuresCol=features, labelCol=LABEL, maxIter=count, seed=42, **params).fit(rows)
        ensemble = read_ensemble(model)
        stages = staged_ndcg(val, ensemble, group, gain, features, k, tiebreak).orderBy("trees").collect()
        history = tuple(float(r["mean_ndcg"] or 0.0) for r in stages)
        best = int(np.argmax(history)) + 1
        if best + patience <= count or count >= rounds or len(ensemble.trees) < count:
            return BoostedRanker(ensemble.first(best), history)
        count = min(rounds, 2 * count)


def _permutations(size: int, count: int, seed: int) -> list[tuple[int, ...]]:
    """All orders of the features if there are at most ``count``, else seeded ones, each with its reverse."""
    if size < 9 and len(every := list(itertools.permutations(range(size)))) <= count:
        return every
    rng = np.random.default_rng(seed)
    half = [tuple(rng.permutation(size).tolist()) for _ in range((count + 1) // 2)]
    return [p for h in half for p in (h, h[::-1])][:count]


def shapley(ensemble: Ensemble, x: np.ndarray, background: np.ndarray, orders: list[tuple[int, ...]]) -> np.ndarray:
    """(rows, features): mean change of the score as a row's features replace a background row's, one by one.

    Over all orders this is the exact Shapley value against the background. Trees that read the same features go together, and a
    set of these that several orders share is scored once.
    """
    size = x.shape[1]
    out = np.zeros((len(x), size))
    for read, part in _by_features(ensemble).items():
        # What trees do not read has no share in their score and stands in for nothing: orders of the rest serve.
        masks: dict[int, float] = {}
        terms: dict[tuple[int, int], float] = {}
        for order in orders:
            mask = 0
            for feature in order:
                if feature not in read:
                    continue
                step = mask | 1 << feature
                terms[mask, feature] = terms.get((mask, feature), 0.0) - 1.0 / len(orders)
                terms[step, feature] = terms.get((step, feature), 0.0) + 1.0 / len(orders)
                masks[mask] = masks[step] = 0.0
                mask = step
        for mask in masks:
            chosen = np.array([bool(mask >> f & 1) for f in range(size)])
            mixed = np.where(chosen, x[:, None, :], background[None, :, :]).reshape(-1, size)
            score = part.predict(mixed).reshape(len(x), len(background)).mean(axis=1)
            for feature in read:
                if (mask, feature) in terms:
                    out[:, feature] += terms[mask, feature] * score
    return out


def _by_features(ensemble: Ensemble) -> dict[frozenset[int], Ensemble]:
    """Trees by the features that they read; a score is the sum over the parts, and so are its Shapley values."""
    parts: dict[frozenset[int], list] = {}
    for tree, weight in zip(ensemble.trees, ensemble.weights):
        inner = tree.left != np.arange(len(tree.left))
        parts.setdefault(frozenset(tree.feature[inner].tolist()), []).append((tree, weight))
    return {read: Ensemble(*(tuple(v) for v in zip(*part))) for read, part in parts.items() if read}


def tree_attributions(
    df: DataFrame, ensemble: Ensemble, background: Sequence[Sequence[float]], features: str = "features",
    name: str = "attribution", orders: int = 120, seed: int = 42,
) -> DataFrame:
    """``df`` with the Shapley value of every feature against a few ``background`` rows that the caller gives.

    Up to five features all orders are taken with the default; beyond, ``orders`` seeded ones, half of them reversed. The values of
    a row add up to its score less the mean score of the background in any case.
    """
    base = np.asarray(background, float)
    chosen = _permutations(base.shape[1], orders, seed)

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            parts = [
                shapley(ensemble, np.stack(batch.iloc[at : at + 1024]), base, chosen) for at in range(0, len(batch), 1024)
            ]
            yield pd.Series([row for part in parts for row in part], dtype=object)

    return df.withColumn(name, run(vector_to_array(col(features))))
