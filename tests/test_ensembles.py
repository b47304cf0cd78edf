"""Trees read from MLlib, staged metrics and Shapley values against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shortlist.models import assembly, ensembles, evaluate
from shortlist.operators.metrics import mean_ndcg


@pytest.fixture(scope="module")
def planted(spark):
    """Gain follows ``a``, a little ``kind``, and not ``b``; one group holds a third of the rows."""
    rng = np.random.default_rng(5)
    data = []
    for i in range(900):
        group = 0 if i < 300 else 1 + i % 70
        a, b, kind = rng.normal(), rng.normal(), "xyz"[rng.integers(3)]
        gain = 5 if a + (kind == "x") > 1 else 1 if a > 0 else 0
        data.append((i, group, float(a), float(b), kind, gain, "train" if group % 4 else "val"))
    df = spark.createDataFrame(data, "row bigint, grp int, a double, b double, kind string, gain int, split string")
    model = assembly.fit_assembly(df, ["a", "b"], ["kind"])
    return assembly.assemble(df.repartition(6), model).cache()


@pytest.fixture(scope="module")
def boosted(planted):
    return GBTRegressor(labelCol="gain", maxIter=6, maxDepth=3, seed=1).fit(planted.withColumn("gain", F.col("gain").cast("double")))


def test_reads_mllib_trees(planted, boosted):
    ensemble = ensembles.read_ensemble(boosted)
    assert any(t.categories for t in ensemble.trees)
    both = ensemble.transform(boosted.transform(planted.drop("prediction")).withColumnRenamed("prediction", "mllib"))
    assert both.filter(F.abs(F.col("mllib") - F.col("prediction")) > 1e-9).count() == 0


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_staged_ndcg_equals_one_evaluation_per_count(planted, boosted, hot_rows):
    ensemble = ensembles.read_ensemble(boosted)
    staged = {r["trees"]: r for r in ensembles.staged_ndcg(planted, ensemble, "grp", "gain", tiebreak=["row"], hot_rows=hot_rows).collect()}
    assert sorted(staged) == list(range(1, 7))
    for count in (1, 3, 6):
        scored = ensemble.first(count).transform(planted)
        one = mean_ndcg(scored, "grp", "prediction", "gain", 5, ["row"], "filter").first()
        assert staged[count]["mean_ndcg"] == pytest.approx(one["mean_ndcg"], abs=1e-12) and staged[count]["groups"] == one["groups"]


def test_staged_ndcg_of_nothing_and_of_unknown_gains(planted, boosted):
    ensemble = ensembles.read_ensemble(boosted).first(2)
    empty = ensembles.staged_ndcg(planted.limit(0), ensemble, "grp", "gain").collect()
    assert all(r["mean_ndcg"] is None and r["groups"] == 0 for r in empty)
    unknown = planted.withColumn("gain", F.lit(None).cast("int")).withColumn("grp", F.lit(None).cast("int"))
    assert [r["mean_ndcg"] for r in ensembles.staged_ndcg(unknown, ensemble, "grp", "gain").collect()] == [0.0, 0.0]


def test_boosting_stops_by_ndcg(planted):
    ranker = ensembles.fit_boosted(planted, "grp", "gain", rounds=40, patience=4, tiebreak=["row"], maxDepth=2)
    best = len(ranker.ensemble.trees)
    assert ranker.history[best - 1] == max(ranker.history) and best <= 40
    assert best + 4 <= len(ranker.history) or len(ranker.history) == 40
    val = planted.filter("split = 'val'")
    assert evaluate.ndcg_of(ranker.transform(val), "grp", "gain", tiebreak=["row"]) == pytest.approx(max(ranker.history))
    short = ensembles.fit_boosted(planted, "grp", "gain", rounds=5, patience=4, tiebreak=["row"], maxDepth=2)
    assert ranker.history[:5] == pytest.approx(short.history)


def exact_shapley(predict, x, background):
    """By the definition: weighted over all sets of the other features."""
    size = len(x)
    out = []
    for f in range(size):
        others, total = [g for g in range(size) if g != f], 0.0
        for n in range(size):
            for some in itertools.combinations(others, n):
                weight = math.factorial(n) * math.factorial(size - n - 1) / math.factorial(size)
                with_, without = background.copy(), background.copy()
                for g in some:
                    with_[:, g] = without[:, g] = x[g]
                with_[:, f] = x[f]
                total += weight * (predict(with_).mean() - predict(without).mean())
        out.append(total)
    return out


def test_shapley_of_five_features(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(400, 5))
    label = np.where(data[:, 0] > 0, data[:, 1], data[:, 2] * data[:, 3])
    rows = spark.createDataFrame([(float(y), [float(v) for v in x]) for x, y in zip(data, label)], "label double, x array<double>")
    rows = rows.withColumn("features", array_to_vector("x"))
    ensemble = ensembles.read_ensemble(GBTRegressor(maxIter=5, maxDepth=4, seed=1).fit(rows))
    background = data[:7]
    found = ensembles.tree_attributions(rows.limit(12), ensemble, background).select("x", "attribution").collect()
    for row in found:
        assert row["attribution"] == pytest.approx(exact_shapley(ensemble.predict, np.array(row["x"]), background), abs=1e-9)
    sampled = ensembles.tree_attributions(rows.limit(5), ensemble, background, orders=10).collect()
    for row in sampled:
        score = ensemble.predict(np.array([row["x"]]))[0] - ensemble.predict(background).mean()
        assert sum(row["attribution"]) == pytest.approx(score, abs=1e-9)
