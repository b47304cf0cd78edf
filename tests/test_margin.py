"""The margin ranker against all pairs."""

import numpy as np
import pytest

from shortlist.models import evaluate, linear, margin


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    data = []
    for i in range(600):
        group = 0 if i < 200 else 1 + i % 60
        a, b = rng.normal(), rng.normal()
        gain = 5 if a > 1 else 1 if a > 0 else 0
        data.append((i, group, float(a), float(b), gain, "train" if group % 5 else "val"))
    df = spark.createDataFrame(data, "row bigint, grp int, a double, b double, gain int, split string")
    return df.repartition(6).cache()


def slow(pdf, ranker, weights, per_group):
    x = (pdf[["a", "b"]].to_numpy() - np.array(ranker.means)) / np.array(ranker.scales)
    s, loss, gradient = x @ weights, 0.0, np.zeros(2)
    for _, idx in pdf.groupby("grp").indices.items():
        pairs = [(i, j) for i in idx for j in idx if pdf["gain"][i] > pdf["gain"][j]]
        for i, j in pairs:
            m = max(0.0, 1 - (s[i] - s[j])) / (len(pairs) if per_group else 1)
            gradient += m * (x[j] - x[i])
            loss += m * max(0.0, 1 - (s[i] - s[j])) / 2
    return loss, gradient


@pytest.mark.parametrize(("per_group", "hot_rows"), [(True, None), (False, 60)])
def test_gradient_equals_all_pairs(planted, per_group, hot_rows):
    ranker = linear.standardiser(planted, ["a", "b"])
    pairs = margin.pairs_of(planted, "grp", "gain", ranker, per_group, hot_rows)
    assert (pairs.hot_rows is None) == (hot_rows is None)
    pdf = planted.toPandas().reset_index(drop=True)
    for weights in ([0.0, 0.0], [1.2, -0.4]):
        assert pairs.gradient(weights) == pytest.approx(slow(pdf, ranker, np.array(weights), per_group)[1], rel=1e-9)


def test_steps_lower_the_loss_and_find_the_order(planted):
    ranker, normal, target = linear.pair_normal(planted, "grp", "gain", ["a", "b"])
    pairs, pdf = margin.pairs_of(planted, "grp", "gain", ranker), planted.toPandas().reset_index(drop=True)
    weights, losses = np.linalg.solve(normal, target), []
    for _ in range(4):
        losses.append(slow(pdf, ranker, weights, True)[0])
        weights = weights - np.linalg.solve(normal, pairs.gradient(weights))
    assert losses == sorted(losses, reverse=True)
    train, val = planted.filter("split = 'train'"), planted.filter("split = 'val'")
    found = margin.fit_margin(train, val, "grp", "gain", ["a", "b"], steps=4, tiebreak=["row"])
    assert found.weights[0] > 10 * abs(found.weights[1])
    assert evaluate.ndcg_of(found.transform(planted), "grp", "gain") > 0.95


def test_too_many_gains(planted):
    with pytest.raises(ValueError):
        margin.pairs_of(planted.withColumn("gain", planted["row"]), "grp", "gain", linear.standardiser(planted, ["a"]))


def test_nothing_to_learn(planted):
    flat = planted.withColumn("gain", planted["gain"] * 0)
    ranker = linear.standardiser(flat, ["a", "b"])
    assert margin.pairs_of(flat, "grp", "gain", ranker).gradient([1.0, 1.0]).tolist() == [0.0, 0.0]
