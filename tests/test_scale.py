"""What is shuffled, joined and scored, and that the plans for small and for hot groups agree."""

import math

import numpy as np
import pytest

from shortlist.models import ensembles, evaluate, linear, margin
from shortlist.operators import metrics, stats
from shortlist.plans import QUERIES


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


def depth(line):
    return len(line) - len(line.lstrip(" :+-"))


def nested_joins(lines):
    """The largest number of joins on a way from the root of a plan to a leaf."""
    most, open_ = 0, []
    for line in lines:
        while open_ and open_[-1] >= depth(line):
            open_.pop()
        if "Join " in line:
            open_.append(depth(line))
            most = max(most, len(open_))
    return most


def test_block_features_joins_one_key_at_a_time(spark, folder):
    assert nested_joins(plan(QUERIES["block_features"](spark, folder))) == 1


def test_block_features_keeps_the_shuffles_of_one_key(spark, folder):
    """The ends of the other keys are written, so that the result joins one key's statistics only."""
    assert sum("Join " in x for x in plan(QUERIES["block_features"](spark, folder))) == 1


def test_feature_matrix_shuffles_no_statistics_in_its_last_step(spark, folder):
    """Positions and statistics in windows are written with the new columns before these meet the log."""
    assert not any("Window" in x for x in plan(QUERIES["feature_matrix"](spark, folder)))


@pytest.mark.parametrize("name", ["item_affinity", "price_trip_features"])
def test_the_log_is_joined_once(spark, folder, name):
    lines = [x for x in plan(QUERIES[name](spark, folder)) if "Relation" in x and "l_orderkey" in x]
    assert len(lines) == 1


def test_item_quality_joins_no_statistics(spark, folder):
    assert nested_joins(plan(QUERIES["item_quality"](spark, folder))) == 0


def test_hot_keys_are_joined_first(rows):
    df = rows("k int, h int, v double", [(i % 20, i % 2, float(i)) for i in range(80)])
    built = stats.block_stats(df, ["k", "h"], ["v"], hot_rows=10)
    assert sum("Join LeftOuter" in x for x in plan(built)) == 3
    got = {(r["k"], r["h"], r["v"]): (r["mean_v_over_k"], r["max_v_over_h"]) for r in built.collect()}
    assert len(got) == 80 and got[3, 1, 23.0] == (33.0, 79.0)


@pytest.fixture(scope="module")
def graded(spark):
    rng = np.random.default_rng(3)
    data = []
    for i in range(500):
        a, b = rng.normal(), float(rng.integers(0, 3))
        data.append((i, 0 if i < 60 else 1 + i % 70, float(a), b, int(rng.choice([0, 0, 1, 5])) if i % 70 else 0))
    return spark.createDataFrame([*data, (500, None, 1.0, 1.0, 5)], "row bigint, grp bigint, a double, b double, gain int").cache()


def test_listwise_steps_agree_with_joined_ones(graded):
    fits = [linear.fit_listwise(graded, "grp", "gain", ["a", "b"], steps=3, hot_rows=h) for h in (None, 50)]
    assert fits[0].weights == pytest.approx(fits[1].weights, rel=1e-9)


def test_margin_gradients_agree_and_rows_are_kept(graded):
    ranker = linear.standardiser(graded, ["a", "b"])
    kept, joined = (margin.pairs_of(graded, "grp", "gain", ranker, True, h) for h in (None, 50))
    assert kept.rows.storageLevel.useMemory and joined.hot_rows == 50
    assert kept.gradient([0.7, -0.2]) == pytest.approx(joined.gradient([0.7, -0.2]), rel=1e-9)
    kept.close()
    assert not kept.rows.storageLevel.useMemory


def test_sums_of_all_columns_serve_fewer(graded):
    sums = linear.pair_normal(graded, "grp", "gain", ["a", "b"])
    for columns in (["a", "b"], ["b"]):
        alone = linear.fit_pairwise(graded, "grp", "gain", columns, 0.1)
        assert linear.solve_pairwise(sums, columns, 0.1).weights == pytest.approx(alone.weights, rel=1e-9)


@pytest.mark.parametrize("on_short", ["filter", "keep"])
@pytest.mark.parametrize("hot_rows", [2_000_000, 50])
def test_scores_side_by_side(graded, rows, on_short, hot_rows):
    odd = rows("row bigint, grp bigint, gain int, s double, t double", [
        (1, 1, 5, None, 1.0), (2, 1, 0, math.nan, 1.0), (3, 1, 1, 2.0, 1.0), (4, 2, None, 1.0, None), (5, 2, 1, 1.0, 3.0), (6, None, 1, 0.0, 0.0),
    ])
    for df, names, k in ((graded, ["a", "b"], 5), (odd, ["s", "t"], 2)):
        found = metrics.mean_ndcg_of(df, "grp", names, "gain", k, ["-row"], on_short, hot_rows)
        each = [metrics.mean_ndcg(df, "grp", n, "gain", k, ["-row"], on_short).first()["mean_ndcg"] for n in names]
        assert found == pytest.approx(each, rel=1e-12)


def test_every_shuffled_variant_scores_a_row_once(graded):
    seen = []

    def score(df):
        seen.append(df.count())
        return df.withColumn("prediction", df["a"] - df["b"])

    evaluate.permutation_importance(graded, score, ["a", "b"], "row", "grp", "gain", repeats=2, tiebreak=["row"])
    assert set(seen) == {501}


def test_shapley_values_score_only_what_a_tree_reads(monkeypatch):
    trees = tuple(ensembles.Tree.stump(f, 0.5, -1.0, 2.0) for f in (0, 1, 2, 0))
    x, background = np.random.default_rng(1).random((6, 4)), np.array([[0.1, 0.9, 0.4, 0.2]])
    scored, plain = [], ensembles.Tree.predict
    monkeypatch.setattr(ensembles.Tree, "predict", lambda self, rows: scored.append(len(rows)) or plain(self, rows))
    ensemble = ensembles.Ensemble(trees, (1.0, 0.5, 1.0, 2.0))
    found = ensembles.shapley(ensemble, x, background, ensembles._permutations(4, 120, 1))
    assert sum(scored) == 4 * 2 * 6
    assert found.sum(axis=1) == pytest.approx(ensemble.predict(x) - ensemble.predict(background)[0])
    assert not found[:, 3].any()
