"""Positions, totals and quantiles of hot groups equal those of plain windows."""

import random

import pytest
from pyspark.sql import functions as F

from shortlist.operators.ordering import attach, exact_quantiles, has_hot_group, positions, running_total, top_k
from shortlist.operators.metrics import ndcg
from shortlist.operators.stats import composite, group_stats, zscore_by


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, a third are copies of one row, some unknown."""
    rng = random.Random(3)
    data = [(1, rng.randint(0, 40) * 1.0, i) for i in range(400)]
    data += [(2, 7.0, -1)] * 400
    data += [(rng.randint(3, 60), rng.choice([None, 1.5, 2.5, 9.0]), i) for i in range(400)]
    data += [(None, rng.random(), i) for i in range(150)]
    return spark.createDataFrame(data, "k int, v double, id int").repartition(5).cache()


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("order", [["v", "k", "id"], ["-v", "-k", "id"]])
def test_positions(skewed, keys, order):
    plain = positions(skewed, keys, order, "p", hot_rows=None)
    cut = positions(skewed, keys, order, "p", hot_rows=60)
    assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0


def test_running_total(skewed):
    rows = skewed.withColumn("w", F.col("id") % 7 + 2)
    plain = running_total(rows, ["k"], ["v", "id"], "w", "t", hot_rows=None)
    cut = running_total(rows, ["k"], ["v", "id"], "w", "t", hot_rows=100)
    assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0


def test_running_total_of_unknown_values(skewed):
    plain = running_total(skewed, ["k"], ["id", "v"], "v", "t", hot_rows=None)
    cut = running_total(skewed, ["k"], ["id", "v"], "v", "t", hot_rows=1)
    rounded = [F.round("t", 9).alias("t"), "k", "id", "v"]
    assert plain.select(rounded).exceptAll(cut.select(rounded)).count() == 0 and plain.count() == cut.count()


def test_payload_of_any_type(skewed):
    """Maps can be neither grouped nor hashed, and need not be."""
    rows = skewed.withColumn("m", F.create_map("id", "v"))
    cut = positions(rows, ["k"], ["id", "v"], "p", hot_rows=1)
    plain = positions(rows, ["k"], ["id", "v"], "p", hot_rows=None)
    as_text = ["k", "id", "v", F.to_json("m").alias("m"), "p"]
    assert plain.select(as_text).exceptAll(cut.select(as_text)).count() == 0 and cut.count() == rows.count()


def test_the_hot_path_broadcasts_no_sample(skewed):
    plan = positions(skewed, [], ["v", "id"], "p", hot_rows=60)._jdf.queryExecution().toString()
    assert "_cuts" not in plan and "collect_list" not in plan


def test_tied_order_still_counts_every_place(skewed):
    cut = positions(skewed, ["k"], ["k"], "p", hot_rows=60)
    per = cut.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("p").alias("d"), F.max("p").alias("m"))
    assert per.filter((F.col("n") != F.col("d")) | (F.col("m") != F.col("n") - 1)).count() == 0


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_quantiles(skewed, hot_rows):
    found = exact_quantiles(skewed, ["k"], "v", {"q": 0.25, "m": 0.5}, hot_rows)
    truth = skewed.groupBy("k").agg(
        F.percentile("v", F.lit(0.25)).alias("tq"), F.median("v").alias("tm")
    ).filter(F.col("tm").isNotNull())
    both = found.join(truth.withColumnRenamed("k", "j"), F.col("k").eqNullSafe(F.col("j")))
    assert both.count() == truth.count()
    assert both.filter((F.abs(both.q - both.tq) > 1e-9) | (F.abs(both.m - both.tm) > 1e-9)).count() == 0


def test_median_of_hot_groups(skewed):
    wanted = {("v", "median"): "median", ("v", "mean"): "mean", ("id", "median"): "other"}
    plain = group_stats(skewed, ["k"], wanted, hot_rows=None)
    split = group_stats(skewed, ["k"], wanted, hot_rows=100)
    rounded = [F.round(c, 6).alias(c) for c in ("median", "mean", "other")]
    assert plain.select("k", *rounded).exceptAll(split.select("k", *rounded)).count() == 0
    assert split.count() == plain.count()


def test_cleared_keys(skewed):
    cleared = []
    assert has_hot_group(skewed, ["k"], 100, cleared) and cleared == []
    assert not has_hot_group(skewed, ["k"], 5000, cleared) and cleared == [{"k"}]
    # A finer key set is not counted again, whatever its limit.
    assert not has_hot_group(skewed, ["k", "id"], 0, cleared)


def test_composite_ignores_unknown_keys(rows):
    df = rows("k string, v double", [(None, 4.0), ("a", 1.0)])
    out = {r["k"]: r for r in composite(df, ["k"], "v").collect()}
    assert out[None]["mean_v_per_k"] is None and out["a"]["mean_v_per_k"] == 1.0


def test_top_k_limits_before_its_shuffle(skewed):
    plan = top_k(skewed, ["k"], ["-v", "id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert partial > exchange


@pytest.mark.parametrize("on_short", ["filter", "keep"])
def test_ndcg_of_hot_groups(skewed, on_short):
    # Some gains are unknown, and all gains of some groups.
    known = F.when(~((F.col("k") % 5).eqNullSafe(0)) & (F.col("id") % 4 != 1), F.col("id") % 3)
    rows = skewed.withColumn("gain", known)
    small = ndcg(rows, "k", "v", "gain", 5, ["id"], on_short, hot_rows=None)
    large = ndcg(rows, "k", "v", "gain", 5, ["id"], on_short, hot_rows=1)
    rounded = F.round("ndcg", 9).alias("ndcg")
    assert small.count() == large.count() > 10
    assert small.select("k", rounded).exceptAll(large.select("k", rounded)).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_back_of_hot_keys(skewed, how):
    table = skewed.filter("k is null or k % 2 = 1").groupBy("k").agg(F.count("*").alias("c"))
    table = table if how in ("left", "inner") else table.select("k")
    plain = attach(skewed, table, ["k"], how, hot_rows=None)
    apart = attach(skewed, table, ["k"], how, hot_rows=100)
    assert plain.exceptAll(apart).count() == 0 and plain.count() == apart.count()


def test_hot_rows_are_not_shuffled(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"), (F.col("id") % 9).alias("v"))
    out = zscore_by(rows, "k", ["v"], "_z", hot_rows=500)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    hot = out.filter("k = 1").agg(F.count("v_z"), F.stddev_samp("v_z")).first()
    assert hot[0] == 2000 and abs(hot[1] - 1) < 1e-9
    assert out.count() == 3000


@pytest.mark.parametrize("split", [None, "s"])
def test_composite_of_hot_keys(skewed, split):
    rows = skewed.withColumn("s", F.col("id") % 2).filter("v is not null")
    plain = composite(rows, ["k"], "v", split=split, hot_rows=None)
    apart = composite(rows, ["k"], "v", split=split, hot_rows=60)
    rounded = [F.round(f"`{c}`", 9).alias(c) if t == "double" else F.col(c) for c, t in plain.dtypes]
    assert plain.select(rounded).exceptAll(apart.select(rounded)).count() == 0
    assert plain.count() == apart.count()
