"""The feature registry and the feature build."""

from pyspark.sql import functions as F

from shortlist.operators.splits import by_modulo
from shortlist.plans import hotel
from shortlist.plans.catalogue import COMPOSITES, Composite, composite_features, registry, selected
from shortlist.plans.hotel_queries import ROW_TAIL, impressions
from shortlist.session import configure
from shortlist.sources import writers
from shortlist.sources.readers import read_columns, read_log
from shortlist.sources.schema import IMPRESSIONS, SCORES, SUBMISSION_LOG


def test_registry_counts():
    names = [n for family in registry().values() for n in family]
    assert len(registry()) == 44 and len(names) == 191 and len(set(names)) == 191
    assert len(selected()) == 183


def test_schemas():
    assert len(IMPRESSIONS.fields) == 54 and len(SUBMISSION_LOG.fields) == 50


def test_anchored_and_joined_statistics_agree(spark):
    df = spark.range(400).select(
        (F.col("id") % 7).cast("int").alias("prop_id"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("int")).alias("k"),
        (F.col("id") * 37 % 101).cast("double").alias("v"),
        F.when(F.col("id") % 2 == 0, "train").otherwise("val").alias("split"),
        "id",
    )
    entries = [
        Composite("f", "v", ("prop_id",), ("mean", "median", "diff min", "rel max")),
        Composite("f", "v", ("prop_id", "k"), ("median", "rel mean")),
    ]
    joined = composite_features(df, entries, "split", anchors=())
    anchored = composite_features(df, entries, "split")
    rounded = [F.round(f"`{c}`", 9).alias(c) if t == "double" else F.col(c) for c, t in joined.dtypes]
    assert joined.select(rounded).exceptAll(anchored.select(rounded)).count() == 0
    assert anchored.filter("k is null and `median_v_per_prop_id_per_k` is not null").count() == 0


def test_build_features(spark, folder):
    log = by_modulo(impressions(configure(spark), folder), "srch_id")
    few = [c for c in COMPOSITES if c.family in ("per_prop_id", "promotion")]
    built = hotel.build_features(log, composites=few, tiebreak=ROW_TAIL)
    missing = set(selected()) - set(built.columns)
    assert missing == {n for c in COMPOSITES if c not in few for n in c.features()} & set(selected())
    assert built.count() == log.count()
    assert built.filter("target = 5").count() == log.filter("booking_bool = 1").count()


def test_files(spark, tmp_path, rows):
    scores = rows("srch_id bigint, prop_id int, pred double, rank bigint", [(1, 7, 0.5, 1), (1, 8, None, 2), (2, 7, 0.1, 1)])
    writers.write_scores(scores, str(tmp_path / "s"), "srch_id", "prop_id")
    back = read_log(spark, str(tmp_path / "s"), SCORES)
    assert sorted((r["srch_id"], r["prop_id"], r["pred"]) for r in back.collect() if r["pred"]) == [(1, 7, 0.5), (2, 7, 0.1)]
    writers.write_columns(scores.withColumn("split", F.lit("train")), str(tmp_path / "p"))
    pruned = read_columns(spark, str(tmp_path / "p"), ["srch_id"])
    assert "ReadSchema: struct<srch_id:bigint>" in pruned._jdf.queryExecution().executedPlan().toString()
    writers.write_metrics(spark, {"ndcg": 0.5}, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["ndcg"] == 0.5
    writers.write_params(spark, {"rank": 3}, str(tmp_path / "q"))
    writers.write_estimates(scores, str(tmp_path / "e"), "srch_id", "prop_id", "pred")
    assert spark.read.csv(str(tmp_path / "e"), header=True).columns == ["SearchId", "PropertyId", "Estimated"]


def test_few_statistics_are_joined_without_a_shuffle_of_the_rows(spark):
    df = spark.range(300).select(
        (F.col("id") % 7).alias("k"), (F.col("id") * 37 % 101).cast("double").alias("v"), F.lit("train").alias("split"), "id"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = composite_features(df, [Composite("f", "v", ("k",), ("mean", "rel max"))], "split")._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan.toString() and "hashpartitioning" not in plan.toString()


def test_row_features_are_not_written(spark, folder, monkeypatch):
    """The wide table that meets the statistics holds the log, not what one row tells."""
    log = by_modulo(impressions(configure(spark), folder), "srch_id")
    tables = []
    monkeypatch.setattr(hotel, "written", lambda df, write=hotel.written: tables.append(df.columns) or write(df))
    hotel.build_features(log, composites=[c for c in COMPOSITES if c.family == "promotion"], tiebreak=ROW_TAIL)
    assert set(log.columns) <= set(tables[0])
    assert not any({"price_per_star", "comp5_rate_percent_diff_signed"} & set(t) for t in tables)
