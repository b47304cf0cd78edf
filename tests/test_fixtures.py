"""Hand-made rows with expected values."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shortlist.functions.columns import class_score, feature_family, graded_target, nans_to_nulls, row_min
from shortlist.functions.numeric import transforms
from shortlist.functions.timeparts import season_number, summer_index, time_features
from shortlist.operators import clean, encode, holidays, metrics, narrow, pricing, profile, ranking, splits, stats, validate


def ranked(rows, gains):
    return rows("g int, s int, gain int", [(1, -i, g) for i, g in enumerate(gains)])


@pytest.mark.parametrize(
    "gains, expected",
    [
        ([5, 1, 0, 0, 0], 1.0),
        ([0, 0, 0, 0, 5], 1 / math.log2(6)),
        ([0, 0, 0, 0, 0], 0.0),
        ([0, 0, 0, 0, 0, 5], 0.0),
    ],
)
def test_ndcg(rows, gains, expected):
    assert metrics.ndcg(ranked(rows, gains), "g", "s", "gain").first()["ndcg"] == pytest.approx(expected)


def test_ndcg_short(rows):
    short = ranked(rows, [1, 0, 0, 0])
    with pytest.raises(PySparkException):
        metrics.ndcg(short, "g", "s", "gain").collect()
    assert metrics.ndcg(short, "g", "s", "gain", on_short="filter").count() == 0
    assert metrics.ndcg(short, "g", "s", "gain", on_short="keep").first()["ndcg"] == 1.0
    with pytest.raises(ValueError):
        metrics.ndcg(short, "g", "s", "gain", on_short="other")


def test_mean_counts_empty_groups(rows):
    both = ranked(rows, [5, 0, 0, 0, 0]).unionByName(ranked(rows, [0] * 5).withColumn("g", F.lit(2)))
    assert metrics.mean_ndcg(both, "g", "s", "gain").first()["mean_ndcg"] == 0.5


def test_target(rows):
    df = rows("book int, click int", [(1, 1), (0, 1), (0, 0), (None, None)])
    assert [r[0] for r in df.select(graded_target("click", "book")).collect()] == [5, 1, 0, 0]


def test_normalise(rows):
    df = rows("k string, v double", [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 7.0), (None, 9.0)])
    out = sorted((r["k"], r["v"], r["v_norm_by_k"]) for r in stats.normalize_by(df, "k", "v").collect())
    assert out == [("a", 1.0, -1.0), ("a", 2.0, 0.0), ("a", 3.0, 1.0), ("b", 7.0, None)]


def test_composite(rows):
    df = rows("k string, v double, c double", [("a", 10.0, 5.0), ("a", 20.0, 6.0), ("a", 60.0, 7.0)])
    out = stats.composite(df, ["k"], "v", compare=["c"]).orderBy("v").collect()
    assert [r["mean_v_per_k"] for r in out] == [30.0] * 3 and out[0]["median_v_per_k"] == 20.0
    assert [r["v_diff_to_mean_v_per_k"] for r in out] == [-20.0, -10.0, 30.0]
    rel = [r["v_rel_diff_to_mean_v_per_k"] for r in out]
    assert rel == pytest.approx([-20 / 10.01, -10 / 20.01, 30 / 60.01])
    assert out[0]["c_diff_to_mean_v_per_k"] == -25.0
    assert out[0]["c_rel_diff_to_mean_v_per_k"] == pytest.approx(-25 / 10.01)


def test_composite_split(rows):
    df = rows("k string, split string, v double", [("a", "train", 1.0), ("a", "train", 3.0), ("a", "val", 10.0), ("a", None, 5.0)])
    out = stats.composite(df, ["k"], "v", ["mean", "sum"], split="split")
    assert sorted((r["split"], r["mean_v_per_k"]) for r in out.collect()) == [("train", 2.0), ("train", 2.0), ("val", 10.0)]
    assert not [c for c in out.columns if "diff_to_sum" in c]


def test_outliers(rows):
    assert clean.outlier_by_key(rows("k int, v double", [(1, 5.0)]), "k", "v").count() == 0
    df = rows("k int, v double", [(1, float(v)) for v in [1] * 20 + [100, -100]] + [(1, None)])
    kept = {r["v"] for r in clean.outlier_global(df, "v").collect()}
    assert kept == {1.0, -100.0}


def test_price_index(rows):
    df = rows("k int, p double", [(1, 30.0), (1, 10.0), (1, 20.0), (1, None)])
    out = {r["p"]: r["price_index_per_k"] for r in ranking.index_in_group(df, "k", "p").collect()}
    assert out == {30.0: 2, 10.0: 0, 20.0: 1, None: 3}


def test_trip_holidays(spark, rows):
    day = dt.date
    df = rows(
        "a date, b date",
        [
            (day(2013, 7, 3), day(2013, 7, 5)),
            (day(2013, 7, 4), day(2013, 7, 4)),
            (day(2013, 7, 5), day(2013, 7, 6)),
            (day(1999, 1, 1), day(1999, 1, 2)),
            (day(2013, 1, 1), day(2013, 12, 31)),
            (None, day(2013, 12, 31)),
        ],
    )
    out = holidays.count_in_interval(df, "a", "b", holidays.us_holidays(spark, 2013, 2013))
    assert sorted(r["holidays"] for r in out.collect()) == [0, 0, 0, 1, 1, 10]


def test_holiday_shift(spark):
    days = {(r["holiday"], r["name"]) for r in holidays.us_holidays(spark, 2010, 2011).collect()}
    assert (dt.date(2011, 12, 26), "Christmas Day") in days and (dt.date(2010, 12, 24), "Christmas Day") in days
    assert (dt.date(2010, 12, 31), "New Year's Day") in days
    assert (dt.date(2011, 11, 24), "Thanksgiving") in days and (dt.date(2011, 5, 30), "Memorial Day") in days
    assert not any(n == "Juneteenth" for _, n in days)
    later = holidays.us_holidays(spark, 2020, 2022, juneteenth=True).filter("name = 'Juneteenth'")
    assert sorted(r["holiday"] for r in later.collect()) == [dt.date(2021, 6, 18), dt.date(2022, 6, 20)]


def test_price_basis(rows):
    # Item 1 quotes per day in 3 of 5 rows, item 2 in exactly half.
    def shown(item, daily):
        return (item, 100.0, 200.0 if daily else 100.0, 2)

    df = rows("i int, p double, g double, s int", [shown(1, d) for d in (1, 1, 1, 0, 0)] + [shown(2, 1), shown(2, 0), (2, 100.0, None, 0)])
    out = {(r["i"], r["s"]): (r["price_per_day"], r["price_per_trip"]) for r in pricing.price_basis(df, "i", "p", "g", "s").collect()}
    assert out[(1, 2)] == (100.0, 200.0) and out[(2, 2)] == (50.0, 100.0) and out[(2, 0)] == (None, 100.0)


def test_cheapest(rows):
    df = rows("a int, b int, c int", [(1, None, 0), (-1, 1, None), (None, None, None)])
    assert [r[0] for r in df.select(row_min(["a", "b", "c"])).collect()] == [0, -1, None]


def test_calendar(rows):
    def at(*days):
        df = rows("t timestamp_ntz", [(dt.datetime(*d),) for d in days])
        return time_features(df, "t", "").collect()

    assert [r["week_id"] for r in at((2012, 12, 31), (2012, 1, 1), (2013, 6, 5))] == [201301, 201152, 201323]
    hours = at(*[(2013, 1, 1, h) for h in (0, 2, 7, 12, 18, 23)])
    names = ["late_evening", "night", "morning", "afternoon", "evening", "late_evening"]
    parts = ("morning", "afternoon", "evening", "late_evening", "night")
    assert [[p for p in parts if r[p]] for r in hours] == [[n] for n in names]
    assert [r["lunch"] for r in at(*[(2013, 1, 1, h) for h in (10, 11, 13, 14)])] == [False, True, True, False]
    assert [r["dow"] for r in at((2013, 6, 3), (2013, 6, 9))] == [1, 7]
    week = rows("w int", [(w,) for w in (1, 2, 3, 28, 29, 53)])
    assert [r[0] for r in week.select(summer_index(F.col("w"))).collect()] == [0, 0, 0, 25, 25, 1]
    month = rows("m int", [(m,) for m in (12, 1, 2, 3, 6, 9, 11)])
    assert [r[0] for r in month.select(season_number(F.col("m"))).collect()] == [1, 1, 1, 2, 3, 4, 4]


@pytest.mark.parametrize("values, cube, exp", [([99.0], True, False), ([100.0], False, False), ([9.0], True, True), ([1.0, None], False, False)])
def test_power_guard(rows, values, cube, exp):
    out = transforms(rows("x double", [(v,) for v in values]), ["x"])
    assert ("x_pow_3" in out.columns) == cube and ("x_exp" in out.columns) == exp
    assert {"x_pow_0.33", "x_log_2", "x_log_10", "x_log_2.72", "x_reciprocal"} <= set(out.columns)


def test_ordinal(rows):
    df = rows("k string, v double", [("a", 6.0), ("a", 8.0), ("b", 5.0), ("c", 9.0), (None, 1.0)])
    out = {r["k"]: r["ordinal_k"] for r in encode.ordinal_by_mean(df, "k", "v").collect()}
    assert out == {"b": 0, "a": 1, "c": 2, None: None}


def test_support(rows):
    data = [("few", 1.0, 0)] * 9 + [("many", 1.0, 0)] * 10 + [("random", 0.0, 1)] * 19
    out = encode.support_encode(rows("k string, v double, r int", data), "k", {"v": "m"}, F.col("r") == 0)
    found = {r["k"]: r["m"] for r in out.collect()}
    assert found == {"few": 0.5, "many": 1.0, "random": 0.5} and out.count() == 38


def test_train_stats_read_training_rows_only(rows):
    data = [("a", 1, 1, "train"), ("a", 0, 0, "train"), ("a", 1, 1, "test"), ("b", 1, 1, "test")]
    out = encode.train_stats(rows("k string, c int, b int, split string", data), "k", "c", "b")
    assert {(r["k"], r["booking_prob_train"]) for r in out.collect()} == {("a", 0.5), ("b", None)}


def test_ordered_split(rows):
    df = rows("g int", [(1,)] * 3 + [(2,)] * 3 + [(3,)] * 4)
    out = splits.ordered(df, "g", 0.5)
    assert {(r["g"], r["split"]) for r in out.collect()} == {(1, "train"), (2, "test"), (3, "test")}
    assert splits.overlap(out, "g").count() == 0


def test_modulo_split(rows):
    out = splits.by_modulo(rows("g int", [(v,) for v in (5, 15, 1, 21, 7)]), "g")
    assert [r["split"] for r in out.collect()] == ["test", "test", "val", "val", "train"]


def test_hash_split_keeps_groups(spark):
    df = splits.by_hash(spark.range(2000).select((F.col("id") % 400).alias("g")), "g", 0.7)
    assert splits.overlap(df, "g").count() == 0
    assert 0.6 < df.filter("split = 'train'").count() / 2000 < 0.8


def test_blend(rows):
    a = rows("srch_id int, prop_id int, ord double", [(1, i, float(i)) for i in (1, 2, 3)])
    b = rows("srch_id int, prop_id int, pred double", [(1, i, float(4 - i)) for i in (1, 2, 3)])
    out = ranking.blend(a, b, ["srch_id", "prop_id"]).orderBy("prop_id").collect()
    assert [r["final_score"] for r in out] == pytest.approx([0.3, 0.0, -0.3])


def test_validate(rows):
    schema = "pos int, g int"
    good = rows(schema, [(0, 1), (1, 1), (2, 2), (3, 2)])

    def kinds(data):
        return {r["kind"] for r in validate.validate(good, rows(schema, data), "g", "pos").collect()}

    assert kinds([(0, 1), (1, 1), (2, 2), (3, 2)]) == set()
    assert kinds([(0, 1), (1, 1), (2, 2), (3, 2), (4, 2)]) == {"row_count", "group_count", "index"}
    assert kinds([(0, 2), (1, 1), (2, 1), (3, 2)]) == {"group_sequence"}
    assert kinds([(0, 1), (1, 1), (2, 1), (3, 2)]) == {"group_count", "group_sequence"}


def test_rank_gaps(rows):
    df = rows("g int, rank int", [(1, 1), (1, 2), (2, 1), (2, 3), (3, 1), (3, 1), (4, 1), (4, 2), (4, 2), (4, 4)])
    assert {r["g"] for r in validate.rank_gaps(df, "g").collect()} == {2, 3, 4}


def test_narrow(rows):
    df = rows(
        "a int, b int, c double, d double, e string, f bigint, g double",
        [(0, -1, 1.0, 1.5, "a", 2**40, None), (255, 127, 2.0, 2.0, "b", -1, 3.0)],
    )
    out = narrow.narrow(df)
    assert dict(out.dtypes) == {"a": "smallint", "b": "tinyint", "c": "tinyint", "d": "float", "e": "string", "f": "bigint", "g": "tinyint"}
    assert sorted(map(str, out.collect())) == sorted(map(str, out.collect()))
    assert [r["a"] for r in out.collect()] == [0, 255] and out.first()["g"] is None
    assert dict(narrow.narrow(df, "simple").dtypes)["c"] == "float"


def test_family(rows):
    df = rows("n string", [("mean_x_per_a",), ("y",), ("x_per_a_per_b",)])
    assert [r[0] for r in df.select(feature_family("n")).collect()] == ["a", "", "a_b"]


def test_category_fill(rows):
    out = clean.fill_category(rows("k string", [("a",), (None,)]), ["k"])
    assert [r["k"] for r in out.collect()] == ["a", "NaN_category"]


def test_corr_strength(rows):
    corr = rows("a string, b string, corr double", [("x", "y", 0.5), ("x", "z", -0.25), ("y", "z", None)])
    out = {r["column"]: r["total"] for r in profile.corr_strength(corr).collect()}
    assert out == {"x": 1.5, "y": 1.0, "z": 0.5}


def test_histogram_of_one_value(rows):
    out = profile.histogram(rows("x double", [(3.0,), (3.0,), (None,)]), "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in out] == [0, 0, 2, 0] and out[0]["low"] == 2.5


def test_class_score(rows):
    df = rows("label int, p array<double>", [(0, [0.9, 0.1]), (5, [0.4, 0.6])])
    assert [r[0] for r in df.select(class_score("label", "p")).collect()] == pytest.approx([0.009, 3.0])


def test_nan_is_unknown(rows):
    df = nans_to_nulls(rows("x double, y int", [(float("nan"), 1), (2.0, None)]))
    assert [r["x"] for r in df.collect()] == [None, 2.0]


def test_min_group_size(rows):
    df = rows("g int, i int", [(1, 1), (1, 2), (2, 1), (2, None)])
    assert {r["g"] for r in clean.min_group_size(df, "g", 2, "i").collect()} == {1}
    assert clean.multi_row_groups(df, "g").count() == 4


def test_group_changes(rows):
    df = rows("t int, g int", [(1, 1), (2, 1), (3, 2), (4, 1)])
    for hot in (None, 2):
        out = splits.group_changes(df, "g", ["t"], hot_rows=hot).orderBy("t").collect()
        assert [r["is_change"] for r in out] == [True, False, True, True]
