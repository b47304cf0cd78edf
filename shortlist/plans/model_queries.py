"""Model jobs on lineitem: an order is a search, a part is an item, the graded flag is the gain."""

from __future__ import annotations

import functools
import math
from dataclasses import replace

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..models import assembly, cocluster_search, ensembles, evaluate, factor_search, factors, linear, margin, trees
from ..operators.ordering import positions
from ..operators.splits import by_modulo
from ..session import written
from .registry import GAIN_SQL, LINE_TAIL, LINE_TAIL_SQL, graded_lines, query

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
GROUP, GAIN = "l_orderkey", "gain"
ROW = "row"


def _rows(spark, folder):
    """Graded rows with split and row number, written once since every fit reads them often."""
    rows = by_modulo(graded_lines(spark, folder), GROUP).withColumn(ROW, F.monotonically_increasing_id())
    return written(rows.select(ROW, GROUP, "l_partkey", GAIN, "split", *FEATURES))


def _vectors(rows):
    model = assembly.fit_assembly(rows.filter("split = 'train'"), FEATURES)
    return assembly.assemble(rows, model)


def _ratings(spark, folder):
    return factors.rating_triples(graded_lines(spark, folder), GROUP, "l_partkey", GAIN)


_RATINGS_SQL = f"t AS (SELECT l_orderkey AS u, l_partkey AS i, avg({GAIN_SQL}) AS r FROM lineitem GROUP BY 1, 2)"


@query(
    "pair_differences",
    f"""WITH b AS (SELECT l_orderkey, l_quantity, round(l_extendedprice * 100) AS cents, {GAIN_SQL} g FROM lineitem)
      SELECT a.l_orderkey, sum(CASE WHEN a.g > b.g THEN 1 ELSE 0 END) AS pairs,
        sum(CASE WHEN a.g > b.g THEN a.l_quantity - b.l_quantity ELSE 0 END) AS diff_l_quantity,
        sum(CASE WHEN a.g > b.g THEN a.cents - b.cents ELSE 0 END) AS diff_cents
      FROM b a JOIN b ON a.l_orderkey = b.l_orderkey GROUP BY 1""",
)
def _pair_differences(spark, folder):
    """The SQL forms every pair; the Spark plan only counts and sums per gain."""
    rows = graded_lines(spark, folder).select(GROUP, GAIN, "l_quantity", F.round(F.col("l_extendedprice") * 100).alias("cents"))
    out = linear.pair_differences(rows, GROUP, GAIN, ["l_quantity", "cents"])
    return out.withColumn("pairs", F.col("pairs").cast("bigint"))


@query(
    "rating_biases",
    f"""WITH {_RATINGS_SQL}, m AS (SELECT round(avg(r), 3) mu FROM t),
      bi AS (SELECT i, sum(r - mu) / (count(*) + 5.3) b FROM t, m GROUP BY 1)
      SELECT u AS "user", round(sum(r - mu - b) / (count(*) + 5.3), 6) AS user_bias FROM t JOIN bi USING (i), m GROUP BY 1""",
)
def _rating_biases(spark, folder):
    ratings = _ratings(spark, folder)
    mean = round(ratings.agg(F.avg("rating")).first()[0], 3)
    return factors.rating_biases(ratings, mean, 5.3)[1]


@query(
    "factor_step",
    f"""WITH {_RATINGS_SQL}, q AS (SELECT u, r, i % 3 - sqrt(2) AS a, i % 5 / sqrt(17) AS b FROM t),
      s AS (SELECT u, sum(a * a) + sqrt(0.2) * count(*) AS aa, sum(a * b) AS ab, sum(b * b) + sqrt(0.2) * count(*) AS bb,
        sum(a * r) AS ar, sum(b * r) AS br FROM q GROUP BY 1)
      SELECT u AS "user", round((ar * bb - br * ab) / (aa * bb - ab * ab), 6) AS first,
        round((br * aa - ar * ab) / (aa * bb - ab * ab), 6) AS second FROM s""",
)
def _factor_step(spark, folder):
    """One half step of the factor model for given item factors."""
    ratings = _ratings(spark, folder)
    given = F.array(F.col("item") % 3 - math.sqrt(2), F.col("item") % 5 / math.sqrt(17))
    known = ratings.select("item").distinct().withColumn("item_factors", given)
    solved = factors.solve_side(ratings, known, "user", "item", 2, math.sqrt(0.2))
    return solved.select("user", F.col("user_factors")[0].alias("first"), F.col("user_factors")[1].alias("second"))


@query(
    "cocluster_means",
    f"""WITH {_RATINGS_SQL} SELECT u % 3 AS user_cluster, i % 4 AS item_cluster, count(*) AS n, round(sum(r), 6) AS total FROM t GROUP BY 1, 2""",
)
def _cocluster_means(spark, folder):
    """The grouped means of one co-clustering step, for given clusters."""
    ratings = _ratings(spark, folder)
    return factors.cluster_means(ratings.withColumns({"user_cluster": F.col("user") % 3, "item_cluster": F.col("item") % 4}))


@query(
    "item_cosine",
    f"""WITH {_RATINGS_SQL}, top AS (SELECT i FROM t GROUP BY 1 ORDER BY count(*) DESC, i LIMIT 5),
      p AS (SELECT a.i AS item, b.i AS other, sum(a.r * b.r) ab, sum(a.r * a.r) aa, sum(b.r * b.r) bb, count(*) n
        FROM t a JOIN t b ON a.u = b.u AND a.i <> b.i WHERE a.i IN (SELECT i FROM top) GROUP BY 1, 2)
      SELECT item, other, round(ab / nullif(sqrt(aa * bb), 0), 6) AS similarity, n AS common FROM p""",
)
def _item_cosine(spark, folder):
    """Neighbours of the five items with the most ratings."""
    ratings = _ratings(spark, folder)
    most = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "item").limit(5)
    return factors.item_similarity(ratings, [r["item"] for r in most.collect()])


@query(
    "item_neighbours",
    f"""WITH {_RATINGS_SQL}, p AS (SELECT a.i AS item, b.i AS other, sum(a.r * b.r) / nullif(sqrt(sum(a.r * a.r) * sum(b.r * b.r)), 0) AS s, count(*) AS n
        FROM t a JOIN t b ON a.u = b.u AND a.i <> b.i GROUP BY 1, 2 HAVING count(*) >= 2),
      k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY round(s, 9) DESC, n DESC, other) AS place FROM p WHERE s IS NOT NULL)
      SELECT item, other, round(s, 6) AS similarity, n AS common, place AS rank FROM k WHERE place <= 10""",
)
def _item_neighbours(spark, folder):
    """The ten nearest neighbours of every item, of those with two common users."""
    return factors.item_neighbours(_ratings(spark, folder))


_KEYS = ("l_partkey", "l_suppkey", "l_returnflag")


@query(
    "category_index",
    f"""WITH b AS (SELECT * FROM lineitem WHERE l_orderkey % 10 <> 5),
      {", ".join(f"k{i} AS (SELECT CAST({c} AS VARCHAR) AS v, row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS x FROM b GROUP BY 1)"
                 for i, c in enumerate(_KEYS))}
      SELECT l_orderkey, {", ".join(_KEYS)}, count(*) AS n, {", ".join(f"max(coalesce(k{i}.x, (SELECT count(*) FROM k{i}))) AS {c}_index" for i, c in enumerate(_KEYS))}
      FROM lineitem l {" ".join(f"LEFT JOIN k{i} ON CAST(l.{c} AS VARCHAR) = k{i}.v" for i, c in enumerate(_KEYS))} GROUP BY l_orderkey, {", ".join(_KEYS)}""",
)
def _category_index(spark, folder):
    """Numbers of three categories from a dictionary of the rows outside the test split."""
    rows = written(by_modulo(graded_lines(spark, folder), GROUP).select(GROUP, *_KEYS, "split"))
    fitted = assembly.fit_dictionary(rows.filter("split <> 'test'"), _KEYS)
    coded = fitted.transform(rows)
    return coded.groupBy(GROUP, *_KEYS).agg(F.count(F.lit(1)).alias("n"), *[F.max(f"{c}_index").alias(f"{c}_index") for c in _KEYS])


_WEIGHTS = (0.5, -1.0, 2.0, 0.25, -0.75)


@query(
    "mean_attribution",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg(abs(({c} - m) / s * {w})), 6) AS attribution
          FROM lineitem, (SELECT avg({c}) m, stddev_pop({c}) s FROM lineitem)"""
        for c, w in zip(FEATURES, _WEIGHTS)
    ),
)
def _mean_attribution(spark, folder):
    """Mean absolute attribution of a linear score with given weights."""
    rows = graded_lines(spark, folder)
    ranker = replace(linear.standardiser(rows, FEATURES), weights=_WEIGHTS)
    return evaluate.mean_attribution(ranker.attributions(rows), FEATURES)


# Mean, deviation and weight of each of FEATURES in a given linear score.
_GIVEN = ((25.0, 15.0, 0.3), (38000.0, 23000.0, -0.4), (0.05, 0.03, 0.2), (0.04, 0.025, 0.1), (4.0, 2.0, -0.25))
_UNITS = [f"(({c} - {m}) / CAST({d} AS DOUBLE))" for c, (m, d, _) in zip(FEATURES, _GIVEN)]


@query(
    "pair_gradient",
    f"""WITH b AS (SELECT l_orderkey AS o, {GAIN_SQL} AS g, {", ".join(f"{u} AS x{i}" for i, u in enumerate(_UNITS))} FROM lineitem),
      s AS (SELECT *, {" + ".join(f"CAST({w} AS DOUBLE) * x{i}" for i, (_, _, w) in enumerate(_GIVEN))} AS s FROM b),
      p AS (SELECT greatest(0, 1 - (a.s - b.s)) AS m, {", ".join(f"b.x{i} - a.x{i} AS d{i}" for i in range(len(FEATURES)))}
        FROM s a JOIN s b ON a.o = b.o AND a.g > b.g)
      {" UNION ALL ".join(f"SELECT '{c}' AS feature, round(sum(m * d{i}) / count(*), 6) AS gradient FROM p" for i, c in enumerate(FEATURES))}""",
)
def _pair_gradient(spark, folder):
    """Gradient of the margin loss by given weights, per pair. The SQL forms every pair, the Spark plan none."""
    rows = graded_lines(spark, folder)
    means, scales, weights = zip(*_GIVEN)
    ranker = linear.LinearRanker(tuple(FEATURES), means, scales, weights)
    pairs = linear.pair_levels(rows, GROUP, GAIN).agg(F.sum(F.col("n") * F.col("lower"))).first()[0]
    kept = margin.pairs_of(rows, GROUP, GAIN, ranker, per_group=False)
    gradient = kept.gradient(weights) / float(pairs)
    kept.close()
    return evaluate.table(rows, list(zip(FEATURES, gradient.tolist())), ["feature", "gradient"])


_NUMBERED_SQL = f"""b AS (SELECT *, {GAIN_SQL} AS g, row_number() OVER (ORDER BY l_orderkey, {LINE_TAIL_SQL}) AS i,
        CASE l_orderkey % 10 WHEN 5 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split FROM lineitem)"""


def _metric_sql(source, keys, score):
    """Mean NDCG@5 of groups of at least five rows of ``source`` (l_orderkey, g, i, keys) by ``score``, for each value of the keys."""
    part = ", ".join([*keys, "l_orderkey"])
    key = ", ".join(keys)
    return f"""SELECT {key}, avg(CASE WHEN ideal = 0 THEN 0 ELSE d / nullif(ideal, 0) END) AS ndcg FROM (
      SELECT {part}, sum(CASE WHEN rk <= 5 THEN g / log2(rk + 1) ELSE 0 END) AS d,
        sum(CASE WHEN ik <= 5 THEN g / log2(ik + 1) ELSE 0 END) AS ideal FROM (
        SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {score} DESC, i) AS rk,
          row_number() OVER (PARTITION BY {part} ORDER BY g DESC) AS ik, count(*) OVER (PARTITION BY {part}) AS rows FROM {source}) AS r
      WHERE rows >= 5 GROUP BY {part}) AS q GROUP BY {key}"""


def _numbered_rows(spark, folder):
    """Graded rows with split and a number that SQL gives them too."""
    rows = by_modulo(graded_lines(spark, folder), GROUP)
    return written(positions(rows, [], [GROUP, *LINE_TAIL], ROW).select(ROW, GROUP, GAIN, "split", *FEATURES))


@query(
    "pairwise_normal",
    f"""WITH m AS (SELECT {", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS d{i}" for i, c in enumerate(FEATURES))} FROM lineitem),
      b AS (SELECT l_orderkey AS o, {GAIN_SQL} AS g, {", ".join(f"({c} - m{i}) / d{i} AS x{i}" for i, c in enumerate(FEATURES))} FROM lineitem, m),
      p AS (SELECT {", ".join(f"a.x{i} - b.x{i} AS x{i}" for i in range(len(FEATURES)))}, 1 / CAST(count(*) OVER (PARTITION BY a.o) AS DOUBLE) AS w,
        a.o AS o FROM b a JOIN b ON a.o = b.o AND a.g > b.g),
      n AS (SELECT CAST(count(DISTINCT o) AS DOUBLE) AS n FROM p)
      """
    + " UNION ALL ".join(
        f"SELECT {i} AS place, {j} AS other, round(sum(w * x{i} * {f'x{j}' if j >= 0 else '1'}) / max(n), 6) AS value FROM p, n"
        for i in range(len(FEATURES))
        for j in range(-1, i + 1)
    ),
)
def _pairwise_normal(spark, folder):
    """Normal equations of the pairwise ranker, per group; other -1 is the right side. The Spark plan forms no pair."""
    rows = graded_lines(spark, folder)
    _, normal, target = linear.pair_normal(rows, GROUP, GAIN, FEATURES)
    groups = linear.pair_levels(rows, GROUP, GAIN).filter("lower > 0").select(GROUP).distinct().count()
    out = [(i, -1, float(target[i] / groups)) for i in range(len(FEATURES))]
    out += [(i, j, float(normal[i, j] / groups)) for i in range(len(FEATURES)) for j in range(i + 1)]
    return evaluate.table(rows, out, ["place", "other", "value"])


@query(
    "listwise_gradient",
    f"""WITH {_NUMBERED_SQL}, x AS (SELECT l_orderkey AS o, g, i, {", ".join(f"{u} AS x{j}" for j, u in enumerate(_UNITS))} FROM b),
      s AS (SELECT *, {" + ".join(f"CAST({w} AS DOUBLE) * x{j}" for j, (_, _, w) in enumerate(_GIVEN))} AS s FROM x),
      r AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY s DESC, i) AS rk, row_number() OVER (PARTITION BY o ORDER BY g DESC) AS ik FROM s),
      d AS (SELECT *, CASE WHEN rk <= 5 THEN 1 / log2(rk + 1) ELSE 0 END AS d,
        sum(CASE WHEN ik <= 5 THEN g / log2(ik + 1) ELSE 0 END) OVER (PARTITION BY o) AS ideal FROM r),
      p AS (SELECT (a.g - b.g) * abs(a.d - b.d) / a.ideal / (1 + exp(a.s - b.s)) AS w,
        {", ".join(f"a.x{j} - b.x{j} AS x{j}" for j in range(len(FEATURES)))} FROM d a JOIN d b ON a.o = b.o AND a.g > b.g),
      n AS (SELECT CAST(count(DISTINCT o) AS DOUBLE) AS n FROM d WHERE ideal > 0)
      {" UNION ALL ".join(f"SELECT '{c}' AS feature, round(sum(w * x{j}) / max(n), 6) AS gradient FROM p, n" for j, c in enumerate(FEATURES))}""",
)
def _listwise_gradient(spark, folder):
    """One step of the list-wise ranker from a given score."""
    start = linear.LinearRanker(tuple(FEATURES), *zip(*_GIVEN))
    rows = graded_lines(spark, folder)
    moved = linear.fit_listwise(rows, GROUP, GAIN, FEATURES, steps=1, rate=1.0, start=start)
    steps = [(c, float(b - a)) for c, a, b in zip(FEATURES, start.weights, moved.weights)]
    return evaluate.table(rows, steps, ["feature", "gradient"])


_LINEAR_SQL = " + ".join(f"{u} * CAST({w} AS DOUBLE)" for u, (_, _, w) in zip(_UNITS, _GIVEN))


@query(
    "leaderboard_of_scores",
    f"""WITH {_NUMBERED_SQL}, s AS (SELECT 'linear' AS model, l_orderkey, g, i, {_LINEAR_SQL} AS s FROM b WHERE split = 'test'
        UNION ALL SELECT 'dear', l_orderkey, g, i, CAST(l_extendedprice AS DOUBLE) FROM b WHERE split = 'test'
        UNION ALL SELECT 'cheap', l_orderkey, g, i, -CAST(l_extendedprice AS DOUBLE) FROM b WHERE split = 'test'),
      m AS ({_metric_sql("s", ["model"], "s")}) SELECT model, round(ndcg, 6) AS ndcg FROM m""",
)
def _leaderboard_of_scores(spark, folder):
    """A given linear score and the price either way round on test rows."""
    rows = _numbered_rows(spark, folder).filter("split = 'test'")
    scorers = {
        "linear": linear.LinearRanker(tuple(FEATURES), *zip(*_GIVEN)).transform,
        "dear": lambda df: df.withColumn("prediction", F.col("l_extendedprice").cast("double")),
        "cheap": lambda df: df.withColumn("prediction", -F.col("l_extendedprice").cast("double")),
    }
    return evaluate.leaderboard(rows, scorers, GROUP, GAIN, tiebreak=[ROW])


_TWO = ["l_extendedprice", "l_tax"]


def _fit_sql(name, where):
    """The least-squares ranker of two features over rows of ``b``, solved by hand: w0 and w1 together, v0 and v1 alone."""
    a, c = _TWO
    return f"""z{name} AS (SELECT avg({a}) AS m0, stddev_pop({a}) AS d0, avg({c}) AS m1, stddev_pop({c}) AS d1 FROM b WHERE {where}),
      x{name} AS (SELECT l_orderkey AS o, g, ({a} - m0) / d0 AS x0, ({c} - m1) / d1 AS x1 FROM b, z{name} WHERE {where}),
      p{name} AS (SELECT a.x0 - b.x0 AS x0, a.x1 - b.x1 AS x1, 1 / CAST(count(*) OVER (PARTITION BY a.o) AS DOUBLE) AS w
        FROM x{name} a JOIN x{name} b ON a.o = b.o AND a.g > b.g),
      n{name} AS (SELECT sum(w * x0 * x0) AS n00, sum(w * x0 * x1) AS n01, sum(w * x1 * x1) AS n11, sum(w * x0) AS t0, sum(w * x1) AS t1 FROM p{name}),
      r{name} AS (SELECT *, n00 + (n00 + n11) / 2000 AS a00, n11 + (n00 + n11) / 2000 AS a11 FROM n{name}),
      f{name} AS (SELECT m0, d0, m1, d1, (t0 * a11 - t1 * n01) / (a00 * a11 - n01 * n01) AS w0, (t1 * a00 - t0 * n01) / (a00 * a11 - n01 * n01) AS w1,
        t0 / (n00 * (1 + 1 / CAST(1000 AS DOUBLE))) AS v0, t1 / (n11 * (1 + 1 / CAST(1000 AS DOUBLE))) AS v1 FROM r{name}, z{name})"""


_SCORE_SQL = f"({_TWO[0]} - m0) / d0 * {{w0}} + ({_TWO[1]} - m1) / d1 * {{w1}}"


@query(
    "refit_two_features",
    f"""WITH {_NUMBERED_SQL}, {_fit_sql("", "split <> 'test'")},
      s AS (SELECT CASE split WHEN 'test' THEN 'test' ELSE 'train_val' END AS part, l_orderkey, g, i, {_SCORE_SQL.format(w0="w0", w1="w1")} AS s FROM b, f),
      m AS ({_metric_sql("s", ["part"], "s")}) SELECT part AS split, round(ndcg, 6) AS ndcg FROM m""",
)
def _refit_two_features(spark, folder):
    """The pairwise ranker of two features, fitted on training and validation rows, and its metric there and on test rows."""
    rows = _numbered_rows(spark, folder)
    return evaluate.refit(rows, lambda part: linear.fit_pairwise(part, GROUP, GAIN, _TWO).transform, GROUP, GAIN, tiebreak=[ROW])


@query(
    "drop_two_features",
    f"""WITH {_NUMBERED_SQL}, {_fit_sql("", "split = 'train'")},
      s AS ({" UNION ALL ".join(f"SELECT '{name}' AS model, l_orderkey, g, i, {_SCORE_SQL.format(w0=a, w1=c)} AS s FROM b, f WHERE split = 'val'"
                               for name, a, c in (("both", "w0", "w1"), (_TWO[0], "0", "v1"), (_TWO[1], "v0", "0")))}),
      m AS ({_metric_sql("s", ["model"], "s")})
      SELECT model AS feature, round((SELECT ndcg FROM m WHERE model = 'both') - ndcg, 6) AS score FROM m WHERE model <> 'both'""",
)
def _drop_two_features(spark, folder):
    """Metric of the pairwise ranker less that of a refit without the feature."""
    rows = _numbered_rows(spark, folder)

    def fit(part, columns):
        return linear.fit_pairwise(part, GROUP, GAIN, columns).transform

    train, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")
    return evaluate.drop_importance(train, val, fit, _TWO, GROUP, GAIN, tiebreak=[ROW])


@query("pairwise_rank")
def _pairwise_rank(spark, folder):
    """Scores of test rows by least squares on all pairs."""
    rows = _rows(spark, folder)
    ranker = linear.fit_pairwise(rows.filter("split = 'train'"), GROUP, GAIN, FEATURES)
    return ranker.transform(rows.filter("split = 'test'")).select(GROUP, "l_partkey", GAIN, "prediction")


@query("margin_rank")
def _margin_rank(spark, folder):
    """Scores of test rows by the margin ranker, stopped by NDCG@5 of validation rows."""
    rows = _rows(spark, folder)
    train, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")
    ranker = margin.fit_margin(train, val, GROUP, GAIN, FEATURES, tiebreak=[ROW])
    return ranker.transform(rows.filter("split = 'test'")).select(GROUP, "l_partkey", GAIN, "prediction")


@query("listwise_rank")
def _listwise_rank(spark, folder):
    rows = _rows(spark, folder)
    train = rows.filter("split = 'train'")
    start = linear.fit_pairwise(train, GROUP, GAIN, FEATURES)
    ranker = linear.fit_listwise(train, GROUP, GAIN, FEATURES, start=start)
    return ranker.transform(rows.filter("split = 'test'")).select(GROUP, "l_partkey", GAIN, "prediction")


# (feature, threshold, value up to it, value beyond, weight of the tree)
_STUMPS = (
    ("l_extendedprice", 30000.0, 0.75, -0.5, 1.0),
    ("l_discount", 0.045, -0.25, 0.5, 0.5),
    ("l_quantity", 25.5, 1.0, -1.5, 0.25),
    ("l_linenumber", 2.5, -0.5, 0.25, 0.5),
)
_STAGES_SQL = [
    " + ".join(f"(CASE WHEN {c} <= {t} THEN {lo * w} ELSE {hi * w} END)" for c, t, lo, hi, w in _STUMPS[: n + 1])
    for n in range(len(_STUMPS))
]


def _given_trees():
    made = [ensembles.Tree.stump(FEATURES.index(c), t, lo, hi) for c, t, lo, hi, _ in _STUMPS]
    return ensembles.Ensemble(tuple(made), tuple(s[-1] for s in _STUMPS))


@query(
    "staged_ndcg",
    f"""WITH b AS (SELECT *, {GAIN_SQL} AS g, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
      s AS ({" UNION ALL ".join(f"SELECT b.*, {n + 1} AS trees, CAST({e} AS DOUBLE) AS s FROM b" for n, e in enumerate(_STAGES_SQL))}),
      r AS (SELECT l_orderkey, trees, g, n, row_number() OVER (PARTITION BY l_orderkey, trees ORDER BY s DESC, {LINE_TAIL_SQL}) AS rk,
        row_number() OVER (PARTITION BY l_orderkey, trees ORDER BY g DESC) AS ik FROM s),
      a AS (SELECT l_orderkey, trees, sum(CASE WHEN rk <= 5 THEN g / log2(rk + 1) ELSE 0 END) AS d,
        sum(CASE WHEN ik <= 5 THEN g / log2(ik + 1) ELSE 0 END) AS i FROM r WHERE n >= 5 GROUP BY 1, 2)
      SELECT trees, round(avg(CASE WHEN i = 0 THEN 0 ELSE d / nullif(i, 0) END), 6) AS mean_ndcg, count(*) AS "groups" FROM a GROUP BY 1""",
)
def _staged_ndcg(spark, folder):
    """NDCG@5 after each of the given trees, in one pass."""
    rows = graded_lines(spark, folder).withColumn("features", array_to_vector(F.array(*[F.col(c).cast("double") for c in FEATURES])))
    return ensembles.staged_ndcg(rows, _given_trees(), GROUP, GAIN, tiebreak=LINE_TAIL)


# Rows against which the given trees' scores are explained, in the order of FEATURES.
_BACKGROUND = ((10.0, 20000.0, 0.02, 0.01, 1.0), (30.0, 40000.0, 0.06, 0.03, 3.0), (45.0, 70000.0, 0.09, 0.05, 5.0))


def _share_sql(feature):
    """Mean size of the share of a feature that one given tree reads, or of one that none reads."""
    for c, t, lo, hi, w in _STUMPS:
        if c == feature:
            values = [lo if row[FEATURES.index(c)] <= t else hi for row in _BACKGROUND]
            return f"avg(abs(CAST({w} AS DOUBLE) * ((CASE WHEN {c} <= {t} THEN {lo} ELSE {hi} END) - CAST({sum(values)} AS DOUBLE) / 3)))"
    return "max(CAST(0 AS DOUBLE))"


@query(
    "tree_attribution",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, round({_share_sql(c)}, 6) AS attribution FROM lineitem" for c in FEATURES),
)
def _tree_attribution(spark, folder):
    """Mean absolute Shapley value of each feature in the scores of the given trees, over all orders of the features."""
    rows = graded_lines(spark, folder).select(array_to_vector(F.array(*[F.col(c).cast("double") for c in FEATURES])).alias("features"))
    return evaluate.mean_attribution(ensembles.tree_attributions(rows, _given_trees(), _BACKGROUND), FEATURES)


@query("pointwise_rank")
def _pointwise_rank(spark, folder):
    """Up to 500 trees, stopped 50 trees after the best NDCG@5 of validation rows."""
    rows = _vectors(_rows(spark, folder))
    model = ensembles.fit_boosted(rows, GROUP, GAIN, tiebreak=[ROW], rounds=500, patience=50, maxDepth=4)
    return model.transform(rows.filter("split = 'test'")).select(GROUP, "l_partkey", GAIN, "prediction")


@query("classifier_score")
def _classifier_score(spark, folder):
    rows = _vectors(_rows(spark, folder))
    model = trees.fit_classifier(rows.filter("split = 'train'"), GAIN, maxIter=100)
    scored = trees.score_classes(model, rows.filter("split = 'test'"))
    return scored.select(GROUP, "l_partkey", GAIN, "label", "prediction", "p_0", "p_1", "p_5")


@query("factor_scores")
def _factor_scores(spark, folder):
    """Estimates for test searches, which training has not seen: the item decides."""
    lines = by_modulo(graded_lines(spark, folder), GROUP)
    train = factors.rating_triples(lines.filter("split <> 'test'"), GROUP, "l_partkey", GAIN)
    test = factors.rating_triples(lines.filter("split = 'test'"), GROUP, "l_partkey", GAIN)
    return factors.fit_factors(train).predict(test)


@query("factor_search")
def _factor_search(spark, folder):
    """Errors of 18 grid points in three folds each, all fits side by side."""
    ratings = _ratings(spark, folder)
    found = factor_search.search_factors(ratings)
    names = ["rank", "iterations", "penalty", "rmse", "mae"]
    return evaluate.table(ratings, [tuple(r[n] for n in names) for r in found], names)


def _epoch_sql():
    """Two reassignments by comparing the squared error of every candidate cluster, from clusters u % 3 and i % 4."""

    def means(k, cu, ci):
        return f"""pair{k} AS (SELECT {cu} AS cu, {ci} AS ci, avg(r) AS a FROM c{k} GROUP BY 1, 2),
      uc{k} AS (SELECT {cu} AS cu, avg(r) AS a FROM c{k} GROUP BY 1), ic{k} AS (SELECT {ci} AS ci, avg(r) AS a FROM c{k} GROUP BY 1)"""

    return f"""WITH {_RATINGS_SQL}, um AS (SELECT u, avg(r) AS m FROM t GROUP BY 1), im AS (SELECT i, avg(r) AS m FROM t GROUP BY 1),
      c0 AS (SELECT u, i, r, um.m AS mu, im.m AS mi, u % 3 AS cu, i % 4 AS ci FROM t JOIN um USING (u) JOIN im USING (i)),
      {means(0, "cu", "ci")},
      ue AS (SELECT u, x.cu, sum((r - (p.a + mu - x.a + mi - y.a)) ** 2) AS e FROM c0 CROSS JOIN uc0 x
        JOIN ic0 y ON y.ci = c0.ci JOIN pair0 p ON p.cu = x.cu AND p.ci = c0.ci GROUP BY 1, 2),
      un AS (SELECT u, arg_min(cu, e) AS cu FROM ue GROUP BY 1),
      c1 AS (SELECT c0.u, i, r, mu, mi, un.cu, ci FROM c0 JOIN un ON un.u = c0.u),
      {means(1, "cu", "ci")},
      ie AS (SELECT i, y.ci, sum((r - (p.a + mu - x.a + mi - y.a)) ** 2) AS e FROM c1 CROSS JOIN ic1 y
        JOIN uc1 x ON x.cu = c1.cu JOIN pair1 p ON p.cu = c1.cu AND p.ci = y.ci GROUP BY 1, 2),
      n AS (SELECT i, arg_min(ci, e) AS ci FROM ie GROUP BY 1)
      SELECT 'user' AS side, u AS id, cu AS "cluster" FROM un UNION ALL SELECT 'item', i, ci FROM n"""


@query("cocluster_epoch", _epoch_sql())
def _cocluster_epoch(spark, folder):
    """The clusters of users and items after one epoch from given clusters."""
    ratings = cocluster_search.sized(_ratings(spark, folder).withColumn("fold", F.lit(0)))
    fits = [cocluster_search.Fit(cocluster_search.NO_FOLD, 3, 4)]
    users = cocluster_search.start(ratings.table, "user", fits, 42).withColumn("cluster", F.array((F.col("user") % 3).cast("int")))
    items = cocluster_search.start(ratings.table, "item", fits, 42).withColumn("cluster", F.array((F.col("item") % 4).cast("int")))
    users, items, _, _ = cocluster_search.epoch(ratings, written(users), written(items), fits)
    rows = [
        state.select(F.lit(side).alias("side"), F.col(side).alias("id"), F.col("cluster")[0].alias("cluster"))
        for side, state in (("user", users), ("item", items))
    ]
    return rows[0].unionByName(rows[1])


@query("cocluster_search")
def _cocluster_search(spark, folder):
    """Errors of 27 grid points in three folds each, 27 fits side by side."""
    ratings = _ratings(spark, folder)
    found = cocluster_search.search_coclusters(ratings)
    names = ["user_clusters", "item_clusters", "epochs", "rmse", "mae"]
    return evaluate.table(ratings, [tuple(r[n] for n in names) for r in found], names)


@query("cocluster_scores")
def _cocluster_scores(spark, folder):
    ratings = _ratings(spark, folder)
    return factors.fit_coclusters(ratings, 3, 3).predict(ratings)


def _scorers(train):
    """A fit per kind of model, each returning rows with a prediction."""
    pair = linear.fit_pairwise(train, GROUP, GAIN, FEATURES)
    model = assembly.fit_assembly(train, FEATURES)
    line = trees.fit_pointwise(assembly.assemble(train, model), GROUP, GAIN, kind="linear")
    return {
        "pairwise": pair.transform,
        "pointwise": lambda df: line.transform(assembly.assemble(df, model)),
        "price": lambda df: df.withColumn("prediction", F.col("l_extendedprice")),
    }


@query("model_leaderboard")
def _model_leaderboard(spark, folder):
    rows = _rows(spark, folder)
    scorers = _scorers(rows.filter("split = 'train'"))
    return evaluate.leaderboard(rows.filter("split = 'test'"), scorers, GROUP, GAIN, tiebreak=[ROW])


@query("random_search")
def _random_search(spark, folder):
    rows = _rows(spark, folder)
    train, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")

    @functools.cache
    def sums(per_group):
        return linear.pair_normal(train, GROUP, GAIN, FEATURES, per_group)

    def fit(penalty, per_group):
        return linear.solve_pairwise(sums(per_group), penalty=penalty).transform

    space = {"penalty": ("log", 1e-2, 10.0), "per_group": [True, False]}
    found = evaluate.random_search(fit, val, space, GROUP, GAIN)
    return evaluate.table(rows, [(r["penalty"], r["per_group"], r["ndcg"]) for r in found], ["penalty", "per_group", "ndcg"])


@query("refit_scores")
def _refit_scores(spark, folder):
    rows = _rows(spark, folder)
    return evaluate.refit(rows, lambda part: linear.fit_pairwise(part, GROUP, GAIN, FEATURES).transform, GROUP, GAIN)


_REPEATS, _SHUFFLE_SEED = 3, 11


def _permutation_sql():
    """All shuffles by the same arithmetic, a step per round, and the metric of every variant."""
    slots = [(i, r) for i in range(len(FEATURES)) for r in range(_REPEATS)]
    rounds = [evaluate.shuffle_rounds(_SHUFFLE_SEED + s) for s in range(len(slots))]
    count, prime = len(rounds[0]), evaluate.SHUFFLE_PRIME
    names = ", ".join(f"a{k}, b{k}, c{k}, d{k}" for k in range(count))
    rows = ", ".join(
        f"({s}, {i}, " + ", ".join(str(v) for one in rounds[s] for v in one) + ")" for s, (i, _) in enumerate(slots)
    )
    steps, last = [], "e0"
    for k in range(count):
        steps.append(
            f"""m{k} AS (SELECT *, ((a{k} % n) - p + n) % n AS q FROM {last}),
      e{k + 1} AS (SELECT * EXCLUDE (q) REPLACE (CASE WHEN (((greatest(p, q) % {prime}) * b{k} + ((greatest(p, q) // {prime}) % {prime}) * c{k} + d{k})
        % {prime}) % 2 = 1 THEN q ELSE p END AS p) FROM m{k})"""
        )
        last = f"e{k + 1}"
    unit = "(({x}) - {m}) / CAST({d} AS DOUBLE) * CAST({w} AS DOUBLE)"

    def total(value):
        return " + ".join(unit.format(x=value(i, c), m=m, d=d, w=w) for i, (c, (m, d, w)) in enumerate(zip(FEATURES, _GIVEN)))

    plain = total(lambda i, c: f"t.{c}")
    changed = total(lambda i, c: f"CASE WHEN f = {i} THEN value ELSE t.{c} END")
    value = "CASE f " + " ".join(f"WHEN {i} THEN CAST({c} AS DOUBLE)" for i, c in enumerate(FEATURES)) + " END"
    return f"""WITH t AS MATERIALIZED (SELECT *, {GAIN_SQL} AS g, row_number() OVER (ORDER BY l_orderkey, {LINE_TAIL_SQL}) - 1 AS i,
        count(*) OVER () AS n, count(*) OVER (PARTITION BY l_orderkey) AS size FROM lineitem),
      k(slot, f, {names}) AS (VALUES {rows}),
      e0 AS (SELECT k.*, t.i AS p, t.i AS i, t.n AS n FROM t CROSS JOIN k),
      {", ".join(steps)},
      v AS (SELECT slot, f, p, {value} AS value FROM {last} JOIN t USING (i)),
      s AS (SELECT -1 AS slot, -1 AS f, t.l_orderkey, t.g, t.i, {plain} AS s FROM t WHERE size >= 5
        UNION ALL SELECT slot, f, t.l_orderkey, t.g, t.i, {changed} AS s FROM v JOIN t ON t.i = v.p WHERE size >= 5),
      r AS (SELECT slot, f, l_orderkey, g, row_number() OVER (PARTITION BY slot, l_orderkey ORDER BY s DESC, i) AS rk,
        row_number() OVER (PARTITION BY slot, l_orderkey ORDER BY g DESC) AS ik FROM s),
      a AS (SELECT slot, f, l_orderkey, sum(CASE WHEN rk <= 5 THEN g / log2(rk + 1) ELSE 0 END) AS d,
        sum(CASE WHEN ik <= 5 THEN g / log2(ik + 1) ELSE 0 END) AS b FROM r GROUP BY 1, 2, 3),
      m AS (SELECT slot, f, avg(CASE WHEN b = 0 THEN 0 ELSE d / nullif(b, 0) END) AS ndcg FROM a GROUP BY 1, 2),
      c AS (SELECT f, ndcg - (SELECT ndcg FROM m WHERE slot = -1) AS change FROM m WHERE slot >= 0)
      SELECT CASE f {" ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(FEATURES))} END AS feature,
        round(avg(change), 6) AS score, round(stddev_pop(change), 6) AS std FROM c GROUP BY f"""


@query("permutation_importance", _permutation_sql())
def _permutation_importance(spark, folder):
    """Every feature of a given linear score shuffled three times over the whole table."""
    rows = positions(graded_lines(spark, folder), [], [GROUP, *LINE_TAIL], ROW).select(ROW, GROUP, GAIN, *FEATURES)
    ranker = linear.LinearRanker(tuple(FEATURES), *zip(*_GIVEN))
    return evaluate.permutation_importance(
        rows, ranker.transform, FEATURES, ROW, GROUP, GAIN, repeats=_REPEATS, seed=_SHUFFLE_SEED, tiebreak=[ROW]
    )


@query("native_importance")
def _native_importance(spark, folder):
    rows = _vectors(_rows(spark, folder))
    model = trees.fit_pointwise(rows, GROUP, GAIN, split="split", kind="forest", numTrees=200, maxDepth=4)
    return evaluate.table(rows, trees.native_importance(model, FEATURES), ["feature", "score"])


@query("drop_importance")
def _drop_importance(spark, folder):
    rows = _rows(spark, folder)
    train, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")
    sums = linear.pair_normal(train, GROUP, GAIN, FEATURES)

    def fit(part, columns):
        """Every refit is on the training rows, whose sums serve all of them."""
        return linear.solve_pairwise(sums, columns).transform

    return evaluate.drop_importance(train, val, fit, FEATURES, GROUP, GAIN)


