"""Splits, metrics, ranked output, blends and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, profile, ranking, splits, stats, validate
from ..operators.narrow import narrow_profile
from ..sources.readers import read_table
from .registry import GAIN_SQL, LINE_TAIL, LINE_TAIL_SQL, events, graded_lines, lineitem, query

LINE_ID = ["l_orderkey", *LINE_TAIL]
LINE_ID_SQL = ", ".join(LINE_ID)
SPLIT_SQL = "CASE l_orderkey % 10 WHEN 5 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END"


@query("split_modulo", f"SELECT {LINE_ID_SQL}, {SPLIT_SQL} AS split FROM lineitem")
def _split_modulo(spark, folder):
    return splits.by_modulo(lineitem(spark, folder, *LINE_ID), "l_orderkey")


_STARTS_SQL = """s AS (SELECT l_orderkey, count(*) n, coalesce(sum(count(*)) OVER (ORDER BY l_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) st FROM lineitem GROUP BY 1),
  c1 AS (SELECT max(st) cut FROM s WHERE st < floor((SELECT count(*) FROM lineitem) * CAST(0.9 AS DOUBLE))),
  c2 AS (SELECT max(st) cut FROM s WHERE st < floor((SELECT cut FROM c1) * CAST(0.9 AS DOUBLE)))"""


@query(
    "split_ordered",
    f"""WITH {_STARTS_SQL} SELECT {LINE_ID_SQL}, CASE WHEN st < (SELECT cut FROM c1) THEN 'train' ELSE 'test' END AS split
      FROM lineitem JOIN s USING (l_orderkey)""",
)
def _split_ordered(spark, folder):
    return splits.ordered(lineitem(spark, folder, *LINE_ID), "l_orderkey", 0.9)


@query(
    "split_two_stage",
    f"""WITH {_STARTS_SQL} SELECT {LINE_ID_SQL}, CASE WHEN st < (SELECT cut FROM c2) THEN 'train'
      WHEN st < (SELECT cut FROM c1) THEN 'val' ELSE 'test' END AS split FROM lineitem JOIN s USING (l_orderkey)""",
)
def _split_two_stage(spark, folder):
    return splits.two_stage(lineitem(spark, folder, *LINE_ID), "l_orderkey", 0.9, 0.9)


@query(
    "split_rows",
    f"""SELECT {LINE_ID_SQL}, CASE WHEN row_number() OVER (ORDER BY l_shipdate, {LINE_ID_SQL})
      <= (SELECT count(*) - ceil(count(*) * CAST(0.1 AS DOUBLE)) FROM lineitem) THEN 'train' ELSE 'test' END AS split FROM lineitem""",
)
def _split_rows(spark, folder):
    return splits.ordered_rows(lineitem(spark, folder, *LINE_ID), ["l_shipdate", *LINE_ID], 0.1)


_ROWS_SPLIT_SQL = f"""r AS (SELECT l_orderkey, CASE WHEN row_number() OVER (ORDER BY l_shipdate, {LINE_ID_SQL})
  <= (SELECT count(*) - ceil(count(*) * CAST(0.1 AS DOUBLE)) FROM lineitem) THEN 'train' ELSE 'test' END AS split FROM lineitem)"""


@query(
    "group_overlap",
    f"""WITH {_ROWS_SPLIT_SQL} SELECT l_orderkey, min(split) AS first_split, max(split) AS last_split FROM r
      GROUP BY 1 HAVING min(split) <> max(split)""",
)
def _group_overlap(spark, folder):
    """Groups that a row split tears apart."""
    rows = splits.ordered_rows(lineitem(spark, folder, *LINE_ID), ["l_shipdate", *LINE_ID], 0.1)
    return splits.overlap(rows, "l_orderkey")


@query(
    "key_intersection",
    f"""WITH {_ROWS_SPLIT_SQL} SELECT l_orderkey FROM r WHERE split = 'train' INTERSECT SELECT l_orderkey FROM r WHERE split = 'test'""",
)
def _key_intersection(spark, folder):
    rows = splits.ordered_rows(lineitem(spark, folder, *LINE_ID), ["l_shipdate", *LINE_ID], 0.1)
    return rows.filter("split = 'train'").select("l_orderkey").intersect(
        rows.filter("split = 'test'").select("l_orderkey")
    )


@query(
    "split_union",
    f"""SELECT {LINE_ID_SQL}, {SPLIT_SQL} AS split FROM lineitem WHERE l_orderkey % 10 <> 5""",
)
def _split_union(spark, folder):
    rows = splits.by_modulo(lineitem(spark, folder, *LINE_ID), "l_orderkey")
    return rows.filter("split = 'train'").unionByName(rows.filter("split = 'val'"))


@query(
    "timeseries_folds",
    """WITH b AS (SELECT l_orderkey, ntile(4) OVER (ORDER BY t, l_orderkey) block
         FROM (SELECT l_orderkey, min(l_shipdate) t FROM lineitem GROUP BY 1))
       SELECT l_orderkey, block, f AS fold, CASE WHEN block <= f THEN 'train' ELSE 'test' END AS role
         FROM b, (VALUES (1), (2), (3)) v(f) WHERE block <= f + 1""",
)
def _timeseries_folds(spark, folder):
    blocks = splits.time_blocks(lineitem(spark, folder, "l_orderkey", "l_shipdate"), "l_orderkey", "l_shipdate", 3)
    return splits.fold_members(blocks, 3)


@query(
    "group_changes",
    """SELECT event_id, user_id IS DISTINCT FROM lag(user_id) OVER (ORDER BY ts, event_id)
         OR row_number() OVER (ORDER BY ts, event_id) = 1 AS is_change FROM events""",
)
def _group_changes(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "ts")
    return splits.group_changes(rows, "user_id", ["ts", "event_id"]).select("event_id", "is_change")


# Draws come from the integer keys of a row, whose text is the same in every engine.
DRAW_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _draw_sql(keys: list[str]) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(keys)}, '42')), 1, 13) AS BIGINT) / CAST({16**13} AS DOUBLE)"


@query(
    "split_hash",
    f"SELECT {LINE_ID_SQL}, CASE WHEN {_draw_sql(['l_orderkey'])} < CAST(0.7 AS DOUBLE) THEN 'train' ELSE 'test' END AS split FROM lineitem",
)
def _split_hash(spark, folder):
    return splits.by_hash(lineitem(spark, folder, *LINE_ID), "l_orderkey", 0.7)


@query("fold_hash", f"SELECT {LINE_ID_SQL}, CAST(floor({_draw_sql(DRAW_KEYS)} * 3) AS BIGINT) AS fold FROM lineitem")
def _fold_hash(spark, folder):
    return splits.fold_by_hash(lineitem(spark, folder, *LINE_ID), DRAW_KEYS, 3)


@query("sample_rows", f"SELECT {LINE_ID_SQL} FROM lineitem WHERE {_draw_sql(DRAW_KEYS)} < CAST(0.1 AS DOUBLE)")
def _sample_rows(spark, folder):
    return splits.sample_rows(lineitem(spark, folder, *LINE_ID), DRAW_KEYS, 0.1)


@query(
    "sample_n",
    f"""SELECT {', '.join(DRAW_KEYS)} FROM (SELECT *, {_draw_sql(DRAW_KEYS)} AS draw FROM lineitem)
      ORDER BY draw, {', '.join(DRAW_KEYS)} LIMIT 1000""",
)
def _sample_n(spark, folder):
    return splits.sample_n(lineitem(spark, folder, *DRAW_KEYS), DRAW_KEYS, 1000)


@query(
    "random_baseline",
    f"""WITH b AS (SELECT *, {GAIN_SQL} g, {_draw_sql(DRAW_KEYS)} AS draw FROM lineitem),
      r AS (SELECT l_orderkey, g, count(*) OVER (PARTITION BY l_orderkey) n,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY draw DESC, l_partkey, l_suppkey, l_linenumber, g) rk,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY g DESC) ik FROM b),
      a AS (SELECT l_orderkey, max(n) n, sum(CASE WHEN rk <= 5 THEN g / log2(rk + 1) ELSE 0 END) dcg,
        sum(CASE WHEN ik <= 5 THEN g / log2(ik + 1) ELSE 0 END) idcg FROM r GROUP BY 1)
      SELECT round(avg(CASE WHEN idcg = 0 THEN 0 ELSE dcg / nullif(idcg, 0) END), 6) AS mean_ndcg, count(*) AS groups
        FROM a WHERE n >= 5""",
)
def _random_baseline(spark, folder):
    """NDCG@5 of a random order, the floor for every ranker."""
    ranked = ranking.random_rank(graded_lines(spark, folder), "l_orderkey", "l_partkey", 42, ["l_suppkey", "l_linenumber"], "gain")
    return metrics.mean_ndcg(ranked, "l_orderkey", "rank", "gt", 5, ["gt"], "filter", ascending=True)


_RANKED_SQL = f"""b AS (SELECT *, {GAIN_SQL} g FROM lineitem),
  r AS (SELECT l_orderkey, g, count(*) OVER (PARTITION BY l_orderkey) n,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, {LINE_TAIL_SQL}) rk,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY g DESC) ik FROM b),
  a AS (SELECT l_orderkey, max(n) n, sum(CASE WHEN rk <= 5 THEN g / log2(rk + 1) ELSE 0 END) dcg,
    sum(CASE WHEN ik <= 5 THEN g / log2(ik + 1) ELSE 0 END) idcg FROM r GROUP BY 1),
  m AS (SELECT l_orderkey, n, dcg, CASE WHEN idcg = 0 THEN 0 ELSE dcg / nullif(idcg, 0) END ndcg FROM a)"""


def _graded(spark, folder):
    return graded_lines(spark, folder).select(*LINE_ID, "l_extendedprice", "gain")


@query(
    "dcg_at_k",
    f"WITH {_RANKED_SQL} SELECT l_orderkey, round(dcg, 6) AS dcg, least(n, 5) AS depth FROM m",
)
def _dcg_at_k(spark, folder):
    return metrics.dcg(_graded(spark, folder), "l_orderkey", "l_extendedprice", "gain", 5, LINE_TAIL)


@query("ndcg_per_group", f"WITH {_RANKED_SQL} SELECT l_orderkey, round(ndcg, 6) AS ndcg FROM m WHERE n >= 5")
def ndcg_per_group(spark, folder):
    return metrics.ndcg(_graded(spark, folder), "l_orderkey", "l_extendedprice", "gain", 5, LINE_TAIL, "filter")


@query(
    "ndcg_unknown_gain",
    f"""WITH b AS (SELECT *, CASE WHEN l_linestatus = 'O' THEN NULL ELSE {GAIN_SQL} END g FROM lineitem),
      r AS (SELECT l_orderkey, g, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, {LINE_TAIL_SQL}) rk,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY g DESC NULLS LAST) ik FROM b),
      a AS (SELECT l_orderkey, coalesce(sum(CASE WHEN rk <= 5 THEN g / log2(rk + 1) END), 0) dcg,
        coalesce(sum(CASE WHEN ik <= 5 THEN g / log2(ik + 1) END), 0) idcg FROM r GROUP BY 1)
      SELECT l_orderkey, round(CASE WHEN idcg = 0 THEN 0 ELSE dcg / nullif(idcg, 0) END, 6) AS ndcg FROM a""",
)
def _ndcg_unknown_gain(spark, folder):
    """An unknown gain is no gain, on the plan for hot groups as on the plain one."""
    rows = graded_lines(spark, folder).withColumn("gain", F.when(F.col("l_linestatus") != "O", F.col("gain")))
    return metrics.ndcg(rows, "l_orderkey", "l_extendedprice", "gain", 5, LINE_TAIL, "keep", hot_rows=5)


@query("ndcg_keep_short", f"WITH {_RANKED_SQL} SELECT l_orderkey, round(ndcg, 6) AS ndcg FROM m")
def _ndcg_keep_short(spark, folder):
    return metrics.ndcg(_graded(spark, folder), "l_orderkey", "l_extendedprice", "gain", 5, LINE_TAIL, "keep")


@query(
    "ndcg_mean",
    f"WITH {_RANKED_SQL} SELECT round(avg(ndcg), 6) AS mean_ndcg, count(*) AS groups FROM m WHERE n >= 5",
)
def ndcg_mean(spark, folder):
    return metrics.mean_ndcg(_graded(spark, folder), "l_orderkey", "l_extendedprice", "gain", 5, LINE_TAIL, "filter")


@query(
    "ndcg_by_split",
    f"""WITH {_RANKED_SQL} SELECT {SPLIT_SQL} AS split, round(avg(ndcg), 6) AS mean_ndcg, count(*) AS groups
      FROM m WHERE n >= 5 GROUP BY 1""",
)
def _ndcg_by_split(spark, folder):
    rows = splits.by_modulo(_graded(spark, folder), "l_orderkey")
    return metrics.mean_ndcg(rows, "l_orderkey", "l_extendedprice", "gain", 5, LINE_TAIL, "filter", by="split")


@query(
    "rating_errors",
    f"""WITH b AS (SELECT {GAIN_SQL} g, l_linenumber * 0.5 p FROM lineitem)
      SELECT round(sqrt(avg((g - p) * (g - p))), 6) AS rmse, round(avg(abs(g - p)), 6) AS mae FROM b""",
)
def _rating_errors(spark, folder):
    rows = graded_lines(spark, folder).withColumn("guess", F.col("l_linenumber") * 0.5)
    return metrics.rating_errors(rows, "gain", "guess")


_CLASSES_SQL = f"c AS (SELECT {GAIN_SQL} g, CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 5 END p FROM lineitem)"


def _classes(spark, folder):
    rest = F.col("l_linenumber") % 3
    return graded_lines(spark, folder).withColumn("guess", F.when(rest == 0, 0).when(rest == 1, 1).otherwise(5))


@query("confusion", f"WITH {_CLASSES_SQL} SELECT g AS truth, p AS predicted, count(*) AS n FROM c GROUP BY 1, 2")
def _confusion(spark, folder):
    return metrics.confusion(_classes(spark, folder), "gain", "guess")


@query(
    "class_metrics",
    f"""WITH {_CLASSES_SQL}, k AS (SELECT l, CAST((SELECT count(*) FROM c WHERE g = l) AS DOUBLE) t,
        CAST((SELECT count(*) FROM c WHERE p = l) AS DOUBLE) q, CAST((SELECT count(*) FROM c WHERE p = l AND g = l) AS DOUBLE) h
        FROM (VALUES (0), (1), (5)) v(l))
      SELECT round(sum(h) / sum(t), 6) AS accuracy, round(avg(h / t), 6) AS balanced_accuracy, round(avg(h / q), 6) AS macro_precision,
        round(avg(h / t), 6) AS macro_recall, round(avg(2 * h / (t + q)), 6) AS macro_f1 FROM k""",
)
def _class_metrics(spark, folder):
    return metrics.class_metrics(_classes(spark, folder), "gain", "guess")


def _auc_sql(label: int, score: str) -> str:
    return f"""SELECT {label} AS label, round((sum(CASE WHEN g = {label} THEN r ELSE 0 END) - p * (p + 1) / 2) / (p * (n - p)), 6) AS auc
      FROM (SELECT g, (rank() OVER (ORDER BY {score}) + rank() OVER (ORDER BY {score}) + count(*) OVER (PARTITION BY {score}) - 1) / CAST(2 AS DOUBLE) r,
        CAST(sum(CASE WHEN g = {label} THEN 1 ELSE 0 END) OVER () AS DOUBLE) p, CAST(count(*) OVER () AS DOUBLE) n FROM b) GROUP BY p, n"""


@query(
    "auc_per_class",
    f"WITH b AS (SELECT *, {GAIN_SQL} g FROM lineitem) {_auc_sql(0, 'l_discount')} UNION ALL {_auc_sql(1, 'l_extendedprice')} UNION ALL {_auc_sql(5, 'l_tax')}",
)
def _auc_per_class(spark, folder):
    scores = {0: "l_discount", 1: "l_extendedprice", 5: "l_tax"}
    return metrics.auc_per_class(graded_lines(spark, folder), "gain", scores)


@query(
    "ranked_output",
    f"""SELECT l_orderkey, l_partkey, round(l_extendedprice, 6) AS pred, {GAIN_SQL} AS gt, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity) AS rank FROM lineitem""",
)
def _ranked_output(spark, folder):
    tail = [c for c in LINE_TAIL if c != "l_partkey"]
    return ranking.ranked_output(_graded(spark, folder), "l_orderkey", "l_partkey", "l_extendedprice", "gain", tiebreak=tail)


@query(
    "ranked_by_position",
    f"""SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS pred, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) AS rank FROM lineitem""",
)
def _ranked_by_position(spark, folder):
    rows = lineitem(spark, folder, *LINE_ID)
    return ranking.ranked_output(
        rows, "l_orderkey", "l_partkey", "l_linenumber", ascending=True, tiebreak=["l_suppkey", "l_shipdate", "l_quantity"]
    )


@query(
    "top_n",
    """SELECT p_brand AS feature, score FROM (SELECT p_brand, round(sum(l_discount), 6) AS score
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY score DESC, p_brand LIMIT 10) WHERE score <> 0""",
)
def _top_n(spark, folder):
    parts = read_table(spark, folder, "part", ["p_partkey", "p_brand"])
    lines = lineitem(spark, folder, "l_partkey", "l_discount")
    scores = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("feature"))
    return ranking.top_n(scores.agg(F.round(F.sum("l_discount"), 6).alias("score")), "feature", "score", 10)


@query(
    "first_rows",
    f"SELECT {LINE_ID_SQL} FROM lineitem ORDER BY l_extendedprice DESC, {LINE_ID_SQL} LIMIT 10",
)
def _first_rows(spark, folder):
    from ..sources.readers import first_rows

    rows = lineitem(spark, folder, *LINE_ID, "l_extendedprice")
    return first_rows(rows, ["-l_extendedprice", *LINE_ID], 10).drop("l_extendedprice")


@query(
    "validate_output",
    """WITH s AS (SELECT l_orderkey g, count(*) e FROM lineitem GROUP BY 1),
       o AS (SELECT l_orderkey g, count(*) f FROM lineitem WHERE l_discount <> 0.05 GROUP BY 1)
       SELECT 'group_count' AS kind, CAST(g AS VARCHAR) AS key, e AS expected, coalesce(f, 0) AS found
         FROM s LEFT JOIN o USING (g) WHERE e <> coalesce(f, 0)
       UNION ALL SELECT 'row_count', NULL, (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_discount <> 0.05)""",
)
def _validate_output(spark, folder):
    """An output that lost rows, held against the full list."""
    rows = lineitem(spark, folder, "l_orderkey", "l_discount")
    return validate.validate(rows, rows.filter("l_discount <> 0.05D"), "l_orderkey")


@query(
    "rank_gaps",
    """WITH r AS (SELECT l_orderkey, l_linenumber k, count(*) c FROM lineitem GROUP BY 1, 2)
       SELECT l_orderkey, CAST(sum(c) AS BIGINT) AS n, CAST(min(k) AS BIGINT) AS first, CAST(max(k) AS BIGINT) AS last, max(c) AS copies
         FROM r GROUP BY 1 HAVING min(k) <> 1 OR max(k) <> sum(c) OR max(c) > 1""",
)
def _rank_gaps(spark, folder):
    """Orders whose line numbers are not exactly 1..n."""
    return validate.rank_gaps(lineitem(spark, folder, "l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber")


def _blend_sides(spark, folder):
    items = lineitem(spark, folder, "l_orderkey", "l_partkey", "l_extendedprice", "l_discount").groupBy("l_orderkey", "l_partkey")
    scores = items.agg(
        F.max(F.round(F.col("l_extendedprice") * 100)).alias("ord"), F.max(F.round(F.col("l_discount") * 100)).alias("pred")
    )
    a = scores.select(F.col("l_orderkey").alias("srch_id"), F.col("l_partkey").alias("prop_id"), "ord")
    b = scores.select(F.col("l_orderkey").alias("srch_id"), F.col("l_partkey").alias("prop_id"), "pred")
    return a, b.filter("prop_id % 7 <> 0")


_BLEND_SQL = """s AS (SELECT l_orderkey srch_id, l_partkey prop_id, max(round(l_extendedprice * 100)) a, max(round(l_discount * 100)) b
    FROM lineitem GROUP BY 1, 2),
  x AS (SELECT srch_id, prop_id, (a - avg(a) OVER w) / nullif(stddev_samp(a) OVER w, 0) a FROM s WINDOW w AS (PARTITION BY srch_id)),
  y AS (SELECT srch_id, prop_id, (b - avg(b) OVER w) / nullif(stddev_samp(b) OVER w, 0) b FROM s WHERE prop_id % 7 <> 0
    WINDOW w AS (PARTITION BY srch_id))"""


@query(
    "blend_scores",
    f"""WITH {_BLEND_SQL} SELECT srch_id, prop_id, round(a * 0.35 + b * 0.65, 6) AS final_score FROM x JOIN y USING (srch_id, prop_id)""",
)
def _blend_scores(spark, folder):
    """Two score files of which the second lacks some items."""
    a, b = _blend_sides(spark, folder)
    return ranking.blend(a, b, ["srch_id", "prop_id"])


@query(
    "blend_coverage",
    f"""WITH {_BLEND_SQL} SELECT 'a' AS side, count(*) AS n FROM x UNION ALL SELECT 'b', count(*) FROM y
      UNION ALL SELECT 'both', count(*) FROM x JOIN y USING (srch_id, prop_id)""",
)
def _blend_coverage(spark, folder):
    a, b = _blend_sides(spark, folder)
    return ranking.blend_coverage(a, b, ["srch_id", "prop_id"])


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
          min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
          round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem"""
        for c in MEASURES
    ),
)
def _summary(spark, folder):
    return profile.summary(lineitem(spark, folder, *MEASURES), MEASURES)


_HISTOGRAM_SQL = """WITH e AS (SELECT min(value) lo, max(value) hi FROM events),
  c AS (SELECT least(CAST(floor((value - lo) / ((hi - lo) / 100)) AS BIGINT) + 1, 100) AS bin, count(*) n FROM events, e GROUP BY 1)
  SELECT b AS bin, round(lo + (b - 1) * ((hi - lo) / 100), 6) AS low, round(lo + b * ((hi - lo) / 100), 6) AS high, coalesce(n, 0) AS n
  FROM e, (SELECT unnest(generate_series(1, 100)) AS b) LEFT JOIN c ON bin = b"""


@query("histogram", _HISTOGRAM_SQL)
def _histogram(spark, folder):
    return profile.histogram(events(spark, folder), "value", 100)


CORR_COLUMNS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "gain"]
_PAIRS = [(a, b) for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1 :]]
_CORR_SQL = "g AS (SELECT *, " + GAIN_SQL + " AS gain FROM lineitem), p AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM g" for a, b in _PAIRS
) + ")"


@query("corr_pairs", f"WITH {_CORR_SQL} SELECT a, b, round(corr, 6) AS corr FROM p")
def _corr_pairs(spark, folder):
    return profile.corr_long(graded_lines(spark, folder), CORR_COLUMNS)


@query(
    "corr_strength",
    f"""WITH {_CORR_SQL}, t AS (SELECT c AS "column", 2 * sum(abs(corr)) AS total
      FROM (SELECT a AS c, corr FROM p UNION ALL SELECT b, corr FROM p) GROUP BY 1)
      SELECT "column", round(total, 6) AS total, row_number() OVER (ORDER BY total, "column") - 1 AS place FROM t""",
)
def _corr_strength(spark, folder):
    return profile.corr_strength(profile.corr_long(graded_lines(spark, folder), CORR_COLUMNS))


@query(
    "corr_report",
    f"""WITH {_CORR_SQL}, t AS (SELECT c, row_number() OVER (ORDER BY 2 * sum(abs(corr)), c) - 1 AS place
      FROM (SELECT a AS c, corr FROM p UNION ALL SELECT b, corr FROM p) GROUP BY 1),
      k AS (SELECT c FROM t WHERE place < 5 AND place >= 1)
      SELECT a, b, round(corr, 6) AS corr FROM p WHERE a IN (SELECT c FROM k) AND b IN (SELECT c FROM k)""",
)
def _corr_report(spark, folder):
    return profile.corr_report(graded_lines(spark, folder), CORR_COLUMNS, drop=1, take=4)


_PROFILE_STATS = {
    "n": "CAST(count({c}) AS DOUBLE)",
    "mean": "avg({c})",
    "std": "stddev_samp({c})",
    "min": "min({c})",
    "max": "max({c})",
    "q25": "quantile_cont({c}, 0.25)",
    "q50": "quantile_cont({c}, 0.5)",
    "q75": "quantile_cont({c}, 0.75)",
}


def _profile_sql(c: str, bins: int) -> str:
    stats = [
        f"""SELECT '{c}' AS "column", '{name}' AS item, round(CAST({value.format(c=c)} AS DOUBLE), 6) AS value FROM lineitem"""
        for name, value in _PROFILE_STATS.items()
    ]
    counts = f"""SELECT '{c}' AS "column", 'bin_' || b AS item, CAST(coalesce(n, 0) AS DOUBLE) AS value
      FROM (SELECT unnest(generate_series(1, {bins})) AS b) LEFT JOIN (SELECT least(CAST(floor(({c} - lo) / ((hi - lo) / {bins})) AS BIGINT) + 1,
        {bins}) AS bin, count(*) AS n FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY 1) ON bin = b"""
    return " UNION ALL ".join([*stats, counts])


@query("column_profile", " UNION ALL ".join(_profile_sql(c, 50) for c in MEASURES))
def _column_profile(spark, folder):
    return profile.column_profile(lineitem(spark, folder, *MEASURES), MEASURES, 50)


def _narrow_sql(columns: dict[str, str]) -> str:
    parts = []
    for c, source in columns.items():
        fraction = f"count(*) FILTER (WHERE {c} <> floor({c}))" if source == "double" else "0"
        parts.append(
            f"""SELECT '{c}' AS "column", '{source}' AS source_type, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
              count(*) FILTER (WHERE {c} IS NULL) AS nulls, {fraction} AS fractions FROM lineitem"""
        )
    return f"""SELECT *, CASE WHEN source_type = 'double' AND fractions > 0 THEN 'float'
      WHEN min >= -128 AND max <= 127 THEN 'tinyint' WHEN min >= -32768 AND max <= 32767 THEN 'smallint'
      WHEN min >= -2147483648 AND max <= 2147483647 THEN 'int' ELSE 'bigint' END AS target_type FROM ({' UNION ALL '.join(parts)})"""


@query(
    "narrow_profile",
    _narrow_sql(
        {
            "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
            "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        }
    ),
)
def _narrow_profile(spark, folder):
    return narrow_profile(lineitem(spark, folder))


@query(
    "narrow_simple",
    """SELECT "column", target_type FROM (SELECT 'event_id' AS "column", CASE WHEN max(event_id) <= 127 THEN 'tinyint'
        WHEN max(event_id) <= 32767 THEN 'smallint' WHEN max(event_id) <= 2147483647 THEN 'int' ELSE 'bigint' END AS target_type FROM events
      UNION ALL SELECT 'user_id', 'float' UNION ALL SELECT 'value', 'float')""",
)
def _narrow_simple(spark, folder):
    rows = events(spark, folder).select("event_id", F.nullif(F.col("user_id"), F.lit(8).cast("bigint")).alias("user_id"), "value")
    return narrow_profile(rows, "simple").select("column", "target_type")


@query(
    "family_parse",
    """WITH f AS (SELECT 'mean_' || p_type || '_per_' || p_brand || '_per_' || p_size AS feature, p_retailprice AS score FROM part)
       SELECT replace(substr(feature, instr(feature, 'per_') + 4), 'per_', '') AS family, round(sum(score), 6) AS score, count(*) AS features
         FROM f GROUP BY 1""",
)
def _family_parse(spark, folder):
    parts = read_table(spark, folder, "part", ["p_type", "p_brand", "p_size", "p_retailprice"])
    name = F.concat(F.lit("mean_"), F.col("p_type"), F.lit("_per_"), F.col("p_brand"), F.lit("_per_"), F.col("p_size").cast("string"))
    return profile.family_importance(parts.select(name.alias("feature"), F.col("p_retailprice").alias("score")))


@query(
    "record_json",
    f"""WITH {_RANKED_SQL}, s AS (SELECT {SPLIT_SQL} AS split, count(*) AS groups FROM m GROUP BY 1)
      SELECT '{{"split":"' || split || '","groups":' || groups || '}}' AS json FROM s""",
)
def _record_json(spark, folder):
    from ..sources.writers import as_json

    rows = splits.by_modulo(lineitem(spark, folder, "l_orderkey").distinct(), "l_orderkey")
    return as_json(stats.value_counts(rows, "split", "groups"), ["split", "groups"])
