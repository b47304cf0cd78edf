"""Targets, filters, group statistics, encodings and numeric features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import graded_target, row_min
from ..functions.numeric import transforms
from ..operators import clean, encode, pricing, ranking, stats
from ..operators.splits import by_modulo
from ..sources.readers import read_table
from .registry import GAIN_SQL, LINE_TAIL, LINE_TAIL_SQL, events, graded_lines, lineitem, query

LINE_ID = ["l_orderkey", *LINE_TAIL]
LINE_ID_SQL = ", ".join(LINE_ID)


@query(
    "graded_target",
    """SELECT event_id, user_id, CAST(CASE WHEN event_type = 'purchase' THEN 5
         WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT) AS target FROM events""",
)
def _graded_target(spark, folder):
    flags = events(spark, folder).select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "click", 1).alias("clicked"),
        F.when(F.col("event_type") == "purchase", 1).alias("booked"),
    )
    return flags.select("event_id", "user_id", graded_target("clicked", "booked").alias("target"))


@query(
    "class_share",
    f"""SELECT {GAIN_SQL} AS gain, count(*) AS n,
         round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM lineitem GROUP BY 1""",
)
def _class_share(spark, folder):
    return stats.value_counts(graded_lines(spark, folder), "gain")


@query(
    "outlier_by_key",
    """SELECT event_id, user_id, value FROM (SELECT *, avg(value) OVER (PARTITION BY user_id) m,
         stddev_samp(value) OVER (PARTITION BY user_id) s FROM events) WHERE abs((value - m) / nullif(s, 0)) < 2""",
)
def _outlier_by_key(spark, folder):
    return clean.outlier_by_key(events(spark, folder), "user_id", "value").select("event_id", "user_id", "value")


@query(
    "outlier_global",
    """SELECT event_id, value FROM events
         WHERE (value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events) < 2""",
)
def _outlier_global(spark, folder):
    return clean.outlier_global(events(spark, folder), "value").select("event_id", "value")


@query(
    "min_group_size",
    f"""SELECT {LINE_ID_SQL} FROM lineitem WHERE l_orderkey IN
         (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(l_partkey) >= 5)""",
)
def _min_group_size(spark, folder):
    return clean.min_group_size(lineitem(spark, folder, *LINE_ID), "l_orderkey", 5, "l_partkey")


@query(
    "multi_row_groups",
    f"""SELECT {LINE_ID_SQL} FROM lineitem WHERE l_orderkey IN
         (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)""",
)
def _multi_row_groups(spark, folder):
    return clean.multi_row_groups(lineitem(spark, folder, *LINE_ID), "l_orderkey")


@query(
    "modulo_filter",
    f"SELECT {LINE_ID_SQL} FROM lineitem WHERE l_quantity % 2.5 <> 0",
)
def _modulo_filter(spark, folder):
    return clean.off_grid_rows(lineitem(spark, folder, *LINE_ID), "l_quantity", 2.5)


@query(
    "name_filter",
    """SELECT p_partkey, p_type FROM part WHERE starts_with(p_name, 's') AND NOT starts_with(p_type, 'SM')""",
)
def _name_filter(spark, folder):
    parts = clean.named(read_table(spark, folder, "part", ["p_partkey", "p_name", "p_type"]), "p_name", prefix="s")
    return clean.named(parts, "p_type", not_prefix="SM").select("p_partkey", "p_type")


@query(
    "category_fill",
    """SELECT event_id, coalesce(nullif(event_type, 'error'), 'NaN_category') AS kind,
         coalesce(CAST(nullif(user_id, 8) AS VARCHAR), 'NaN_category') AS visitor FROM events""",
)
def _category_fill(spark, folder):
    holed = events(spark, folder).select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("kind"),
        F.nullif(F.col("user_id"), F.lit(8).cast("bigint")).alias("visitor"),
    )
    return clean.fill_category(holed, ["kind", "visitor"])


@query("group_sizes", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1")
def _group_sizes(spark, folder):
    return clean.sizes(lineitem(spark, folder, "l_orderkey"), "l_orderkey")


@query(
    "item_occurrences",
    "SELECT l_partkey, count(l_orderkey) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1",
)
def _item_occurrences(spark, folder):
    rows = lineitem(spark, folder, "l_partkey", "l_orderkey", "l_linestatus").filter("l_linestatus = 'F'")
    return rows.groupBy("l_partkey").agg(F.count("l_orderkey").alias("n"))


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _distinct_values(spark, folder):
    return lineitem(spark, folder, "l_returnflag", "l_linestatus").distinct()


@query(
    "grouped_share",
    """SELECT l_partkey, round(avg(CASE WHEN l_discount > 0.05 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6)
         AS share FROM lineitem GROUP BY 1""",
)
def _grouped_share(spark, folder):
    return stats.grouped_share(lineitem(spark, folder), "l_partkey", F.col("l_discount") > 0.05)


@query(
    "rate_by_category",
    """SELECT l_linenumber, round(avg(CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6)
         AS rate FROM lineitem GROUP BY 1""",
)
def _rate_by_category(spark, folder):
    rows = lineitem(spark, folder).select("l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("booked"))
    return stats.rate_by_category(rows, "l_linenumber", "booked")


@query(
    "column_means",
    f"""SELECT round(avg(l_extendedprice), 6) AS price, round(avg(l_discount), 6) AS discount,
         round(avg({GAIN_SQL}), 6) AS gain FROM lineitem""",
)
def _column_means(spark, folder):
    return graded_lines(spark, folder).agg(
        F.avg("l_extendedprice").alias("price"), F.avg("l_discount").alias("discount"), F.avg("gain").alias("gain")
    )


@query(
    "segment_comparison",
    """WITH k AS (SELECT l_partkey, count(*) n, avg(l_discount) d, avg(l_extendedprice) p FROM lineitem GROUP BY 1)
       SELECT n >= 30 AS frequent, round(avg(d), 6) AS l_discount, round(avg(p), 6) AS l_extendedprice
         FROM k GROUP BY 1""",
)
def _segment_comparison(spark, folder):
    return stats.segment_means(lineitem(spark, folder), "l_partkey", ["l_discount", "l_extendedprice"], 30)


def _index_sql(key: str) -> str:
    return f"""SELECT {LINE_ID_SQL}, row_number() OVER (PARTITION BY {key}
         ORDER BY l_extendedprice, l_orderkey, {LINE_TAIL_SQL}) - 1 AS price_index FROM lineitem"""


def _price_index(key):
    def build(spark, folder):
        rows = lineitem(spark, folder, *LINE_ID, "l_extendedprice")
        tail = ["l_orderkey", *LINE_TAIL]
        return ranking.index_in_group(rows, key, "l_extendedprice", tail, "price_index").drop("l_extendedprice")

    return build


query("price_index_order", _index_sql("l_orderkey"))(_price_index("l_orderkey"))
query("price_index_item", _index_sql("l_partkey"))(_price_index("l_partkey"))
query("price_index_supplier", _index_sql("l_suppkey"))(_price_index("l_suppkey"))


def _z_sql(value: str, key: str) -> str:
    return f"({value} - avg({value}) OVER (PARTITION BY {key})) / nullif(stddev_samp({value}) OVER (PARTITION BY {key}), 0)"


@query(
    "group_zscore",
    f"SELECT {LINE_ID_SQL}, round({_z_sql('l_extendedprice', 'l_orderkey')}, 6) AS z FROM lineitem",
)
def _group_zscore(spark, folder):
    rows = lineitem(spark, folder, *LINE_ID, "l_extendedprice").withColumnRenamed("l_extendedprice", "z")
    return stats.zscore_by(rows, "l_orderkey", ["z"])


@query(
    "norm_log10",
    f"""SELECT {LINE_ID_SQL}, round({_z_sql('x', 'l_partkey')}, 6) AS l_extendedprice_log10_norm_by_l_partkey
         FROM (SELECT *, log10(l_extendedprice + 0.01) x FROM lineitem)""",
)
def _norm_log10(spark, folder):
    rows = lineitem(spark, folder, *LINE_ID, "l_extendedprice")
    return stats.normalize_by(rows, "l_partkey", "l_extendedprice", log10=True).drop("l_extendedprice")


@query(
    "zscore_all",
    f"""SELECT {LINE_ID_SQL}, round({_z_sql('l_extendedprice', 'l_suppkey')}, 6) AS l_extendedprice_z,
         round({_z_sql('l_discount', 'l_suppkey')}, 6) AS l_discount_z, round({_z_sql('l_tax', 'l_suppkey')}, 6) AS l_tax_z
         FROM lineitem""",
)
def _zscore_all(spark, folder):
    values = ["l_extendedprice", "l_discount", "l_tax"]
    rows = lineitem(spark, folder, *LINE_ID, *values)
    return stats.zscore_by(rows, "l_suppkey", values, "_z").drop(*values)


# Whole cents add up exactly in any order, so both engines get the same means.
CENTS_SQL = "round(l_extendedprice * 100)"


def _cents(spark, folder):
    cents = F.round(F.col("l_extendedprice") * 100).alias("cents")
    return lineitem(spark, folder).select(*LINE_ID, cents)


def _composite_sql(keys: list[str], aggs: list[str], source: str, value: str, compare: tuple[str, ...] = (), digits: int = 6) -> str:
    sql_name = {"mean": "avg", "median": "median", "min": "min", "max": "max", "sum": "sum"}
    names = {a: stats.stat_name(a, value, [k for k in keys if k != "split"]) for a in aggs}
    on = ", ".join(keys)
    out = [f"round({n}, {digits}) AS {n}" for n in names.values()]
    for a, n in names.items():
        if a != "sum":
            for c in (value, *compare):
                out.append(f"round({c} - {n}, {digits}) AS {c}_diff_to_{n}")
                out.append(f"round(({c} - {n}) / nullif({value} + 0.01, 0), {digits}) AS {c}_rel_diff_to_{n}")
    aggregates = ", ".join(f"{sql_name[a]}({value}) AS {n}" for a, n in names.items())
    return f"""WITH t AS ({source}), a AS (SELECT {on}, {aggregates} FROM t GROUP BY {on})
      SELECT {LINE_ID_SQL}, {', '.join(out)} FROM t JOIN a USING ({on})"""


def _composite_columns(df, before):
    return df.select(*LINE_ID, *[c for c in df.columns if c not in before])


@query(
    "composite_stats",
    _composite_sql(["l_suppkey", "l_linenumber"], ["mean", "median", "min", "max", "sum"], f"SELECT *, {CENTS_SQL} AS cents FROM lineitem", "cents"),
)
def _composite_stats(spark, folder):
    rows = _cents(spark, folder)
    out = stats.composite(rows, ["l_suppkey", "l_linenumber"], "cents", [*stats.DEFAULT_AGGS, "sum"])
    return _composite_columns(out, rows.columns)


@query(
    "composite_by_split",
    _composite_sql(
        ["l_partkey", "split"],
        ["mean", "median", "min", "max"],
        f"""SELECT *, {CENTS_SQL} AS cents, CASE l_orderkey % 10 WHEN 5 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split
          FROM lineitem""",
        "cents",
    ),
)
def _composite_by_split(spark, folder):
    rows = by_modulo(_cents(spark, folder), "l_orderkey")
    out = stats.composite(rows, ["l_partkey"], "cents", split="split")
    return _composite_columns(out, rows.columns)


@query(
    "composite_comparison",
    _composite_sql(
        ["l_suppkey", "l_linenumber"],
        ["mean", "sum"],
        """SELECT l.*, round(l_extendedprice * 100) AS cents, round(o_totalprice * 100) AS total_cents
          FROM lineitem l JOIN orders ON l_orderkey = o_orderkey""",
        "cents",
        ("total_cents",),
        4,
    ),
    digits=4,
)
def _composite_comparison(spark, folder):
    totals = read_table(spark, folder, "orders", ["o_orderkey", "o_totalprice"])
    lines = lineitem(spark, folder, *LINE_ID, "l_extendedprice")
    rows = lines.join(totals, lines.l_orderkey == totals.o_orderkey).select(
        *LINE_ID,
        F.round(F.col("l_extendedprice") * 100).alias("cents"),
        F.round(F.col("o_totalprice") * 100).alias("total_cents"),
    )
    out = stats.composite(rows, ["l_suppkey", "l_linenumber"], "cents", ["mean", "sum"], compare=["total_cents"])
    return _composite_columns(out, rows.columns)


BLOCK_KEYS = ["l_orderkey", "l_suppkey", "l_linenumber"]
BLOCK_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


def _block_sql(diff: bool) -> str:
    names = stats.block_names(BLOCK_KEYS, BLOCK_COLUMNS)
    sql_name = {"mean": "avg", "min": "min", "max": "max"}
    parts, joins = [], []
    for k in BLOCK_KEYS:
        aggregates = ", ".join(f"{sql_name[a]}({c}) AS {n}" for c, a, n in names if n.endswith("_over_" + k))
        parts.append(f"a_{k} AS (SELECT {k}, {aggregates} FROM lineitem GROUP BY {k})")
        joins.append(f"JOIN a_{k} USING ({k})")
    if diff:
        out = [f"round(({c} - {n}) / nullif({n}, 0), 7) AS diff_to_{n}" for c, _, n in names]
    else:
        out = [f"round({n}, 6) AS {n}" for _, _, n in names]
    return f"WITH {', '.join(parts)} SELECT {LINE_ID_SQL}, {', '.join(out)} FROM lineitem {' '.join(joins)}"


@query("block_stats", _block_sql(False))
def _block_stats(spark, folder):
    rows = lineitem(spark, folder, *dict.fromkeys([*LINE_ID, *BLOCK_COLUMNS]))
    return stats.block_stats(rows, BLOCK_KEYS, BLOCK_COLUMNS).drop("l_extendedprice", "l_discount")


@query("block_rel_diff", _block_sql(True), digits=7)
def _block_rel_diff(spark, folder):
    rows = lineitem(spark, folder, *dict.fromkeys([*LINE_ID, *BLOCK_COLUMNS]))
    out = stats.block_rel_diff(rows, BLOCK_KEYS, BLOCK_COLUMNS)
    return out.select(*LINE_ID, *[c for c in out.columns if c.startswith("diff_to_")])


@query(
    "numeric_transforms",
    """SELECT event_id, round(power(value, 0.33), 6) AS "value_pow_0.33", round(power(value, 0.5), 6) AS "value_pow_0.5",
         round(power(value, 2), 6) AS value_pow_2, round(power(value, 3), 6) AS value_pow_3,
         round(ln(value + 1e-6) / ln(CAST(2 AS DOUBLE)), 6) AS value_log_2,
         round(ln(value + 1e-6) / ln(CAST(10 AS DOUBLE)), 6) AS value_log_10,
         round(ln(value + 1e-6), 6) AS "value_log_2.72",
         round(1 / (value + 1e-6), 6) AS value_reciprocal FROM events""",
)
def _numeric_transforms(spark, folder):
    rows = events(spark, folder).select("event_id", "value")
    return transforms(rows, ["value"], exp=False, guards="always").drop("value")


@query(
    "guarded_transforms",
    """SELECT event_id, round(power(value, 2), 6) AS value_pow_2, round(power(share, 2), 6) AS share_pow_2,
         round(power(share, 3), 6) AS share_pow_3, round(exp(share), 6) AS share_exp
         FROM (SELECT event_id, value, value / (SELECT max(value) FROM events) AS share FROM events)""",
)
def _guarded_transforms(spark, folder):
    """Powers above 2 and the exponential only where the data allow them."""
    top = events(spark, folder).agg(F.max("value").alias("m")).scalar()
    rows = events(spark, folder).select("event_id", "value", (F.col("value") / top).alias("share"))
    return transforms(rows, ["value", "share"], powers=(2, 3), bases=(), reciprocal=False).drop("value", "share")


@query(
    "row_min",
    f"""SELECT {LINE_ID_SQL}, least(nullif(l_linenumber, 3) * 0.01, l_discount, nullif(l_tax, 0)) AS lowest FROM lineitem""",
)
def _row_min(spark, folder):
    rows = lineitem(spark, folder, *LINE_ID, "l_discount", "l_tax").withColumns(
        {
            "a": F.nullif(F.col("l_linenumber"), F.lit(3)) * F.lit(0.01),
            "b": F.nullif(F.col("l_tax"), F.lit(0.0)),
        }
    )
    return rows.select(*LINE_ID, row_min(["a", "l_discount", "b"]).alias("lowest"))


@query(
    "price_basis",
    f"""WITH b AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN l_extendedprice * (1 + (l_linenumber - 1) * ((l_suppkey + l_partkey) % 2)) END g
         FROM lineitem),
       s AS (SELECT l_partkey, avg(CASE WHEN abs(g - l_linenumber * l_extendedprice) < abs(g - l_extendedprice)
         THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) > 0.2 AS daily FROM b GROUP BY 1)
       SELECT {LINE_ID_SQL}, round(CASE WHEN daily THEN l_extendedprice ELSE l_extendedprice / l_linenumber END, 6) AS price_per_day,
         round(CASE WHEN daily THEN l_extendedprice * l_linenumber ELSE l_extendedprice END, 6) AS price_per_trip
         FROM b JOIN s USING (l_partkey)""",
)
def _price_basis(spark, folder):
    by_day = (F.col("l_suppkey") + F.col("l_partkey")) % 2
    total = F.col("l_extendedprice") * (1 + (F.col("l_linenumber") - 1) * by_day)
    rows = lineitem(spark, folder, *LINE_ID, "l_extendedprice", "l_returnflag").withColumn(
        "gross", F.when(F.col("l_returnflag") == "R", total)
    )
    out = pricing.price_basis(rows, "l_partkey", "l_extendedprice", "gross", "l_linenumber", share=0.2)
    return out.select(*LINE_ID, "price_per_day", "price_per_trip")


@query(
    "ordinal_by_mean",
    f"""WITH o AS (SELECT l_partkey, row_number() OVER (ORDER BY m, l_partkey) - 1 AS ordinal_l_partkey
         FROM (SELECT l_partkey, avg(CAST(round(l_extendedprice * 100) AS BIGINT)) m FROM lineitem GROUP BY 1)),
       s AS (SELECT l_suppkey, row_number() OVER (ORDER BY m, l_suppkey) - 1 AS ordinal_l_suppkey
         FROM (SELECT l_suppkey, avg(CAST(round(l_extendedprice * 100) AS BIGINT)) m FROM lineitem GROUP BY 1))
       SELECT {LINE_ID_SQL}, ordinal_l_partkey, ordinal_l_suppkey FROM lineitem JOIN o USING (l_partkey) JOIN s USING (l_suppkey)""",
)
def _ordinal_by_mean(spark, folder):
    rows = lineitem(spark, folder, *LINE_ID, "l_extendedprice").withColumn(
        "cents", F.round(F.col("l_extendedprice") * 100).cast("bigint")
    )
    return encode.ordinal_by_mean(rows, ["l_partkey", "l_suppkey"], "cents").drop("l_extendedprice", "cents")


@query(
    "last_ordinals",
    """SELECT d AS ordinal_l_suppkey, round(m, 6) AS mean FROM (SELECT row_number() OVER (ORDER BY m, l_suppkey) - 1 d, m
         FROM (SELECT l_suppkey, avg(l_extendedprice) m FROM lineitem GROUP BY 1)) ORDER BY d DESC LIMIT 50""",
)
def _last_ordinals(spark, folder):
    rows = encode.ordinal_by_mean(lineitem(spark, folder, "l_suppkey", "l_extendedprice"), "l_suppkey", "l_extendedprice")
    return encode.last_ordinals(rows, "ordinal_l_suppkey", "l_extendedprice", 50)


@query(
    "time_ordinal",
    """SELECT event_id, dense_rank() OVER (ORDER BY date_trunc('minute', ts)) AS minute_ordinal FROM events""",
)
def _time_ordinal(spark, folder):
    rows = events(spark, folder).select("event_id", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"))
    return encode.dense_ordinal(rows, "minute").drop("minute")


@query(
    "target_encoding",
    f"""WITH b AS (SELECT *, {GAIN_SQL} AS g FROM lineitem),
       k AS (SELECT l_partkey, avg(g) mg, avg(round(l_discount * 100)) md FROM b WHERE l_linestatus = 'F' GROUP BY 1 HAVING count(*) >= 10)
       SELECT {LINE_ID_SQL}, round(coalesce(mg, (SELECT avg(g) FROM b)), 6) AS mean_gain,
         round(coalesce(md, (SELECT avg(round(l_discount * 100)) FROM b)), 6) AS mean_percent FROM b LEFT JOIN k USING (l_partkey)""",
)
def _target_encoding(spark, folder):
    percent = F.round(F.col("l_discount") * 100).alias("percent")
    rows = graded_lines(spark, folder).select(*LINE_ID, "gain", percent, "l_linestatus")
    out = encode.support_encode(
        rows, "l_partkey", {"gain": "mean_gain", "percent": "mean_percent"}, F.col("l_linestatus") == "F", 10
    )
    return out.select(*LINE_ID, "mean_gain", "mean_percent")


@query(
    "train_only_stats",
    f"""WITH k AS (SELECT l_partkey, avg(CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) b,
         avg(CASE WHEN l_returnflag IN ('R', 'A') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) c,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE)
           / nullif(sum(CASE WHEN l_returnflag IN ('R', 'A') THEN 1 ELSE 0 END), 0) r,
         avg(l_linenumber) p, avg(CASE WHEN l_linestatus = 'F' THEN l_linenumber END) q
         FROM lineitem WHERE l_orderkey % 10 NOT IN (1, 5) GROUP BY 1)
       SELECT {LINE_ID_SQL}, round(b, 6) AS booking_prob_train, round(c, 6) AS click_prob_train, round(r, 6) AS book_per_click,
         round(p, 6) AS mean_position_train, round(q, 6) AS mean_position_train_when_not_random
         FROM lineitem LEFT JOIN k USING (l_partkey)""",
)
def _train_only_stats(spark, folder):
    rows = by_modulo(lineitem(spark, folder), "l_orderkey").select(
        *LINE_ID,
        "split",
        F.col("l_returnflag").isin("R", "A").cast("int").alias("click"),
        (F.col("l_returnflag") == "R").cast("int").alias("book"),
        F.col("l_linenumber").alias("position"),
        (F.col("l_linestatus") != "F").cast("int").alias("random"),
    )
    out = encode.train_stats(rows, "l_partkey", "click", "book", "position", "random")
    return out.drop("split", "click", "book", "position", "random")


@query(
    "members",
    """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS has_pending FROM customer""",
)
def _members(spark, folder):
    customers = read_table(spark, folder, "customer", ["c_custkey"])
    keys = read_table(spark, folder, "orders", ["o_custkey", "o_orderstatus"]).filter("o_orderstatus = 'P'")
    keys = keys.select(F.col("o_custkey").alias("c_custkey"))
    inside = clean.members(customers, keys, ["c_custkey"]).withColumn("has_pending", F.lit(True))
    outside = clean.non_members(customers, keys, ["c_custkey"]).withColumn("has_pending", F.lit(False))
    return inside.unionByName(outside)


@query(
    "missing_keys",
    """SELECT p_partkey AS item, CAST(NULL AS DOUBLE) AS mean_discount FROM part WHERE p_partkey NOT IN
         (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09)
       UNION ALL SELECT l_partkey, round(avg(l_discount), 6) FROM lineitem WHERE l_discount > 0.09 GROUP BY 1""",
)
def _missing_keys(spark, folder):
    """Keys missing from a lookup, added to it once each."""
    lookup = (
        lineitem(spark, folder, "l_partkey", "l_discount").filter("l_discount > 0.09")
        .groupBy(F.col("l_partkey").alias("item")).agg(F.avg("l_discount").alias("mean_discount"))
    )
    keys = read_table(spark, folder, "part", ["p_partkey"]).withColumnRenamed("p_partkey", "item")
    return lookup.unionByName(clean.non_members(keys, lookup, ["item"]), allowMissingColumns=True)


@query(
    "count_align",
    """WITH a AS (SELECT p_type, count(*) n FROM part WHERE p_size < 5 GROUP BY 1),
       b AS (SELECT p_type, count(*) n FROM part WHERE p_size >= 5 AND p_type <> 'ECONOMY' GROUP BY 1)
       SELECT coalesce(a.p_type, b.p_type) AS p_type, a.n + b.n AS n FROM a FULL OUTER JOIN b ON a.p_type = b.p_type""",
)
def _count_align(spark, folder):
    parts = read_table(spark, folder, "part", ["p_type", "p_size"])
    return stats.count_align(parts.filter("p_size < 5"), parts.filter("p_size >= 5 AND p_type <> 'ECONOMY'"), "p_type")
