"""Files written from lineitem and read back: scans with faults, sinks, and the way of a submission."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ranking, validate
from ..operators.ordering import positions
from ..session import shared_folder
from ..sources import readers, writers
from .registry import LINE_TAIL, LINE_TAIL_SQL, graded_lines, lineitem, query

LINES = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)


def _place(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/shortlist-{name}-{uuid.uuid4().hex}"


@query(
    "checked_scan",
    """WITH f AS (SELECT l_orderkey % 97 = 0 AS bad, l_orderkey % 89 = 0 AND l_orderkey % 97 <> 0 AS late FROM lineitem)
      SELECT 'rows' AS kind, count(*) AS n FROM f WHERE NOT bad UNION ALL SELECT 'rejected', count(*) FROM f WHERE bad
      UNION ALL SELECT 'unreadable', count(*) FROM f WHERE late""",
)
def _checked_scan(spark, folder):
    """A CSV file with unreadable numbers and times, read by schema."""
    faulty = lineitem(spark, folder, *LINES.names).select(
        "l_orderkey",
        F.when(F.col("l_orderkey") % 97 == 0, "many").otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.when(F.col("l_orderkey") % 89 == 0, "2020-13-45").otherwise(F.col("l_shipdate").cast("string")).alias("l_shipdate"),
    )
    path = _place(spark, "faulty")
    writers.write_csv(faulty, path)
    return readers.read_checked(spark, path, LINES).counts()


@query(
    "checked_rows",
    """SELECT l_orderkey, count(*) AS n, round(sum(l_quantity), 6) AS quantity, CAST(count(CASE WHEN l_orderkey % 89 <> 0 THEN 1 END) AS BIGINT) AS dated,
      max(CASE WHEN l_orderkey % 89 <> 0 THEN l_shipdate END) AS last FROM lineitem GROUP BY 1""",
)
def _checked_rows(spark, folder):
    """What a scan with an index column gives, by order."""
    late = F.col("l_orderkey") % 89 == 0
    faulty = lineitem(spark, folder, *LINES.names).select(
        F.monotonically_increasing_id().alias("_c0"),
        "l_orderkey",
        F.col("l_quantity").cast("string").alias("l_quantity"),
        F.when(late, "soon").otherwise(F.col("l_shipdate").cast("string")).alias("l_shipdate"),
    )
    path = _place(spark, "indexed")
    writers.write_csv(faulty, path)
    rows = readers.read_checked(spark, path, LINES, index_column=True).rows
    return rows.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"), F.count("l_shipdate").alias("dated"), F.max("l_shipdate").alias("last")
    )


@query(
    "sink_round_trip",
    """SELECT 'estimates' AS sink, count(*) AS n, round(sum(l_discount), 6) AS total FROM lineitem
      UNION ALL SELECT 'columns', count(*), round(sum(l_discount), 6) FROM lineitem WHERE l_orderkey % 10 = 5
      UNION ALL SELECT 'metrics', 1, round((SELECT max(l_tax) FROM lineitem), 6) UNION ALL SELECT 'params', 2, 12""",
)
def _sink_round_trip(spark, folder):
    """What each sink wrote, read back: estimates, columns by split, metrics and parameters."""
    from ..operators.splits import by_modulo

    rows = by_modulo(lineitem(spark, folder, "l_orderkey", "l_partkey", "l_discount", "l_tax"), "l_orderkey")
    paths = {name: _place(spark, name) for name in ("estimates", "columns", "metrics", "params")}
    writers.write_estimates(rows, paths["estimates"], "l_orderkey", "l_partkey", "l_discount")
    writers.write_columns(rows, paths["columns"])
    writers.write_metrics(spark, {"ndcg": float(rows.agg(F.max("l_tax")).first()[0])}, paths["metrics"])
    writers.write_params(spark, {"depth": 4, "rounds": 8}, paths["params"])
    schema = T.StructType(
        [T.StructField("SearchId", T.LongType()), T.StructField("PropertyId", T.LongType()), T.StructField("Estimated", T.DoubleType())]
    )
    params = T.StructType([T.StructField("param", T.StringType()), T.StructField("param_value", T.DoubleType())])
    sinks = {
        "estimates": readers.read_log(spark, paths["estimates"], schema).select(F.col("Estimated").alias("v")),
        "columns": readers.read_columns(spark, paths["columns"]).filter("split = 'test'").select(F.col("l_discount").alias("v")),
        "metrics": spark.read.schema("ndcg double").json(paths["metrics"]).select(F.col("ndcg").alias("v")),
        "params": readers.read_log(spark, paths["params"], params).select(F.col("param_value").alias("v")),
    }
    out = None
    for name, values in sinks.items():
        part = values.agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")).select(F.lit(name).alias("sink"), "n", "total")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "submission_check",
    f"""WITH o AS (SELECT l_orderkey AS g, row_number() OVER (ORDER BY l_orderkey, l_extendedprice DESC, {LINE_TAIL_SQL}) - 1 AS p FROM lineitem),
      s AS (SELECT CASE WHEN l_orderkey % 101 = 0 THEN l_orderkey + 1 ELSE l_orderkey END AS g, row_number() OVER (ORDER BY l_orderkey, {LINE_TAIL_SQL}) - 1 AS p
        FROM lineitem),
      a AS (SELECT g, count(*) AS n FROM s GROUP BY 1), b AS (SELECT g, count(*) AS n FROM o GROUP BY 1)
      SELECT 'group_count' AS kind, CAST(coalesce(a.g, b.g) AS VARCHAR) AS key, coalesce(a.n, 0) AS expected, coalesce(b.n, 0) AS found
        FROM a FULL JOIN b ON a.g = b.g WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
      UNION ALL SELECT 'group_sequence', CAST(p AS VARCHAR), s.g, o.g FROM s JOIN o USING (p) WHERE s.g <> o.g""",
)
def _submission_check(spark, folder):
    """A ranked output written as CSV, read back in its order, and held by position against a sample with other groups."""
    rows = graded_lines(spark, folder)
    ranked = ranking.ranked_output(rows, "l_orderkey", "l_partkey", "l_extendedprice", tiebreak=[c for c in LINE_TAIL if c != "l_partkey"])
    path = _place(spark, "submission")
    writers.write_ranked(ranked, path, "l_orderkey", "l_partkey")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("l_orderkey", "l_partkey", "rank")])
    ours = positions(readers.read_log(spark, path, schema), [], ["l_orderkey", "rank"], "place")
    sample = positions(lineitem(spark, folder, "l_orderkey", *LINE_TAIL), [], ["l_orderkey", *LINE_TAIL], "place")
    other = F.when(F.col("l_orderkey") % 101 == 0, F.col("l_orderkey") + 1).otherwise(F.col("l_orderkey"))
    return validate.validate(sample.withColumn("l_orderkey", other), ours, "l_orderkey", "place")
