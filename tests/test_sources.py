"""Scans with faults."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from shortlist.sources import readers

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("t", T.TimestampNTZType())]
)


def file(tmp_path, text, name="f.csv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_bad_records_and_times_are_kept_apart(spark, tmp_path):
    path = file(
        tmp_path,
        "id,x,t\n1,2.5,2020-01-02 03:04:05\n2,many,2020-01-02 00:00:00\n3,NaN,never\n4,NULL,NULL\n5,1.0\n6,1,2020-01-01 00:00:00,7\nx,1,never\n",
    )
    scan = readers.read_checked(spark, path, SCHEMA)
    rows = {r["id"]: r for r in scan.rows.collect()}
    assert sorted(rows) == [1, 3, 4] and rows[1]["t"] == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert rows[3]["x"] is None and rows[3]["t"] is None and rows[4]["x"] is None
    assert sorted(r["record"][0] for r in scan.rejected.collect()) == ["2", "5", "6", "x"]
    assert [tuple(r) for r in scan.unreadable.collect()] == [("t", "never", 1)]
    assert {r["kind"]: r["n"] for r in scan.counts().collect()} == {"rows": 3, "rejected": 4, "unreadable": 1}


def test_headers(spark, tmp_path):
    assert readers.header_faults(spark, file(tmp_path, "ID,x,t\n"), SCHEMA) == []
    assert readers.header_faults(spark, file(tmp_path, ",id,x,t\n"), SCHEMA, index_column=True) == []
    assert readers.header_faults(spark, file(tmp_path, "id,t,x\n"), SCHEMA) == ["t is column 2", "x is column 3"]
    with pytest.raises(ValueError, match="missing x, unexpected y"):
        readers.read_checked(spark, file(tmp_path, "id,y,t\n1,2,3\n"), SCHEMA)


def test_index_column_format_and_no_times(spark, tmp_path):
    path = file(tmp_path, ",id,x,t\n0,1,2.5,02.01.2020\n1,2,3.5,2020\n")
    scan = readers.read_checked(spark, path, SCHEMA, index_column=True, time_format="dd.MM.yyyy")
    assert [(r["id"], r["t"]) for r in scan.rows.orderBy("id").collect()] == [(1, dt.datetime(2020, 1, 2)), (2, None)]
    plain = T.StructType(SCHEMA.fields[:2])
    assert readers.read_checked(spark, file(tmp_path, "id,x\n1,2\n"), plain).unreadable.collect() == []


def test_sample_keeps_about_its_share(spark, tmp_path):
    path = file(tmp_path, "id,x,t\n" + "".join(f"{i},1.0,2020-01-01 00:00:00\n" for i in range(4000)))
    first = readers.read_sample(spark, path, SCHEMA, 0.25, 3)
    assert 850 < first.count() < 1150 and first.select("id").distinct().count() == first.count()


def test_parse_time(rows):
    df = rows("t string", [("2020-01-02 03:04:05",), ("never",), (None,)])
    assert [r["t"] for r in readers.parse_time(df, "t", strict=False).collect()] == [dt.datetime(2020, 1, 2, 3, 4, 5), None, None]
    with pytest.raises(Exception, match="CANNOT_PARSE|cannot be parsed|never"):
        readers.parse_time(df, "t").collect()


def test_the_submission_sample_is_numbered_by_its_order_only(spark, rows, tmp_path, monkeypatch):
    import datetime

    from shortlist.plans import source_queries
    from shortlist.plans.registry import LINE_TAIL

    schema = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    day = datetime.datetime(2020, 1, 1)
    data = [(i // 3, i % 5, i % 4, i % 3, 1.0 * i, 10.0 * i, 0.1, 0.0, "R", "O", day) for i in range(303, 330)]
    rows(schema, data).write.parquet(str(tmp_path / "lineitem.parquet"))
    seen = []
    number = source_queries.positions
    monkeypatch.setattr(source_queries, "positions", lambda df, *a: seen.append(set(df.columns)) or number(df, *a))
    found = source_queries._submission_check(spark, str(tmp_path)).collect()
    # Order 101 stands in the sample as 102.
    assert {(r["kind"], r["key"]) for r in found if r["kind"] == "group_count"} == {("group_count", "101"), ("group_count", "102")}
    assert {"l_orderkey", *LINE_TAIL} in seen and not any("l_returnflag" in columns for columns in seen)
