import os

from shortlist.session import discard, written


def test_discard_deletes_written_tables_only(spark, tmp_path):
    first, second = written(spark.range(10)), written(spark.range(5).filter("id < 0"), "zstd")
    other = str(tmp_path / "other")
    spark.range(3).write.parquet(other)
    assert first.count() == 10 and second.count() == 0
    folders = {os.path.dirname(f.removeprefix("file://")) for t in (first, second) for f in t.inputFiles()}
    assert all(os.path.exists(f) for f in folders)
    for table in (first, second, spark.read.parquet(other)):
        discard(table)
    assert len(folders) == 2 and not any(os.path.exists(f) for f in folders)
    assert spark.read.parquet(other).count() == 3
