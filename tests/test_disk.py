"""What stays on disk after work is written: neither shuffle files nor tables that nothing reads any more."""

import os
import time

from pyspark.sql import functions as F

from shortlist.llm import components, fuzzy_lines, mixing_lm
from shortlist.session import SHUFFLE_CLEANUP, shared_folder, written
from tests.llm.conftest import prose


def tables(spark):
    folder = shared_folder(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("shortlist-")}


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.length()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_written(spark):
    before = shuffle_files(spark)
    was = spark.conf.get(SHUFFLE_CLEANUP, "false")
    sums = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    table = written(sums)
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == was
    # The frame itself can be read again.
    assert sorted(table.collect()) == sorted(sums.collect())


def edited_lines(rows):
    lines = []
    for n in range(40):
        words = prose(n, 6 + n).split()
        lines += [" ".join(words), " ".join(["edited", *words[1:]]), " ".join([*words[:-1], "other"]), " ".join(words)]
    return rows("doc_id bigint, text string", list(enumerate(lines)))


def test_line_groups_leave_their_result_only(spark, rows):
    lines = fuzzy_lines.coded_lines(edited_lines(rows), "doc_id", "text", 1)
    before = tables(spark)
    groups = fuzzy_lines.all_line_groups(lines, 0.8)
    assert groups.count() >= 120
    # The groups, the codes of words of lines of the next step and no round's tables.
    assert len(tables(spark) - before) <= 2


def test_keys_in_parts_give_the_same_lines(spark, rows, monkeypatch):
    """Of each four lines the first stays, whatever the parts."""
    assert fuzzy_lines.parts_of(0) == fuzzy_lines.parts_of(50_000) == 1
    assert fuzzy_lines.parts_of(10**9) == fuzzy_lines.KEY_PARTS
    monkeypatch.setattr(fuzzy_lines, "PART_LINES", 50)
    kept = fuzzy_lines.deduplicate(edited_lines(rows), max_bits=None, min_words=1).collect()
    assert {r["doc_id"]: r["removed"] for r in kept} == {i: [0] if i % 4 else [] for i in range(160)}


def test_last_pairs_in_parts(spark, rows):
    """A chain through one bucket, whose pivots link to few of its members."""
    nodes = written(rows("id bigint, fp int", [(i, 3 * i) for i in range(60)]))
    posts = written(rows("key bigint, id bigint, fp int", [(k, i, 3 * i) for i in range(60) for k in (i // 20, 5 + (i + 10) // 20)]))
    near = lambda x, y: F.abs(x - y) <= 3
    found = {tuple(r) for r in components.grouped(nodes, posts, near, parts=3).collect()}
    assert found == {(i, 0) for i in range(60)}


def test_pairs_in_blocks_and_ranges_give_the_same_lines(spark, rows, monkeypatch):
    """Pairs meet maps by blocks of ids and lines by ranges; nothing is left of either."""
    assert fuzzy_lines.blocks_of(0) == fuzzy_lines.blocks_of(fuzzy_lines.BLOCK_PAIRS) == 1
    assert fuzzy_lines.blocks_of(10**12) == fuzzy_lines.BLOCKS
    for name, value in (("BLOCK_PAIRS", 20), ("RANGE_LINES", 40), ("BROADCAST_ROWS", 0), ("PART_LINES", 50)):
        monkeypatch.setattr(fuzzy_lines, name, value)
    blocks, ranges, of, cut = [], [], fuzzy_lines.blocks_of, fuzzy_lines.line_ranges
    monkeypatch.setattr(fuzzy_lines, "blocks_of", lambda n: blocks.append(of(n)) or blocks[-1])
    monkeypatch.setattr(fuzzy_lines, "line_ranges", lambda df: ranges.append(cut(df)) or ranges[-1])
    lines = fuzzy_lines.coded_lines(edited_lines(rows).repartition(6), "doc_id", "text", 1)
    before = tables(spark)
    groups = fuzzy_lines.all_line_groups(lines, 0.8)
    assert groups.select("ga", "gb").distinct().count() == 40 and groups.count() == 120
    assert len(tables(spark) - before) <= 2
    assert max(blocks) > 1 and max(map(len, ranges)) > 1
    for conditions in ranges:
        assert sum(lines.filter(c("line")).count() for c in conditions) == lines.count() == 160


def test_a_side_of_many_rows_is_not_broadcast(spark):
    """A broadcast is collected and built by the driver, whose memory does not grow with the tables."""
    few, many = (components.checked(spark.range(n)) for n in (50_000, 300_000))
    assert "broadcast" in few._jdf.queryExecution().logical().toString()
    assert "broadcast" not in many._jdf.queryExecution().logical().toString()
    assert fuzzy_lines.BROADCAST_PLACES <= components.BROADCAST_ROWS


def test_components_leave_their_result_only(spark, rows):
    edges = rows("a bigint, b bigint", [(i, i + 1) for i in range(200) if i % 7])
    before = tables(spark)
    found = components.components(edges)
    assert found.count() > 100 and len(tables(spark) - before) == 1


def test_fitting_leaves_no_table(spark):
    docs = spark.createDataFrame([(i, prose(i, 60)) for i in range(5)], "doc_id bigint, text string")
    before = tables(spark)
    found = mixing_lm.score(docs, F.lit(True))
    # Words and the scored rows, which the result reads.
    assert len(tables(spark) - before) == 2
    assert found.count() == 5
