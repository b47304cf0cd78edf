import re
from collections import defaultdict

import pytest

from shortlist.llm import mixing

WORD = re.compile("[^\x20\x09-\x0D]+")


def size_of(text):
    return len(WORD.findall(text or ""))


def check(docs, mixed, cap=2.0):
    assert len(docs) == len(mixed)
    taken, target, largest, sizes = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in mixed:
        s = r["source"]
        assert r["taken"] <= cap * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[s] += r["taken"]
        sizes[s] += r["size"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
        assert target[s] <= cap * sizes[s] + 1e-6
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_odd_documents(odd):
    docs = odd.collect()
    mixed = mixing.pareto_mix(odd).collect()
    check(docs, mixed)
    assert sorted(r["size"] for r in mixed) == sorted(size_of(r["text"]) for r in docs)


@pytest.mark.parametrize("bucket_rows", [1, 7, 10_000])
def test_buckets_change_nothing(spark, folder, bucket_rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    key = lambda r: tuple(r)
    usual = sorted(map(key, mixing.pareto_mix(docs).select("doc_id", "copies", "taken").collect()))
    other = sorted(map(key, mixing.pareto_mix(docs, bucket_rows=bucket_rows).select("doc_id", "copies", "taken").collect()))
    assert usual == other
    check(docs.collect(), mixing.pareto_mix(docs, bucket_rows=bucket_rows).collect())


def test_levels(rows):
    sizes = rows("source string, source_size bigint", [("a", 10), ("b", 1000), ("c", 1000), (None, 0)])
    found = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # a stops at 20; the other 2995 of 3015 words are shared 2 to 1, and b stops at 2000.
    assert found["a"] == 20 and found[None] == 0
    assert found["b"] == pytest.approx(2995 * 2 / 3) and found["c"] == pytest.approx(2995 / 3)


def test_empty(none):
    assert mixing.pareto_mix(none).count() == 0


def test_no_words(rows):
    docs = rows("doc_id bigint, text string, source string", [(1, None, "a"), (2, "", None)])
    assert [(r["taken"], r["target"]) for r in mixing.pareto_mix(docs).collect()] == [(0, 0.0), (0, 0.0)]
