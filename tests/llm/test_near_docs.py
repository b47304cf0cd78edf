import random
import re
from itertools import combinations

import pytest
import xxhash

from shortlist.llm import near_docs
from shortlist.llm.components import components, connected, hamming
from tests.llm.conftest import prose

LOW = {i: i + 32 for i in range(65, 91)}


def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def linked(fps, most=3):
    groups = Groups(fps)
    for a, b in combinations(fps, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= most:
            groups.join(a, b)
    return groups


@pytest.mark.parametrize("text", ["", " \n", None, "a", "A b", "one two three", "Ä É x y z\x85w", prose(5, 300), "w " * 70_000])
def test_fingerprint(text):
    assert near_docs.fingerprint(text) % 2**64 == slow_fingerprint(text)


@pytest.mark.parametrize("most", range(1, 7))
def test_position_sets_miss_no_pair(most):
    for width in range(1, 9 - most):
        sets = [set(s) for s in near_docs.position_sets(width, most)]
        for kept in combinations(range(8), 8 - most):
            assert any(s <= set(kept) for s in sets)


def test_components(spark, rows):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)]
    groups = Groups({i for e in edges for i in e})
    for a, b in edges:
        groups.join(a, b)
    found = components(rows("a bigint, b bigint", edges)).collect()
    assert {r["id"]: r["root"] for r in found} == {i: groups.find(i) for i in groups.up}
    assert components(rows("a bigint, b bigint", [])).count() == 0


def test_a_dense_group_keeps_its_links(rows):
    """Fingerprints around one centre, few of which are close to any pivot."""
    rng = random.Random(4)
    fps = set()
    for centre in (0, 2**63 + 12345, 77 << 20):
        for _ in range(120):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    fps = sorted({signed(f) for f in fps})
    groups = linked(fps)
    from pyspark.sql import functions as F

    for width in (1, 2, 3, 5):
        sets = near_docs.position_sets(width)
        nodes = rows("id bigint, fp bigint", [(f, f) for f in fps])
        found = connected(nodes, near_docs.postings(F.col("fp"), sets), lambda a, b: hamming(a, b) <= 3)
        roots = {r["id"]: r["root"] for r in found.collect()}
        assert {f: roots.get(f, f) for f in fps} == {f: groups.find(f) for f in fps}


def test_odd_documents(odd):
    docs = odd.collect()
    fps = {signed(slow_fingerprint(r["text"])) for r in docs}
    groups, first = linked(sorted(fps)), {}
    for r in docs:
        root = groups.find(signed(slow_fingerprint(r["text"])))
        if r["doc_id"] is not None:
            first[root] = min(first.get(root, r["doc_id"]), r["doc_id"])
    want = sorted(str((r["doc_id"], signed(slow_fingerprint(r["text"])), first.get(groups.find(signed(slow_fingerprint(r["text"]))))) ) for r in docs)
    found = near_docs.near_duplicates(odd).collect()
    assert sorted(str((r["doc_id"], r["fp"], r["component_id"])) for r in found) == want


def test_one_document_of_each_group_stays(odd):
    kept = near_docs.deduplicate(odd)
    assert kept.columns == odd.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    groups = linked(sorted({signed(slow_fingerprint(r["text"])) for r in odd.collect()}))
    roots = [groups.find(signed(slow_fingerprint(t))) for _, t in found]
    assert len(roots) == len(set(roots)) == len({groups.find(f) for f in groups.up})
    assert (3, "") in found


def test_all_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fps = {i: signed(slow_fingerprint(t)) for i, t in texts.items()}
    groups, first = linked(sorted(set(fps.values()))), {}
    for i, f in sorted(fps.items()):
        first.setdefault(groups.find(f), i)
    found = near_docs.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["fp"], r["component_id"]) for r in found} == {i: (f, first[groups.find(f)]) for i, f in fps.items()}


def test_empty(none):
    assert near_docs.near_duplicates(none).count() == 0 and near_docs.deduplicate(none).count() == 0
