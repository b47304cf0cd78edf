import random
import re

import numpy as np
import pytest

from shortlist.llm import passages

from .conftest import prose

LAST = passages.LAST


def slow(docs, window):
    """Removed words of each row by a dictionary of all windows."""
    split = [(LAST if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, words in split:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, words), (doc, _) in zip(split, docs):
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < i:
                gone.update(range(s, s + window))
        out.append((doc, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=repr)


def fast(spark, docs, **parameters):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = passages.remove_repeats(df, **parameters).select("doc_id", "passages.*")
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect()), key=repr)


def corpus(seed, count, size, alphabet):
    """Texts of few words, with stretches copied from other texts, edits and copies."""
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        words = [rng.choice(alphabet) for _ in range(rng.randrange(size))]
        if texts and rng.random() < 0.8:
            other = rng.choice(texts)
            a = rng.randrange(len(other) + 1)
            piece = other[a : a + rng.randrange(1, size)]
            at = rng.randrange(len(words) + 1)
            words[at:at] = piece
        if words and rng.random() < 0.2:
            words[rng.randrange(len(words))] = rng.choice(alphabet)
        texts.append(words)
    docs = [(rng.randrange(count), " ".join(t)) for t in texts]
    return docs + [(None, docs[0][1]), (docs[1][0], docs[1][1]), (docs[1][0], docs[2][1]), (None, docs[3][1])]


@pytest.mark.parametrize(
    ("window", "prefix", "alphabet", "max_leaves"),
    [(6, 2, "ab", passages.MAX_LEAVES), (5, 1, "abcdefgh", passages.MAX_LEAVES), (8, 3, "abc", 2), (4, 4, "abcd", 2)],
)
def test_equals_a_dictionary_of_all_windows(spark, window, prefix, alphabet, max_leaves):
    docs = corpus(window * 10 + prefix, 60, 30, alphabet)
    assert fast(spark, docs, window=window, prefix=prefix, max_leaves=max_leaves) == slow(docs, window)


def test_long_texts_are_cut_without_a_change(spark, monkeypatch):
    docs = corpus(3, 20, 400, "abcdefghijkl")
    whole = fast(spark, docs, window=12)
    assert whole == slow(docs, 12)
    words = [np.arange(100, dtype=np.uint64)]
    monkeypatch.setattr(passages, "BLOCK", 32)
    parts = [p for _, _, p in passages.blocks(iter(words), 12)]
    seen = {tuple(p[s : s + 12]) for group in parts for p in group for s in range(len(p) - 11)}
    assert len(seen) == 89


def test_fifty_words(spark):
    body = prose(9, 60)
    words = body.split()
    docs = [
        (5, "x " + body + " y"),
        (2, " ".join(words[:50])),
        (3, " ".join(words[:49]) + " other"),
        (9, " \t".join(words[10:60])),
        (1, prose(10, 40)),
    ]
    assert fast(spark, docs) == slow(docs, 50)
    assert {d: n for d, _, n, _ in fast(spark, docs)} == {5: 50, 2: 0, 3: 0, 9: 50, 1: 0}


def test_odd_rows(spark, odd, odd_rows, none):
    found = passages.remove_repeats(odd)
    assert found.columns == [*odd.columns, "passages"]
    got = sorted(((r[0], r[-1].n_words, r[-1].n_removed, r[-1].kept) for r in found.collect()), key=repr)
    assert got == slow([r[:2] for r in odd_rows], 50)
    assert passages.remove_repeats(none).collect() == []


def test_many_partitions_change_nothing(spark):
    docs = corpus(4, 80, 60, "abcdef")
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(13)
    got = passages.remove_repeats(df, window=7).select("doc_id", "passages.kept").collect()
    assert sorted(((r[0], r[1]) for r in got), key=repr) == sorted(((d, k) for d, _, _, k in slow(docs, 7)), key=repr)
