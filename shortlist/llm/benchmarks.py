"""Benchmark decontamination by a BM25 index of the test items with block-max bounds.

Every document is cut into passages of ``PASSAGE`` words that overlap by half,
and items, their questions and their answers into entries of at most half a passage, so that an entry that a
document holds lies whole in one of its passages, also where question and answer stand apart. A passage queries the index
with its distinct terms; term weights come from how many pieces of the whole
corpus hold a term. Retrieval is block-max WAND for all passages of a document
at once: entries stand in blocks of ``BLOCK``, the index has the largest
contribution of each term to each block, and the sum of these maxima over the
rarer terms of each entry that a passage holds, with the most that its common ones can add, bounds the
score of every entry of a block. Only blocks whose bound reaches what an entry
needs, ``SHARE`` of its score against itself, are scored, exactly. All entries that reach it are
candidates, however many.

A candidate item is verified over the whole document: at least ``OVERLAP`` of the
five-word shingles of the item must occur in it, those between question and answer counted or not, and both must be
clearly present: ``PRESENT`` of their own shingles, or all but ``EDITED`` of the words, in order, at one place. An
item is a question followed by its answer; where no separate answer is given it
is the last sentence, or the second half of an item of one sentence.

Items are read by the driver in shards of at most about ``SHARD_BYTES`` of text, and the index
of a shard is broadcast; a larger benchmark makes more shards. Documents are never
shuffled.

Cases: words are runs of ASCII letters, digits and all other characters beyond
ASCII, lower-cased; a part of fewer than five words is one shingle; items
without a word match nothing; a null id is kept as it is; equal items are all
reported; a repeated document is reported on each row; null and empty texts
match nothing. All columns are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASSAGE = 256
STRIDE = PASSAGE // 2
SHARE = 0.6
SHINGLE = 5
OVERLAP = 0.8
# What each of question and answer must show: shingles, or else words that may be edited.
PRESENT, EDITED = 0.5, 0.25
BLOCK = 4
K1, B, LENGTH = 1.2, 0.75, 64
SHARD_BYTES = 16 << 20
# Bounds that are held at once.
CELLS = 1 << 22
PIECE = 1 << 20
_KEPT = bytes(i if chr(i) in "0123456789abcdefghijklmnopqrstuvwxyz" or i > 127 else 32 for i in range(256))
_SENTENCE = re.compile(r"(?<=[.?!])\s+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_KEPT).split()


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, about ``PIECE`` characters at a time."""
    text, at = text or "", 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        yield words_of(text[at:end])
        at = end
    yield words_of(text[at:])


def question_and_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer of an item that is one text."""
    sentences = [w for w in map(words_of, _SENTENCE.split((text or "").strip())) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    return words[: len(words) // 2], words[len(words) // 2 :]


def shingles(words: list[bytes], size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def entries(items: list[tuple]) -> list[tuple[int, list[bytes]]]:
    """(place of the item, words) of every entry: an item, its question and its answer cut evenly into parts of at most half a passage.

    A question or answer of less than a shingle hardly counts in the overlap and is no entry of its own.
    """
    out = []
    for i, (_, question, answer) in enumerate(items):
        apart = [x for x in (question, answer) if len(x) >= SHINGLE] if question and answer else []
        for words in (question + answer, *apart):
            count = -(-len(words) // STRIDE)
            cuts = [len(words) * k // count for k in range(count + 1)] if count else []
            out += [(i, words[a:b]) for a, b in zip(cuts, cuts[1:])]
    return out


def edits(part: np.ndarray, numbers: np.ndarray) -> int:
    """The fewest words to insert, remove or replace so that ``part`` stands somewhere in ``numbers``."""
    place = np.arange(len(numbers) + 1)
    row = np.zeros(len(numbers) + 1, np.int64)
    for i, word in enumerate(part.tolist(), 1):
        after = np.empty_like(row)
        after[0] = i
        after[1:] = np.minimum(row[:-1] + (numbers != word), row[1:] + 1)
        row = np.minimum.accumulate(after - place) + place
    return int(row.min())


def vocabulary(items: list[tuple]) -> dict[bytes, int]:
    return {w: n + 1 for n, w in enumerate(sorted({w for _, q, a in items for w in q + a}))}


def numbered(terms: dict[bytes, int], text: str | None) -> np.ndarray:
    """The term of every word, 0 for words of no item."""
    found = [np.fromiter((terms.get(w, 0) for w in words), np.int32, len(words)) for words in pieces(text)]
    return np.concatenate(found)


class Index:
    def __init__(self, items: list[tuple], terms: dict[bytes, int], held: np.ndarray, total: float, share: float = SHARE):
        """``held[t]`` of ``total`` pieces of the corpus hold term t."""
        self.terms, self.ids = terms, [x[0] for x in items]
        self.parts = [(shingles(q), shingles(a), shingles(q + a)) for _, q, a in items]
        self.words = [tuple(np.array([terms[w] for w in part], np.int32) for part in (q, a)) for _, q, a in items]
        # Entries of like length share a block, so that a short one does not lower what a block needs.
        cut = sorted(entries(items), key=lambda x: len(x[1]))
        self.item = np.array([i for i, _ in cut], np.int64)
        size = len(terms) + 1
        weight = np.log(1 + (total - held + 0.5) / (held + 0.5))
        weight[0] = 0
        rows = [
            (terms[w], e, weight[terms[w]] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / LENGTH)))
            for e, (_, words) in enumerate(cut)
            for w, n in Counter(words).items()
        ]
        term = np.array([r[0] for r in rows], np.int64)
        entry = np.array([r[1] for r in rows], np.int64)
        gain = np.array([r[2] for r in rows], np.float64)
        self.need = share * np.bincount(entry, gain, len(cut))
        # The terms of an entry and what they add, entry by entry.
        self.start = np.searchsorted(entry, np.arange(len(cut) + 1))
        self.term, self.gain = term, gain
        # The commonest terms of an entry that add up to half of what it needs are not looked up.
        order = np.lexsort((weight[term], entry))
        total_gain = np.cumsum(gain[order])
        before = np.concatenate([[0.0], total_gain])[self.start]
        common = np.zeros(len(term), bool)
        common[order] = 2 * (total_gain - before[entry[order]]) <= self.need[entry[order]]
        least = self.need - np.bincount(entry, np.where(common, gain, 0.0), len(cut))
        kept = ~common
        self.rare = np.zeros(size, bool)
        self.rare[term[kept]] = True
        self.blocks = -(-len(cut) // BLOCK)
        self.least = np.array([least[b * BLOCK : (b + 1) * BLOCK].min() for b in range(self.blocks)])
        key, most = term[kept] * max(1, self.blocks) + entry[kept] // BLOCK, gain[kept]
        order = np.argsort(key, kind="stable")
        unique, first = np.unique(key[order], return_index=True)
        self.most = np.maximum.reduceat(most[order], first) if len(first) else np.zeros(0)
        self.block = unique % max(1, self.blocks)
        self.at = np.searchsorted(unique // max(1, self.blocks), np.arange(size + 1))

    def search(self, numbers: np.ndarray) -> set[int]:
        """Items with an entry whose score for a passage reaches what it needs."""
        found: set[int] = set()
        passages = max(1, -(-(len(numbers) - STRIDE) // STRIDE))
        step = max(1, CELLS // max(1, self.blocks))
        for first in range(0, passages, step):
            last = min(passages, first + step)
            found |= self._search(numbers[first * STRIDE : (last - 1) * STRIDE + PASSAGE], last - first)
        return found

    def _search(self, numbers: np.ndarray, passages: int) -> set[int]:
        place = np.flatnonzero(self.rare[numbers])
        term, half = numbers[place].astype(np.int64), place // STRIDE
        size = len(self.terms) + 1
        # A word lies in the passage that starts with its half, and in the one before.
        pairs = np.unique(np.concatenate([half * size + term, (half - 1) * size + term]))
        passage, term = pairs // size, pairs % size
        inside = (passage >= 0) & (passage < passages)
        passage, term = passage[inside], term[inside]
        n = self.at[term + 1] - self.at[term]
        posting = np.repeat(self.at[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        cell = np.repeat(passage, n) * self.blocks + self.block[posting]
        bound = np.bincount(cell, self.most[posting], passages * self.blocks).reshape(passages, self.blocks)
        found: set[int] = set()
        present = np.zeros(size, bool)
        reached = bound >= self.least * (1 - 1e-9)
        for p in np.flatnonzero(reached.any(axis=1)).tolist():
            words = numbers[p * STRIDE : p * STRIDE + PASSAGE]
            present[words] = True
            for b in np.flatnonzero(reached[p]).tolist():
                for e in range(b * BLOCK, min((b + 1) * BLOCK, len(self.need))):
                    own = slice(self.start[e], self.start[e + 1])
                    if self.gain[own][present[self.term[own]]].sum() >= self.need[e] * (1 - 1e-9):
                        found.add(int(self.item[e]))
            present[words] = False
        return found

    def leaks(self, text: str | None) -> list[tuple[int, float, float]]:
        """(item, question overlap, answer overlap) of all items that a text holds."""
        numbers = numbered(self.terms, text)
        found = self.search(numbers) if len(numbers) and self.ids else set()
        if not found:
            return []
        wanted = set().union(*[part for i in found for part in self.parts[i]])
        sizes, seen, before = {len(s) for s in wanted}, set(), []
        for words in pieces(text):
            line = before + words
            for size in sizes:
                seen |= wanted.intersection(zip(*[line[k:] for k in range(size)]))
            before = line[-SHINGLE:]
        out = []
        for i in sorted(found):
            hits = [sum(x in seen for x in part) for part in self.parts[i]]
            sizes = [len(part) for part in self.parts[i]]
            question, answer, whole = (h / n if n else 1.0 for h, n in zip(hits, sizes))
            if max(whole, (hits[0] + hits[1]) / (sizes[0] + sizes[1])) < OVERLAP:
                continue
            if all(x >= PRESENT or self._edited(part, numbers) for x, part in zip((question, answer), self.words[i])):
                out.append((i, question, answer))
        return out

    def _edited(self, part: np.ndarray, numbers: np.ndarray) -> bool:
        """Whether a part of at least a shingle stands in the text but for few of its words."""
        return len(part) >= SHINGLE and edits(part, numbers) <= EDITED * len(part)


def shards(
    benchmark: DataFrame, item_id: str, question: str, answer: str | None, shard_bytes: int = SHARD_BYTES
) -> Iterator[list[tuple]]:
    """Items in lists of about ``shard_bytes`` of text at most, one list at a time."""
    texts = [question] if answer is None else [question, answer]
    size = sum((F.coalesce(F.octet_length(F.col(t)), F.lit(0)).cast("bigint") for t in texts), F.lit(0))
    total = benchmark.agg(F.sum(size).alias("n")).first()["n"] or 0
    count = max(1, -(-total // shard_bytes))
    columns = [F.col(item_id).alias("id"), *[F.coalesce(F.col(t), F.lit("")).alias(f"t{i}") for i, t in enumerate(texts)]]
    shard = F.pmod(F.xxhash64(*[F.col(t) for t in texts], F.col(item_id)), F.lit(count))
    rows = benchmark.select(*columns, shard.alias("shard"))
    for k in range(count):
        found = rows.filter(F.col("shard") == k).orderBy("id", "t0").collect()
        yield [
            (r["id"], *(question_and_answer(r["t0"]) if answer is None else (words_of(r["t0"]), words_of(r["t1"]))))
            for r in found
        ]


def corpus_counts(docs: DataFrame, text: str, terms: dict[bytes, int]) -> tuple[np.ndarray, float]:
    """In how many pieces of half a passage each term occurs, and the number of pieces of all texts."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, held = len(known.value) + 1, None
        for batch in batches:
            held = np.zeros(size, np.int64) if held is None else held
            for value in batch["text"]:
                numbers = numbered(known.value, value)
                for at in range(0, len(numbers), CELLS):
                    part = numbers[at : at + CELLS]
                    place = np.flatnonzero(part)
                    pairs = np.unique(place // STRIDE * size + part[place])
                    held += np.bincount(pairs % size, minlength=size)
                # Place 0 counts the pieces.
                held[0] += -(-len(numbers) // STRIDE)
        if held is not None:
            used = np.flatnonzero(held)
            yield pd.DataFrame({"term": used, "n": held[used]})

    counted = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(run, "term bigint, n bigint")
    rows = counted.groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    known.unpersist()
    held = np.zeros(len(terms) + 1)
    held[rows["term"].to_numpy(np.int64)] = rows["n"]
    total, held[0] = held[0], 0
    return held, float(total)


LEAK = "array<struct<item_id:{kind},question_overlap:double,answer_overlap:double>>"


def _finder(index: Broadcast, schema: str):
    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = index.value
        for texts in batches:
            found = [known.leaks(t) for t in texts]
            names = ("item_id", "question_overlap", "answer_overlap")
            yield pd.Series([[dict(zip(names, (known.ids[i], q, a))) for i, q, a in row] for row in found], dtype=object)

    return run


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    question: str = "text",
    answer: str | None = None,
    name: str = "leaks",
    share: float = SHARE,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Add the list of test items that each document leaks, in order of the id."""
    kind = benchmark.schema[item_id].dataType.simpleString()
    schema, context = LEAK.format(kind=kind), docs.sparkSession.sparkContext
    found = F.array().cast(schema)
    for items in shards(benchmark, item_id, question, answer, shard_bytes):
        items = [x for x in items if x[1] or x[2]]
        if not items:
            continue
        terms = vocabulary(items)
        index = context.broadcast(Index(items, terms, *corpus_counts(docs, text, terms), share))
        found = F.concat(found, _finder(index, schema)(F.coalesce(F.col(text), F.lit(""))))
    return docs.withColumn(name, F.array_sort(found))
