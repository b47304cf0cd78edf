"""Repeated passages: words covered by a window of words that an earlier document has too.

The suffixes of all texts, as sequences of words, make one tree, cut by prefixes
into subtrees that fit a task's memory. Not every suffix is a leaf: of the
``prefix`` -word sequences in a window the one of smallest hash is its anchor, so a
window finds the same anchor in every text, and only suffixes that begin at an
anchor are kept, about one in twenty. A leaf is such a suffix with the words
of all windows that its anchor owns, some of them before the anchor. Equal
leaves are one, with the smallest document; the other documents' windows there are repeats.

* Prefixes: leaves meet by the words of their anchor. A prefix in one document only holds no repeat and goes before any
  text is fetched. A prefix of more than ``MAX_LEAVES`` different leaves is lengthened, to the whole
  window: its node is then one sequence, and its smallest document an aggregate that combines before the shuffle.
* Subtrees: of the words right of the anchor, and of those left of it read backwards, nodes are split word by word;
  what is alone in a node is dropped. A window that starts o words before its anchor repeats
  where leaves share the node ``window`` - o words deep on the right and o words deep on the left.

Words are compared by 64-bit hashes, and equal leaves by 128 bits.

Cases: null, empty and blank texts have no words; texts of fewer words than the
window keep all. A null id counts as later than every id, and null ids as one. Rows that repeat an
id, with one text or several, never make each other lose. An empty table gives
no row. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import fresh
from .components import BROADCAST_ROWS, checked

WINDOW = 50
MAX_LEAVES = 4096
# A null id counts as this one, the last.
LAST = (1 << 63) - 1
# Words that are held as arrays at once, and leaves that are split at once.
BLOCK = 1 << 18
LEAVES = 1 << 14
# An odd multiplier for hashes of word sequences, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

ANCHORS = "doc bigint, tid bigint, a int, n int, off int, g bigint, ctx bigint"
LEAF = "g bigint, ctx bigint, m bigint, n int, off int, hot boolean, words array<bigint>"


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """The bits of each number spread over all of it."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sequences:
    """Hashes of stretches of a sequence of word hashes."""

    def __init__(self, words: np.ndarray):
        n = len(words) + 1
        powers = np.full(n, BASE, np.uint64)
        inverses = np.full(n, INVERSE, np.uint64)
        powers[0] = inverses[0] = 1
        self.inverses = np.cumprod(inverses)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(words * np.cumprod(powers)[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverses[start])


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the first smallest of every ``width`` neighbours."""
    best, span = np.arange(len(values)), 1

    def smaller(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] < values[a], b, a)

    while 2 * span <= width:
        best, span = smaller(best[:-span], best[span:]), 2 * span
    rest = width - span
    return smaller(best[: len(best) - rest], best[rest:]) if rest else best


def owned(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int, prefix: int) -> dict[str, np.ndarray]:
    """The anchors of texts that lie one behind the other in ``words``.

    For each: its text, the first window it owns (place in ``words``), how many it owns, how far
    it lies behind the first, and the hashes of its prefix and of all words of these windows.
    """
    whole = Sequences(words)
    places = np.arange(len(words) - prefix + 1)
    best = first_smallest(whole.of(places, places + prefix), window - prefix + 1)
    counts = lengths - window + 1
    first = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) + np.repeat(starts - first, counts)
    anchor = best[at]
    cuts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    n = np.diff(np.append(cuts, len(at)))
    a, p = at[cuts], anchor[cuts]
    return {
        "text": np.repeat(np.arange(len(starts)), counts)[cuts],
        "a": a,
        "n": n,
        "off": p - a,
        "g": whole.of(p, p + prefix),
        "ctx": whole.of(a, a + n + window - 1),
    }


def blocks(texts: Iterator[np.ndarray], window: int) -> Iterator[tuple[list[int], list[int], list[np.ndarray]]]:
    """Stretches of texts, about BLOCK words together: text, first word, words. Long texts are cut with an overlap,
    which changes what an anchor owns near the cut but no result."""
    rows, firsts, parts, size = [], [], [], 0
    for row, words in enumerate(texts):
        for first in range(0, max(0, len(words) - window + 1), BLOCK):
            part = words[first : first + BLOCK + window - 1]
            rows.append(row)
            firsts.append(first)
            parts.append(part)
            size += len(part)
            if size >= BLOCK:
                yield rows, firsts, parts
                rows, firsts, parts, size = [], [], [], 0
    if rows:
        yield rows, firsts, parts


def anchors(df: DataFrame, window: int, prefix: int) -> DataFrame:
    """The anchors of every row of ``df`` (doc, tid, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            doc, tid = batch["doc"].to_numpy(), batch["tid"].to_numpy()
            for rows, firsts, parts in blocks(map(word_hashes, batch["text"]), window):
                lengths = np.array([len(p) for p in parts])
                starts = np.cumsum(lengths) - lengths
                found = owned(np.concatenate(parts), starts, lengths, window, prefix)
                text, row = found["text"], np.array(rows)[found["text"]]
                yield pd.DataFrame(
                    {
                        "doc": doc[row],
                        "tid": tid[row],
                        "a": (found["a"] - starts[text] + np.array(firsts)[text]).astype("int32"),
                        "n": found["n"].astype("int32"),
                        "off": found["off"].astype("int32"),
                        "g": found["g"].view("int64"),
                        "ctx": found["ctx"].view("int64"),
                    }
                )

    return df.mapInPandas(run, ANCHORS)


def leaves(df: DataFrame, window: int) -> DataFrame:
    """The words of each leaf that is listed with its text; df: text, m, leaves."""

    columns = ["g", "ctx", "m", "n", "off", "hot"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, parts = [], []
        for batch in batches:
            for text, m, wanted in zip(batch["text"], batch["m"], batch["leaves"]):
                words = word_hashes(text).view("int64")
                for leaf in wanted:
                    rows.append((leaf["g"], leaf["ctx"], m, leaf["n"], leaf["off"], leaf["hot"]))
                    parts.append(words[leaf["a"] : leaf["a"] + leaf["n"] + window - 1])
                    if len(rows) == LEAVES:
                        yield pd.DataFrame(rows, columns=columns).assign(words=parts)
                        rows, parts = [], []
        yield pd.DataFrame(rows, columns=columns).assign(words=parts)

    return df.mapInPandas(run, LEAF)


def nodes(root: np.ndarray, columns: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """The node of every row at depth 0, 1, ...; -1 once a row is alone in its node or has no more words."""
    node = root.copy()
    yield node
    live = np.arange(len(root))
    for depth in range(columns.shape[1]):
        live = live[lengths[live] > depth]
        key, word = node[live], columns[live, depth]
        order = np.lexsort((word, key))
        key, word = key[order], word[order]
        new = np.ones(len(live), bool)
        new[1:] = (key[1:] != key[:-1]) | (word[1:] != word[:-1])
        number = np.cumsum(new) - 1
        many = np.bincount(number, minlength=1)[number] > 1
        node = np.full(len(root), -1)
        live = live[order][many]
        node[live] = number[many]
        yield node


def repeats(
    g: np.ndarray, m: np.ndarray, n: np.ndarray, off: np.ndarray, words: list[np.ndarray], window: int, prefix: int
) -> np.ndarray:
    """Of each leaf the windows, as bits, that a leaf of a smaller document shares. Leaves of one prefix have one ``g``."""
    reach, count = window - prefix, len(g)
    right, left = np.zeros((count, window), np.int64), np.zeros((count, reach), np.int64)
    for row, (o, w) in enumerate(zip(off, words)):
        right[row, : len(w) - o] = w[o:]
        left[row, :o] = w[:o][::-1]
    total = n + window - 1
    root = np.unique(g, return_inverse=True)[1]
    rights = list(nodes(root, right, total - off))
    shared = np.zeros(count, np.int64)
    for o, lefts in enumerate(nodes(np.zeros(count, np.int64), left, off)):
        rights_o = rights[window - o]
        live = np.flatnonzero((rights_o >= 0) & (lefts >= 0) & (o <= off) & (o > off - n))
        key = rights_o[live] * (count + 1) + lefts[live]
        order = np.argsort(key, kind="stable")
        key, live = key[order], live[order]
        if not len(live):
            continue
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        first = np.repeat(np.minimum.reduceat(m[live], starts), np.diff(np.append(starts, len(key))))
        live = live[m[live] > first]
        shared[live] |= np.left_shift(np.int64(1), (off[live] - o).astype(np.int64))
    return shared


def subtrees(df: DataFrame, window: int, prefix: int) -> DataFrame:
    """(g, ctx, mask) of the leaves that hold repeats; ``df`` has the leaves of a prefix in one partition, sorted."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        columns = [frame[c].to_numpy() for c in ("g", "m", "n", "off")]
        mask = repeats(*columns, list(frame["words"]), window, prefix)
        return frame[["g", "ctx"]].assign(mask=mask)[mask != 0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, len(batch), LEAVES):
                held.append(batch.iloc[at : at + LEAVES])
                size += len(held[-1])
                if size >= LEAVES:
                    frame = pd.concat(held)
                    # The last prefix may go on in the next batch.
                    last = (frame["g"] == frame["g"].iloc[-1]).to_numpy()
                    if not last.all():
                        yield solve(frame[~last])
                        frame = frame[last]
                    held, size = [frame], len(frame)
        if held:
            yield solve(pd.concat(held))

    return df.mapInPandas(run, "g bigint, ctx bigint, mask bigint")


def whole_windows(df: DataFrame, window: int) -> DataFrame:
    """(g, ctx, mask) as from :func:`subtrees`, with the prefix lengthened to the window."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024]
                words = list(part["words"])
                lengths = np.array([len(w) for w in words], np.int64)
                starts = np.cumsum(lengths) - lengths
                sequences = Sequences(np.concatenate(words).view(np.uint64))
                n = part["n"].to_numpy()
                t = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                s = np.repeat(starts, n) + t
                yield pd.DataFrame(
                    {
                        **{c: np.repeat(part[c].to_numpy(), n) for c in ("g", "ctx", "m")},
                        "t": t.astype("int32"),
                        "o": (np.repeat(part["off"].to_numpy(), n) - t).astype("int32"),
                        "sequence": sequences.of(s, s + window).view("int64"),
                    }
                )

    exploded = written(df.mapInPandas(run, "g bigint, ctx bigint, m bigint, t int, o int, sequence bigint"))
    node = ["g", "o", "sequence"]
    first = exploded.groupBy(*node).agg(F.min("m").alias("first"), F.max("m").alias("last")).filter("first < last")
    found = exploded.join(written(first.select(*node, "first")), node).filter("m > first")
    return found.groupBy("g", "ctx").agg(F.bit_or(F.expr("shiftleft(1L, t)")).alias("mask"))


def _merged(df: DataFrame, window: int) -> DataFrame:
    """(doc, tid, spans): the words covered by the windows of ``df`` (doc, tid, a, mask), as starts and ends in turn."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.arange(63)
        for batch in batches:
            spans = []
            for places, masks in zip(batch["places"], batch["masks"]):
                a, mask = np.asarray(places, np.int64), np.asarray(masks, np.int64)
                row, bit = np.nonzero((mask[:, None] >> bits) & 1)
                at = np.unique(a[row] + bit)
                cut = np.flatnonzero(np.diff(at) > window) + 1
                starts, ends = at[np.append(0, cut)], at[np.append(cut - 1, len(at) - 1)] + window
                spans.append(np.stack([starts, ends], axis=1).ravel().astype("int32"))
            yield pd.DataFrame({"doc": batch["doc"], "tid": batch["tid"], "spans": spans})

    grouped = df.groupBy("doc", "tid").agg(F.collect_list("a").alias("places"), F.collect_list("mask").alias("masks"))
    return grouped.mapInPandas(run, "doc bigint, tid bigint, spans array<int>")


def repeated_spans(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, prefix: int | None = None,
    max_leaves: int = MAX_LEAVES,
) -> DataFrame:
    """(doc, tid, spans) of the texts that have repeats: id (a null one as LAST), hash of the text, and the first and
    one past the last word of each stretch of repeated words, in turn."""
    prefix = prefix or max(1, window // 5)
    if not 0 < prefix <= window or window - prefix > 61:
        raise ValueError("an anchor may own at most 62 windows: window - prefix must lie in 0..61")
    keyed = df.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("doc"), F.xxhash64(F.col(text)).alias("tid"), F.col(text).alias("text")
    )
    found = written(anchors(keyed, window, prefix))
    groups = found.groupBy("g").agg(
        F.min("ctx").alias("lo"), F.max("ctx").alias("hi"), F.min("doc").alias("first"), F.max("doc").alias("last")
    )
    groups = written(groups.filter("first < last").select("g", (F.col("lo") != F.col("hi")).alias("several")))
    shared = written(found.join(groups, "g"))
    first = written(shared.groupBy("g", "ctx", "several").agg(F.min("doc").alias("m")))
    sizes = first.filter("several").groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    hot = written(sizes.filter(F.col("size") > max_leaves).select("g", F.lit(True).alias("hot")))
    marked = written(shared.join(first, ["g", "ctx", "several"]))
    # One occurrence of each leaf, in its smallest document, stands for it.
    fields = F.struct("tid", "a", "n", "off")
    stands = marked.filter("several and doc = m").groupBy("g", "ctx", "m").agg(F.min(fields).alias("at"))
    stands = stands.join(checked(hot), "g", "left").select("m", "at.*", "g", "ctx", F.coalesce("hot", F.lit(False)).alias("hot"))
    listed = stands.groupBy("m", "tid").agg(F.collect_list(F.struct("g", "ctx", "a", "n", "off", "hot")).alias("leaves"))
    listed = written(listed)
    ids = listed.select(F.col("m").alias("doc"), "tid")
    texts = keyed.join(checked(ids), ["doc", "tid"], "left_semi").dropDuplicates(["doc", "tid"])
    fetched = texts.join(listed.withColumnRenamed("m", "doc"), ["doc", "tid"]).select("text", F.col("doc").alias("m"), "leaves")
    fetched = written(leaves(fetched, window))
    cold = fetched.filter("not hot").repartition("g").sortWithinPartitions("g")
    masks = subtrees(cold, window, prefix).unionByName(whole_windows(fetched.filter("hot"), window))
    later = marked.filter("doc > m").select("doc", "tid", "a", F.expr("shiftleft(1L, n) - 1").alias("mask"))
    same = marked.filter("several and doc = m").join(written(masks), ["g", "ctx"]).select("doc", "tid", "a", "mask")
    return _merged(later.unionByName(same), window)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "passages", **parameters) -> DataFrame:
    """``df`` with a struct ``name``: n_words, n_removed, the kept words joined by one space, and the removed spans."""
    spans = written(repeated_spans(df, doc_id, text, **parameters))
    doc, tid, places = (fresh(df, c) for c in ("_doc", "_tid", "_spans"))
    renamed = spans.select(F.col("doc").alias(doc), F.col("tid").alias(tid), F.col("spans").alias(places))
    # Few spans are sent to the texts; else the texts are dealt out by id and hash.
    total = spans.agg(F.coalesce(F.sum(F.size("spans") + 2), F.lit(0))).first()[0]
    side = F.broadcast(renamed) if total <= BROADCAST_ROWS else renamed
    same = (F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)) == F.col(doc)) & (F.xxhash64(F.col(text)) == F.col(tid))

    @F.pandas_udf("n_words bigint, n_removed bigint, kept string, spans array<int>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, removed in batches:
            out = []
            for value, gone in zip(texts, removed):
                words = (value or "").encode().split()
                gone = [] if gone is None else list(gone)
                edges = [0, *gone, len(words)]
                kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode(), gone))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "spans"])

    joined = df.join(side, same, "left")
    return joined.withColumn(name, cut(F.col(text), F.col(places))).drop(doc, tid, places)
