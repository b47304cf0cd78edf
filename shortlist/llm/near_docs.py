"""SimHash near-duplicates by an inverted index of positional bytes.

The 64-bit fingerprint of a document has a bit where more than half of its
shingle hashes have it. Two documents link if at most ``max_bits`` bits differ. These
bits lie in at most ``max_bits`` of the eight bytes, so linked fingerprints
share at least 8 - max_bits bytes in place: the guaranteed minimum of matches.

Postings of single bytes would be long, so the index lists sets of positional bytes. The
positions are cut into ``parts`` parts, and a posting is made for every set of
``width`` positions inside one part. Any 8 - max_bits matching bytes have ``width`` of
them in one part, so no pair is lost. A wider set makes more and shorter
postings; the width follows the number of fingerprints and changes no result.
The matches of a pair are counted from its two fingerprints, pairs below the minimum
go, and the rest is verified by its bits.

Documents with one fingerprint are one node, so copies make no pairs, and
:mod:`components` keeps dense groups from making all of theirs.

Cases: a null, empty or blank text has fingerprint zero, and such documents
link to each other; repeated rows are linked like copies; a null id takes part
and is never the component's id unless the component has no other. An empty table
gives no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import fresh
from .components import checked, connected, hamming

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# Shingle hashes that are counted at once, so a long text needs little memory.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Fingerprint as a signed long."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    # bytes.lower() and split() know ASCII letters and the six white spaces only.
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths).tolist()
    count = max(1, len(words) - shingle_words + 1)
    stops = (ends[-count:] - 1).tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, count, BLOCK):
        some = [digest(line[a:b], SEED) for a, b in zip(starts[at : min(at + BLOCK, count)], stops[at : at + BLOCK])]
        bits = np.unpackbits(np.array(some, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > count).view(">i8")[0])


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, copy, fp) of every row; copy is a hash that tells texts of one id apart."""

    @F.pandas_udf("bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle_words) for t in texts], dtype="int64")

    source = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("copy"), run(source).alias("fp"))


def byte_at(fp: Column, place: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * place).bitwiseAND(F.lit(255))


def position_sets(width: int, max_bits: int = MAX_BITS) -> list[tuple[int, ...]]:
    """Sets of ``width`` byte positions of which any 8 - max_bits positions hold one.

    With p parts, 8 - max_bits positions put ceil((8 - max_bits) / p) into one of them.
    """
    kept = 8 - max_bits
    parts = max(p for p in range(1, 9) if -(-kept // p) >= width)
    cuts = [round(8 * i / parts) for i in range(parts + 1)]
    return [s for a, b in zip(cuts, cuts[1:]) for s in combinations(range(a, b), min(width, b - a))]


def set_width(count: int, max_bits: int = MAX_BITS) -> int:
    """The smallest width at which a posting holds about one of ``count`` fingerprints by chance.

    Widths with more sets than the widest are of no use.
    """
    kept = 8 - max_bits
    most = len(position_sets(kept, max_bits))
    return next((w for w in range(1, kept) if 256**w >= count and len(position_sets(w, max_bits)) <= most), kept)


def postings(fp: Column, sets: list[tuple[int, ...]]) -> Column:
    """A posting key per set: its number, and the bytes at its positions."""

    def key(number: int, places: tuple[int, ...]) -> Column:
        packed = F.lit(number).cast("bigint")
        for place in places:
            packed = F.shiftleft(packed, 8).bitwiseOR(byte_at(fp, place))
        return packed

    return F.array(*[key(n, s) for n, s in enumerate(sets)])


def matches(a: Column, b: Column) -> Column:
    """Bytes that two fingerprints share in place."""
    same = a.bitwiseXOR(b)
    return sum((F.when(byte_at(same, p) == 0, 1).otherwise(0) for p in range(8)), F.lit(0))


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, copy, fp, root, component_id) of every row; the id of a component is its smallest doc_id."""
    prints = written(fingerprints(df, doc_id, text, shingle_words))
    classes = prints.groupBy(F.col("fp").alias("id")).agg(F.min("doc_id").alias("first"))
    classes = written(classes)
    count = classes.count()
    width = set_width(count, max_bits)

    def near(a: Column, b: Column) -> Column:
        return (matches(a, b) >= 8 - max_bits) & (hamming(a, b) <= max_bits)

    roots = connected(
        classes.select("id", F.col("id").alias("fp")), postings(F.col("fp"), position_sets(width, max_bits)), near
    )
    # Every class with the first document of its component.
    rooted = written(classes.join(roots, "id").select("id", "root", "first"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = written(rooted.join(firsts, "root").select(F.col("id").alias("fp"), "root", "component_id"))
    named = written(
        classes.join(linked, classes["id"] == linked["fp"], "left").select(
            F.col("id").alias("fp"), F.coalesce("root", "id").alias("root"), F.coalesce("component_id", "first").alias("component_id")
        )
    )
    return prints.join(named, "fp").select("doc_id", "copy", "fp", "root", "component_id")


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **parameters: int) -> DataFrame:
    """One row of each component: the smallest id, and of several texts or rows of that id one.

    Only rows that repeat an id and a text exactly are shuffled with their text, unless more rows go than may be broadcast.
    """
    linked = written(near_duplicates(df, doc_id, text, **parameters))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "copy")
    kept = linked.groupBy("root").agg(F.min(rank).alias("first"))
    kept = written(kept.select(F.col("first.doc_id").alias("_id"), F.col("first.copy").alias("_copy")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy"))
    id_, copy = fresh(df, "_id"), fresh(df, "_copy")
    gone = linked.join(kept, same, "left_anti").select(F.col("doc_id").alias(id_), F.col("copy").alias(copy)).distinct()
    gone = written(gone)
    counts = linked.groupBy("doc_id", "copy").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = written(counts.select(F.col("doc_id").alias(id_), F.col("copy").alias(copy)))
    in_side = (F.xxhash64(F.col(text)) == F.col(copy)) & F.col(doc_id).eqNullSafe(F.col(id_))
    rest = df.join(checked(gone), in_side, "left_anti")
    if twice.isEmpty():
        return rest
    repeated = rest.join(checked(twice), in_side, "left_semi").withColumn(copy, F.xxhash64(F.col(text)))
    return rest.join(checked(twice), in_side, "left_anti").unionByName(repeated.dropDuplicates([doc_id, copy]).drop(copy))
