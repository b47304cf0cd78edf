"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: a share by weight of the total, up
to ``cap`` times what the source has; what a capped source cannot use is shared
again by weight. A document of a source with target t and size s is wanted t / s
times. The whole part is taken for certain. The rest is its inclusion
probability p, and documents are ranked by random odds over inclusion odds,
(u / (1 - u)) / (p / (1 - p)), with u from a hash of the id: the Pareto order
sample of unequal probabilities, fixed in words per source. Documents are taken in this
order up to the one whose middle reaches what the target leaves, so a source
misses its target by half a document at most.

No task sees a whole source: ranks are cut into buckets of equal width, bucket
sums are added up, and only the bucket in which a source's sample ends is ranked
row by row. The number of buckets follows the number of rows.

Cases: a null text has size 0; documents of size 0 and sources without words
take nothing; a null source is one source, ranked last; repeated rows are taken
like other rows and share one u, which ties are broken by id and size; a null id counts as the
empty text. An empty table gives no row. Columns beside the named ones are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import positions
from ..session import written
from .common import WORD

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
# Rows per bucket of ranks, on average; only one bucket per source is ranked.
BUCKET_ROWS = 4096
HASH_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone; any engine with md5 gives the same."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**HASH_DIGITS))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Add ``target`` to a table of sources and their ``source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn. A level L
    is sought with sum(min(cap * size, L * weight)) = share * total. Each round
    caps the sources that are above and raises L for the rest; only sums come to
    the driver, and every round but the last caps at least one source more.
    """
    numbered = positions(sizes, [], ["source"], "_place")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    weighted = written(numbered.withColumn("weight", weight.cast("bigint")))
    limit = F.col("source_size") * F.lit(float(cap))
    total = weighted.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level, capped = 0.0, -1
    while True:
        above = (F.col("weight") * F.lit(level) >= limit) if capped >= 0 else F.lit(False)
        sums = weighted.agg(
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if sums["n"] == capped or sums["weight"] == 0:
            break
        capped = sums["n"]
        level = (share * total - cap * sums["fixed"]) / sums["weight"]
    return weighted.withColumn("target", F.least(limit, F.col("weight") * F.lit(level))).drop("_place")


def pareto_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """doc_id, source, size, source_size, weight, target, copies and taken of every document."""
    sized = written(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = sized.count()
    # One row per source: adaptive execution broadcasts it if it is small, and else splits the skew.
    aimed = targets(sources, weights, share, cap).withColumnRenamed("source", "_source")
    joined = sized.join(aimed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(wanted)
    rest = wanted - whole
    odds = uniform(F.col("doc_id")) / (1 - uniform(F.col("doc_id")))
    rank = F.when(rest > 0, odds / (rest / (1 - rest)))
    buckets = max(1, -(-rows // bucket_rows))
    ranked = (
        joined.withColumn("_whole", whole)
        .withColumn("_left", F.greatest(F.lit(0.0), F.col("target") - whole * F.col("source_size")))
        .withColumn("_rank", rank)
        # A rank r is the odds of r / (1 + r), which spreads over (0, 1). Documents taken whole have none.
        .withColumn("_bucket", F.floor(F.col("_rank") / (1 + F.col("_rank")) * buckets).cast("bigint"))
    )
    sums = ranked.filter(F.col("_rank").isNotNull()).groupBy("source", "_bucket").agg(F.sum("size").alias("_size"), F.first("_left").alias("_left"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that the join below shuffles both sides and a hot source can be split.
    edge = written(
        sums.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .filter((F.col("_start") <= F.col("_left")) & (F.col("_start") + F.col("_size") > F.col("_left")))
        .select(F.col("source").alias("_source"), F.col("_bucket").alias("_edge"), "_start")
    )
    placed = ranked.join(edge, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    # A source without an edge takes all of its buckets.
    inside = F.col("_edge").isNull() | (F.col("_bucket") < F.col("_edge"))
    at_edge = F.coalesce(F.col("_bucket") == F.col("_edge"), F.lit(False))
    order = Window.partitionBy("source").orderBy("_rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("_start") + F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("size") / 2
    sure = placed.filter(~at_edge).withColumn("_take", (inside & F.col("_rank").isNotNull()).cast("bigint"))
    close = placed.filter(at_edge).withColumn("_take", (middle <= F.col("_left")).cast("bigint"))
    copies = (F.col("_whole") + F.col("_take")).cast("bigint")
    return sure.unionByName(close).select(
        "doc_id", "source", "size", "source_size", "weight", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
