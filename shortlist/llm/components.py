"""Links between fingerprints that differ in few bits, and their connected groups.

Candidates share a bucket: some of the blocks of their fingerprints are equal.
A bucket may hold very many fingerprints that all lie close together, so its
pairs are not written out. Each member is held against one member of its bucket,
the pivot, first. What links to a pivot is one group from then on, and only pairs
that are not in one group yet can add anything. A pivot has met its whole bucket
and leaves it. The rounds after the first take other pivots in the buckets that
still hold several groups, and the last compares what is
left outside a bucket's largest group with the whole bucket. No link between
different groups is lost, whatever the size of a bucket.

DataFrame operations only. Nothing but row counts comes to the driver. Tables of a
round are deleted once the next one is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, written

# A side of up to this many rows of two to four longs is broadcast: some 10 MB where the driver collects and builds it.
BROADCAST_ROWS = 100_000
ROUNDS = 2
# Numbers that change the order of ids, so that rounds have different pivots.
TURNS = (0, 0x2545F4914F6CDD1D)

Near = Callable[[Column, Column], Column]
Verify = Callable[[DataFrame], DataFrame]


def checked(side: DataFrame) -> DataFrame:
    """A written side, marked for broadcast if its row count allows it."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every end of ``edges`` (a, b); root is the smallest id of the group.

    Each round hooks every node to its smallest neighbour, follows these
    pointers to their ends by doubling, and goes on with the links between
    different ends. Groups at least halve, stars end in one round.
    """
    edges = written(edges.select("a", "b"))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots: DataFrame | None = None
    while True:
        hooks = both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("root"))
        hooks = _followed(written(hooks))
        if roots is None:
            roots = hooks
        else:
            step = hooks.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
            joined = roots.join(step, F.col("root") == F.col("_id"), "left")
            before, roots = roots, written(joined.select("id", F.coalesce("_root", "root").alias("root")))
            discard(before)
        a = hooks.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        b = hooks.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        left = edges.join(a, "a").join(b, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        joined_ends, edges = edges, written(left.distinct())
        discard(joined_ends)
        if hooks is not roots:
            discard(hooks)
        if edges.isEmpty():
            discard(edges)
            return roots
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _followed(pointers: DataFrame) -> DataFrame:
    """Replace each pointer by the end of its chain; a root points to itself. The given table is deleted."""
    while True:
        # Only pointers to nodes that themselves point on need another step.
        moving = written(
            pointers.filter("root <> id").select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        )
        stepped = pointers.join(moving, F.col("root") == F.col("_id"), "left")
        moved = written(stepped.select("id", F.coalesce("_root", "root").alias("root"), F.col("_id").isNotNull().alias("moved")))
        discard(moving)
        discard(pointers)
        pointers = moved.select("id", "root")
        if moved.filter("moved").isEmpty():
            return pointers


def _rooted(posts: DataFrame, roots: DataFrame) -> DataFrame:
    return written(posts.drop("root").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")))


def _open(posts: DataFrame, fps: DataFrame, turn: int, pivots: bool) -> DataFrame:
    """Members of buckets that hold several groups, written: with ``pivots`` beside the bucket's pivot of this turn
    and its fingerprint, without the pivot itself.
    """
    mixed = F.lit(turn)
    found = posts.groupBy("key").agg(
        F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.min(F.col("id").bitwiseXOR(mixed)).alias("_pivot")
    )
    buckets = found.filter("_lo <> _hi").select("key", F.col("_pivot").bitwiseXOR(mixed).alias("pivot"))
    chosen = written(buckets.join(fps, "pivot"))
    members = posts.join(checked(chosen), "key")
    members = written(members.filter("id <> pivot") if pivots else members.drop("pivot", "pivot_fp"))
    discard(chosen)
    return members


def connected(nodes: DataFrame, keys: Column, near: Near, verify: Verify | None = None) -> DataFrame:
    """(id, root) of the nodes (id, fp) that link to another, root being the smallest id of the group.

    ``keys`` lists the buckets of ``fp``, ``near`` says whether two fingerprints are
    close, and ``verify`` keeps the pairs (a, b) that link, written. Ids are distinct longs.
    """
    nodes = written(nodes)
    return grouped(nodes, nodes.select(F.explode(keys).alias("key"), "id", "fp"), near, verify)


def _screened(candidates: Sequence[DataFrame], screen: Verify) -> DataFrame:
    """The different pairs of all parts that ``screen`` keeps, written."""
    found = [written(pairs.distinct(), "zstd") for pairs in candidates]
    kept = screen(reduce(DataFrame.unionByName, found))
    for done in found:
        discard(done)
    if len(found) == 1:
        return kept
    # A pair that shares keys of several parts stands there once each.
    different = written(kept.distinct())
    discard(kept)
    return different


def grouped(
    nodes: DataFrame, posts: DataFrame, near: Near, verify: Verify | None = None, parts: int = 1, screen: Verify | None = None
) -> DataFrame:
    """The same from a written table of nodes and the members (key, id, fp) of the buckets, whose keys are longs if ``parts`` is over 1.

    The pairs of the last comparison are found in ``parts`` by their keys, one after the other, so that fewer are shuffled at once.
    ``screen`` keeps those pairs of a written table that may link, written; what it keeps of a round is verified together.
    """
    posts = posts.withColumn("root", F.col("id"))
    edges: list[DataFrame] = []
    # Tables of a round: (key, id, fp, root), and those of earlier rounds' groups.
    held: DataFrame | None = None
    roots: DataFrame | None = None

    def link(*candidates: DataFrame) -> DataFrame:
        for pairs in candidates if screen is None else [_screened(candidates, screen)]:
            found = pairs.distinct() if screen is None else pairs
            edges.append(verify(found) if verify else written(found))
            if screen is not None:
                discard(pairs)
        return components(reduce(DataFrame.unionByName, edges))

    def opened(turn: int, pivots: bool) -> DataFrame:
        """Members of the buckets that are still open; what they were read from goes."""
        if roots is None:
            return _open(posts, fps, turn, pivots)
        current = _rooted(posts, roots)
        discard(held)
        members = _open(current, fps, turn, pivots)
        discard(current)
        return members

    fps = nodes.select(F.col("id").alias("pivot"), F.col("fp").alias("pivot_fp"))
    for turn in TURNS[:ROUNDS]:
        members = held = opened(turn, True)
        posts = members.drop("pivot", "pivot_fp")
        if members.isEmpty():
            break
        close = members.filter(near(F.col("fp"), F.col("pivot_fp")))
        before, roots = roots, link(close.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")))
        if before is not None:
            discard(before)
    if roots is None:
        return nodes.select("id", F.col("id").alias("root")).limit(0)
    rest = opened(TURNS[0], False)
    if rest.isEmpty():
        for done in (rest, *edges):
            discard(done)
        return roots
    # All of a bucket against what its largest group leaves out.
    sizes = rest.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = written(sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main")))
    outside = written(rest.join(checked(largest), "key").filter("root <> main")).alias("l")
    whole = rest.join(checked(largest), "key").alias("r")
    across = (
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.root") != F.col("r.root"))
        & ((F.col("r.root") == F.col("r.main")) | (F.col("l.id") < F.col("r.id")))
        & near(F.col("l.fp"), F.col("r.fp"))
    )
    pairs = outside.join(whole, across)
    ends = [F.least(F.col("l.id"), F.col("r.id")).alias("a"), F.greatest(F.col("l.id"), F.col("r.id")).alias("b")]
    if parts > 1:
        candidates = [pairs.filter(F.pmod(F.col("l.key"), F.lit(parts)) == part).select(*ends) for part in range(parts)]
    else:
        candidates = [pairs.select(*ends)]
    before, roots = roots, link(*candidates)
    for done in (before, rest, largest, outside, *edges):
        discard(done)
    return roots


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
