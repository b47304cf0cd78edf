"""Train, validation and test splits that keep groups whole."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import draw, safe_div
from ..session import written
from .ordering import HOT_ROWS, attach, col, group_sizes, pieces, positions, running_total, window


def by_modulo(df: DataFrame, group: str, name: str = "split", base: int = 10, test: int = 5, val: int = 1) -> DataFrame:
    """Split by the last digit of the group."""
    rest = F.pmod(col(group), F.lit(base))
    return df.withColumn(name, F.when(rest == test, "test").when(rest == val, "val").otherwise("train"))


def by_hash(df: DataFrame, group: str, size: float = 0.7, seed: int = 42, name: str = "split") -> DataFrame:
    """Random split of whole groups; the same group lands the same way in every run."""
    return df.withColumn(name, F.when(draw([group], seed) < F.lit(size), "train").otherwise("test"))


def fold_by_hash(df: DataFrame, keys: list[str], folds: int = 3, seed: int = 42, name: str = "fold") -> DataFrame:
    """Random fold number from 0."""
    return df.withColumn(name, F.floor(draw(keys, seed) * folds).cast("int"))


def group_starts(df: DataFrame, group: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(group, n, start): size of each group and rows of the groups before it."""
    return running_total(group_sizes(df, [group]), [], [group], "n", "start", hot_rows)


def _cut(starts: DataFrame, group: str, rows: int, size: float):
    """First group of the second part: the last that starts inside the first k rows."""
    k = math.floor(rows * size)
    found = starts.filter(F.col("start") < k).agg(F.max_by(col(group), "start"), F.max("start")).first()
    return found[0], found[1] or 0


def ordered(df: DataFrame, group: str, size: float = 0.9, name: str = "split", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Groups in ascending order; those before the cut train, the rest test.

    Only two values come to the driver, the number of rows and the first group
    of the test part; rows are then labelled by comparison, without a shuffle.
    """
    cut, _ = _cut(group_starts(df, group, hot_rows), group, df.count(), size)
    return df.withColumn(name, F.when(col(group) < F.lit(cut), "train").otherwise("test"))


def two_stage(
    df: DataFrame, group: str, a: float = 0.9, b: float = 0.9, name: str = "split", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """The ordered split, then once more on its first part: train, val, test."""
    starts = written(group_starts(df, group, hot_rows))
    outer, first_part = _cut(starts, group, df.count(), a)
    inner, _ = _cut(starts, group, first_part, b)
    label = F.when(col(group) < F.lit(inner), "train").when(col(group) < F.lit(outer), "val").otherwise("test")
    return df.withColumn(name, label)


def ordered_rows(
    df: DataFrame, order: list[str], test_size: float = 0.1, name: str = "split", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Split rows, not groups, at a position of a total order."""
    rows = df.count()
    train = rows - math.ceil(rows * test_size)
    placed = positions(df, [], order, "_position", hot_rows)
    label = F.when(F.col("_position") < train, "train").otherwise("test")
    return placed.withColumn(name, label).drop("_position")


def _tile(position: Column, count: Column, tiles: int) -> Column:
    """1-based tile of a position; the first tiles take the remainder."""
    size = F.floor(count / tiles)
    longer = count - size * tiles
    edge = longer * (size + 1)
    late = longer + F.floor(safe_div(position - edge, size))
    return F.when(position < edge, F.floor(position / (size + 1))).otherwise(late) + 1


def time_blocks(df: DataFrame, group: str, time: str, folds: int = 3, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(group, block): groups by first time, cut into ``folds + 1`` blocks."""
    first = df.groupBy(col(group)).agg(F.min(col(time)).alias("_first"))
    placed = positions(first, [], ["_first", group], "_position", hot_rows)
    count = first.agg(F.count(F.lit(1)).alias("n")).scalar()
    return placed.select(col(group), _tile(F.col("_position"), count, folds + 1).cast("int").alias("block"))


def time_folds(df: DataFrame, group: str, time: str, folds: int = 3, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Rows with their block; fold i trains on blocks up to i and tests on i + 1."""
    return attach(df, time_blocks(df, group, time, folds, hot_rows), [group], "left", hot_rows)


def fold_members(blocks: DataFrame, folds: int = 3) -> DataFrame:
    """One row per fold and member, with its role in the fold."""
    fold = F.explode(F.sequence(F.greatest(F.lit(1), F.col("block") - 1), F.lit(folds)))
    return blocks.withColumn("fold", fold).withColumn(
        "role", F.when(F.col("block") <= F.col("fold"), "train").otherwise("test")
    )


def overlap(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Groups found in more than one split; none for a group-safe split."""
    return (
        df.groupBy(col(group))
        .agg(F.min(col(split)).alias("first_split"), F.max(col(split)).alias("last_split"))
        .filter(F.col("first_split") != F.col("last_split"))
    )


def group_changes(df: DataFrame, group: str, order: list[str], name: str = "is_change", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Whether a row belongs to another group than the row before it.

    Rows are cut into ranges of the order. Each range looks back inside itself,
    and its first row at the last row of the range before.
    """
    slim = df.withColumns({"_value": F.lit(0), "_row": F.monotonically_increasing_id()})
    tagged = written(slim)
    cut = pieces(tagged, [], [*order, group], hot_rows or HOT_ROWS)
    ahead = window(["_piece"], [*order, group, "_row"])
    inside = cut.select("_row", "_piece", col(group).alias("_group"), F.row_number().over(ahead).alias("_n"), F.lag(group).over(ahead).alias("_before"))
    inside = written(inside)
    last = inside.groupBy("_piece").agg(F.max_by(F.struct("_group"), "_n").alias("_last"))
    edges = last.select(F.col("_piece").alias("_p"), F.lag("_last").over(window([], ["_piece"])).alias("_edge"))
    joined = inside.join(edges, F.col("_piece") == F.col("_p"))
    first = F.col("_n") == 1
    changed = F.when(first, F.col("_edge").isNull() | ~F.col("_group").eqNullSafe(F.col("_edge._group"))).otherwise(
        ~F.col("_group").eqNullSafe(F.col("_before"))
    )
    flags = joined.select(F.col("_row").alias("_r"), changed.alias(name))
    return tagged.join(flags, F.col("_row") == F.col("_r")).select(*[col(c) for c in df.columns], col(name))


def sample_rows(df: DataFrame, keys: list[str], share: float = 0.1, seed: int = 42) -> DataFrame:
    """Keep each row with the given probability; rows of equal keys stay or go together."""
    return df.filter(draw(keys, seed) < F.lit(share))


def sample_n(df: DataFrame, keys: list[str], n: int = 100_000, seed: int = 42) -> DataFrame:
    """A fixed number of rows at random, the same in every run; tasks keep n rows each, not all."""
    return df.orderBy(draw(keys, seed), *[col(k) for k in keys]).limit(n)
