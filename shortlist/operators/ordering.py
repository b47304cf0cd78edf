"""Positions and running totals inside groups of any size.

A plain window sends each group to one task. That is right for the many small
groups of a search log and wrong for a group that holds a large part of all
rows, or for an order over a whole table. Here the size of every group is
counted first (one column-pruned, map-side combined aggregate). Groups of up to
``hot_rows`` rows use the plain window. The rows of larger ones are cut into
ranges along their order; every piece is numbered on its own and shifted by the
total of the pieces before it. Columns beside keys and order are not sorted.

Order columns are names; a leading ``-`` sorts descending. Nulls come last.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

HOT_ROWS = 2_000_000
PIECES_PER_HOT = 4
# Spark samples about a hundred order keys per piece on the driver.
MAX_PIECES = 20_000


def col(name: str) -> Column:
    """A column by its literal name; feature names may contain dots."""
    return F.col(f"`{name}`")


def names_of(order: Sequence[str]) -> list[str]:
    return [o.removeprefix("-") for o in order]


def order_by(order: Sequence[str]) -> list[Column]:
    return [
        col(o[1:]).desc_nulls_last() if o.startswith("-") else col(o).asc_nulls_last() for o in order
    ]


def window(keys: Sequence[str], order: Sequence[str] = ()) -> Window:
    spec = Window.partitionBy(*[col(k) for k in keys])
    return spec.orderBy(*order_by(order)) if order else spec


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Groups above ``hot_rows`` rows. There are at most rows / hot_rows of them."""
    return group_sizes(df, keys, "_n").filter(F.col("_n") > hot_rows)


def has_hot_group(df: DataFrame, keys: Sequence[str], hot_rows: int, cleared: list[set[str]] | None = None) -> bool:
    """Whether a group exceeds ``hot_rows`` rows.

    A table of no more rows than that has none; counting rows first is answered
    from file footers where it can be. ``cleared`` collects key sets without
    such a group; finer sets have none either.
    """
    if cleared is not None and any(known <= set(keys) for known in cleared):
        return False
    if df.count() > hot_rows and not hot_groups(df, keys, hot_rows).isEmpty():
        return True
    if cleared is not None:
        cleared.append(set(keys))
    return False


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of key columns with their prefixed copies."""
    return functools.reduce(
        operator.and_, [col(k).eqNullSafe(col(prefix + k)) for k in keys], F.lit(True)
    )


def prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def pieces(rows: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys, order columns, ``_value``, ``_row`` and ``_piece``: rows cut along (keys, order, row) into ranges.

    Pieces follow each other in that order. Spark finds the cuts from a sample of
    fixed size per piece; it decides where they lie and never which rows are kept. The table
    is written, which fixes the numbers of the pieces.
    """
    names = list(dict.fromkeys([*keys, *names_of(order), "_value", "_row"]))
    slim = rows.select(*[col(n) for n in names])
    count = min(MAX_PIECES, max(2, -(-PIECES_PER_HOT * slim.count() // hot_rows)))
    along = [*[col(k).asc_nulls_first() for k in keys], *order_by(order), col("_row").asc()]
    return written(slim.repartitionByRange(count, *along).withColumn("_piece", F.spark_partition_id()))


def _hot_totals(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, hot_rows: int
) -> DataFrame:
    """Totals before each row. Only keys and order columns are sorted; the rows meet their totals by number."""
    tagged = written(rows.withColumns({"_value": F.coalesce(value, F.lit(0)), "_row": F.monotonically_increasing_id()}))
    cut = pieces(tagged, keys, order, hot_rows)
    piece = [*keys, "_piece"]
    before = window(piece, [*order, "_row"]).rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.select(*[col(c) for c in piece], "_row", F.coalesce(F.sum("_value").over(before), F.lit(0)).alias("_inside"))
    piece_before = window(keys, ["_piece"]).rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*[col(c) for c in piece]).agg(F.sum("_value").alias("_sum"))
    shifts = sums.withColumn("_shift", F.coalesce(F.sum("_sum").over(piece_before), F.lit(0))).drop("_sum")
    placed = inside.join(prefixed(shifts, piece, "_s_"), same_keys(piece, "_s_"), "inner")
    totals = placed.select(F.col("_row").alias("_r_row"), (F.col("_shift") + F.col("_inside")).alias("_total"))
    joined = tagged.join(totals, F.col("_row") == F.col("_r_row"), "inner")
    return joined.select(*[col(c) for c in rows.columns], F.col("_total").alias(name))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str | None,
    name: str,
    hot_rows: int | None = HOT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add the total of ``value`` over the rows before each row of its group.

    ``value=None`` counts rows, which gives the 0-based position. ``order``
    should end in a tie-break; rows that tie are kept in an arbitrary order.
    ``hot_rows=None`` skips the size check for groups known to be small;
    ``sizes`` holds the keys of the rows for it, where ``df`` is dear to make.
    """
    keys, order = list(keys), list(order)

    def plain(rows: DataFrame) -> DataFrame:
        if value is None:
            total = (F.row_number().over(window(keys, order)) - 1).cast("bigint")
        else:
            before = window(keys, order).rowsBetween(Window.unboundedPreceding, -1)
            total = F.coalesce(F.sum(col(value)).over(before), F.lit(0))
        return rows.withColumn(name, total)

    if hot_rows is None or not has_hot_group(df if sizes is None else sizes, keys, hot_rows):
        return plain(df)
    unit = F.lit(1).cast("bigint") if value is None else col(value)
    if not keys:
        return _hot_totals(df, keys, order, unit, name, hot_rows)
    hot = hot_groups(df, keys, hot_rows)
    listed = F.broadcast(prefixed(hot.select(*[col(k) for k in keys]), keys, "_h_"))
    large = df.join(listed, same_keys(keys, "_h_"), "left_semi")
    small = df.join(listed, same_keys(keys, "_h_"), "left_anti")
    return plain(small).unionByName(_hot_totals(large, keys, order, unit, name, hot_rows))


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, hot_rows: int | None = HOT_ROWS, sizes: DataFrame | None = None
) -> DataFrame:
    """Add the 0-based position of each row in its group."""
    return running_total(df, keys, order, None, name, hot_rows, sizes)


def attach(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot_rows: int | None = HOT_ROWS,
    source: DataFrame | None = None,
    cleared: list[set[str]] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join a table with one row per key back to the rows.

    Adaptive execution does not split a hot key here, since the other side is an
    aggregate and not a shuffle of its own. Rows of keys above ``hot_rows`` rows
    are therefore joined apart, to a broadcast of their few statistics (at most
    rows / hot_rows), and never shuffled. An unknown key counts as one key, so
    that many unknown keys do not meet in one task either; unless ``null_safe``
    it matches nothing. ``source`` is a shorter way to the same rows for the
    size check.
    """
    keys = list(keys)

    def join(rows: DataFrame, side: DataFrame) -> DataFrame:
        if not null_safe:
            return rows.join(side, keys, how)
        joined = rows.join(prefixed(side, keys, "_a_"), same_keys(keys, "_a_"), how)
        return joined.drop(*["_a_" + k for k in keys])

    rows = df if source is None else source
    if hot_rows is None or not has_hot_group(rows, keys, hot_rows, cleared):
        return join(df, stats)
    hot = hot_groups(rows, keys, hot_rows).select(*[col(k) for k in keys])
    listed = F.broadcast(prefixed(hot, keys, "_h_"))
    few = stats.join(listed, same_keys(keys, "_h_"), "left_semi")
    large = df.join(listed, same_keys(keys, "_h_"), "left_semi")
    small = df.join(listed, same_keys(keys, "_h_"), "left_anti")
    return join(small, stats).unionByName(join(large, F.broadcast(few)))


def beside(
    df: DataFrame,
    keys: Sequence[str],
    stats: dict[str, Column],
    hot_rows: int | None = HOT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add aggregates of each row's group; an unknown key has none.

    Without a hot group the rows are shuffled by key once and nothing else is,
    however dear ``df`` is to make. With one, the aggregates are joined back by
    :func:`attach`. ``sizes`` holds the keys of the rows for the size check.
    """
    keys = list(keys)
    known = functools.reduce(operator.and_, [col(k).isNotNull() for k in keys])
    if hot_rows is None or not has_hot_group(df if sizes is None else sizes, keys, hot_rows):
        over = window(keys)
        return df.withColumns({name: F.when(known, value.over(over)) for name, value in stats.items()})
    table = df.filter(known).groupBy(*[col(k) for k in keys]).agg(*[v.alias(n) for n, v in stats.items()])
    joined = attach(df, table, keys, hot_rows=hot_rows, source=sizes)
    return joined.select(*[col(c) for c in df.columns], *[col(n) for n in stats])


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their 1-based rank.

    The limit is applied by every task before the shuffle, so a group of any
    size sends at most k rows per task.
    """
    return df.withColumn(rank, F.row_number().over(window(keys, order)).cast("bigint")).filter(col(rank) <= k)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Interpolated quantiles per group from counts of equal values.

    No task holds the values of a whole group: equal values are counted first,
    and the two values around each quantile are found by their running count.
    """
    keys = list(keys)
    known = df.filter(col(value).isNotNull()).select(*[col(k) for k in keys], col(value).alias("_v"))
    counts = known.groupBy(*[col(k) for k in keys], "_v").agg(F.count(F.lit(1)).alias("_c"))
    placed = running_total(counts, keys, ["_v"], "_c", "_start", hot_rows)
    sizes = counts.groupBy(*[col(k) for k in keys]).agg(F.sum("_c").alias("_n"))
    if keys:
        sized = attach(placed, sizes, keys, "inner", hot_rows, source=counts, null_safe=True)
    else:
        sized = placed.withColumn("_n", sizes.select("_n").scalar())

    def at(place: Column) -> Column:
        inside = (F.col("_start") <= place) & (place < F.col("_start") + F.col("_c"))
        return F.max(F.when(inside, F.col("_v").cast("double")))

    picks = []
    for name, share in shares.items():
        place = F.lit(float(share)) * (F.col("_n") - 1)
        picks += [
            at(F.floor(place)).alias(name + "|lo"),
            at(F.ceil(place)).alias(name + "|hi"),
            F.max(place - F.floor(place)).alias(name + "|part"),
        ]
    picked = sized.groupBy(*[col(k) for k in keys]).agg(*picks)
    return picked.select(
        *[col(k) for k in keys],
        *[
            (col(n + "|lo") + (col(n + "|hi") - col(n + "|lo")) * col(n + "|part")).alias(n)
            for n in shares
        ],
    )
