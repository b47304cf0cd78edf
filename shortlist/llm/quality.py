"""Quality rules: robust multivariate outliers per language and source.

Each text has five statistics, transformed to be roughly symmetric: its length
in words, the length of its words, and symbols, repeated lines and words in
repeated windows per word. For every language and source the centre and
covariance are those of the minimum covariance determinant: of the share ``CORE``
of the rows whose covariance has the smallest determinant. The search starts once from
medians and quartiles and once from the moments of all rows, and takes concentration steps, each the moments of the
rows that lie closest by the step before, for as long as the determinant falls; the lower end counts. Rows are rejected whose squared Mahalanobis distance is beyond the chi-square
quantile that leaves out the share ``REJECTED`` of normal rows.

Groups of fewer than ``MIN_ROWS`` rows are estimated together, since the moments of so few rows say little: a row of such a
group is then an outlier among all rows of small groups, not within its own. If all of these are
fewer, their rows are kept. Scales have a floor, so that a statistic that does not vary
within a group does not reject every row that differs by a little.

DataFrame operations only. Medians and cores are found from counts of narrow bins and moments
from sums, so no group is ever in one task, and no row is left out.

Cases: a null or empty text has no words and fails the base rules, as does every text
of fewer than ``MIN_WORDS`` words; a null language or source is a value of its own;
repeated rows count as often as they occur; an empty table gives no row. Columns
beside the named ones are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import WORD

MIN_WORDS = 50
MAX_REPEATED = 50
MIN_ROWS = 50
CORE = 0.75
# Concentration goes on while the log of the determinant falls by this.
LEAST_FALL = 1e-3
# Share of normal rows that are rejected.
REJECTED = 1e-6
# Repeated windows of a text that are looked up one by one; more are found by sorting.
FEW = 64
SYMBOLS = r"[#*$%&|<>]"
# Smallest scales of the transformed statistics.
FLOORS = {"words": 0.25, "length": 0.05, "symbols": 0.1, "lines": 0.15, "repeats": 0.2}
FEATURES = tuple(FLOORS)
BINS = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_places(windows: Column) -> Column:
    """Places, in order, of the windows whose hash occurs twice or more."""

    def in_sorted(order: Column) -> Column:
        same = F.filter(order, lambda h, i: h == F.get(order, i - 1))
        return let(F.array_distinct(same), lambda twice: F.when(F.size(twice) <= FEW, looked_up(twice)).otherwise(by_sort()))

    def looked_up(twice: Column) -> Column:
        return F.filter(F.transform(windows, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull())

    def by_sort() -> Column:
        def neighbours(order: Column) -> Column:
            def place(s: Column, i: Column) -> Column:
                h = s["h"]
                return F.when((h == F.get(order, i - 1)["h"]) | (h == F.get(order, i + 1)["h"]), s["i"])

            return F.sort_array(F.filter(F.transform(order, place), lambda i: i.isNotNull()))

        return let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), neighbours)

    none = F.array().cast("array<int>")
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), none).otherwise(let(F.sort_array(windows), in_sorted))


def _covered(places: Column) -> Column:
    """Words under windows of three words that start at ``places``."""
    gaps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, g: total + g)


def statistics(text: Column) -> Column:
    """Struct of the word count and the four base statistics of a text."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        n = F.size(words)
        triples = F.transform(
            F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
        )
        repeats = let(triples, lambda t: let(_repeated_places(t), _covered))
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            n.cast("bigint").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            repeats.alias("n_repeat_words"),
        )

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words)


def _features() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "words": F.log(n),
        "length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "symbols": F.sqrt(F.col("n_symbols") / n),
        "lines": F.sqrt(F.col("n_dup_lines") / n),
        "repeats": F.sqrt(F.col("n_repeat_words") / n),
    }


def chi_square_below(x: float, freedom: int) -> float:
    """Probability of a chi-square value below ``x``: the series of the incomplete gamma function."""
    a, total, term, k = freedom / 2, 0.0, 1 / (freedom / 2), 0
    while term > 1e-16 * max(total, 1e-300):
        total, k = total + term, k + 1
        term *= (x / 2) / (a + k)
    return total * math.exp(-x / 2 + a * math.log(x / 2) - math.lgamma(a))


def chi_square_quantile(share: float, freedom: int) -> float:
    low, high = 1e-6, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_below(middle, freedom) < share else (low, middle)
    return low


def consistency(share: float, size: int) -> float:
    """Factor that makes the covariance of the core that of the whole, for normal rows."""
    return share / chi_square_below(chi_square_quantile(share, size), size + 2)


def _quantile_bins(bins: DataFrame, keys: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """Per key the first bin up to which at least each share of the rows lies. A key has a bounded number of bins."""
    counted = bins.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*keys).orderBy("bin")
    ranked = counted.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    return ranked.groupBy(*keys).agg(
        *[F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("bin"))).alias(name) for name, share in shares.items()]
    )


def _start(rows: DataFrame) -> DataFrame:
    """Medians and scales from quartiles, as a centre and the inverse of a diagonal factor."""
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), F.floor(F.col(f) * BINS).cast("bigint").alias("bin")) for f in FEATURES])
    long = rows.select("group", F.explode(entries).alias("e")).select("group", "e.*")
    quartiles = _quantile_bins(long, ["group", "feature"], {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    scale = (F.col("q3") - F.col("q1")) / BINS / 1.349
    wide = quartiles.groupBy("group").agg(
        *[F.max(F.when(F.col("feature") == f, (F.col("q2") + 0.5) / BINS)).alias("m_" + f) for f in FEATURES],
        *[F.max(F.when(F.col("feature") == f, F.greatest(scale, F.lit(FLOORS[f])))).alias("s_" + f) for f in FEATURES],
    )
    inverse = {(i, j): 1 / F.col("s_" + f) if i == j else F.lit(0.0) for i, f in enumerate(FEATURES) for j in range(i + 1)}
    return wide.select("group", *[F.col("m_" + f) for f in FEATURES], *[c.alias(f"w_{i}_{j}") for (i, j), c in inverse.items()])


def _estimates(core: DataFrame) -> DataFrame:
    """Centre, inverse Cholesky factor and log determinant of each group's core."""
    size, factor = len(FEATURES), consistency(CORE, len(FEATURES))
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]
    moments = core.groupBy("group").agg(
        *[F.avg(f).alias("m_" + f) for f in FEATURES],
        *[F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c_{i}_{j}") for i, j in pairs],
    )
    # The floors are added to the variances, which also keeps the matrix regular.
    for i, f in enumerate(FEATURES):
        moments = moments.withColumn(f"c_{i}_{i}", F.col(f"c_{i}_{i}") * factor + F.lit(FLOORS[f] ** 2))
    moments = moments.withColumns({f"c_{i}_{j}": F.col(f"c_{i}_{j}") * factor for i, j in pairs if i != j})

    def dot(terms: list[Column]) -> Column:
        return reduce(Column.__add__, terms, F.lit(0.0))

    for i, j in pairs:
        rest = F.col(f"c_{i}_{j}") - dot([F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)])
        moments = moments.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}_{j}"))
    for j in range(size):
        for i in range(j, size):
            known = dot([F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)])
            moments = moments.withColumn(f"w_{i}_{j}", (1 / F.col(f"l_{i}_{i}")) if i == j else -known / F.col(f"l_{i}_{i}"))
    log_det = dot([2 * F.log(f"l_{i}_{i}") for i in range(size)])
    return moments.select(
        "group", *[F.col("m_" + f) for f in FEATURES], *[F.col(f"w_{i}_{j}") for i, j in pairs], log_det.alias("log_det")
    )


def _distances(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Add the squared Mahalanobis distance of each row to its group."""
    whitened = [
        reduce(Column.__add__, [F.col(f"w_{i}_{j}") * (F.col(FEATURES[j]) - F.col("m_" + FEATURES[j])) for j in range(i + 1)])
        for i in range(len(FEATURES))
    ]
    joined = rows.join(estimates, "group", how)
    return joined.withColumn("distance", reduce(Column.__add__, [z * z for z in whitened])).select(*rows.columns, "distance")


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Estimates of the closest rows: a concentration step. The core ends with a whole bin of distances."""
    binned = _distances(rows, estimates).withColumn("bin", F.floor(F.log(F.col("distance") + 1e-9) * BINS).cast("bigint"))
    limits = _quantile_bins(binned.select("group", "bin"), ["group"], {"limit": CORE})
    return _estimates(binned.join(written(limits), "group").filter("bin <= limit"))


def _settled(rows: DataFrame, start: DataFrame) -> DataFrame:
    """Concentration steps from a start. A group takes them for as long as its determinant falls."""
    best = written(_concentrated(rows, written(start)).withColumn("moving", F.lit(True)))
    while not (moving := best.filter("moving")).isEmpty():
        after = written(_concentrated(rows.join(moving.select("group"), "group", "left_semi"), moving.drop("moving")))
        fallen = moving.select("group", F.col("log_det").alias("before")).join(after.select("group", "log_det"), "group")
        fallen = written(fallen.filter(F.col("before") - F.col("log_det") >= LEAST_FALL).select("group"))
        lower = after.join(fallen, "group", "left_semi").withColumn("moving", F.lit(True))
        best = written(best.join(fallen, "group", "left_anti").withColumn("moving", F.lit(False)).unionByName(lower))
    return best.drop("moving")


def estimates_of(rows: DataFrame) -> DataFrame:
    """Minimum covariance determinant estimates of each group of rows: the lower of two starts, from quartiles and from all rows."""
    ends = _settled(rows, _start(rows)).unionByName(_settled(rows, _estimates(rows)))
    columns = [c for c in ends.columns if c != "group"]
    lowest = ends.groupBy("group").agg(F.min(F.struct("log_det", *[c for c in columns if c != "log_det"])).alias("e"))
    return written(lowest.select("group", *[F.col("e." + c) for c in columns]))


def rate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", rejected: float = REJECTED
) -> DataFrame:
    """doc_id, the statistics, base_failed, distance and kept of every document."""
    measured = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), statistics(F.col(text)).alias("s")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    measured = measured.select("doc_id", "lang", "source", "s.*").withColumn("base_failed", failed)
    measured = written(measured.withColumns(_features()))
    passed = measured.filter("not base_failed")
    sizes = passed.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    group = F.when(F.col("n") >= MIN_ROWS, F.struct("lang", "source"))
    named = written(sizes.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), group.alias("_group")))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    # The group of the small groups has a null inside, and no language and source.
    key = F.to_json(F.struct(F.col("_group").isNull().alias("pooled"), "_group.lang", "_group.source"))
    rows = written(
        measured.join(named, same, "left").withColumn("group", key).drop("_lang", "_source", "_group")
    )
    counted = rows.filter("not base_failed").groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_ROWS)
    usable = rows.filter("not base_failed").join(written(counted.select("group")), "group", "left_semi")
    estimates = estimates_of(usable)
    rated = _distances(rows, estimates, "left")
    cutoff = chi_square_quantile(1 - rejected, len(FEATURES))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return rated.withColumn("kept", kept).drop("group", *FEATURES)
