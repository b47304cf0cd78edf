"""Toxicity by two class-conditional Kneser-Ney language models.

Both classes have a word model of absolute discounts: a word after its
neighbour, a word, and shorter and shorter beginnings of the word, so that a
rare form is judged by its stem. Counts are Kneser-Ney's, the number of
different words that stand before, so that a passage repeated in many documents
counts once. What a class does not know is shared out by counts of both classes
together, in which they do not differ: what neither has seen says nothing. The
evidence of a token is the difference of its two log-likelihoods. A text is
described by the mean over its tokens, the largest means over few neighbouring
tokens, the mean of its strongest tokens and its length; a logistic fit makes these a probability. The fit uses
a fourth of the labelled rows, which the counts leave out.

The models are fitted on at most about ``max_docs`` labelled rows per class,
drawn by a hash of the id, and keep at most about ``max_terms`` words, pairs and
beginnings each, the commonest. That bounds the model, which is broadcast, to
about 100 MB. Scoring reads whole texts of all rows, piece by piece.

Cases: a null text is empty; an empty text has no evidence and gets the score of
that; labels of null ids, null labels and labels without a document are not used,
several labels of an id count as toxic if one is; without rows of both
classes the score is 1 if only toxic rows are known, else 0. Repeated rows score alike. All
columns are kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import fresh

MAX_DOCS = 8000
MAX_TERMS = 200_000
# Numbers of neighbouring tokens, of strongest tokens, and of letters that a beginning has.
WIDTHS = (1, 4, 20)
TOP = 3
LENGTHS = (5,)
DISCOUNT = 0.75
RIDGE = 1e-3
PIECE = 1 << 20
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W_]+")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A text in pieces of about ``size`` characters, cut between words."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and (text[end].isalnum() or text[end - 1].isalnum()):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def tokens(text: str | None) -> Iterator[list[str]]:
    for piece in pieces(text or ""):
        yield _WORD.findall(piece.lower())


@dataclass
class Model:
    """Evidence, toxic minus ordinary log-likelihood, by word, beginning and pair. Word 0 is the unknown one."""

    words: dict[str, int]
    word_llr: np.ndarray
    starts: list[dict[str, float]]
    unknown: float
    context_llr: np.ndarray
    pairs: np.ndarray
    pair_llr: np.ndarray
    only: float = 0.0
    word_p: np.ndarray | None = None
    weights: np.ndarray | None = None
    center: np.ndarray | None = None
    scale: np.ndarray | None = None

    def start(self, word: str) -> float:
        """Evidence of the longest known beginning of an unknown word."""
        for length, known in zip(LENGTHS, self.starts):
            found = known.get(word[:length])
            if found is not None:
                return found
        return self.unknown

    def evidence(self, text: str | None) -> np.ndarray:
        ids, llrs = [np.zeros(0, np.int64)], [np.zeros(0)]
        for found in tokens(text):
            index = np.fromiter((self.words.get(w, 0) for w in found), np.int64, len(found))
            llr = self.word_llr[index]
            rare = np.flatnonzero(index == 0)
            llr[rare] = [self.start(found[i]) for i in rare.tolist()]
            ids.append(index)
            llrs.append(llr)
        word, llr = np.concatenate(ids), np.concatenate(llrs)
        if not len(word):
            return llr
        before = np.concatenate([[0], word[:-1]])
        key = before * len(self.word_llr) + word
        place = np.searchsorted(self.pairs, key).clip(max=len(self.pairs) - 1)
        seen = (self.pairs[place] == key) & (before > 0) & (word > 0)
        return np.where(seen, self.pair_llr[place], llr + self.context_llr[before])

    def features(self, text: str | None) -> np.ndarray:
        llr = self.evidence(text)
        if not len(llr):
            return np.zeros(len(WIDTHS) + 3)
        sums = np.concatenate([[0.0], np.cumsum(llr)])
        widths = [(w, min(w, len(llr))) for w in WIDTHS]
        top = [(sums[n:] - sums[:-n]).max() / w for w, n in widths]
        few = np.partition(llr, -min(TOP, len(llr)))[-TOP:].sum() / TOP
        return np.array([sums[-1] / len(llr), *top, few, np.log1p(len(llr))])

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.only
        x = (self.features(text) - self.center) / self.scale
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -500, 500))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE, steps: int = 50) -> np.ndarray:
    """Newton's method with a small ridge; the first weight is the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w, weight = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        # A step of bounded length keeps separable classes from running off.
        w -= step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(
    docs: DataFrame, labels: DataFrame, max_docs: int, doc_id: str, text: str, label: str
) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of the sampled rows, written, and the number of labels per class.

    Ids are drawn by hash before any text is read; at most about 2 * max_docs of them are broadcast.
    """
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_toxic"))
    sizes = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    span = 1 << 30
    rate = F.lit(0)
    for c, n in sizes.items():
        rate = F.when(F.col("_toxic") == c, int(span * min(1.0, max_docs / n))).otherwise(rate)
    drawn = known.filter(F.pmod(F.xxhash64("_id"), F.lit(span)) < rate)
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return written(rows.join(F.broadcast(drawn), "_id").select("_text", "_toxic")), sizes


def _pair_counts(sample: DataFrame) -> DataFrame:
    """For neighbouring words v, w the number of different words before them, per class; no word is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: set = set()
            for text, toxic in zip(batch["_text"], batch["_toxic"]):
                u = v = ""
                for words in tokens(text):
                    line = [u, v, *words]
                    found.update(zip(line, line[1:], words, [int(toxic)] * len(words)))
                    u, v = line[-2], line[-1]
                    if len(found) > 500_000:
                        yield rows(found)
                        found = set()
            yield rows(found)

    def rows(found: set) -> pd.DataFrame:
        return pd.DataFrame([(zlib.crc32(u.encode()), v, w, c) for u, v, w, c in found], columns=["u", "v", "w", "c"])

    seen = sample.mapInPandas(run, "u bigint, v string, w string, c int").groupBy("u", "v", "w").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi")
    )
    return seen.groupBy("v", "w").agg(F.sum(1 - F.col("lo")).alias("n0"), F.sum("hi").alias("n1"))


def _commonest(df: DataFrame, most: int) -> DataFrame:
    """Rows counted twice or more, or still more often if those are more than ``most``."""
    sums = df.withColumn("_n", F.col("n0") + F.col("n1")).filter("_n >= 2")
    capped = sums.groupBy(F.least("_n", F.lit(10_000)).alias("_n")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sorted((r["_n"], r["n"]) for r in capped.collect())
    least, kept = 2, sum(n for _, n in sizes)
    for value, n in sizes:
        if kept <= most:
            break
        kept, least = kept - n, value + 1
    return sums.filter(F.col("_n") >= least).drop("_n")


def _sums(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per class the sum of the counts, and the number of rows that have one."""
    r = df.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n0", "n1")],
        *[F.count(F.when(F.col(c) > 0, 1)).alias("t" + c[1]) for c in ("n0", "n1")],
    ).first()
    return np.maximum(1.0, [r["n0"], r["n1"]]), np.maximum(1.0, [r["t0"], r["t1"]])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_docs: int = MAX_DOCS,
    max_terms: int = MAX_TERMS,
) -> Model:
    """Fit both models and the calibration on the labelled rows."""
    sample, sizes = labelled_sample(docs, labels, max_docs, doc_id, text, label)
    # Equal texts stay on one side.
    aside = F.pmod(F.xxhash64("_text"), F.lit(4)) == 0
    pairs = written(_pair_counts(sample.filter(~aside)))
    words = written(
        pairs.groupBy("w").agg(
            F.count(F.when(F.col("n0") > 0, 1)).alias("n0"),
            F.count(F.when(F.col("n1") > 0, 1)).alias("n1"),
            F.count(F.lit(1)).alias("shared"),
        )
    )
    lengths = F.array(*[F.lit(n) for n in LENGTHS])
    starts = words.select(F.explode(lengths).alias("length"), "w", "n0", "n1", "shared")
    starts = written(
        starts.groupBy("length", F.expr("substring(w, 1, length)").alias("w")).agg(
            *[F.sum(c).alias(c) for c in ("n0", "n1", "shared")]
        )
    )
    model = Model({}, np.zeros(1), [], 0.0, np.zeros(1), np.array([-1]), np.zeros(1), float(set(sizes) == {1}))
    _word_levels(model, words, starts, max_terms)
    _pair_level(model, pairs, max_terms)
    if len(sizes) == 2:
        _calibrate(model, sample.filter(aside), sizes)
    return model


def _word_levels(model: Model, words: DataFrame, starts: DataFrame, max_terms: int) -> None:
    """Probabilities of beginnings from the shortest to the longest, then of words."""
    total, _ = _sums(words)
    below: dict[str, tuple[np.ndarray, float]] = {}
    everything = float(words.agg(F.sum("shared").alias("n")).first()["n"] or 1)
    bias, levels = np.zeros(0), []
    kept = _commonest(starts, max_terms).toPandas()
    for length in reversed(LENGTHS):
        _, types = _sums(starts.filter(F.col("length") == length))
        rows = kept[kept["length"] == length]
        below = _level(rows, below, total, types, everything, shorter(length))
        levels.append((below, np.log(DISCOUNT * types / total)))
    _, types = _sums(words)
    rows = _commonest(words, max_terms).toPandas().sort_values("w")
    last = _level(rows, below, total, types, everything, LENGTHS[0])
    bias = np.log(DISCOUNT * types / total)
    model.words = {w: i + 1 for i, w in enumerate(last)}
    model.word_p = np.array([[1.0, 1.0], *[p for p, _ in last.values()]])
    model.word_llr = np.log(model.word_p[:, 1]) - np.log(model.word_p[:, 0])
    for level, own in reversed(levels):
        # What a longer beginning would have added is shared out: the same for all unknown words.
        model.starts.append({w: float(np.log(p[1] / p[0]) + bias[1] - bias[0]) for w, (p, _) in level.items()})
        bias = bias + own
    model.unknown = float(bias[1] - bias[0])


def shorter(length: int) -> int:
    """The next shorter beginning; 0 after the shortest."""
    return next((n for n in LENGTHS if n < length), 0)


def _level(
    rows: pd.DataFrame, below: dict[str, tuple[np.ndarray, float]], total: np.ndarray, types: np.ndarray, everything: float, length: int
) -> dict[str, tuple[np.ndarray, float]]:
    """Interpolated probabilities per class, and the shared count, of every row."""
    root = (np.ones(2), everything)
    out = {}
    for w, n0, n1, shared in zip(rows["w"], rows["n0"], rows["n1"], rows["shared"]):
        p, mass = below.get(w[:length], root)
        own = np.maximum(0.0, np.array([n0, n1]) - DISCOUNT) / total
        out[w] = (own + DISCOUNT * types / total * p * (shared / mass), float(shared))
    return out


def _pair_level(model: Model, pairs: DataFrame, max_terms: int) -> None:
    follow = pairs.groupBy("v").agg(
        *[F.sum(c).alias(c) for c in ("n0", "n1")], *[F.count(F.when(F.col("n" + c) > 0, 1)).alias("t" + c) for c in "01"]
    )
    size = len(model.word_llr)
    tokens_after, rest = np.zeros((size, 2)), np.ones((size, 2))
    rows = _commonest(follow, max_terms).toPandas()
    place = np.array([model.words.get(v, 0) for v in rows["v"]], np.int64)
    tokens_after[place] = rows[["n0", "n1"]].to_numpy(float).reshape(-1, 2)
    types = rows[["t0", "t1"]].to_numpy(float).reshape(-1, 2)
    # A word that a class has never seen before another leaves all to the level below.
    rest[place] = np.where(tokens_after[place] > 0, DISCOUNT * types / np.maximum(1, tokens_after[place]), 1.0)
    rest[0] = 1.0
    model.context_llr = np.log(rest[:, 1]) - np.log(rest[:, 0])
    rows = _commonest(pairs, max_terms).toPandas()
    v = np.array([model.words.get(x, 0) for x in rows["v"]], np.int64)
    w = np.array([model.words.get(x, 0) for x in rows["w"]], np.int64)
    n = rows[["n0", "n1"]].to_numpy(float).reshape(-1, 2)
    p = np.maximum(0, n - DISCOUNT) / np.maximum(1, tokens_after[v]) + rest[v] * model.word_p[w]
    order = np.argsort(v * size + w, kind="stable")
    model.pairs = np.concatenate([[-1], (v * size + w)[order]])
    model.pair_llr = np.concatenate([[0.0], (np.log(p[:, 1]) - np.log(p[:, 0]))[order]])


def _calibrate(model: Model, sample: DataFrame, sizes: dict[int, int]) -> None:
    """Logistic fit on rows outside the counts, weighted to the classes' true shares."""
    known = sample.sparkSession.sparkContext.broadcast(model)
    names = [f"x{i}" for i in range(len(WIDTHS) + 3)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([known.value.features(t) for t in batch["_text"]]).reshape(-1, len(names))
            yield pd.DataFrame(x, columns=names).assign(y=batch["_toxic"].to_numpy())

    rows = sample.mapInPandas(run, ", ".join(f"{n} double" for n in names) + ", y int").toPandas().sort_values(["y", *names])
    known.unpersist()
    x, y = rows[names].to_numpy(float), rows["y"].to_numpy(float)
    if min((y == c).sum() for c in (0, 1)) == 0:
        return
    model.center, model.scale = x.mean(axis=0), np.maximum(1e-6, x.std(axis=0))
    weight = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum())
    model.weights = logistic((x - model.center) / model.scale, y, weight)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability that a text is toxic."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([known.value.score(t) for t in texts], dtype="float64")

    return docs.withColumn(name, run(F.coalesce(F.col(text), F.lit(""))))


def reject(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD, **parameters: str | int) -> DataFrame:
    """The documents that score below ``threshold``, with their columns."""
    name = fresh(docs, "_score")
    scored = score(docs, fit(docs, labels, text=text, **parameters), text, name)
    return scored.filter(F.col(name) < threshold).drop(name)
