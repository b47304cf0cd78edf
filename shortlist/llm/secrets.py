"""Secret scan: three patterns, and a character convolutional network over all other candidates.

A candidate is a run of ``MIN_VALUE`` or more of the characters that keys are
made of, unless it looks like plain words: letters with full stops or hyphens, small or capitalised, and fewer than ``LONG`` of
them in all. Shorter runs are left to the patterns: words with a digit are so many among them that the network, trained with
them, no longer finds keys a little shorter than those of the patterns. The network sees the candidate and its
surroundings as classes of characters: one convolution of width ``KERNEL``,
the largest and the mean response of each filter, and a logistic unit. Long candidates are
read in overlapping windows, of which the most suspicious counts. It is
trained with numpy, side by side on Spark, on findings of the corpus: candidates that a
pattern labels as secrets, against those that none does. Each is shown once
with its surroundings and once without, so that the shape of a value alone must do as well.

Probabilities are calibrated on rows that were not trained on, and the threshold
is a half, or lower if it takes that to recall ``RECALL`` of the labelled
findings there. Candidates above it that do not lie within the patterns' findings are added as
kind ``cnn``; one that reaches beyond a finding is judged as a whole.

The fit takes all different candidates of the corpus. They are dealt by hash into parts of about ``PART_ROWS``; in each
epoch every part takes its steps from the same weights, and the weights and moments of all parts are averaged. Calibration and
threshold come from all candidates that were set aside, one in four by hash. The network has a few thousand weights.

Cases: a null text is empty and has no finding; repeated rows have the same
findings; without labelled findings of both classes only the patterns count.
All columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

# Patterns of the contract.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = (b"passw", b"secret", b"token", b"api")
KINDS = ("assign", "access", "hex", "cnn")

MIN_VALUE, LONG = 12, 24
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_VALUE)
# A digit or sign that words lack, a capital after a small letter or another capital, or many characters.
SHAPE = re.compile(r"[0-9+/_=]|[a-z].*[A-Z]|[A-Z]{2}|.{%d}" % LONG)
BEFORE, VALUE, AFTER = 32, 64, 16
KERNEL, FILTERS = 5, 24
# Findings that a task trains on by itself, between two averages of the networks.
PART_ROWS = 4000
RECALL = 0.99
EPOCHS, BATCH, RATE, SEED = 12, 128, 0.01, 7
CHUNK = 512

# Classes of characters: each of these strings, then the rest of ASCII, then all beyond.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", " ", "\n\r\t", "\"'`", "=", ":", "+/", "_", "-", ".", "@", ",;", "()[]{}<>")
_PAD = len(CLASSES) + 2
_CLASS = np.full(256, len(CLASSES), np.int64)
_CLASS[128:] = len(CLASSES) + 1
for _n, _chars in enumerate(CLASSES):
    _CLASS[[ord(c) for c in _chars]] = _n
_LENGTH = BEFORE + VALUE + AFTER
# One more channel says which characters belong to the candidate.
_CHANNELS = _PAD + 1

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Findings of the patterns; the checks before each only save time."""
    raw = text.encode()
    low, spans = raw.lower(), []
    if any(k in low for k in KEYWORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    # Runs are maximal, so asking for the length at once finds the same.
    spans += [("hex", *m.span()) for m in HEX_RUN.finditer(text)]
    return spans


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if SHAPE.search(m[0])]


def touches(span: tuple[int, int], spans: list[Span]) -> bool:
    return any(a < span[1] and span[0] < b for _, a, b in spans)


def within(span: tuple[int, int], spans: list[Span]) -> bool:
    """Whether every character of a span lies in one of ``spans``."""
    at = span[0]
    for a, b in sorted((a, b) for _, a, b in spans if a < span[1] and span[0] < b):
        if a > at:
            return False
        at = max(at, b)
    return at >= span[1]


def windows(text: str, start: int, end: int) -> list[tuple[str, str, str]]:
    """Surroundings and value of a candidate, in windows that overlap by half."""
    out = []
    for at in range(start, max(start + 1, end - VALUE // 2), VALUE // 2):
        stop = min(end, at + VALUE)
        out.append((text[max(0, at - BEFORE) : at], text[at:stop], text[stop : stop + AFTER]))
    return out


def encode(rows: list[tuple[str, str, str]]) -> np.ndarray:
    """Windows as indicator rows of shape (rows, characters, channels)."""
    out = np.zeros((len(rows), _LENGTH, _CHANNELS), np.float32)
    for r, (before, value, after) in enumerate(rows):
        text = before.rjust(BEFORE, "\0") + value.ljust(VALUE, "\0") + after.ljust(AFTER, "\0")
        codes = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
        classes = np.where(codes == 0, _PAD - 1, _CLASS[codes])
        out[r, np.arange(_LENGTH), classes] = 1
        out[r, BEFORE : BEFORE + len(value), _CHANNELS - 1] = 1
    return out


@dataclass
class Network:
    kernel: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    constant: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def forward(self, x: np.ndarray) -> tuple:
        columns = np.lib.stride_tricks.sliding_window_view(x, KERNEL, axis=1)
        columns = columns.transpose(0, 1, 3, 2).reshape(len(x), -1, KERNEL * _CHANNELS)
        response = np.maximum(0, columns @ self.kernel + self.bias)
        pooled = np.concatenate([response.max(axis=1), response.mean(axis=1)], axis=1)
        return columns, response, pooled, pooled @ self.dense + self.constant[0]

    def gradients(self, columns: np.ndarray, response: np.ndarray, pooled: np.ndarray, error: np.ndarray) -> list[np.ndarray]:
        """Of a loss by kernel, bias, dense and constant, from its derivative by each logit."""
        back = error[:, None] * self.dense
        flow = np.repeat(back[:, None, FILTERS:] / response.shape[1], response.shape[1], axis=1)
        top = response.argmax(axis=1)
        flow[np.arange(len(error))[:, None], top, np.arange(FILTERS)] += back[:, :FILTERS]
        flow *= response > 0
        return [np.tensordot(columns, flow, axes=([0, 1], [0, 1])), flow.sum(axis=(0, 1)), pooled.T @ error, error.sum(keepdims=True)]

    def logits(self, rows: list[tuple[str, str, str]]) -> np.ndarray:
        parts = [self.forward(encode(rows[i : i + CHUNK]))[3] for i in range(0, len(rows), CHUNK)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probabilities(self, rows: list[tuple[str, str, str]]) -> np.ndarray:
        return _sigmoid(self.scale * self.logits(rows) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def started(seed: int = SEED) -> Network:
    """The network before training."""
    rng = np.random.default_rng(seed)
    return Network(
        rng.normal(0, 0.2, (KERNEL * _CHANNELS, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.2, 2 * FILTERS), np.zeros(1)
    )


def epoch(state: np.ndarray, rows: list[tuple[str, str, str]], y: np.ndarray, shares: tuple[float, float], steps: int, seed: int) -> tuple[np.ndarray, int]:
    """One pass of Adam over ``rows`` from a packed state, on the log loss with the classes weighted by ``shares``; the new state and steps."""
    rng = np.random.default_rng(seed)
    net, first, second = unpacked(state)
    values = [net.kernel, net.bias, net.dense, net.constant]
    x, weight, order = encode(rows), np.where(y == 1, shares[1], shares[0]), rng.permutation(len(y))
    for at in range(0, len(y), BATCH):
        pick = order[at : at + BATCH]
        columns, response, pooled, z = net.forward(x[pick])
        error = weight[pick] * (_sigmoid(z) - y[pick]) / len(pick)
        grads = net.gradients(columns, response, pooled, error)
        steps += 1
        for v, g, m, s in zip(values, grads, first, second):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(s / (1 - 0.999**steps)) + 1e-8)
    return np.concatenate([v.ravel() for v in (*values, *first, *second)]), steps


def unpacked(state: np.ndarray) -> tuple[Network, list[np.ndarray], list[np.ndarray]]:
    """The network and both moments of its weights from one row of numbers."""
    shapes = [(KERNEL * _CHANNELS, FILTERS), (FILTERS,), (2 * FILTERS,), (1,)]
    cuts = np.cumsum([int(np.prod(s)) for s in shapes] * 3)[:-1]
    parts = [p.reshape(s).copy() for p, s in zip(np.split(state, cuts), shapes * 3)]
    return Network(*parts[:4]), parts[4:8], parts[8:]


def train(found: DataFrame, counts: dict[int, int]) -> Network:
    """Epochs over all findings (part, before, value, after, y), side by side in the parts, whose networks are averaged after each."""
    net = started()
    weights = np.concatenate([v.ravel() for v in (net.kernel, net.bias, net.dense, net.constant)])
    state, steps, total = np.concatenate([weights, np.zeros(2 * len(weights))]), 0, sum(counts.values())
    shares = total * 0.5 / counts[0], total * 0.5 / counts[1]
    for turn in range(EPOCHS):
        moved = found.groupBy("part").applyInPandas(_stepper(state, shares, steps, turn), "place int, value double, n double")
        moved = moved.groupBy("place").agg((F.sum("value") / F.sum("n")).alias("value")).toPandas().sort_values("place")
        state, steps = moved["value"].to_numpy()[:-1], int(round(moved["value"].iloc[-1]))
    return unpacked(state)[0]


def _stepper(state: np.ndarray, shares: tuple[float, float], steps: int, turn: int):
    """What a part does in an epoch: its new state, the steps at the last place, weighted by its number of rows."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows, part = rows.sort_values(["h", "before", "value", "after", "y"]), int(rows["part"].iloc[0])
        new, done = epoch(state, *both(rows), shares, steps, SEED + EPOCHS * part + turn)
        new, n = np.append(new, done), float(len(rows))
        return pd.DataFrame({"place": np.arange(len(new)), "value": n * new, "n": n})

    return run


def calibrate(net: Network, found: DataFrame, recall: float = RECALL) -> None:
    """Fit scale and shift of the logits, then a threshold of even odds, or the highest that keeps the recall; on all rows of ``found``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, y = both(batch)
            yield pd.DataFrame({"z": net.logits(rows), "y": y})

    scored = written(found.select("before", "value", "after", "y").mapInPandas(run, "z double, y double"))
    n = {int(r["y"]): r["n"] for r in scored.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    target = F.when(F.col("y") == 1, F.lit((n[1] + 1) / (n[1] + 2))).otherwise(F.lit(1 / (n[0] + 2)))
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.lit(float(w[0])) * F.col("z") + F.lit(float(w[1]))))))
        part, bend = scored.select("z", (p - target).alias("e"), (p * (1 - p)).alias("b")), F.col("b")
        sums = part.agg(F.sum(F.col("e") * F.col("z")), F.sum("e"), F.sum(bend * F.col("z") * F.col("z")), F.sum(bend * F.col("z")), F.sum(bend)).first()
        grad = np.array(sums[:2]) + 1e-3 * (w - [1.0, 0.0])
        step = np.linalg.solve(np.array([[sums[2], sums[3]], [sums[3], sums[4]]]) + 1e-3 * np.eye(2), grad)
        w -= step * min(1.0, 2 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    net.scale, net.shift = float(max(1e-3, w[0])), float(w[1])
    # The labelled finding at which the recall ends, by a sort of all of them.
    place = int(np.floor((1 - recall) * n[1]))
    ranked = scored.filter("y = 1").select("z").orderBy("z").rdd.zipWithIndex()
    z = ranked.filter(lambda r: r[1] == place).map(lambda r: r[0]["z"]).first()
    net.threshold = float(min(0.5, _sigmoid(np.array([net.scale * z + net.shift]))[0]))


def findings(docs: DataFrame, text: str) -> DataFrame:
    """All different candidates (h, before, value, after, y) of the texts; ``h`` is a hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = set()
            for value in batch["text"]:
                spans = base_spans(value)
                for a, b in candidates(value):
                    rows.add((*windows(value, a, b)[0], int(touches((a, b), spans))))
            yield pd.DataFrame(sorted(rows), columns=["before", "value", "after", "y"])

    found = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(run, "before string, value string, after string, y int")
    return found.distinct().withColumn("h", F.xxhash64("before", "value", "after"))


def both(rows: pd.DataFrame) -> tuple[list[tuple[str, str, str]], np.ndarray]:
    """Findings with their surroundings, then without, and their classes."""
    own, y = list(zip(rows["before"], rows["value"], rows["after"])), rows["y"].to_numpy(float)
    return own + [("", v, "") for _, v, _ in own], np.concatenate([y, y])


def fit(docs: DataFrame, text: str = "text", part_rows: int = PART_ROWS) -> Network | None:
    """The network, trained and calibrated on all findings; ``part_rows`` is about the number that a task trains on by itself."""
    found = written(findings(docs, text).withColumn("aside", F.pmod("h", F.lit(4)) == 0))
    sizes = {(r["y"], r["aside"]): r["n"] for r in found.groupBy("y", "aside").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any((c, aside) not in sizes for c in (0, 1) for aside in (True, False)):
        return None
    counts = {c: sizes[c, False] for c in (0, 1)}
    parts = max(1, round(sum(counts.values()) / part_rows))
    # Bits of the hash beside those that say what is set aside.
    dealt = found.filter(~F.col("aside")).withColumn("part", F.pmod(F.shiftright("h", 2), F.lit(parts)))
    net = train(dealt.repartition(parts, "part"), counts)
    calibrate(net, found.filter("aside"))
    return net


RESULT = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _scanner(known: Broadcast):
    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = known.value
        for texts in batches:
            found, asked, rows = [], [], []
            for n, text in enumerate(texts):
                spans = base_spans(text)
                found.append([(a, KINDS.index(k), b, 1.0) for k, a, b in spans])
                for a, b in candidates(text) if net is not None else ():
                    if not within((a, b), spans):
                        own = windows(text, a, b)
                        asked += [(n, a, b)] * len(own)
                        rows += own
            best: dict[tuple[int, int, int], float] = {}
            for key, p in zip(asked, net.probabilities(rows).tolist() if rows else ()):
                best[key] = max(p, best.get(key, 0.0))
            for (n, a, b), p in best.items():
                if p >= net.threshold:
                    found[n].append((a, KINDS.index("cnn"), b, p))
            yield pd.Series(
                [[{"kind": KINDS[k], "start": a, "end": b, "score": p} for a, k, b, p in sorted(row)] for row in found], dtype=object
            )

    return run


def scan(docs: DataFrame, text: str = "text", name: str = "secrets", net: Network | None = None) -> DataFrame:
    """Add the list of findings by start, then kind; the network is fitted on ``docs`` if none is given."""
    net = fit(docs, text) if net is None else net
    known = docs.sparkSession.sparkContext.broadcast(net)
    return docs.withColumn(name, _scanner(known)(F.coalesce(F.col(text), F.lit(""))))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
