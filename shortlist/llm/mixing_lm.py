"""Language-model scores by online logistic context mixing.

The model predicts a text bit by bit. A predictor looks up the counts of zeros
and ones seen after its context and the bits of the current byte so far in a
hashed table. There is one for the last 0 to ``ORDERS - 1`` bytes each, and one
for the word so far, of which the last ``WORD`` bytes count. The predictions, as logits, are
mixed by weights; a gate, the bit's place, the longest context of bytes that is known and how well it and
the word so far are, chooses the weight set. While a text is read its weight sets are refined: after every
``STEP`` bytes the sets are scaled by an online Newton step on the loss of the bytes read, so that a
text with much of its own kind is soon trusted less or more. The sum over all bits,
with an end mark, is the log-probability of the text.

Fitting gathers the counts of all byte sequences, each a byte after its contexts, from all training
texts. The table has up to 2^``MAX_BITS`` slots of two one-byte counts, exact up to 32 and
logarithmic above, and grows with the number of sequences until then, which bounds
the broadcast to 32 MB. Every sequence counts in every context: none is left out, beyond the bound more of them share a slot.
The weights are fitted by Newton steps on sums over all
sequences, each counted without one occurrence of itself. Within a
batch of texts a sequence is evaluated once, however often it stands there.

The base is a smoothed word model. Its counts are an unbounded table, so only
the ``COMMON`` commonest words are looked up in memory; the others are joined.

Texts are lower-cased in A-Z first, for both models. Cases: a null text is empty; an empty
text is its end mark; a null id counts as the empty text when rows are held out; repeated rows
score alike; without training rows all bits are even and the base is the bare smoothing. An empty table gives no
row. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, written

ORDERS = 6
WORD = 7
INPUTS = ORDERS + 1
# Counts from which a context is known a little, better and well.
LEVELS = (1, 4, 16)
GATES = ORDERS * (len(LEVELS) + 1) ** 2 * 8
MIN_BITS, MAX_BITS = 16, 24
SLOT_BLOCK = 1 << 16
PRIOR = 0.4
NEWTON_STEPS, RIDGE = 4, 1e-2
STEP = 512
# Weight of the fitted scale against what a text shows, and the limits of a text's own scale.
TRUST, SLOWEST, FASTEST = 200.0, 0.25, 4.0
CHUNK = 1 << 22
MAX_WORDS = 1 << 20
# Sequences whose evaluation a task remembers; 60 bytes each.
REMEMBERED = 1 << 21
COMMON = 1 << 16
SMOOTHING = 0.1
# Not a byte of UTF-8, and not a word.
END, END_WORD = b"\xff", b"\n"
EXACT, PER_LOG = 32, 9.0
_COUNT = np.arange(256, dtype=np.float32)
_COUNT[EXACT:] = EXACT * np.exp((_COUNT[EXACT:] - EXACT) / PER_LOG)
# Sequences that are evaluated at once, and places.
BLOCK, PLACES = 1 << 15, 1 << 13
# Bytes that stand between words; zero stands before a text.
_GAP = np.isin(np.arange(256), [0, 9, 10, 11, 12, 13, 32])
_LAST = np.array([(1 << 8 * (k + 1)) - 1 for k in range(WORD + 1)], np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD], np.uint64)


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case; ``bytes.lower`` and ``bytes.split`` know ASCII only."""
    return (text or "").encode().lower()


def sequences(data: bytes) -> np.ndarray:
    """At every place from WORD on, that byte and the word before it or the last ORDERS - 1 bytes, whichever is longer.

    A sequence is one number, zero where nothing counts.
    """
    codes = np.frombuffer(data, np.uint8)
    n = len(codes) - WORD
    place = np.arange(len(codes), dtype=np.int32)
    gap = np.maximum.accumulate(np.where(_GAP[codes], place, -1))
    # Bytes of the word before each place.
    depth = np.clip(place[WORD:] - 1 - gap[WORD - 1 : -1], ORDERS - 1, WORD)
    # Eight bytes from every place on, as one number each.
    window = np.ndarray((n,), ">u8", data, strides=(1,)).astype(np.uint64)
    return (window & _LAST[depth]).view(np.int64)


def segments(data: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """A text with its end mark in parts that overlap by the longest context, zeros before the first."""
    whole = bytes(WORD) + data + END
    for at in range(0, len(whole) - WORD, size):
        yield whole[at : at + size + WORD]


def coded(count: np.ndarray) -> np.ndarray:
    """Counts as bytes: exact up to EXACT, then by logarithm."""
    large = EXACT + np.log(np.maximum(count, EXACT) / EXACT) * PER_LOG
    return np.minimum(255, np.rint(np.where(count <= EXACT, count, large))).astype(np.uint8)


@dataclass
class Network:
    """Coded counts of zeros and ones per slot, and weights per gate and predictor."""

    bits: int
    zeros: np.ndarray
    ones: np.ndarray
    tables: tuple[np.ndarray, ...] | None = None
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, INPUTS), 1.0 / INPUTS))

    def slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots of shape (keys, predictors, 8), and the bits of the last byte."""
        keys = keys.view(np.uint64)
        before, byte = keys >> np.uint64(8), (keys & np.uint64(255)).astype(np.int64)
        place = np.arange(8)
        node = (1 << place) | (byte[:, None] >> (8 - place))
        bit = (byte[:, None] >> (7 - place)) & 1
        # Bytes of the word so far: up to the first gap, looking back.
        depth = np.full(len(keys), WORD)
        for k in range(WORD - 1, -1, -1):
            depth[_GAP[(before >> np.uint64(8 * k) & np.uint64(255)).astype(np.int64)]] = k
        contexts = [before & np.uint64((1 << 8 * order) - 1) for order in range(ORDERS)]
        contexts.append(before & ((np.uint64(1) << (8 * depth).astype(np.uint64)) - np.uint64(1)))
        out = np.empty((len(keys), INPUTS, 8), np.int64)
        step = node.astype(np.uint64) * _MIX[1]
        for i, context in enumerate(contexts):
            base = (context * _MIX[2] + np.uint64(i + 1)) * _MIX[0]
            mixed = ((base ^ base >> np.uint64(31))[:, None] + step) * _MIX[2]
            out[:, i] = ((mixed ^ mixed >> np.uint64(29)) * _MIX[0] >> np.uint64(64 - self.bits)).astype(np.int64)
        return out, bit

    def inputs(self, keys: np.ndarray, left_out: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Logits for the bits that came, (keys, predictors, 8), and the gates, (keys, 8).

        With ``left_out`` one occurrence of each sequence is taken out of its counts.
        """
        slots, bit = self.slots(keys)
        zeros, ones = _COUNT[self.zeros[slots]], _COUNT[self.ones[slots]]
        set_ = bit[:, None, :] == 1
        came, other = np.where(set_, ones, zeros), np.where(set_, zeros, ones)
        if left_out:
            came = np.maximum(0, came - 1)
        seen = came + other
        longest = np.maximum(0, ((seen[:, :ORDERS] > 0) * np.arange(1, ORDERS + 1)[:, None]).max(axis=1) - 1)
        deep = np.searchsorted(LEVELS, np.take_along_axis(seen, longest[:, None], axis=1)[:, 0], side="right")
        word = np.searchsorted(LEVELS, seen[:, ORDERS], side="right")
        gate = ((longest * (len(LEVELS) + 1) + deep) * (len(LEVELS) + 1) + word) * 8 + np.arange(8)
        return np.log((came + np.float32(PRIOR)) / (other + np.float32(PRIOR))), gate

    def ready(self) -> tuple[np.ndarray, ...]:
        """Tables by the two codes of a slot: the logit of a one, and the level of the sum. Made once per task."""
        if self.tables is None:
            zeros, ones = np.meshgrid(_COUNT, _COUNT, indexing="ij")
            logit = np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)))
            level = np.searchsorted(LEVELS, zeros + ones, side="right").astype(np.int8)
            pairs = self.zeros.astype(np.uint16) << 8 | self.ones
            self.tables = pairs, logit.ravel(), level.ravel(), self.weights.T.astype(np.float32).copy()
        return self.tables

    def mixed(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mixed logits for the bits that came, and the longest known order: ``inputs`` by table."""
        pairs, logit, level, weights = self.ready()
        slots, bit = self.slots(keys)
        codes = pairs[slots]
        levels = level[codes]
        # The level of the longest known order, with the orders below it counted in.
        deep = levels[:, 0].astype(np.int16)
        for order in range(1, ORDERS):
            deep = np.where(levels[:, order] > 0, levels[:, order] + np.int16(order * (len(LEVELS) + 1)), deep)
        gate = (deep * np.int16(len(LEVELS) + 1) + levels[:, ORDERS]) * np.int16(8) + np.arange(8, dtype=np.int16)
        mix = np.zeros(bit.shape, np.float32)
        for i in range(INPUTS):
            mix += logit[codes[:, i]] * weights[i][gate]
        # A text's own scale is at most FASTEST, so nothing overflows.
        return np.clip(np.where(bit == 1, mix, -mix), -20, 20), deep[:, 0] // (len(LEVELS) + 1)


class Reader:
    """Scores texts; each text refines its own scales of the weight sets."""

    def __init__(self, net: Network):
        self.net = net
        self.known = np.zeros(0, np.int64), np.zeros((0, 8), np.float32), np.zeros(0, np.int64), np.zeros(0, np.float32)

    def _evaluated(self, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """Logits, longest known orders and curvatures of sorted sequences; those read lately are remembered."""
        place = np.searchsorted(self.known[0], keys)
        found = np.flatnonzero(place < len(self.known[0]))
        found = found[self.known[0][place[found]] == keys[found]]
        new = np.ones(len(keys), bool)
        new[found] = False
        fresh = keys[new]
        parts = [self.net.mixed(fresh[i : i + BLOCK]) for i in range(0, len(fresh), BLOCK)]
        if parts:
            logits, orders = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            even = 1 / (1 + np.exp(logits))
            # The curvature at the fitted scale.
            bends = np.einsum("kb,kb->k", even * (1 - even), logits * logits)
            after = np.searchsorted(self.known[0], fresh)
            self.known = tuple(np.insert(a, after, b, axis=0) for a, b in zip(self.known, (fresh, logits, orders, bends)))
        place = np.searchsorted(self.known[0], keys)
        out = tuple(a[place] for a in self.known[1:])
        if len(self.known[0]) > REMEMBERED:
            self.known = tuple(a[:0] for a in self.known)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probabilities."""
        total = np.zeros(len(texts))
        group, size = [], 0
        for n, data in enumerate(texts):
            parts = segments(data)
            if len(data) >= CHUNK:
                state = np.ones((1, ORDERS)), np.zeros((1, ORDERS))
                for part in parts:
                    total[n] += self._read([part], state)[0]
                continue
            group.append((n, next(parts)))
            size += len(data)
            if size >= CHUNK:
                self._group(group, total)
                group, size = [], 0
        self._group(group, total)
        return total / math.log(10)

    def _group(self, group: list[tuple[int, bytes]], total: np.ndarray) -> None:
        if group:
            state = np.ones((len(group), ORDERS)), np.zeros((len(group), ORDERS))
            total[[n for n, _ in group]] += self._read([part for _, part in group], state)

    def _moved(self, logits: np.ndarray, code: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Losses and slopes by scale of the places, few at a time so that they stay in the processor's cache."""
        lost, push = np.empty(len(code), np.float32), np.empty(len(code), np.float32)
        for i in range(0, len(code), PLACES):
            at = slice(i, i + PLACES)
            z = logits[code[at]]
            odds = np.exp(z * -factor[at, None])
            total = odds + np.float32(1)
            odds /= total
            push[at] = np.einsum("kb,kb->k", odds, z)
            lost[at] = np.einsum("kb->k", np.log(total, out=total))
        return lost, push

    def _read(self, parts: list[bytes], state: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Natural log-probabilities of the parts; ``state`` holds scales and curvatures, and is brought up to date."""
        scale, curve = state
        lengths = np.array([len(p) - WORD for p in parts])
        keys = np.concatenate([sequences(p) for p in parts])
        # Different byte sequences are few, and each is evaluated once.
        codes, unique = pd.factorize(keys)
        del keys
        by_key = np.argsort(unique)
        rank = np.empty(len(unique), np.int32)
        rank[by_key] = np.arange(len(unique))
        codes = rank[codes]
        logits, orders, bends = self._evaluated(unique[by_key])
        text = np.repeat(np.arange(len(parts), dtype=np.int32), lengths)
        turn = np.concatenate([np.arange(n) // STEP for n in lengths]).astype(np.int16)
        # Places by turn: all first blocks, all second ones, and so on.
        order = np.argsort(turn, kind="stable")
        ends = np.cumsum(np.bincount(turn))
        out = np.zeros(len(parts))
        for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
            at = order[a:b]
            code, who = codes[at], text[at]
            cell = who.astype(np.int64) * ORDERS + orders[code]
            lost, push = self._moved(logits, code, scale.reshape(-1)[cell].astype(np.float32))
            out -= np.bincount(who, lost, len(parts))
            slope = np.bincount(cell, push, scale.size).reshape(scale.shape)
            curve += np.bincount(cell, bends[code], scale.size).reshape(scale.shape)
            scale += slope / (TRUST + curve)
            np.clip(scale, SLOWEST, FASTEST, out=scale)
        return out


def _partials(docs: DataFrame, text: str) -> DataFrame:
    """Counts of words and of byte sequences, summed per batch; one of both columns is null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words: Counter = Counter()
            pending, size, sums = [], 0, []
            for value in batch["text"]:
                data = lowered(value)
                words.update(data.split())
                words[END_WORD] += 1
                if len(words) > MAX_WORDS:
                    yield word_rows(words)
                    words = Counter()
                for part in segments(data):
                    pending.append(sequences(part))
                    size += len(pending[-1])
                    if size >= CHUNK:
                        sums.append(counted(pending, None))
                        pending, size = [], 0
            if pending:
                sums.append(counted(pending, None))
            yield word_rows(words)
            if sums:
                keys, n = counted([k for k, _ in sums], [n for _, n in sums])
                yield pd.DataFrame({"word": [None] * len(keys), "key": pd.array(keys, "Int64"), "n": n})

    def counted(keys: list[np.ndarray], n: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        codes, unique = pd.factorize(np.concatenate(keys))
        weight = None if n is None else np.concatenate(n)
        return unique, np.bincount(codes, weight, len(unique)).astype(np.int64)

    def word_rows(words: Counter) -> pd.DataFrame:
        return pd.DataFrame(
            {"word": list(words), "key": pd.array([None] * len(words), "Int64"), "n": np.fromiter(words.values(), np.int64, len(words))}
        )

    source = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    return source.mapInPandas(run, "word binary, key bigint, n bigint")


def _least(counts: DataFrame, column: str, most: int) -> int:
    """The smallest count that at most ``most`` rows reach."""
    sizes = counts.groupBy(F.least(column, F.lit(100_000)).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    found = sorted((r["n"], r["rows"]) for r in sizes.collect())
    least, kept = 1, sum(n for _, n in found)
    for value, n in found:
        if kept <= most:
            break
        kept, least = kept - n, value + 1
    return least


def fit_network(counts: DataFrame) -> Network:
    """Counts and weights from (key, n) of all byte sequences of the training texts."""
    number = counts.count()
    # Slots for the contexts and bits of the sequences, up to the bound.
    bits = min(MAX_BITS, max(MIN_BITS, (16 * max(1, number)).bit_length()))
    net = Network(bits, np.zeros(1 << bits, np.uint8), np.zeros(1 << bits, np.uint8))
    shape = Network(bits, np.zeros(0), np.zeros(0))

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, 1 << bits), np.float32)
        for batch in batches:
            keys, n = batch["key"].to_numpy(np.int64), batch["n"].to_numpy(np.float64)
            for at in range(0, len(keys), BLOCK):
                slots, bit = shape.slots(keys[at : at + BLOCK])
                weight = np.broadcast_to(n[at : at + BLOCK, None, None], slots.shape)
                codes, used = pd.factorize(slots.ravel())
                for value in (0, 1):
                    sums[value, used] += np.bincount(codes, (weight * (bit == value)[:, None, :]).ravel(), len(used)).astype(np.float32)
        used = np.flatnonzero(sums.any(axis=0))
        yield pd.DataFrame({"slot": used, "zeros": sums[0, used], "ones": sums[1, used]})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed: dict[int, np.ndarray] = {}
        for batch in batches:
            block, place = batch["slot"].to_numpy() // SLOT_BLOCK, batch["slot"].to_numpy() % SLOT_BLOCK
            codes = coded(batch["zeros"].to_numpy()), coded(batch["ones"].to_numpy())
            for one in np.unique(block).tolist():
                own, at = packed.setdefault(one, np.zeros((2, SLOT_BLOCK), np.uint8)), block == one
                own[0, place[at]], own[1, place[at]] = codes[0][at], codes[1][at]
        yield pd.DataFrame([(k, v[0].tobytes(), v[1].tobytes()) for k, v in packed.items()], columns=["block", "zeros", "ones"])

    slots = counts.mapInPandas(tally, "slot bigint, zeros double, ones double")
    slots = slots.groupBy("slot").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    blocks = slots.repartition((F.col("slot") / SLOT_BLOCK).cast("bigint")).mapInPandas(pack, "block bigint, zeros binary, ones binary")
    # At most 2^MAX_BITS slots of two bytes come to the driver, from a table, so that the sums of the slots are not kept on disk.
    blocks = written(blocks)
    for r in blocks.toLocalIterator():
        at = slice(r["block"] * SLOT_BLOCK, (r["block"] + 1) * SLOT_BLOCK)
        net.zeros[at], net.ones[at] = np.frombuffer(r["zeros"], np.uint8), np.frombuffer(r["ones"], np.uint8)
    discard(blocks)
    if number:
        _fit_weights(net, counts)
    return net


def _fit_weights(net: Network, counts: DataFrame) -> None:
    """Newton steps on the log loss of all sequences; per step each task sends sums of fixed size."""
    context = counts.sparkSession.sparkContext
    pairs = [(i, j) for i in range(INPUTS) for j in range(i + 1)]
    size = INPUTS + len(pairs)
    tables = context.broadcast((net.bits, net.zeros, net.ones))
    first, second = (list(c) for c in zip(*pairs))
    for _ in range(NEWTON_STEPS):
        weights = net.weights

        def run(batches: Iterator[pd.DataFrame], weights=weights) -> Iterator[pd.DataFrame]:
            own, sums = Network(*tables.value, weights), np.zeros((GATES, size))
            for batch in batches:
                keys, n = batch["key"].to_numpy(np.int64), batch["n"].to_numpy(np.float64)
                for at in range(0, len(keys), BLOCK):
                    logit, gate = own.inputs(keys[at : at + BLOCK], left_out=True)
                    # By gate, so that the sums of one are products of matrices.
                    order = np.argsort(gate.ravel().astype(np.int16), kind="stable")
                    x = logit.transpose(0, 2, 1).reshape(-1, INPUTS)[order].astype(np.float64)
                    gate, n8 = gate.ravel()[order], np.repeat(n[at : at + BLOCK], 8)[order]
                    miss = 1 / (1 + np.exp(np.clip(np.einsum("ki,ki->k", x, weights[gate]), -60, 60)))
                    pull, bent = n8 * miss, x * (n8 * miss * (1 - miss))[:, None]
                    ends = np.cumsum(np.bincount(gate, minlength=GATES))
                    for g in np.unique(gate).tolist():
                        own_rows = slice(ends[g - 1] if g else 0, ends[g])
                        sums[g, :INPUTS] += pull[own_rows] @ x[own_rows]
                        sums[g, INPUTS:] += (bent[own_rows].T @ x[own_rows])[first, second]
            gates, parts = np.indices(sums.shape)
            yield pd.DataFrame({"gate": gates.ravel(), "part": parts.ravel(), "value": sums.ravel()})

        found = counts.mapInPandas(run, "gate int, part int, value double").groupBy("gate", "part").agg(F.sum("value").alias("value"))
        total = np.zeros((GATES, size))
        rows = found.toPandas()
        total[rows["gate"], rows["part"]] = rows["value"]
        slope, bend = total[:, :INPUTS], np.zeros((GATES, INPUTS, INPUTS))
        for k, (i, j) in enumerate(pairs):
            bend[:, i, j] = bend[:, j, i] = total[:, INPUTS + k]
        step = np.linalg.solve(bend + RIDGE * np.eye(INPUTS), slope[..., None])[..., 0]
        net.weights = weights + step * np.minimum(1.0, 1.0 / np.maximum(1e-12, np.abs(step).max(axis=1, keepdims=True)))
        if np.abs(step).max() < 1e-3:
            break
    tables.unpersist()


def _common(words: DataFrame) -> dict[bytes, int]:
    """The commonest words with their counts, at most COMMON of them."""
    least = _least(words, "n", COMMON)
    return {bytes(r["word"]): r["n"] for r in words.filter(F.col("n") >= least).collect()}


def score(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, train (whether ``training`` holds), n_tokens, n_known, train_tokens, base_score, score and bytes of every document."""
    partials = written(_partials(docs.filter(training), text))
    words = written(partials.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")))
    counts = written(partials.filter("key is not null").groupBy("key").agg(F.sum("n").alias("n")))
    discard(partials)
    net = fit_network(counts)
    discard(counts)
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("words")).first()
    train_tokens = int(totals["n"])
    bottom = train_tokens + SMOOTHING * (totals["words"] + 1)
    context = docs.sparkSession.sparkContext
    logs = {w: math.log10((n + SMOOTHING) / bottom) for w, n in _common(words).items()}
    known = context.broadcast((net, logs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net, logs = known.value
        reader = Reader(net)
        for batch in batches:
            data, rows = [], []
            for value in batch["text"]:
                data.append(lowered(value))
                tokens = data[-1].split()
                tokens.append(END_WORD)
                found = [logs.get(t) for t in tokens]
                rare = Counter([t for t, p in zip(tokens, found) if p is None])
                common = [p for p in found if p is not None]
                rows.append((len(tokens), len(common), math.fsum(common), list(rare), list(rare.values())))
            out = pd.DataFrame(rows, columns=["n_tokens", "n_common", "common", "rare", "times"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            out.insert(1, "train", batch["train"].to_numpy())
            out["score"], out["bytes"] = reader.score(data), [len(d) for d in data]
            yield out

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {kind}, train boolean, n_tokens bigint, n_common bigint, common double, "
        "rare array<binary>, times array<bigint>, score double, bytes bigint"
    )
    source = docs.select(
        F.col(doc_id).alias("doc_id"), training.alias("train"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    read = written(source.mapInPandas(run, schema).withColumn("row", F.monotonically_increasing_id()))
    zipped = F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("times"))
    rare = read.select("row", F.explode(zipped).alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.times").alias("times"))
    counted = rare.join(words, "word", "left")
    log = F.log10((F.coalesce("n", F.lit(0)) + SMOOTHING) / F.lit(bottom))
    sums = counted.groupBy("row").agg(
        F.sum(F.col("times") * log).alias("rest"), F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("n_rest")
    )
    joined = read.drop("rare", "times").join(sums, "row", "left")
    return joined.select(
        "doc_id",
        "train",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("common") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        "score",
        "bytes",
    )
