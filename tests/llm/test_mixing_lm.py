import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shortlist.llm import mixing_lm
from shortlist.llm.queries import registry
from tests.llm.conftest import prose

LOW = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return [*re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOW)), "\n"]


def base(docs, training):
    counts = Counter(w for i, t in docs if training(i) for w in words_of(t))
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for i, t in docs:
        found = [counts[w] for w in words_of(t)]
        score = sum(math.log10((c + 0.1) / (total + 0.1 * (kinds + 1))) for c in found)
        out.append((i, len(found), sum(c > 0 for c in found), total, score))
    return out


def test_query_against_plain_counts(spark, folder, monkeypatch):
    monkeypatch.setattr(mixing_lm, "COMMON", 50)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    training = lambda i: zlib.crc32(str(i).encode()) % 10 != 0
    found = sorted(registry.QUERIES["op2_context_mixing"](spark, folder).collect())
    for r, (i, n, known, total, score) in zip(found, sorted(base(docs, training)), strict=True):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, n, known, total)
        assert r["base_score"] == pytest.approx(score) and r["held_out"] == (not training(i)) and r["score"] < 0
    held = [r for r in found if r["held_out"]]
    # Far below the eight bits of an unknown byte.
    assert sum(r["bits_per_byte"] for r in held) / len(held) < 3


def brute_score(net, data):
    """The same model, place by place and bit by bit."""
    scale, curve = np.ones(mixing_lm.ORDERS), np.zeros(mixing_lm.ORDERS)
    keys = mixing_lm.sequences(bytes(mixing_lm.WORD) + data + mixing_lm.END)
    total = 0.0
    for at in range(0, len(keys), mixing_lm.STEP):
        slope, bend = np.zeros(mixing_lm.ORDERS), np.zeros(mixing_lm.ORDERS)
        for k in keys[at : at + mixing_lm.STEP]:
            logits, order = net.mixed(np.array([k]))
            for z in logits[0].astype(float):
                miss, even = 1 / (1 + math.exp(z * scale[order[0]])), 1 / (1 + math.exp(z))
                total += math.log(1 - miss)
                slope[order[0]] += miss * z
                bend[order[0]] += even * (1 - even) * z * z
        curve += bend
        scale = np.clip(scale + slope / (mixing_lm.TRUST + curve), mixing_lm.SLOWEST, mixing_lm.FASTEST)
    return total / math.log(10)


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.createDataFrame([(i, prose(i, 200)) for i in range(20)], "doc_id bigint, text string")
    counts = mixing_lm._partials(docs, "text").filter("key is not null").groupBy("key").agg(F.sum("n").alias("n"))
    return mixing_lm.fit_network(counts)


def test_reader_against_the_slow_one(network, monkeypatch):
    texts = [b"", b"w", prose(3, 150).encode(), prose(50, 300).encode(), "né ß".encode(), bytes(range(256))]
    fast = mixing_lm.Reader(network).score(texts)
    assert np.allclose(fast, [brute_score(network, t) for t in texts], rtol=1e-4)
    # Alone, in any company, and in parts of a long text.
    assert np.allclose(fast, [mixing_lm.Reader(network).score([t])[0] for t in texts], rtol=1e-5)
    monkeypatch.setattr(mixing_lm, "CHUNK", mixing_lm.STEP * 2)
    assert np.allclose(fast[3], mixing_lm.Reader(network).score([texts[3]])[0], rtol=1e-5)


def test_probabilities_of_next_bytes_add_up(network):
    before = b"\0" * 4 + b" wa"
    keys = np.concatenate([mixing_lm.sequences(before + bytes([b])) for b in range(256)])
    logits, _ = network.mixed(keys)
    assert (1 / (1 + np.exp(-logits.astype(float)))).prod(axis=1).sum() == pytest.approx(1, abs=1e-4)


def test_tables_give_the_mixture(network):
    keys = mixing_lm.sequences(bytes(mixing_lm.WORD) + prose(8, 60).encode())
    logit, gate = network.inputs(keys)
    plain = np.einsum("kob,kbo->kb", logit.astype(float), network.weights[gate])
    assert np.allclose(network.mixed(keys)[0], np.clip(plain, -20, 20), atol=1e-3)


def test_sequences():
    data = bytes(mixing_lm.WORD) + b"ab abcdefghij"
    got = [int(k).to_bytes(8, "big", signed=True).lstrip(b"\0") for k in mixing_lm.sequences(data)]
    # The byte with the word before it, or with five bytes.
    assert got[0] == b"a" and got[3] == b"ab a" and got[8] == b"abcdef" and got[-1] == b"cdefghij"


def test_codes():
    counts = np.array([0, 1, 31, 32, 33, 1000, 1e6, 1e9])
    found = mixing_lm._COUNT[mixing_lm.coded(counts)]
    assert (found[:4] == counts[:4]).all() and np.allclose(found, counts, rtol=0.06)


def test_odd_documents(odd, none):
    training = F.coalesce(F.col("doc_id") != 2, F.lit(True))
    found = mixing_lm.score(odd, training).collect()
    docs = [((r["doc_id"]), r["text"]) for r in odd.collect()]
    want = base(docs, lambda i: i != 2)
    key = lambda r: str(r)
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(got, key=key) == sorted([(*w[:4], round(w[4], 6)) for w in want], key=key)
    assert len({r["score"] for r in found if r["bytes"] == 0}) == 1
    assert mixing_lm.score(none, training).count() == 0


def test_nothing_to_learn_from(rows):
    df = rows("doc_id bigint, text string", [(1, "ab"), (2, None)])
    found = {r["doc_id"]: r for r in mixing_lm.score(df, F.lit(False)).collect()}
    assert found[1]["n_known"] == found[1]["train_tokens"] == 0
    # Three even bytes with the end mark.
    assert found[1]["score"] == pytest.approx(24 * math.log10(0.5), rel=1e-5)
    assert found[2]["n_tokens"] == 1


def test_rare_sequences_count_in_long_contexts(spark, monkeypatch):
    """Every sequence is found under its longest context, however many commoner ones there are."""
    monkeypatch.setattr(mixing_lm, "MAX_SEQUENCES", 4, raising=False)
    docs = spark.createDataFrame([(0, "zqxjvk"), *[(i, "common words here") for i in range(1, 60)]], "doc_id bigint, text string")
    counts = mixing_lm._partials(docs, "text").filter("key is not null").groupBy("key").agg(F.sum("n").alias("n"))
    net = mixing_lm.fit_network(counts)
    rare = mixing_lm.sequences(bytes(mixing_lm.WORD) + b"zqxjvk")
    assert net.mixed(rare)[1].tolist()[-1] == mixing_lm.ORDERS - 1
