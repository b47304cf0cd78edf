import hashlib
import math

import numpy as np
import pytest

from shortlist.llm import queries, vector_codes, whitening  # noqa: F401
from shortlist.llm.registry import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, k1 int, x string, code int, vector string, weight int, _label int"
EXTRA = (1, "x", 2, "v", 3, 4)


def cloud(seed, count, length, spread=0.2):
    rng = np.random.default_rng(seed)
    values = rng.normal(0, spread, (count, length)) @ np.diag(np.linspace(2, 0.5, length))
    return values.astype("float32")


@pytest.fixture(scope="module")
def odd_vectors():
    """Copies, repeated and null ids and labels, and vectors that must go."""
    values = cloud(1, 300, 32)
    values[200:] = values[7]
    rows = [(int(i) if i % 50 != 3 else None, v.tolist(), int(i % 3) if i % 7 else None, *EXTRA) for i, v in enumerate(values)]
    rows[11] = (10, *rows[11][1:])
    bad = [None, [None] * 32, [math.nan] * 32, [math.inf] + [0.0] * 31, [], [1.0]]
    return rows + [(1000 + i, v, 1, *EXTRA) for i, v in enumerate(bad)]


def kept(rows):
    return [r for r in rows if r[1] is not None and len(r[1]) == 32 and all(c is not None and math.isfinite(c) for c in r[1])]


def slow_codes(rows, parts=16, entries=64, rounds=2):
    """Codes by comparing every part with every entry, in Python's integers."""
    rows = sorted(kept(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    values = [[math.floor(256 * float(c)) for c in r[1]] for r in rows]
    width = len(values[0]) // parts
    books = [[v[p * width : (p + 1) * width] for v in values[:entries]] for p in range(parts)]

    def assign():
        out = []
        for v in values:
            line = []
            for p in range(parts):
                x = v[p * width : (p + 1) * width]
                line.append(min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p])))
            out.append(line)
        return out

    for _ in range(rounds):
        lines = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p * width : (p + 1) * width] for v, line in zip(values, lines) if line[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    lines = assign()
    errors = [sum(d for d, _ in line) for line in lines]
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(
        ((r[0], "".join(f"{i:02x}" for _, i in line), e, by_label[r[2]], sha) for r, line, e in zip(rows, lines, errors)), key=repr
    )


def codes(df, **parameters):
    found = vector_codes.encode(df, **parameters)
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found.collect()), key=repr)


def test_codes_equal_brute_force(spark, odd_vectors):
    df = spark.createDataFrame(odd_vectors, SCHEMA)
    assert codes(df) == slow_codes(odd_vectors)


def test_few_vectors_and_none(spark, odd_vectors):
    few = odd_vectors[:5]
    assert codes(spark.createDataFrame(few, SCHEMA)) == slow_codes(few)
    assert codes(spark.createDataFrame([], SCHEMA)) == []
    uneven = [(i, [float(i), -float(i), 0.5], 0, *EXTRA) for i in range(4)]
    assert [c[1][:4] for c in codes(spark.createDataFrame(uneven, SCHEMA), parts=2)] == ["0000", "0101", "0202", "0303"]


@pytest.mark.parametrize("spread", [1, 4, 60, 10**7])
def test_gnat_finds_the_nearest_entry_of_lowest_index(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread + 1, (64, 4))
    entries[40] = entries[3]
    queries_ = np.concatenate([rng.integers(-spread, spread + 1, (2000, 4)), entries])
    exact = vector_codes.squared(queries_, entries)
    index, distance = vector_codes.Gnat(entries).nearest(queries_)
    assert (index == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_gnat_eliminates_subtrees():
    rng = np.random.default_rng(0)
    centres = rng.integers(-10_000, 10_000, (8, 4))
    entries = (centres[:, None] + rng.integers(-50, 51, (8, 8, 4))).reshape(-1, 4)
    queries_ = entries[rng.integers(0, 64, 1000)] + rng.integers(-20, 21, (1000, 4))
    tree = vector_codes.Gnat(entries)
    best, index = np.full(1000, np.iinfo(np.int64).max), np.full(1000, 99)
    assert tree.search(queries_, best, index, np.arange(1000)) < 0.6 * 64 * 1000


def slow_whitening(rows, components=32):
    rows = kept(rows)
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in r[1]] for r in rows])
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return [r[0] for r in rows], n, deviation, centred @ vectors / np.sqrt(values), values / np.trace(covariance), covariance


def test_whitening_equals_numpy(spark, odd_vectors):
    df = spark.createDataFrame(odd_vectors, SCHEMA)
    found = whitening.whiten(df).collect()
    ids, n, deviation, projected, explained, _ = slow_whitening(odd_vectors)
    assert {r.n for r in found} == {n} and len(found) == len(ids)
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, deviation[i]))
    found.sort(key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation))
    assert [(r.vec_id, r.deviation) for r in found] == [(ids[i], deviation[i]) for i in order]
    got, want = np.array([r.whitened for r in found]), projected[order]
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-7
    assert np.abs(np.array(found[0].explained) / explained - 1).max() < 1e-9
    assert max(r.identity_error for r in found) < 1e-9
    assert np.abs(got.T @ got / n - np.eye(32)).max() < 1e-9


def test_weights_of_one_ignore_copies(spark, odd_vectors):
    once = list({tuple(r[1]): r for r in kept(odd_vectors)}.values())
    few = whitening.whiten(spark.createDataFrame(once, SCHEMA), weights="counts").collect()
    many = whitening.whiten(spark.createDataFrame(odd_vectors, SCHEMA), weights="one").collect()
    assert {r.n for r in many} == {r.n for r in few} == {len(once)}
    assert np.allclose(few[0].explained, many[0].explained)


def test_degenerate_vectors(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0, *EXTRA) for i in range(4)], SCHEMA)
    found = whitening.whiten(same).collect()
    assert len(found) == 4 and all(r.whitened == [None] * 3 and r.explained == [None] * 3 and r.deviation == 0 for r in found)
    line = spark.createDataFrame([(i, [float(i), 0.0], 0, *EXTRA) for i in range(4)], SCHEMA)
    rows = whitening.whiten(line).collect()
    assert all(r.whitened[1] is None and abs(r.identity_error) < 1e-12 for r in rows)
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    huge = spark.createDataFrame([(1, [3e38], 0, *EXTRA), (2, [-3e38], 0, *EXTRA), (3, [0.0], 0, *EXTRA)], SCHEMA)
    assert sorted(str(r.deviation) for r in whitening.whiten(huge).collect())[-1] == "None"
    assert vector_codes.encode(huge, parts=1).count() == 3


def test_queries_over_the_table(spark, folder):
    rows = [tuple(r) + EXTRA for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = QUERIES["op11_whiten_embeddings"](spark, folder).toPandas()
    assert list(found.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(found) == 32 * len(rows) and found["identity_error"].max() <= 1e-4 and set(found["component"]) == set(range(1, 33))
