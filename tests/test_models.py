"""Model jobs against brute force and on planted structure."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from shortlist.models import assembly, evaluate, factor_search, factors, linear, store, trees
from shortlist.session import shared_folder


@pytest.fixture(scope="module")
def planted(spark):
    """Gain follows ``a`` and not ``b``; one group holds a third of the rows."""
    rng = np.random.default_rng(5)
    data = []
    for i in range(600):
        group = 0 if i < 200 else 1 + i % 60
        a, b = rng.normal(), rng.normal()
        gain = 5 if a > 1 else 1 if a > 0 else 0
        data.append((i, group, float(a), float(b), gain, "train" if group % 5 else "val"))
    df = spark.createDataFrame(data, "row bigint, grp int, a double, b double, gain int, split string")
    return df.repartition(6).cache()


def brute_force_pairs(pdf, per_group, penalty, ranker):
    x = (pdf[["a", "b"]].to_numpy() - np.array(ranker.means)) / np.array(ranker.scales)
    gram, target = np.zeros((2, 2)), np.zeros(2)
    for _, idx in pdf.groupby("grp").indices.items():
        pairs = [(i, j) for i in idx for j in idx if pdf["gain"][i] > pdf["gain"][j]]
        for i, j in pairs:
            d = (x[i] - x[j]) / 1.0
            w = 1 / len(pairs) if per_group else 1.0
            gram += w * np.outer(d, d)
            target += w * d
    ridge = penalty * np.trace(gram) / 2
    return np.linalg.solve(gram + ridge * np.eye(2), target)


@pytest.mark.parametrize("per_group", [True, False])
def test_pairwise_equals_all_pairs(planted, per_group):
    ranker = linear.fit_pairwise(planted, "grp", "gain", ["a", "b"], 1e-3, per_group)
    pdf = planted.toPandas().reset_index(drop=True)
    assert np.array(ranker.weights) == pytest.approx(brute_force_pairs(pdf, per_group, 1e-3, ranker), rel=1e-6)


def test_pairwise_of_hot_groups(planted):
    cold = linear.fit_pairwise(planted, "grp", "gain", ["a", "b"])
    hot = linear.fit_pairwise(planted, "grp", "gain", ["a", "b"], hot_rows=50)
    assert hot.weights == pytest.approx(cold.weights, rel=1e-9)


def test_pairwise_finds_the_order(planted):
    ranker = linear.fit_pairwise(planted, "grp", "gain", ["a", "b"])
    assert ranker.weights[0] > 10 * abs(ranker.weights[1])
    assert evaluate.ndcg_of(ranker.transform(planted), "grp", "gain") > 0.95


def brute_force_step(pdf, ranker, k):
    x = (pdf[["a", "b"]].to_numpy() - np.array(ranker.means)) / np.array(ranker.scales)
    s, gain = x @ np.array(ranker.weights), pdf["gain"].to_numpy()
    total, groups = np.zeros(2), 0
    for _, idx in pdf.groupby("grp").indices.items():
        ideal = sum(g / np.log2(r + 2) for r, g in enumerate(sorted(gain[idx], reverse=True)[:k]))
        if ideal == 0:
            continue
        groups += 1
        order = sorted(idx, key=lambda i: -s[i])
        discount = {i: (1 / np.log2(r + 2) if r < k else 0.0) for r, i in enumerate(order)}
        for i in idx:
            for j in idx:
                if gain[i] > gain[j]:
                    swing = (gain[i] - gain[j]) * abs(discount[i] - discount[j]) / ideal
                    total += swing / (1 + np.exp(s[i] - s[j])) * (x[i] - x[j])
    return total / groups


def test_listwise_step_equals_all_pairs(planted):
    start = linear.fit_pairwise(planted, "grp", "gain", ["a", "b"])
    moved = linear.fit_listwise(planted, "grp", "gain", ["a", "b"], steps=1, rate=1.0, start=start)
    step = np.array(moved.weights) - np.array(start.weights)
    expected = brute_force_step(planted.toPandas().reset_index(drop=True), start, 5)
    assert step == pytest.approx(expected, rel=1e-6)


def test_pair_differences(planted):
    out = {r["grp"]: r for r in linear.pair_differences(planted, "grp", "gain", ["a"]).collect()}
    pdf = planted.toPandas()
    for g, part in pdf.groupby("grp"):
        diffs = [x - y for x, gx in zip(part["a"], part["gain"]) for y, gy in zip(part["a"], part["gain"]) if gx > gy]
        assert out[g]["pairs"] == len(diffs) and out[g]["diff_a"] == pytest.approx(sum(diffs))


def test_permutation_importance(planted):
    ranker = linear.fit_pairwise(planted, "grp", "gain", ["a", "b"])
    out = evaluate.permutation_importance(planted, ranker.transform, ["a", "b"], "row", "grp", "gain", repeats=2)
    found = {r["feature"]: r["score"] for r in out.collect()}
    assert found["a"] < -0.1 and abs(found["b"]) < 0.05


def test_permuted_keeps_the_values(planted):
    out = evaluate.permuted(planted, "a", "row", 1, hot_rows=100)
    assert out.select("a").exceptAll(planted.select("a")).count() == 0
    assert out.join(planted.select("row", F.col("a").alias("old")), ["row"]).filter("a = old").count() < 20


def test_trees(planted):
    model = assembly.fit_assembly(planted, ["a", "b"], ["split"])
    rows = assembly.assemble(planted, model)
    point = trees.fit_pointwise(rows, "grp", "gain", kind="forest", numTrees=3, maxDepth=3)
    top = max(trees.native_importance(point, ["a", "b", "split"]), key=lambda r: r[1])
    assert top[0] == "a"
    classes = trees.fit_classifier(rows, "gain", maxIter=20)
    scored = trees.score_classes(classes, rows)
    assert set(scored.select("label").distinct().toPandas()["label"]) <= {0, 1, 5}
    assert scored.filter("label = gain").count() > 500


def test_fill_modes(rows):
    df = rows("x double", [(1.0,), (4.0,), (None,)])
    assert assembly.fill_values(df, ["x"]) == {"x": 0.0} and assembly.fill_values(df, ["x"], "max") == {"x": 5.0}


@pytest.fixture(scope="module")
def ratings(spark):
    data = [(u, i, 4.0 if (u % 2) == (i % 2) else 1.0) for u in range(30) for i in range(20) if (u + i) % 3]
    return spark.createDataFrame(data, "user int, item int, rating double").cache()


def test_factors(ratings, rows):
    model = factors.fit_factors(ratings, rank=3, iterations=5, penalty=0.05)
    fitted = model.predict(ratings)
    assert fitted.filter(F.abs(F.col("rating") - F.col("estimate")) < 0.8).count() > 0.9 * ratings.count()
    new = model.predict(rows("user int, item int", [(999, 1), (999, 999)])).collect()
    assert all(0 <= r["estimate"] <= 5 for r in new)


def test_factors_of_hot_ids(ratings):
    """Ids above and below the size limit get the same factors."""
    cold = factors.fit_factors(ratings, rank=3, iterations=3, penalty=0.05)
    hot = factors.fit_factors(ratings, rank=3, iterations=3, penalty=0.05, hot_rows=8)
    both = cold.predict(ratings).join(hot.predict(ratings).withColumnRenamed("estimate", "other"), ["user", "item"])
    assert both.count() == ratings.count() and both.filter(F.abs(F.col("estimate") - F.col("other")) > 1e-6).count() == 0
    assert hot.users.count() == 30 and hot.items.count() == 20


def test_factors_beyond_int_ids(ratings):
    far = ratings.select((F.col("user") + F.lit(1 << 40)).alias("user"), "item", "rating")
    model = factors.fit_factors(far, rank=2, iterations=1, scale=(0.0, 3.0))
    assert model.predict(far).agg(F.max("estimate")).first()[0] <= 3.0


def test_stored_models(spark, planted, ratings, tmp_path):
    ranker = linear.fit_pairwise(planted, "grp", "gain", ["a", "b"])
    store.save(spark, ranker, str(tmp_path / "r"))
    assert store.load(spark, str(tmp_path / "r")) == ranker
    for n, model in enumerate((factors.fit_factors(ratings, 2, 1), factors.fit_coclusters(ratings, 2, 2, epochs=1))):
        store.save(spark, model, str(tmp_path / f"m{n}"))
        again = store.load(spark, str(tmp_path / f"m{n}"))
        key = ["user", "item", "estimate"]
        assert sorted(model.predict(ratings).select(*key).collect()) == sorted(again.predict(ratings).select(*key).collect())
    rows = assembly.assemble(planted, assembly.fit_assembly(planted, ["a", "b"]))
    for n, model in enumerate((assembly.fit_assembly(planted, ["a", "b"]), trees.fit_classifier(rows, "gain", maxIter=3))):
        store.save(spark, model, str(tmp_path / f"p{n}"))
        again, source = store.load(spark, str(tmp_path / f"p{n}")), planted if n == 0 else rows
        assert again.transform(source).drop("split").exceptAll(model.transform(source).drop("split")).count() == 0


def test_coclusters(ratings):
    base = ratings.agg(F.stddev_pop("rating")).first()[0]
    model = factors.fit_coclusters(ratings, 2, 2, epochs=2)
    errors = model.predict(ratings).agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("estimate"), 2)))).first()[0]
    assert errors <= base + 1e-9


def test_states_of_earlier_steps_are_deleted(ratings, spark):
    """What a fit leaves in the shared folder does not grow with its steps."""
    folder = Path(shared_folder(spark).removeprefix("file:"))

    def left(fit):
        before = set(folder.iterdir())
        fit()
        return len(set(folder.iterdir()) - before)

    assert left(lambda: factors.fit_coclusters(ratings, 2, 2, epochs=1)) == left(lambda: factors.fit_coclusters(ratings, 2, 2, epochs=3))
    assert left(lambda: factors.fit_factors(ratings, 2, 1)) == left(lambda: factors.fit_factors(ratings, 2, 3))
    one, three = (left(lambda n=n: factor_search.search_factors(ratings, (2,), (n,), (0.1,), folds=2)) for n in (1, 3))
    assert one == three


def test_factors_of_an_id_in_several_batches(ratings, monkeypatch):
    """Biases and factors do not depend on the rows of a batch, and an unknown id gets none."""
    more = ratings.unionByName(ratings.limit(2).withColumn("user", F.lit(None).cast(ratings.schema["user"].dataType)))
    whole = {r["user"]: r["user_factors"] for r in factors.fit_factors(more, 2, 2).users.collect()}
    monkeypatch.setattr(factors, "BATCH", 3)
    for r in factors.fit_factors(more, 2, 2).users.collect():
        assert (r["user_factors"] is None) == (r["user"] is None)
        assert r["user"] is None or r["user_factors"] == pytest.approx(whole[r["user"]], abs=1e-9)


def test_random_search_is_seeded(planted):
    def fit(penalty):
        return lambda df: df.withColumn("prediction", F.col("a") * F.lit(penalty))

    space = {"penalty": ("log", 0.1, 1.0)}
    first = evaluate.random_search(fit, planted, space, "grp", "gain", calls=2)
    assert first == evaluate.random_search(fit, planted, space, "grp", "gain", calls=2)


def place(x, size, rounds):
    for mirror, a, b, c in rounds:
        other = (mirror - x) % size
        larger = max(x, other)
        p = evaluate.SHUFFLE_PRIME
        x = other if (larger % p * a + larger // p % p * b + c) % p % 2 else x
    return x


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_shuffled_places_are_a_permutation(spark, size):
    frame = spark.range(size).select("id", evaluate.shuffled_place(F.col("id"), size, evaluate._rounds(3)).alias("to"))
    found = {r["id"]: r["to"] for r in frame.collect()}
    assert sorted(found.values()) == list(range(size))
    assert found == {i: place(i, size, evaluate.shuffle_rounds(3)) for i in range(size)}
    if size == 1000:
        assert abs(np.corrcoef(list(found), list(found.values()))[0, 1]) < 0.15 and sum(i == t for i, t in found.items()) < 10


@pytest.mark.parametrize("size", [1, 2, 1000, 3 * evaluate.SHUFFLE_PRIME])
def test_places_of_many_numbers_at_once(size):
    """Numbers beyond the prime too, with the mirror at both ends."""
    numbers, rounds = np.unique(np.linspace(0, size - 1, 200).astype(int)), evaluate.shuffle_rounds(8)
    assert evaluate.shuffled_places(numbers, size, rounds).tolist() == [place(int(i), size, rounds) for i in numbers]


def test_permutation_importance_equals_single_shuffles(planted):
    ranker = linear.fit_pairwise(planted, "grp", "gain", ["a", "b"])
    found = {r["feature"]: r for r in evaluate.permutation_importance(planted, ranker.transform, ["a", "b"], "row", "grp", "gain", 2, 5, hot_rows=100).collect()}
    base = evaluate.ndcg_of(ranker.transform(planted), "grp", "gain")
    for i, c in enumerate(["a", "b"]):
        changes = [
            evaluate.ndcg_of(ranker.transform(evaluate.permuted(planted, c, "row", 5 + 2 * i + r)), "grp", "gain") - base for r in range(2)
        ]
        assert found[c]["score"] == pytest.approx(np.mean(changes), abs=1e-12)
        assert found[c]["std"] == pytest.approx(np.std(changes), abs=1e-12)


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_dictionary(rows, hot_rows):
    train = rows("a string, b int", [("x", i % 60) for i in range(100)] + [("y", 1), (None, None), ("z", 1)])
    fitted = assembly.fit_dictionary(train, ["a", "b"], hot_rows=hot_rows)
    assert fitted.sizes == {"a": 4, "b": 61}
    found = fitted.transform(rows("a string, b int", [("x", 1), (None, 99), ("new", 0), ("y", None)]), hot_rows=hot_rows).collect()
    # Equally common values are in the order of their texts.
    assert {(r["a"], r["b"]): (r["a_index"], r["b_index"]) for r in found} == {
        ("x", 1): (0, 0), (None, 99): (1, 61), ("new", 0): (4, 1), ("y", None): (2, 60)
    }
    assert assembly.fit_dictionary(train, ["b"], min_count=2).sizes == {"b": 40}
    vectors = assembly.assemble_large(train.limit(3), ["b"], fitted, {"b": -1.0})
    assert vectors.columns == ["a", "b", "features"] and vectors.first()["features"].size == 3


@pytest.mark.parametrize("support", [1, 2, 3])
def test_neighbours_equal_all_pairs(rows, support):
    """User 0 rated everything, and every third item has few other users."""
    data = [(0, i, float(i % 5 + 1)) for i in range(40)]
    data += [(u, i, float((u * i) % 5 + 1)) for u in range(1, 25) for i in range(40) if (u * 7 + i * 3) % (9 if i % 3 else 31) == 0]
    by_item = {}
    for u, i, r in data:
        by_item.setdefault(i, {})[u] = r
    want = {}
    for i, a in by_item.items():
        near = []
        for j, b in by_item.items():
            common = a.keys() & b.keys()
            if i != j and len(common) >= support:
                dot = sum(a[u] * b[u] for u in common)
                near.append((-round(dot / np.sqrt(sum(a[u] ** 2 for u in common) * sum(b[u] ** 2 for u in common)), 9), -len(common), j))
        want[i] = sorted(near)[:4]
    found = {i: [] for i in by_item}
    for r in factors.item_neighbours(rows("user int, item int, rating double", data), 4, support, hot_rows=15).orderBy("item", "rank").collect():
        found[r["item"]].append((-round(r["similarity"], 9), -r["common"], r["other"]))
    assert found == want


@pytest.mark.parametrize("basket", [0, 12, 64])
def test_neighbours_of_users_with_few_and_many_ratings(rows, basket):
    """Users of few ratings, of many and an unknown one; pairs may reach their support through both kinds."""
    data = [(u, i, float((u * 3 + i) % 5)) for u in range(20) for i in range(30) if (u * 5 + i * 7) % (2 if u < 3 else 5) == 0]
    frame = rows("user int, item int, rating double", [*data, (None, 1, 1.0), (None, 2, 1.0), (4, None, 1.0)])
    found = {(r["item"], r["other"]): (r["common"], r["similarity"]) for r in factors.item_neighbours(frame, 100, 2, basket=basket).collect()}
    by_item = {i: {u: r for u, j, r in data if j == i} for i in range(30)}
    want = {}
    for i, a in by_item.items():
        for j, b in by_item.items():
            common = a.keys() & b.keys()
            size = np.sqrt(sum(a[u] ** 2 for u in common) * sum(b[u] ** 2 for u in common))
            if i != j and len(common) >= 2 and size:
                want[i, j] = (len(common), pytest.approx(sum(a[u] * b[u] for u in common) / size, abs=1e-9))
    assert found == want


def test_forests_read_parts_of_bounded_size(planted, monkeypatch):
    parts = []
    monkeypatch.setattr(trees, "PART_ROWS", 50)
    monkeypatch.setattr(trees.RandomForestRegressor, "fit", lambda self, rows: parts.append(rows.rdd.getNumPartitions()))
    trees.fit_pointwise(planted.withColumn("features", F.col("a")), "grp", "gain", kind="forest", numTrees=3)
    assert parts == [12]
