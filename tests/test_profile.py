"""Exact quartiles from brackets."""

import numpy as np
import pytest

from shortlist.operators import profile


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 30_000
    spread, ties = rng.normal(size=n), rng.integers(0, 4, n).astype(float)
    half = [None if i % 2 else float(i) for i in range(n)]
    data = list(zip(spread.tolist(), ties.tolist(), half, [None] * n, [7.5] * n))
    return spark.createDataFrame(data, "spread double, ties double, half double, none double, same double").repartition(5).cache()


def expected(values):
    return [float(np.quantile(values, q)) for q in (0.25, 0.5, 0.75)]


@pytest.mark.parametrize("bracket", [profile.BRACKET, -0.5])
def test_quartiles_are_exact(table, monkeypatch, bracket):
    """Also where the brackets hold no quartile, so that all values are counted."""
    monkeypatch.setattr(profile, "BRACKET", bracket)
    pdf = table.toPandas()
    found = {r["column"]: r for r in profile.summary(table, table.columns).collect()}
    for c in ("spread", "ties", "half", "same"):
        assert [found[c][q] for q in profile.QUARTILES] == pytest.approx(expected(pdf[c].dropna().to_numpy()), abs=1e-12)
        assert found[c]["n"] == pdf[c].count() and found[c]["mean"] == pytest.approx(pdf[c].mean())
    assert found["none"]["n"] == 0 and found["none"]["q50"] is None


def test_few_rows_and_none(spark, table):
    few = spark.createDataFrame([(1.0,), (4.0,)], "x double")
    row = profile.summary(few, ["x"]).first()
    assert (row["q25"], row["q50"], row["q75"]) == (1.75, 2.5, 3.25)
    assert profile.summary(few.limit(0), ["x"]).first()["q50"] is None
    assert profile.summary(few.limit(1), ["x"]).first()["q75"] == 1.0
