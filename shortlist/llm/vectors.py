"""Vectors that can be worked with, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether the vector is there and each of its entries is a finite number."""
    entries = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.col(vector).isNotNull() & entries


def usable(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows with a finite vector, and the vectors' length.

    A table should hold one length. Of several, the commonest counts (of
    equally common ones the shortest), and rows of another are left out. Empty vectors are left out.
    """
    kept = df.filter(finite(vector))
    lengths = kept.groupBy(F.size(vector).alias("length")).count().filter("length > 0")
    found = lengths.orderBy(F.desc("count"), "length").first()
    length = 0 if found is None else found["length"]
    return kept.filter(F.size(vector) == length if length else F.lit(False)), length


def matrix(column: pd.Series, length: int, kind: str = "float64") -> np.ndarray:
    """The vectors of a batch, one a row."""
    return np.stack([np.asarray(v, dtype=kind) for v in column]) if len(column) else np.zeros((0, length), kind)
