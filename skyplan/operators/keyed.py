"""Aggregates by key beside the rows they are of."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_aggregates(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """df with aggregates over the rows of equal keys; nulls are equal. Sums
    are taken in all tasks before any shuffle and joined as a row per key, so a
    key that many rows have is never sorted in one task, as a window over it
    would be: such a join can be split."""
    names = [f"__key{i}" for i in range(len(keys))]
    by = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(*[a.alias(c) for c, a in aggregates.items()])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return df.drop(*aggregates).join(by, same, "left").drop(*names)
