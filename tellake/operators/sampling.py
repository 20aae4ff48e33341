"""Seeded samples and splits of ids; the order of input rows does not matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ledger import with_place


def sample_key(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))


def sample_ids(ids: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n ids (all, if fewer) chosen uniformly without replacement."""
    return ids.orderBy(sample_key(key, seed), key).limit(n)


def split_ids(ids: DataFrame, key: str, train: float = 0.7, val: float = 0.15, test: float = 0.15, seed: int = 42) -> DataFrame:
    """ids with split: int(n * train) train, int(n * val) val, the rest test, in seeded order."""
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError("ratios must sum to 1")
    n = ids.count()
    placed = with_place(ids.withColumn("__key", F.concat(sample_key(key, seed), F.lit("|"), F.col(key).cast("string"))), "__key").drop("__key")
    first, second = int(n * train), int(n * train) + int(n * val)
    return placed.withColumn("split", F.when(F.col("place") < first, "train").when(F.col("place") < second, "val").otherwise("test")).drop("place")
