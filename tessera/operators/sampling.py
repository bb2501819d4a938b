"""Prefix limits and seeded samples.  Source order is a column, never the physical order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import generated_id


def prefix_limit(df: DataFrame, n: int, row_index: str = "row_index") -> DataFrame:
    """Rows 0 to n - 1 in source order; a filter that reaches the scan."""
    if n <= 0:
        raise ValueError("limit must be positive")
    return df.where(F.col(row_index) < n)


def seeded_sample(df: DataFrame, n: int, seed: int, key: str = "row_index") -> DataFrame:
    """A uniform sample without replacement, the same for the same seed: the n least hashes of seed
    and key.  Each task keeps n rows at most, so nothing is sorted as a whole."""
    if n <= 0:
        raise ValueError("limit must be positive")
    rank = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("sample_rank", rank).orderBy("sample_rank", key).limit(n)


def reindexed(sample: DataFrame, split: str, key: str = "row_index") -> DataFrame:
    """Adds ``position`` (from 0, in the sample's order) and the id generated from it."""
    position = (F.row_number().over(Window.orderBy("sample_rank", key)) - 1).cast("bigint")
    return sample.withColumn("position", position).withColumn("generated_id", generated_id(F.lit(split), F.col("position")))
