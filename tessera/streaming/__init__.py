"""Streams: the same contracts and loss windows over Structured Streaming.

The batch expressions are stateless per row or plain aggregates, so a stream reuses them; only the
duplicate check is bounded by a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import contracts


def checked_stream(stream: DataFrame, fields: contracts.Fields) -> DataFrame:
    """Rows with ``record_id`` and ``violation``, as they arrive; without the duplicate check."""
    code = contracts.violation(contracts.checks_of(stream, fields))
    return stream.withColumn("record_id", contracts.record_id(fields)).withColumn("violation", code)


def first_deliveries(stream: DataFrame, id_col: str, time_col: str, delay: str = "1 day") -> DataFrame:
    """The first row of each id within the watermark; state older than ``delay`` is dropped."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def windowed_losses(stream: DataFrame, time_col: str, keys: list[str], value: str, length: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Mean of a logged value by run and time window; late rows count up to the watermark."""
    kept = stream.withWatermark(time_col, delay)
    return kept.groupBy(F.window(time_col, length), *keys).agg(F.count("*").alias("n_events"), F.avg(F.when(~F.isnan(value), F.col(value))).alias(value))
