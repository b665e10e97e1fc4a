"""Sessions and sliding windows of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sessions(events: DataFrame, time: str, gap: str, by: tuple[str, ...], aggregates: dict[str, Column]) -> DataFrame:
    """``by, started, ended`` (the last event's time plus the gap) and the aggregates of each run of events of one key in which no two
    neighbours are ``gap`` or more apart. Works on batch frames and, in append mode with a watermark on ``time``, on streams. Events with a null time are left out."""
    found = events.where(F.col(time).isNotNull()).groupBy(*by, F.session_window(time, gap).alias("__w")).agg(*(x.alias(n) for n, x in aggregates.items()))
    return found.select(*by, F.col("__w.start").alias("started"), F.col("__w.end").alias("ended"), *aggregates)


def sliding(events: DataFrame, time: str, length: str, step: str, by: tuple[str, ...], aggregates: dict[str, Column]) -> DataFrame:
    """The same for windows of one ``length`` that begin every ``step``; a window without events has no row."""
    found = events.where(F.col(time).isNotNull()).groupBy(*by, F.window(time, length, step).alias("__w")).agg(*(x.alias(n) for n, x in aggregates.items()))
    return found.select(*by, F.col("__w.start").alias("started"), F.col("__w.end").alias("ended"), *aggregates)
