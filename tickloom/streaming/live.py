"""Live streams: JSON messages in, Parquet by ingest hour out, one query for each stream."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.exprs import floor_to, month_of, ratio
from ..functions.live import PARSERS, parse_mempool
from ..sources.schemas import dataset_path

FLUSH = "60 seconds"


def parse_stream(messages: DataFrame, stream: str, column: str = "message") -> DataFrame:
    """Typed columns of a stream's messages; works on batch and streaming frames."""
    if stream == "mempool":
        now = F.floor(F.col("received_ms") / 1000) if "received_ms" in messages.columns else F.unix_timestamp()
        return messages.select(*parse_mempool(F.col(column), now))
    return messages.select(*PARSERS[stream](F.col(column)))


def sink(parsed: DataFrame, root: str, stream: str, trigger: dict | None = None) -> StreamingQuery:
    """Appends to ``live/<stream>`` by ingest year, month, day and hour, every 60 s or with the trigger given; the
    checkpoint makes a stop or crash lose nothing and repeat nothing."""
    now = F.current_timestamp()
    dated = parsed.withColumns({"year": F.year(now), "month": F.month(now), "day": F.day(now), "hour": F.hour(now)})
    path = dataset_path(root, "live", stream=stream)
    return dated.writeStream.queryName(stream).outputMode("append").partitionBy("year", "month", "day", "hour").option("checkpointLocation", f"{root}/state/{stream}").trigger(**(trigger or {"processingTime": FLUSH})).format("parquet").start(path)


def run_live(spark: SparkSession, sources: dict[str, DataFrame], root: str, trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """One query for each stream; stop them with ``query.stop()``."""
    return {name: sink(parse_stream(messages, name), root, name, trigger) for name, messages in sources.items()}


def throughput(queries: dict[str, StreamingQuery]) -> dict[str, int]:
    """Rows that each query has taken in its recent batches."""
    return {name: sum(p["numInputRows"] for p in q.recentProgress) for name, q in queries.items()}


def wait(queries: dict[str, StreamingQuery], every: float = 300.0, report: Callable[[dict[str, int]], None] | None = None, until: Callable[[], bool] = lambda: False) -> None:
    """Blocks until one of ``queries`` ends or ``until`` is true, and then stops them all, each with what its last batch has
    written; an error of one is raised. ``report`` gets the throughput every ``every`` seconds."""
    began = told = time.monotonic()
    try:
        while all(q.isActive for q in queries.values()) and not until():
            next(iter(queries.values())).awaitTermination(min(1.0, every))
            if report is not None and time.monotonic() - told >= every:
                told = time.monotonic()
                report(throughput(queries))
    finally:
        for q in queries.values():
            q.stop()
    for q in queries.values():
        if q.exception() is not None:
            raise q.exception()
    if report is not None and told == began:
        report(throughput(queries))


class Monitor(StreamingQueryListener):
    """Rows taken by each stream and the streams that failed, as Spark reports them; add it with
    ``spark.streams.addListener`` and read it whenever a status is wanted."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.failed: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.rows.setdefault(event.name, 0)

    def onQueryProgress(self, event) -> None:
        self.rows[event.progress.name] = self.rows.get(event.progress.name, 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed[str(event.id)] = event.exception


def bucket_stream(trades: DataFrame, grain: int = 1, late: str = "10 seconds", by: tuple[str, ...] = ()) -> DataFrame:
    """Event-time twin of the bucket operator on a stream of trades (timestamp in ms): repeated trades within the
    watermark count once, buckets close when the watermark passes. The return, which needs the bucket before, is left
    to the batch side."""
    timed = trades.withColumn("event_ts", F.timestamp_millis("timestamp")).withWatermark("event_ts", late)
    order, quote, buy = F.struct("timestamp", "agg_trade_id"), F.col("price") * F.col("quantity"), ~F.col("is_buyer_maker")
    sums = timed.dropDuplicatesWithinWatermark([*by, "agg_trade_id"]).groupBy(*by, F.window("event_ts", f"{grain} seconds").alias("w")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume"), F.sum(quote).alias("quote_volume"), F.sum(F.when(buy, F.col("quantity")).otherwise(0.0)).alias("buy_volume"), F.sum(F.when(buy, 0.0).otherwise(F.col("quantity"))).alias("sell_volume"), F.count("price").alias("trade_count"),
    )
    second = floor_to(F.unix_timestamp("w.start"), grain)
    return sums.select(second.alias("timestamp_s"), month_of(second).alias("month"), *[c for c in sums.columns if c != "w"], ratio(F.col("buy_volume"), F.col("volume"), 0.5).alias("buy_ratio"), ratio(F.col("quote_volume"), F.col("volume"), F.col("close")).alias("vwap"))
