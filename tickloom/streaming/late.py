"""What becomes of rows that come after the watermark: they go to a side table, from which a batch mends the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.readers import path_exists


def split_late(stream: DataFrame, time: str, delay: str, root: str, trigger: dict | None = None) -> StreamingQuery:
    """Writes a stream in two tables: ``<root>/on_time`` and ``<root>/late``. A row is late if its time (a timestamp) is not after the largest time
    of all batches before its own, less ``delay`` (such as "10 minutes"): that is what a watermark of that delay drops. Rows without a time are late.

    Each batch has its own folder, which it replaces if it is run again, and its largest time is kept beside it, so a restart
    judges a planned batch as the first run did. A late row is never lost: ``on_time`` and ``late`` together are the stream.
    """
    return stream.writeStream.foreachBatch(_Judge(time, delay, root)).option("checkpointLocation", f"{root}/state").trigger(**(trigger or {"processingTime": "60 seconds"})).start()


class _Judge:
    def __init__(self, time: str, delay: str, root: str) -> None:
        self.time, self.delay, self.root = time, delay, root.rstrip("/")

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = f"{self.root}/times"
        newest = spark.read.parquet(known).where(F.col("batch") < number).agg(F.max("newest_us")).first()[0] if path_exists(spark, known) else None
        bound = F.timestamp_micros(F.lit(newest).cast("long")) - F.expr(f"interval {self.delay}")
        late = F.col(self.time).isNull() | (F.lit(newest is not None) & F.coalesce(F.col(self.time) <= bound, F.lit(False)))
        held = batch.persist()
        try:
            for name, rows in (("on_time", held.where(~late)), ("late", held.where(late))):
                rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={number}")
            held.agg(F.max(F.unix_micros(F.col(self.time).cast("timestamp"))).alias("newest_us")).write.mode("overwrite").parquet(f"{known}/batch={number}")
        finally:
            held.unpersist()


def whole(spark: SparkSession, root: str) -> DataFrame:
    """All rows of a split stream, late ones included, each with ``late``: what a batch that mends the results reads."""
    on_time, late = (spark.read.parquet(f"{root.rstrip('/')}/{name}").drop("batch") for name in ("on_time", "late"))
    return on_time.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
