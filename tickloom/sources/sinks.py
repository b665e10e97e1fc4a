"""Sinks and task state. Writes are idempotent: a month is replaced as a whole, so a run can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_months(df: DataFrame, path: str, partitions: tuple[str, ...] = ("year", "month"), mode: str = "overwrite", compression: str = "snappy", by: tuple[str, ...] = ()) -> None:
    """Parquet partitioned by the keys of ``by``, year and month. ``overwrite`` replaces only the partitions that ``df`` has, so one
    key's month never touches another's; ``ignore`` does nothing if the dataset exists, ``append`` adds files. ``month`` as yyyymm is
    split in year and month."""
    if "year" in partitions and "year" not in df.columns:
        df = df.withColumns({"year": F.floor(F.col("month") / 100).cast("int"), "month": (F.col("month") % 100).cast("int")})
    folders = [*by, *(p for p in partitions if p not in by)]
    order = [c for c in ("timestamp_s", "timestamp", "block_height") if c in df.columns]
    df.repartition(*folders).sortWithinPartitions(*folders, *order).write.mode(mode).option("compression", compression).option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def from_months(df: DataFrame) -> DataFrame:
    """A dataset read back, with ``month`` as yyyymm in place of year and month."""
    return df.withColumn("month", (F.col("year") * 100 + F.col("month")).cast("int")).drop("year")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """The long metric table by metric and year."""
    year = F.year(F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400).cast("int")))
    write_months(metrics.withColumn("year", year), path, ("metric", "year"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def save_state(spark: SparkSession, path: str, task: str, key: str, value: str) -> None:
    """Appends one fact (task, key, value); the newest of a key counts."""
    spark.createDataFrame([(task, key, value)], "task string, key string, value string").withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("task string, key string, value string, updated_at timestamp").parquet(path).groupBy("task", "key").agg(F.max_by("value", "updated_at").alias("value"), F.max("updated_at").alias("updated_at"))
