"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.shared import shared_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again.

    This cuts the lineage: losing an executor later costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(df: DataFrame, name: str) -> DataFrame:
    """``df``, a sorted table as read from its Parquet files, with ``name``: each row's place (0, 1, ...) in it.

    Spark reads files in the order of their sizes, so the place is taken from the files: their names have the number of
    the sorted partition and, for partitions cut into several files, of the file.
    """
    rows = df.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    number = lambda regex: F.regexp_extract("__file", regex, 1).cast("long")
    before = Window.partitionBy("one").orderBy(number(r"^part-(\d+)"), number(r"-c(\d+)\."), "__file").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    counts = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1))
    offsets = counts.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return rows.join(F.broadcast(offsets), "__file").withColumn(name, F.col("__before") + F.col("__row")).select(*df.columns, name)


#: Most rows and bytes of an Arrow batch of texts: batches of the default 10,000 rows take hundreds of MB beside the heap.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's Arrow batches to BATCH_ROWS rows and BATCH_BYTES if they are larger."""
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = conf.get(key).rstrip("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(key, str(most))
    return df
