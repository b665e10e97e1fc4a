"""Readers: Parquet by month, typed CSV, CSV in ZIP, JSON, listings."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.exprs import nan_to_null
from .schemas import CSV


def read_csv(spark: SparkSession, path: str, kind: str, mode: str = "PERMISSIVE") -> DataFrame:
    """A headerless CSV of a declared kind. A header line, which some archives have, does not parse as numbers and is
    left out; so is the column ``ignore``."""
    schema = StructType.fromDDL(CSV[kind])
    first = schema.fieldNames()[0]
    rows = spark.read.schema(schema).csv(path, header=False, mode=mode)
    return nan_to_null(rows.where(F.col(first).isNotNull()).drop("ignore"))


def read_zipped_csv(spark: SparkSession, path: str | list[str], kind: str, with_file: bool = False) -> DataFrame:
    """The first ``.csv`` member of each ZIP file, one file a task: a ZIP can't be split. Damaged files give no rows.
    ``with_file`` adds the ZIP file's name in ``file``."""
    schema = StructType.fromDDL(CSV[kind])
    names = schema.fieldNames()
    out_names = [*names, "file"]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, file in zip(batch.column("content"), batch.column("path").to_pylist(), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                        member = next((n for n in z.namelist() if n.endswith(".csv")), None)
                        data = z.read(member) if member else b""
                except zipfile.BadZipFile:
                    data = b""
                if data:
                    text = pa.csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()))
                    for rows in pa.csv.read_csv(io.BytesIO(data), pa.csv.ReadOptions(column_names=names), convert_options=text).to_batches():
                        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([file.rsplit("/", 1)[-1]] * rows.num_rows, pa.string())], names=out_names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    raw = files.mapInArrow(unpack, ", ".join(f"`{n}` string" for n in out_names))
    typed = raw.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema] + (["file"] if with_file else []))
    return nan_to_null(typed.where(F.col(names[0]).isNotNull()).drop("ignore"))


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_months(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, schema: str | None = None) -> DataFrame:
    """A dataset partitioned by year and month; only the months first..last (yyyymm) are listed and read. Unreadable
    files are skipped if spark.sql.files.ignoreCorruptFiles is set."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    at = F.col("year") * 100 + F.col("month")
    if first is not None:
        df = df.where(at >= first)
    return df if last is None else df.where(at <= last)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, length, modificationTime`` of all files below ``path``; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "length", "modificationTime")


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``metric, timestamp, value``: of rows for one metric and time, the one in the file whose name comes last counts."""
    rows = spark.read.parquet(path).select("metric", "timestamp", "value", F.col("_metadata.file_name").alias("file"))
    return rows.groupBy("metric", "timestamp").agg(F.max_by(F.struct("value"), "file").alias("x")).select("metric", "timestamp", "x.value")
