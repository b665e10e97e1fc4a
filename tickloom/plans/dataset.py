"""The monthly dataset: features, labels, statistics and reports for all months of one plan."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.exprs import month_of
from ..operators import quality
from ..operators.bucket import bucket_trades, fill_gaps
from ..operators.features import build_features
from ..operators.labels import HORIZONS, make_labels, no_leakage
from ..operators.normalize import FAST, SLOW, feature_stats, normalize_features
from ..operators.rolling import WINDOWS, rolling_features
from ..sources.readers import path_exists
from ..sources.shared import shared_folder
from ..sources.sinks import from_months, write_months


@dataclass(frozen=True)
class Recipe:
    """``priority`` 1: trades, blocks and calendar; 2: also mempool, funding and metrics. ``compat``: labels from the
    normalised close and the literal skip list, as older datasets have them."""

    grain: int = 1
    windows: tuple[int, ...] = WINDOWS
    horizons: dict[str, int] = field(default_factory=lambda: dict(HORIZONS))
    priority: int = 1
    normalize: bool = True
    compat: bool = False
    fast: int = FAST
    slow: int = SLOW


def build(trades: DataFrame, recipe: Recipe, blocks: DataFrame | None = None, mempool: DataFrame | None = None, funding: DataFrame | None = None, metrics: DataFrame | None = None, by: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Lazy frames ``buckets, series, enriched, features, labels``: months (and keys of ``by``, such as a symbol, which all
    inputs must then have) are partitions of one plan, so any number of them is built at once. No trades give empty frames."""
    buckets = bucket_trades(trades, recipe.grain, by)
    series = fill_gaps(buckets, recipe.grain, by)
    rolled = rolling_features(series, recipe.windows, by)
    more = (mempool, funding, metrics) if recipe.priority >= 2 else (None, None, None)
    enriched = build_features(rolled, blocks, *more, by=by)
    features = normalize_features(enriched, recipe.fast, recipe.slow, by, recipe.compat) if recipe.normalize else enriched
    labels = make_labels(features if recipe.compat else series, recipe.horizons, by)
    return {"buckets": buckets, "series": series, "enriched": enriched, "features": features, "labels": labels}


def missing_months(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Months (yyyymm) of ``wanted`` that ``done`` has not."""
    return wanted.join(done.select("month"), "month", "left_anti")


def months_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """``month`` (yyyymm), both ends (yyyy-mm-dd) included."""
    start = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(first).cast("date"), "month"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("d"))
    return start.select((F.year("d") * 100 + F.month("d")).cast("int").alias("month"))


def report_months(frames: dict[str, DataFrame], klines: DataFrame | None = None, min_rows: int = quality.MIN_ROWS, by: tuple[str, ...] = ()) -> DataFrame:
    """One row a month (and key of ``by``): the quality checks, the leakage verdict and, with ``klines``, the errors against them."""
    features, labels = frames["features"], frames["labels"]
    keys = [*by, "month"]
    report = quality.check_quality(features, labels, frames["buckets"], min_rows, by)
    numeric = [f.name for f in features.schema if isinstance(f.dataType, T.NumericType) and f.name not in (*keys, "timestamp_s")]
    mus = [c for c in labels.columns if c.startswith("mu_")]
    if mus:
        verdict = no_leakage(features, labels, numeric, mus[0], by).select(*keys, "no_leakage")
        report = report.join(verdict, keys, "left")
    return report if klines is None else report.join(quality.check_klines(frames["series"], klines, by=tuple(keys)).drop("passed"), keys, "left")


def write_dataset(frames: dict[str, DataFrame], root: str, klines: DataFrame | None = None, min_rows: int = quality.MIN_ROWS, by: tuple[str, ...] = (), resume: bool = False) -> DataFrame:
    """Writes buckets, features and labels by key and month (replacing those built, no others), and from what was written the
    statistics (before normalising) and the report of each month, which is returned for all that are stored. With ``resume`` the months
    that have a report for a key are left as they are, for that key; else building again is safe, the partitions decide what is
    complete. A dataset must always be written with the same keys ``by``."""
    spark, keys = frames["features"].sparkSession, [*by, "month"]
    kinds = T.StructType([frames["features"].schema[k] for k in by])
    if resume and path_exists(spark, f"{root}/reports"):
        done = from_months(_stored(spark, f"{root}/reports", kinds)).select(*keys).distinct()
        frames = {name: f.join(done, keys, "left_anti") for name, f in frames.items()}
    stored = {}
    for name in ("buckets", "enriched", "features", "labels"):
        write_months(frames[name], f"{root}/{name}", by=by)
        stored[name] = from_months(spark.read.schema(_stored_schema(frames[name])).parquet(f"{root}/{name}"))
    built = frames["buckets"].select(*keys).distinct()
    return _reported({name: f.join(built, keys, "left_semi") for name, f in stored.items()}, root, klines, min_rows, by)


def _reported(stored: dict[str, DataFrame], root: str, klines: DataFrame | None, min_rows: int, by: tuple[str, ...]) -> DataFrame:
    """Writes statistics and reports of the months built, and returns the reports of all."""
    spark, keys = stored["features"].sparkSession, [*by, "month"]
    stored = stored | {"series": stored["enriched"]}
    numeric = [f.name for f in stored["enriched"].schema if isinstance(f.dataType, T.NumericType) and f.name not in (*keys, "timestamp_s")]
    write_months(feature_stats(stored["enriched"], numeric, tuple(keys), accuracy=10_000), f"{root}/stats", by=by)
    write_months(report_months(stored, klines, min_rows, by), f"{root}/reports", by=by)
    return from_months(_stored(spark, f"{root}/reports", T.StructType([stored["features"].schema[k] for k in by])))


def build_dataset(trades: DataFrame, recipe: Recipe, root: str, blocks: DataFrame | None = None, mempool: DataFrame | None = None, funding: DataFrame | None = None, metrics: DataFrame | None = None, klines: DataFrame | None = None, min_rows: int = quality.MIN_ROWS, by: tuple[str, ...] = (), resume: bool = False, progress: Callable[[str], None] | None = None) -> DataFrame:
    """What ``write_dataset`` of ``build`` writes and returns, each table made from the one stored before it, so nothing is
    computed twice and a lost executor costs no more than a stage. With ``resume`` the trades of months that have a report are
    not read further than their time. ``progress`` is called with the name of each table when it is stored."""
    spark, keys = trades.sparkSession, [*by, "month"]
    told = progress or (lambda name: None)
    dated = trades.withColumn("month", month_of(F.floor(F.col("timestamp") / 1000)))
    if resume and path_exists(spark, f"{root}/reports"):
        done = from_months(_stored(spark, f"{root}/reports", T.StructType([trades.schema[k] for k in by]))).select(*keys).distinct()
        dated = dated.join(done, keys, "left_anti")
    listed = f"{shared_folder(spark)}/built-{uuid.uuid4().hex}"
    dated.select(*keys).distinct().write.parquet(listed)  # a row a month and key
    built = spark.read.schema(dated.select(*keys).schema).parquet(listed)

    def stored(name: str, df: DataFrame) -> DataFrame:
        write_months(df, f"{root}/{name}", by=by)
        told(name)
        return from_months(spark.read.schema(_stored_schema(df)).parquet(f"{root}/{name}")).join(built, keys, "left_semi")

    buckets = stored("buckets", bucket_trades(dated.drop("month"), recipe.grain, by))
    more = (mempool, funding, metrics) if recipe.priority >= 2 else (None, None, None)
    enriched = stored("enriched", build_features(rolling_features(fill_gaps(buckets, recipe.grain, by), recipe.windows, by), blocks, *more, by=by))
    features = stored("features", normalize_features(enriched, recipe.fast, recipe.slow, by, recipe.compat) if recipe.normalize else enriched)
    labels = stored("labels", make_labels(features if recipe.compat else enriched, recipe.horizons, by))
    return _reported({"buckets": buckets, "enriched": enriched, "features": features, "labels": labels}, root, klines, min_rows, by)


def _stored(spark: SparkSession, path: str, keys: T.StructType) -> DataFrame:
    """A stored table; the keys, folder names there, have the types they were written with."""
    df = spark.read.parquet(path)
    own = T.StructType([f for f in df.schema if f.name not in keys.names])
    for key in keys:
        own = own.add(key)
    return spark.read.schema(own).parquet(path)


def _stored_schema(df: DataFrame) -> T.StructType:
    """``month`` is stored as the partition folders year and month."""
    return T.StructType([f for f in df.schema if f.name != "month"]).add("year", T.IntegerType()).add("month", T.IntegerType())
