"""Data-quality, cross-source and inventory reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import month_of, ratio_or_one
from .bucket import reaggregate, series_window

# Thresholds of the monthly report.
MIN_ROWS, MAX_NULLS, MAX_GAP, MIN_STD, MIN_LABELS, KLINE_TOLERANCE = 2_000_000, 0.05, 300, 0.01, 0.95, 0.01
PRICE_PER_GB = 0.02


def null_ratio(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Share of NULL cells, rounded to 6 digits."""
    cells = F.count(F.lit(1)) * len(columns)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in columns[1:]), F.count_if(F.col(columns[0]).isNull()))
    return df.groupBy(*by).agg(F.round(F.coalesce(F.try_divide(nulls, cells), F.lit(0.0)), 6).alias("null_ratio"))


def max_gap(series: DataFrame, by: tuple[str, ...] = (), report: tuple[str, ...] = ()) -> DataFrame:
    """The largest step of timestamp_s within a month, for each key of ``report``."""
    return series.select(*report, (F.col("timestamp_s") - F.lag("timestamp_s").over(series_window(by))).alias("g")).groupBy(*report).agg(F.max("g").alias("max_gap"))


def check_quality(features: DataFrame, labels: DataFrame, before_fill: DataFrame | None = None, min_rows: int = MIN_ROWS, by: tuple[str, ...] = ()) -> DataFrame:
    """One row a month (and key of ``by``): each check's value and verdict, and ``passed``. Nulls and gaps are measured on
    ``before_fill`` (default: the features), which should be the series before it was filled and normalised."""
    raw = features if before_fill is None else before_fill
    keys = [*by, "month"]
    rows = features.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.lit(len(set(features.columns) - {*keys, "timestamp_s"}))).alias("n_features"), F.stddev_samp("buy_ratio").alias("buy_ratio_std"))
    mus = [c for c in labels.columns if c.startswith("mu_")]
    complete = F.lit(True)
    for c in mus:
        complete = complete & F.col(c).isNotNull()
    valid = labels.groupBy(*keys).agg(F.try_divide(F.count_if(complete), F.count(F.lit(1))).alias("valid_labels"))
    numeric = [c for c in raw.columns if c not in ("timestamp_s", *keys)]
    report = rows
    for part in (null_ratio(raw, numeric, tuple(keys)), max_gap(raw, by, tuple(keys)), valid):  # a row a month each
        report = report.join(part, keys, "left")
    checks = {"rows_ok": F.col("n_rows") >= min_rows, "nulls_ok": F.col("null_ratio") <= MAX_NULLS, "gap_ok": F.coalesce(F.col("max_gap") <= MAX_GAP, F.lit(True)), "variation_ok": F.col("buy_ratio_std") >= MIN_STD, "labels_ok": F.col("valid_labels") > MIN_LABELS}
    judged = report.withColumns({k: F.coalesce(c, F.lit(False)) for k, c in checks.items()})
    every = F.lit(True)
    for k in checks:
        every = every & F.col(k)
    return judged.withColumn("passed", every)


def check_klines(series: DataFrame, klines: DataFrame, tolerance: float = KLINE_TOLERANCE, by: tuple[str, ...] = ()) -> DataFrame:
    """One row (for each key of ``by``, which may have ``month``) ``n, price_error_pct, volume_error_pct, status, passed`` against
    one-minute candles (open_time in ms). Errors are means of relative differences in percent; status is skipped (no
    candles), no_overlap, ok or warning."""
    ours = reaggregate(series, by=by).select(*by, "minute", F.col("close").alias("close_agg"), F.col("volume").alias("volume_agg"))
    minute = (F.floor(F.col("open_time") / 60_000) * 60).alias("minute")
    dated = klines.withColumn("month", month_of(F.floor(F.col("open_time") / 1000))) if "month" in by and "month" not in klines.columns else klines
    theirs = dated.select(*by, minute, F.col("close").alias("close_kline"), F.col("volume").alias("volume_kline"))
    error = lambda c: F.avg(ratio_or_one(F.abs(F.col(f"{c}_agg") - F.col(f"{c}_kline")), F.col(f"{c}_kline"))) * 100
    both = ours.join(theirs, [*by, "minute"]).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.round(error("close"), 6).alias("price_error_pct"), F.round(error("volume"), 6).alias("volume_error_pct"))
    had = theirs.groupBy(*by).agg(F.count(F.lit(1)).alias("__k"))
    if by:
        found = series.select(*by).distinct().join(had, list(by), "left").join(both, list(by), "left").na.fill(0, ["n", "__k"])
    else:
        found = both.crossJoin(had)  # one row each
    status = F.when(F.col("__k") == 0, "skipped").when(F.col("n") == 0, "no_overlap").when(F.col("price_error_pct") < tolerance, "ok").otherwise("warning")
    return found.withColumn("status", status).withColumn("passed", F.col("status") != "warning").drop("__k")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, mean, std, min, median, max, nan_pct``, rounded to 4 digits."""
    stats = [F.struct(F.lit(c).alias("feature"), *(F.round(e, 4).alias(n) for n, e in (("mean", F.avg(c)), ("std", F.stddev_samp(c)), ("min", F.min(c).cast("double")), ("median", F.percentile(c, 0.5)), ("max", F.max(c).cast("double")), ("nan_pct", 100 - 100 * F.try_divide(F.count(c), F.count(F.lit(1))))))) for c in columns]
    return df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """``bin`` (0 ..), ``count`` over ``bins`` equal parts of the column's range; the maximum is in the last."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    at = F.floor(F.coalesce(F.try_divide((F.col(column) - F.col("lo")) * bins, F.col("hi") - F.col("lo")), F.lit(0.0)))
    return df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin")).count()


def coverage(df: DataFrame, month: str = "month") -> DataFrame:
    return df.agg(F.count_distinct(month).alias("months"), F.min(month).alias("first_month"), F.max(month).alias("last_month"), F.count(F.lit(1)).alias("n_rows"))


def status_tally(statuses: DataFrame) -> DataFrame:
    """Files, rows and bytes of each status."""
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def inventory(files: DataFrame, depth: int = 1) -> DataFrame:
    """``prefix, files, bytes, first_file, last_file, cost`` of a listing (path, length)."""
    prefix = F.substring_index("path", "/", depth)
    return files.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.min("path").alias("first_file"), F.max("path").alias("last_file")).withColumn("cost", F.round(F.col("bytes") / 1e9 * PRICE_PER_GB, 4))


def latest_reports(reports: DataFrame, n: int = 5) -> DataFrame:
    """The reports of the last ``n`` months."""
    return reports.orderBy(F.desc("month")).limit(n)
