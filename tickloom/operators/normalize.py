"""Causal rolling z-scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from .bucket import series_window
from .features import METRICS
from .rolling import running_sums, trailing, variance

FAST, SLOW, CLIP = 259_200, 31_536_000, 6.0
# Columns that stay as they are. ``block_`` names are those the merged columns have.
_PLAIN = ("halving_epoch", "segwit_tx_ratio", "taproot_tx_ratio")
SKIPPED = frozenset({"timestamp_s", "month", *(f"{c}_{k}" for c in ("hour", "dow", "month", "dom") for k in ("sin", "cos")), "is_weekend", "buy_ratio", "block_whale_tx_ratio", "block_whale_volume_ratio", *_PLAIN})
CORRECTED = SKIPPED | {f"block_{c}" for c in _PLAIN}
DAILY = frozenset(f"gn_{m}" for m in METRICS)


def zscore(df: DataFrame, columns: dict[str, int], by: tuple[str, ...] = (), min_periods: int | None = None) -> DataFrame:
    """Each column as (x - mean) / std (ddof 1) over its last ``w`` rows, this one included, clipped to [-6, 6].

    A window is at most as long as its month's series. NULL, too few values (default a tenth of the window, at least 1) and a
    std of 0 give 0. Values are centred on their month's mean before squares are summed."""
    if not columns:
        return df
    month = Window.partitionBy(*by, "month")
    centred = df.withColumns({f"__c_{c}": F.col(c).cast("double") - F.avg(c).over(month) for c in columns} | {"__rows": F.count(F.lit(1)).over(month)})
    parts = {}
    for c in columns:
        x = F.col(f"__c_{c}")
        parts |= {f"__s_{c}": F.coalesce(x, F.lit(0.0)), f"__q_{c}": F.coalesce(x * x, F.lit(0.0)), f"__n_{c}": F.when(x.isNotNull(), 1).otherwise(0)}
    framed = running_sums(centred, parts, by)
    framed = framed.withColumns({f"{p}w_{c}": trailing(f"{p}_{c}", w, by) for c, w in columns.items() for p in ("__s", "__q", "__n")})
    out = {}
    for c, w in columns.items():
        s, q, n = (F.col(f"{p}w_{c}") for p in ("__s", "__q", "__n"))
        std = F.sqrt(variance(n, s, q, F.col(f"__q_{c}"), 1))
        least = F.lit(min_periods) if min_periods else F.greatest(F.lit(1), F.floor(F.least(F.lit(w), F.col("__rows")) / 10))
        z = F.when(n >= least, F.try_divide(F.col(f"__c_{c}") - F.try_divide(s, n), std))
        out[c] = F.when(z.isNull(), 0.0).otherwise(F.least(F.greatest(z, F.lit(-CLIP)), F.lit(CLIP)))
    return framed.select([out[c].alias(c) if c in out else F.col(c) for c in df.columns])


def normalize_features(df: DataFrame, fast: int = FAST, slow: int = SLOW, by: tuple[str, ...] = (), compat: bool = False) -> DataFrame:
    """Every numeric column but the skipped ones as z-score; daily metrics over the slow window. ``compat`` uses the literal skip list, without the ``block_`` names."""
    skipped = SKIPPED if compat else CORRECTED
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skipped and f.name not in by]
    return zscore(df, {c: slow if c in DAILY else fast for c in numeric}, by)


def feature_stats(df: DataFrame, columns: list[str], by: tuple[str, ...] = (), accuracy: int | None = None) -> DataFrame:
    """``feature, mean, std, min, max, median, q01, q99, nan_ratio``, one row for each column (and key of ``by``, such as
    the month), from one aggregation. Quantiles are exact, which keeps a group's distinct values in one task; with ``accuracy``
    they are off by at most 1 / accuracy of the ranks and memory is bounded."""
    quantile = lambda c, q: F.percentile(c, q) if accuracy is None else F.percentile_approx(c, q, accuracy).cast("double")
    rows = F.count(F.lit(1))
    stats = [F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"), quantile(c, 0.5).alias("median"), quantile(c, 0.01).alias("q01"), quantile(c, 0.99).alias("q99"), (1 - F.try_divide(F.count(c), rows)).alias("nan_ratio")) for c in columns]
    return df.groupBy(*by).agg(F.array(*stats).alias("s")).select(*by, F.explode("s").alias("s")).select(*by, "s.*")
