"""Trades to a dense fixed-grain OHLCV series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exprs import floor_to, month_of, ratio

FILLED = ("open", "high", "low", "close", "vwap")


def series_window(by: tuple[str, ...] = ()) -> Window:
    return Window.partitionBy(*by, "month").orderBy("timestamp_s")


def bucket_trades(trades: DataFrame, grain: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """One row for each ``grain`` seconds with trades (timestamp in ms, agg_trade_id, price, quantity, is_buyer_maker):
    OHLC in the order of (timestamp, agg_trade_id), volumes by side, ratios with neutral defaults, and the return
    on the previous bucket with trades of the month (0 for the first). Empty in, empty out."""
    order = F.struct("timestamp", "agg_trade_id")
    quote = F.col("price") * F.col("quantity")
    buy = ~F.col("is_buyer_maker")
    second = floor_to(F.floor(F.col("timestamp") / 1000), grain)
    sums = (
        trades.withColumn("timestamp_s", second)
        .groupBy(*by, "timestamp_s")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("quantity").alias("volume"),
            F.sum(quote).alias("quote_volume"),
            F.coalesce(F.sum(F.when(buy, F.col("quantity"))), F.lit(0.0)).alias("buy_volume"),
            F.coalesce(F.sum(F.when(~buy, F.col("quantity"))), F.lit(0.0)).alias("sell_volume"),
            F.count("price").alias("trade_count"),
        )
    )
    both = F.col("buy_volume") + F.col("sell_volume")
    return sums.withColumns(
        {
            "month": month_of(F.col("timestamp_s")),
            "buy_ratio": ratio(F.col("buy_volume"), F.col("volume"), 0.5),
            "vwap": ratio(F.col("quote_volume"), F.col("volume"), F.col("close")),
            "volume_imbalance": ratio(F.col("buy_volume") - F.col("sell_volume"), both, 0.0),
            "price_range": F.col("high") - F.col("low"),
        }
    ).withColumn("price_return", F.coalesce(ratio(F.col("close"), F.lag("close").over(series_window(by))) - 1, F.lit(0.0)))


def fill_gaps(buckets: DataFrame, grain: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """A row for every ``grain`` seconds between a month's first and last bucket.

    Each bucket makes its own gap rows up to the next bucket, so there is neither a spine nor a join: prices and vwap
    repeat (each column from its own last value), price_range and volumes are 0, buy_ratio 0.5,
    imbalance and return 0."""
    w = series_window(by)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    carried = buckets.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in FILLED} | {"__next": F.lead("timestamp_s").over(w)})
    last = F.coalesce(F.col("__next") - grain, F.col("timestamp_s"))
    dense = carried.withColumn("__t", F.explode(F.sequence("timestamp_s", last, F.lit(grain).cast("long"))))
    gap = F.col("__t") > F.col("timestamp_s")
    neutral = {"volume": 0.0, "quote_volume": 0.0, "buy_volume": 0.0, "sell_volume": 0.0, "buy_ratio": 0.5, "volume_imbalance": 0.0, "price_return": 0.0, "price_range": 0.0, "trade_count": 0}
    named = [F.when(gap, F.lit(neutral[c])).otherwise(F.col(c)).cast(buckets.schema[c].dataType).alias(c) if c in neutral else F.col("__t").alias(c) if c == "timestamp_s" else F.col(c) for c in buckets.columns]
    return dense.select(*named)


def process_trades(trades: DataFrame, grain: int = 1, fill: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    buckets = bucket_trades(trades, grain, by)
    return fill_gaps(buckets, grain, by) if fill else buckets


def reaggregate(series: DataFrame, grain: int = 60, by: tuple[str, ...] = ()) -> DataFrame:
    """Last close and summed volume for each ``grain`` seconds: ``minute, close, volume``."""
    minute = floor_to(F.col("timestamp_s"), grain)
    return series.groupBy(*by, minute.alias("minute")).agg(F.max_by("close", "timestamp_s").alias("close"), F.sum("volume").alias("volume"))
