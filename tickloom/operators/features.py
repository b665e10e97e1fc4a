"""Feature enrichment of the dense series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exprs import calendar, prefixed, ratio, ratio_or_one, select_available
from .asof import Slow, asof_join, asof_joins
from .bucket import series_window

# The columns merged from each slow series.
BLOCK_COLUMNS = ["tx_count", "total_fees_btc", "fee_rate_p50_sat_vbyte", "fee_rate_p90_sat_vbyte", "segwit_tx_ratio", "taproot_tx_ratio", "utxo_net_change", "seconds_since_prev_block", "difficulty", "halving_epoch", "blocks_since_halving"]
MEMPOOL_COLUMNS = ["mempool_tx_count", "mempool_vsize_bytes", "fee_standard_sat_vbyte", "fee_urgent_sat_vbyte", "fee_p50_sat_vbyte", "fee_p90_sat_vbyte"]
METRICS = ("active_addresses", "new_addresses", "transaction_count", "transfer_volume", "exchange_inflow", "exchange_outflow", "sopr", "hashrate_mean", "difficulty", "supply_last_active_1y")


def add_calendar(series: DataFrame) -> DataFrame:
    return series.withColumns(calendar(F.col("timestamp_s")))


def with_whale_ratios(blocks: DataFrame, corrected: bool = False) -> DataFrame:
    """Shares of a block's transactions and volume in the class of 100 to 1,000 coins; ``corrected``: of 100 and more."""
    if not {"tx_count_above_100btc", "volume_above_100btc", "tx_count", "total_output_btc"} <= set(blocks.columns):
        return blocks
    more = lambda kind: F.col(f"{kind}_above_100btc") + (F.coalesce(F.col(f"{kind}_above_1000btc"), F.lit(0)) if corrected else 0)
    return blocks.withColumns({"block_whale_tx_ratio": ratio_or_one(more("tx_count"), F.col("tx_count")), "block_whale_volume_ratio": ratio_or_one(more("volume"), F.col("total_output_btc"))})


def _blocks(blocks: DataFrame, by: tuple[str, ...] = (), corrected: bool = False) -> Slow:
    ready = with_whale_ratios(blocks, corrected)
    wanted = select_available(ready, [*BLOCK_COLUMNS, "block_whale_tx_ratio", "block_whale_volume_ratio"])
    tie = "block_height" if "block_height" in ready.columns else None
    slow = prefixed(ready.select(*by, "block_timestamp", *select_available(ready, ["block_height"]), *wanted), "block_", by)
    return Slow(slow, "block_timestamp", [c for c in slow.columns if c not in (*by, "block_timestamp", "block_height")], tie)


def _mempool(mempool: DataFrame, by: tuple[str, ...] = ()) -> Slow:
    slow = prefixed(mempool.select(*by, "timestamp", *select_available(mempool, MEMPOOL_COLUMNS)), "mempool_", (*by, "timestamp"))
    return Slow(slow, "timestamp", [c for c in slow.columns if c not in (*by, "timestamp")])


def _funding(funding: DataFrame, by: tuple[str, ...] = ()) -> Slow:
    at = F.floor(F.col("calc_time") / 1000) if "calc_time" in funding.columns else F.col("timestamp")
    wanted = select_available(funding, ["last_funding_rate", "mark_price"])
    return Slow(funding.select(*by, at.cast("long").alias("funding_s"), *wanted), "funding_s", wanted)


def _with_basis(joined: DataFrame) -> DataFrame:
    return joined if "mark_price" not in joined.columns else joined.withColumn("basis", ratio(F.col("mark_price") - F.col("close"), F.col("close"), 0.0))


def _metrics(metrics: DataFrame, names: tuple[str, ...] = METRICS, by: tuple[str, ...] = ()) -> Slow:
    wide = metrics.where("value is not null").groupBy(*by, "timestamp").pivot("metric", list(names)).agg(F.max("value"))
    # a metrics table has a row a day: one window over all of it is small
    so_far = Window.partitionBy(*(by or [F.lit(0)])).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    carried = wide.select(*by, "timestamp", *(F.last(n, ignorenulls=True).over(so_far).alias(f"gn_{n}") for n in names))
    return Slow(carried, "timestamp", [f"gn_{n}" for n in names])


def _joined(series: DataFrame, slow: Slow, by: tuple[str, ...]) -> DataFrame:
    return asof_join(series, slow.rows, slow.on, slow.columns, slow.tie, by)


def merge_blocks(series: DataFrame, blocks: DataFrame, by: tuple[str, ...] = (), corrected: bool = False) -> DataFrame:
    """Block columns, prefixed ``block_``, and whale ratios by one as-of join on block_timestamp."""
    return _joined(series, _blocks(blocks, by, corrected), by)


def merge_mempool(series: DataFrame, mempool: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return _joined(series, _mempool(mempool, by), by)


def merge_funding(series: DataFrame, funding: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Funding rate and mark price by as-of join, and the basis (mark - close) / close, NULL as 0. The time is
    calc_time (ms) or, without it, timestamp (s)."""
    return _with_basis(_joined(series, _funding(funding, by), by))


def merge_metrics(series: DataFrame, metrics: DataFrame, names: tuple[str, ...] = METRICS, by: tuple[str, ...] = ()) -> DataFrame:
    """Each metric of the long table (metric, timestamp, value) as ``gn_<name>``, its last value not later. All metrics
    come in one pivot and one as-of join: values are first carried forward column by column. Of several values for
    one time the largest counts; ``read_metrics`` leaves one."""
    return _joined(series, _metrics(metrics, names, by), by)


def forward_fill(df: DataFrame, keys: tuple[str, ...] = ("timestamp_s", "month"), by: tuple[str, ...] = ()) -> DataFrame:
    so_far = series_window(by).rowsBetween(Window.unboundedPreceding, 0)
    return df.select([F.col(c) if c in keys or c in by else F.last(c, ignorenulls=True).over(so_far).alias(c) for c in df.columns])


def build_features(series: DataFrame, blocks: DataFrame | None = None, mempool: DataFrame | None = None, funding: DataFrame | None = None, metrics: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Calendar, blocks, mempool, funding, metrics, then forward fill of every column; absent inputs are left out. All slow series are
    merged in one pass, which deals and sorts the series once."""
    slow = [made(df, by=by) for made, df in ((_blocks, blocks), (_mempool, mempool), (_funding, funding), (_metrics, metrics)) if df is not None]
    return forward_fill(_with_basis(asof_joins(add_calendar(series), slow, by)), by=by)
