"""The registered queries and the SQL that checks them.

Each query applies operators to the driver's tables; floats are rounded to 6 digits at the very end."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import exprs, live
from ..operators import blocks as block_ops, quality, rolling
from ..operators.asof import asof_join
from ..operators.bucket import bucket_trades, fill_gaps, process_trades, reaggregate
from ..operators.features import add_calendar, forward_fill, merge_blocks, merge_funding, merge_mempool, merge_metrics, with_whale_ratios
from ..operators.labels import HORIZONS, leakage, make_labels, top_correlations
from ..operators.normalize import FAST, SLOW, feature_stats, normalize_features, zscore
from ..operators.rolling import rolling_features
from ..sources.readers import list_files
from ..sources.shared import shared_folder
from ..streaming.live import bucket_stream
from . import oracle as q
from .adapters import as_trades, click_funding, order_documents, purchase_mempool, seconds, signup_blocks, table, trades
from .dataset import Recipe, build, missing_months, months_between

HOUR, WINDOWS = 3600, (30, 60, 300)
Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return add


def shown(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Floats as doubles of 6 digits, months dropped."""
    names = [c for c in columns or df.columns if c != "month"]
    kinds = dict(df.dtypes)
    return df.select([F.round(F.col(c).cast("double"), 6).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in names])


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_trades(trades(spark, sf_dir), HOUR)


_BUCKETS = "timestamp_s, trade_count, " + q.rounded([c for c in q.BUCKET_COLUMNS if c != "trade_count"])


@query(f"WITH {q.buckets(60)} SELECT {_BUCKETS} FROM buckets")
def ohlcv_bucket_60s(spark, sf_dir):
    return shown(bucket_trades(trades(spark, sf_dir), 60))


@query(f"WITH {q.buckets(1)} SELECT timestamp_s, round(price_return, 6) AS price_return FROM buckets")
def bucket_return(spark, sf_dir):
    return shown(bucket_trades(trades(spark, sf_dir), 1), ["timestamp_s", "price_return"])


@query(f"WITH {q.dense(HOUR)} SELECT {_BUCKETS} FROM dense")
def gap_fill_3600s(spark, sf_dir):
    return shown(hourly(spark, sf_dir))


@query(f"WITH {q.dense(1)} SELECT month, count(*) AS n_rows, CAST(sum(trade_count) AS BIGINT) AS n_trades, sum(close) AS sum_close, sum(high) AS sum_high, sum(volume) AS sum_volume, sum(buy_ratio = 0.5 AND volume = 0)::BIGINT AS n_filled FROM dense GROUP BY month")
def gap_fill_1s_summary(spark, sf_dir):
    filled = F.count_if((F.col("buy_ratio") == 0.5) & (F.col("volume") == 0))
    return process_trades(trades(spark, sf_dir), 1).groupBy("month").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("trade_count").alias("n_trades"), F.sum("close").alias("sum_close"), F.sum("high").alias("sum_high"), F.sum("volume").alias("sum_volume"), filled.alias("n_filled"))


def _rolling(name: str, kinds: tuple[str, ...]) -> None:
    columns = [f"{k}_{w}s" for w in WINDOWS for k in kinds]
    counts = [c for c in columns if c.startswith("trade_count")]
    floats = [c for c in columns if c not in counts]

    def run(spark, sf_dir):
        return shown(rolling_features(hourly(spark, sf_dir), WINDOWS), ["timestamp_s", *columns])

    run.__name__ = name
    query(f"WITH {q.dense(HOUR)}, {q.rolling(WINDOWS)} SELECT timestamp_s, {', '.join([*counts, *filter(None, [q.rounded(floats)])])} FROM rolled")(run)


for _name, _kinds in (("rolling_volume", ("volume_sum", "quote_volume_sum")), ("rolling_trade_count", ("trade_count",)), ("rolling_buy_ratio", ("buy_ratio",)), ("rolling_vwap", ("vwap",)), ("rolling_imbalance", ("volume_imbalance",)), ("rolling_volatility", ("volatility",)), ("rolling_momentum", ("return",)), ("rolling_range", ("range",))):
    _rolling(_name, _kinds)


@query(f"WITH {q.dense(HOUR)} SELECT timestamp_s, {q.calendar()} FROM dense")
def calendar_features(spark, sf_dir):
    return shown(add_calendar(hourly(spark, sf_dir).select("timestamp_s")))


@query(f"WITH {q.dense(HOUR)}, {q.slow('signup')} SELECT d.timestamp_s, CAST(s.price AS INTEGER) AS block_tx_count, round(s.price / 100, 6) AS block_total_fees_btc, CASE WHEN s.event_id % 5 <> 0 THEN s.quantity END AS block_difficulty FROM dense d ASOF LEFT JOIN signups s ON d.timestamp_s >= s.at")
def asof_blocks(spark, sf_dir):
    return shown(merge_blocks(hourly(spark, sf_dir).select("timestamp_s", "month"), signup_blocks(spark, sf_dir)))


@query(f"WITH {q.dense(HOUR)}, {q.slow('purchase')} SELECT d.timestamp_s, CAST(s.price AS INTEGER) AS mempool_tx_count, s.quantity AS mempool_fee_standard_sat_vbyte FROM dense d ASOF LEFT JOIN purchases s ON d.timestamp_s >= s.at")
def asof_mempool(spark, sf_dir):
    return shown(merge_mempool(hourly(spark, sf_dir).select("timestamp_s", "month"), purchase_mempool(spark, sf_dir)))


@query(f"WITH {q.dense(HOUR)}, {q.slow('click')} SELECT d.timestamp_s, d.close, round(s.quantity / 1000, 6) AS last_funding_rate, s.price AS mark_price, round(coalesce((s.price - d.close) / nullif(d.close, 0), 0), 6) AS basis FROM dense d ASOF LEFT JOIN clicks s ON d.timestamp_s >= s.at")
def asof_funding_basis(spark, sf_dir):
    return shown(merge_funding(hourly(spark, sf_dir).select("timestamp_s", "month", "close"), click_funding(spark, sf_dir)))


def _ship_days(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    return i.groupBy(seconds(i, "l_shipdate").alias("timestamp_s")).agg(F.count(F.lit(1)).alias("n_lines")).withColumn("month", exprs.month_of(F.col("timestamp_s")))


_SHIP_DAYS = "days AS (SELECT epoch_us(l_shipdate) // 1000000 AS timestamp_s, count(*) AS n_lines FROM lineitem GROUP BY 1)"


@query(f"WITH {_SHIP_DAYS}, o AS (SELECT epoch_us(o_orderdate) // 1000000 AS at_s, max(o_orderkey) AS o_orderkey, last(o_totalprice ORDER BY o_orderkey) AS o_totalprice FROM orders GROUP BY 1) SELECT timestamp_s, n_lines, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM days ASOF LEFT JOIN o ON timestamp_s >= at_s")
def asof_orders_lineitem(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    slow = o.select(seconds(o, "o_orderdate").alias("at"), "o_orderkey", "o_totalprice")
    return shown(asof_join(_ship_days(spark, sf_dir), slow, "at", ["o_orderkey", "o_totalprice"], tie="o_orderkey"))


@query(f"WITH {_SHIP_DAYS}, o AS (SELECT epoch_us(o_orderdate) // 86400000000 * 86400 AS at_s, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1), f AS (SELECT at_s, CAST(f AS DOUBLE) AS v FROM o WHERE f > 0), p AS (SELECT at_s, CAST(p AS DOUBLE) AS v FROM o WHERE p > 0) SELECT timestamp_s, n_lines, f.v AS gn_sopr, p.v AS gn_difficulty FROM days ASOF LEFT JOIN f ON timestamp_s >= f.at_s ASOF LEFT JOIN p ON timestamp_s >= p.at_s")
def asof_metrics_pivot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus in ('F', 'P')")
    day = exprs.floor_to(seconds(o, "o_orderdate"), exprs.DAY).alias("timestamp")
    name = F.when(F.col("o_orderstatus") == "F", "sopr").otherwise("difficulty").alias("metric")
    metrics = o.groupBy(name, day).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return shown(merge_metrics(_ship_days(spark, sf_dir), metrics, ("sopr", "difficulty")))


@query("SELECT l_orderkey AS block_height, round(CAST(sum(l_quantity >= 40) AS DOUBLE) / count(*), 6) AS block_whale_tx_ratio, round(coalesce(sum(l_quantity) FILTER (l_quantity >= 40), 0) / CASE WHEN sum(l_quantity) = 0 THEN 1 ELSE sum(l_quantity) END, 6) AS block_whale_volume_ratio FROM lineitem GROUP BY 1")
def whale_ratio(spark, sf_dir):
    big = F.col("l_quantity") >= 40
    blocks = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("block_height")).agg(F.count(F.lit(1)).alias("tx_count"), F.count_if(big).alias("tx_count_above_100btc"), F.lit(0).alias("tx_count_above_1000btc"), F.lit(0.0).alias("volume_above_1000btc"), F.sum(F.when(big, F.col("l_quantity")).otherwise(0)).alias("volume_above_100btc"), F.sum("l_quantity").alias("total_output_btc"))
    return shown(with_whale_ratios(blocks), ["block_height", "block_whale_tx_ratio", "block_whale_volume_ratio"])


@query(f"WITH {q.dense(HOUR)} SELECT timestamp_s, last_value(CASE WHEN close % 3 <> 0 THEN close END IGNORE NULLS) OVER ({q.W}) AS a, last_value(CASE WHEN volume % 2 = 0 THEN volume END IGNORE NULLS) OVER ({q.W}) AS b FROM dense")
def global_ffill(spark, sf_dir):
    holes = hourly(spark, sf_dir).select("timestamp_s", "month", F.when(F.col("close") % 3 != 0, F.col("close")).alias("a"), F.when(F.col("volume") % 2 == 0, F.col("volume")).alias("b"))
    return shown(forward_fill(holes))


@query(f"WITH {q.dense(HOUR)} SELECT timestamp_s, round({q.zscore('close', 168)}, 6) AS close, round({q.zscore('volume', 30)}, 6) AS volume FROM dense")
def rolling_zscore(spark, sf_dir):
    return shown(zscore(hourly(spark, sf_dir).select("timestamp_s", "month", "close", "volume"), {"close": 168, "volume": 30}))


@query(f"WITH {q.dense(HOUR)} SELECT timestamp_s, round(buy_ratio, 6) AS buy_ratio, " + ", ".join(f"round({q.zscore(c, 168)}, 6) AS {c}" for c in ("high", "vwap", "trade_count", "price_return")) + " FROM dense")
def normalize_all(spark, sf_dir):
    series = hourly(spark, sf_dir).select("timestamp_s", "month", "high", "vwap", "trade_count", "price_return", "buy_ratio")
    return shown(normalize_features(series, fast=168))


@query(f"WITH {q.dense(HOUR)} SELECT timestamp_s, round({q.zscore('close', FAST, 720)}, 6) AS close, round({q.zscore('volume', SLOW, 720)}, 6) AS gn_sopr FROM dense")
def normalize_defaults(spark, sf_dir):
    """The default windows, which a month's 720 hours cap."""
    series = hourly(spark, sf_dir).select("timestamp_s", "month", "close", F.col("volume").alias("gn_sopr"))
    return shown(normalize_features(series))


def by_hour(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sums over all rows of each hour, to 3 digits: a series of one second has 2.6 million rows a month."""
    return df.groupBy(exprs.floor_to(F.col("timestamp_s"), HOUR).alias("hour")).agg(F.count(F.lit(1)).alias("n"), *((F.round(F.sum(F.col(c).cast("double")), 3) + 0.0).alias(c) for c in columns))


def sql_by_hour(table: str, columns: list[str]) -> str:
    return f"SELECT timestamp_s // {HOUR} * {HOUR} AS hour, count(*) AS n, {', '.join(f'round(sum(CAST({c} AS DOUBLE)), 3) + 0.0 AS {c}' for c in columns)} FROM {table} GROUP BY 1"


_SECONDS = [f"{k}_{w}s" for w in rolling.WINDOWS for k in ("volume_sum", "quote_volume_sum", "buy_ratio", "volatility", "vwap", "trade_count", "volume_imbalance", "return", "range")]


@query(f"WITH {q.dense(1)}, {q.rolling(rolling.WINDOWS)} {sql_by_hour('rolled', _SECONDS)}")
def rolling_1s_by_hour(spark, sf_dir):
    """All nine features over all five default windows of the series of one second."""
    return by_hour(rolling_features(process_trades(trades(spark, sf_dir), 1)), _SECONDS)


@query(f"WITH {q.dense(1)}, z AS (SELECT timestamp_s, {q.zscore('close', FAST)} AS close, {q.zscore('volume', FAST)} AS volume FROM dense) {sql_by_hour('z', ['close', 'volume'])}")
def zscore_1s_by_hour(spark, sf_dir):
    return by_hour(normalize_features(process_trades(trades(spark, sf_dir), 1).select("timestamp_s", "month", "close", "volume")), ["close", "volume"])


_LABELS = [f"{k}_{n}" for n in HORIZONS for k in ("mu", "sigma", "direction")]


@query(f"WITH {q.dense(HOUR)}, {q.labels(HORIZONS)} SELECT timestamp_s, {q.rounded(_LABELS)} FROM labels")
def labels_all(spark, sf_dir):
    return shown(make_labels(hourly(spark, sf_dir)))


@query(f"WITH {q.dense(1)}, {q.labels(HORIZONS)} {sql_by_hour('labels', _LABELS)}")
def labels_1s_by_hour(spark, sf_dir):
    return by_hour(make_labels(process_trades(trades(spark, sf_dir), 1)), _LABELS)


@query(f"WITH {q.buckets(1)} SELECT timestamp_s // 60 * 60 AS minute, last(close ORDER BY timestamp_s) AS close, sum(volume) AS volume FROM buckets GROUP BY 1")
def bucket_reaggregate_1m(spark, sf_dir):
    return shown(reaggregate(bucket_trades(trades(spark, sf_dir), 1)))


@query(f"WITH {q.buckets(1)}, m AS (SELECT timestamp_s // 60 * 60 AS minute, last(close ORDER BY timestamp_s) AS close, sum(volume) AS volume FROM buckets GROUP BY 1), k AS (SELECT minute, close + minute // 60 % 2 AS kc, volume AS kv FROM m) SELECT count(*) AS n, round(avg(abs(close - kc) / CASE WHEN kc = 0 THEN 1 ELSE kc END) * 100, 6) AS price_error_pct, round(avg(abs(volume - kv) / CASE WHEN kv = 0 THEN 1 ELSE kv END) * 100, 6) AS volume_error_pct, CASE WHEN count(*) = 0 THEN 'no_overlap' WHEN round(avg(abs(close - kc) / CASE WHEN kc = 0 THEN 1 ELSE kc END) * 100, 6) < 0.01 THEN 'ok' ELSE 'warning' END AS status, round(avg(abs(close - kc) / CASE WHEN kc = 0 THEN 1 ELSE kc END) * 100, 6) < 0.01 AS passed FROM m JOIN k USING (minute)")
def kline_crosscheck(spark, sf_dir):
    series = bucket_trades(trades(spark, sf_dir), 1)
    minutes = reaggregate(series)
    klines = minutes.select((F.col("minute") * 1000).alias("open_time"), (F.col("close") + F.floor(F.col("minute") / 60) % 2).alias("close"), "volume")
    return quality.check_klines(series, klines)


_STAT_COLUMNS = ["close", "volume", "buy_ratio", "price_return"]


def _union(template: str, columns: list[str]) -> str:
    return " UNION ALL ".join(template.replace("@", c) for c in columns)


@query(f"WITH {q.buckets(60)} " + _union("SELECT '@' AS feature, round(avg(@), 6) AS mean, round(stddev_samp(@), 6) AS std, round(min(@), 6) AS min, round(max(@), 6) AS max, round(quantile_cont(@, 0.5), 6) AS median, round(quantile_cont(@, 0.01), 6) AS q01, round(quantile_cont(@, 0.99), 6) AS q99, round(1 - count(@) / count(*), 6) AS nan_ratio FROM buckets", _STAT_COLUMNS))
def feature_statistics(spark, sf_dir):
    return shown(feature_stats(bucket_trades(trades(spark, sf_dir), 60), _STAT_COLUMNS))


@query(f"WITH {q.buckets(60)} " + _union("SELECT '@' AS feature, round(avg(@), 4) AS mean, round(stddev_samp(@), 4) AS std, round(min(@), 4) AS min, round(quantile_cont(@, 0.5), 4) AS median, round(max(@), 4) AS max, round(100 - 100.0 * count(@) / count(*), 4) AS nan_pct FROM buckets", _STAT_COLUMNS))
def describe_features(spark, sf_dir):
    return quality.describe(bucket_trades(trades(spark, sf_dir), 60), _STAT_COLUMNS)


@query("WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events) SELECT CAST(least(floor((value - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin, count(*) AS count FROM events, e GROUP BY 1")
def histogram_50(spark, sf_dir):
    return quality.histogram(table(spark, sf_dir, "events"), "value")


_BLOCK = ["block_height", "tx_count", "total_input_btc", "total_output_btc", "total_fees_btc", "fee_rate_min_sat_vbyte", "fee_rate_p50_sat_vbyte", "fee_rate_p90_sat_vbyte", "tx_count_1_10btc", "volume_1_10btc", "tx_count_10_100btc", "tx_size_mean_bytes", "tx_size_median_bytes", "tx_size_p90_bytes", "segwit_tx_count", "taproot_tx_count", "taproot_tx_ratio", "utxo_net_change", "halving_epoch", "blocks_since_halving"]


@query("""WITH t AS (SELECT l_orderkey, CAST(round(CAST(round(l_extendedprice / 1000, 5) AS DECIMAL(20,8)) * 100000000) AS BIGINT) AS paid, l_linenumber * 1000000 AS fee, CAST(l_quantity AS INTEGER) AS vsize, l_returnflag AS f FROM lineitem),
x AS (SELECT *, paid - fee AS created, CASE WHEN vsize > 0 THEN fee / vsize END AS rate FROM t)
SELECT CAST(l_orderkey AS INTEGER) AS block_height, CAST(count(*) + 1 AS INTEGER) AS tx_count, round(sum(paid) / 1e8, 6) AS total_input_btc, round((sum(created) + 625000000) / 1e8, 6) AS total_output_btc, round((sum(paid) - sum(created)) / 1e8, 6) AS total_fees_btc,
 round(CAST(CAST(coalesce(min(rate), 0) AS FLOAT) AS DOUBLE), 6) AS fee_rate_min_sat_vbyte,
 round(CAST(CAST(coalesce(list_sort(list(rate) FILTER (rate IS NOT NULL))[CAST(floor(count(rate) * 50 / 100) AS BIGINT) + 1], 0) AS FLOAT) AS DOUBLE), 6) AS fee_rate_p50_sat_vbyte,
 round(CAST(CAST(coalesce(list_sort(list(rate) FILTER (rate IS NOT NULL))[CAST(floor(count(rate) * 90 / 100) AS BIGINT) + 1], 0) AS FLOAT) AS DOUBLE), 6) AS fee_rate_p90_sat_vbyte,
 CAST(count(*) FILTER (created >= 100000000 AND created < 1000000000) AS INTEGER) AS tx_count_1_10btc, round(CAST(CAST(coalesce(sum(created) FILTER (created >= 100000000 AND created < 1000000000), 0) / 1e8 AS FLOAT) AS DOUBLE), 6) AS volume_1_10btc,
 CAST(count(*) FILTER (created >= 1000000000 AND created < 10000000000) AS INTEGER) AS tx_count_10_100btc,
 round(CAST(CAST((sum(vsize) + 100) / (count(*) + 1) AS FLOAT) AS DOUBLE), 6) AS tx_size_mean_bytes, round(CAST(CAST(quantile_cont_list.m AS FLOAT) AS DOUBLE), 6) AS tx_size_median_bytes, round(CAST(CAST(quantile_cont_list.p AS FLOAT) AS DOUBLE), 6) AS tx_size_p90_bytes,
 CAST(count(*) FILTER (f <> 'R') AS INTEGER) AS segwit_tx_count, CAST(count(*) FILTER (f = 'A') AS INTEGER) AS taproot_tx_count, round(CAST(CAST(count(*) FILTER (f = 'A') / count(*) AS FLOAT) AS DOUBLE), 6) AS taproot_tx_ratio,
 CAST(1 AS INTEGER) AS utxo_net_change, CAST(least(l_orderkey // 210000, 4) AS TINYINT) AS halving_epoch, CAST(l_orderkey - least(l_orderkey // 210000, 4) * 210000 AS INTEGER) AS blocks_since_halving
FROM x JOIN (SELECT k, quantile_cont(s, 0.5) AS m, quantile_cont(s, 0.9) AS p FROM (SELECT l_orderkey AS k, CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS s FROM lineitem UNION ALL SELECT DISTINCT l_orderkey, 100.0 FROM lineitem) GROUP BY k) quantile_cont_list ON k = l_orderkey GROUP BY l_orderkey, quantile_cont_list.m, quantile_cont_list.p""")
def block_rollup(spark, sf_dir):
    return shown(block_ops.block_records(order_documents(spark, sf_dir)), _BLOCK)


@query("SELECT l_orderkey, " + ", ".join(f"round(list_sort(list(l_extendedprice))[CAST(floor(count(*) * {p} / 100) AS BIGINT) + 1], 6) AS p{p}" for p in block_ops.PERCENTILES) + " FROM lineitem GROUP BY 1")
def fee_percentiles_floor_rank(spark, sf_dir):
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_extendedprice").alias("v"))
    return shown(lists.select("l_orderkey", *(exprs.floor_rank(F.col("v"), p).alias(f"p{p}") for p in block_ops.PERCENTILES)))


def _amount_case(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} < {b} THEN '{n}'" for n, b in exprs.AMOUNT_CLASSES[:-1]) + f" ELSE '{exprs.AMOUNT_CLASSES[-1][0]}' END"


@query(f"SELECT {_amount_case('l_extendedprice / 1000')} AS class, count(*) AS n, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY 1")
def amount_histogram(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(exprs.amount_class(F.col("l_extendedprice") / 1000).alias("class")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"))


@query("SELECT o_orderkey * 37 AS block_height, CAST(least(o_orderkey * 37 // 210000, 4) AS TINYINT) AS halving_epoch, CAST(o_orderkey * 37 - least(o_orderkey * 37 // 210000, 4) * 210000 AS INTEGER) AS blocks_since_halving FROM orders")
def halving_epoch(spark, sf_dir):
    h = F.col("o_orderkey") * 37
    return table(spark, sf_dir, "orders").select(h.alias("block_height"), exprs.halving_epoch(h).alias("halving_epoch"), exprs.blocks_since_halving(h).alias("blocks_since_halving"))


@query("SELECT CASE event_type WHEN 'view' THEN 'p2pkh' WHEN 'click' THEN 'p2sh' WHEN 'signup' THEN 'p2tr' WHEN 'error' THEN 'op_return' ELSE 'other' END AS script, count(*) AS n FROM events GROUP BY 1")
def script_type(spark, sf_dir):
    kinds = {"view": "pubkeyhash", "click": "scripthash", "signup": "witness_v1_taproot", "error": "nulldata"}
    kind = F.element_at(F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair)), F.col("event_type"))
    return table(spark, sf_dir, "events").groupBy(exprs.script_type(kind).alias("script")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey AS block_height, CAST(coalesce(epoch_us(o_orderdate) // 1000000 - lag(epoch_us(o_orderdate) // 1000000) OVER (ORDER BY o_orderkey), 0) AS INTEGER) AS seconds_since_prev_block FROM orders")
def seconds_since_prev(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    blocks = o.select(F.col("o_orderkey").alias("block_height"), seconds(o, "o_orderdate").alias("block_timestamp"))
    return block_ops.with_block_gaps(blocks, 1000).select("block_height", "seconds_since_prev_block")


def _message(**fields: str) -> F.Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *(F.when(F.expr(when), F.concat(F.lit(f'"{k}":'), F.expr(value))) for k, (value, when) in fields.items())), F.lit("}"))


@query("WITH " + q.TRADES + " SELECT tms AS event_time, agg_trade_id, CASE WHEN agg_trade_id % 7 = 0 THEN 0 ELSE price / 100 END AS price, quantity, 0::BIGINT AS first_trade_id, user_id AS last_trade_id, tms AS trade_time, is_buyer_maker AND agg_trade_id % 3 <> 0 AS is_buyer_maker FROM trades")
def parse_live_json(spark, sf_dir):
    text = _message(E=("timestamp", "true"), a=("agg_trade_id", "true"), p=("concat('\"', price / 100, '\"')", "agg_trade_id % 7 <> 0"), q=("concat('\"', quantity, '\"')", "true"), l=("user_id", "true"), T=("timestamp", "true"), m=("is_buyer_maker", "agg_trade_id % 3 <> 0"))
    return trades(spark, sf_dir).select(text.alias("message")).select(*live.parse_aggtrade(F.col("message")))


@query("WITH " + q.TRADES + " SELECT agg_trade_id AS update_id, tms AS event_time, price / 100 AS best_bid_price, quantity AS best_bid_qty, CASE WHEN agg_trade_id % 5 = 0 THEN 0 ELSE price / 100 + 1 END AS best_ask_price, quantity + 1 AS best_ask_qty FROM trades")
def parse_live_book(spark, sf_dir):
    text = _message(u=("agg_trade_id", "true"), E=("timestamp", "true"), b=("concat('\"', price / 100, '\"')", "true"), B=("concat('\"', quantity, '\"')", "true"), a=("concat('\"', price / 100 + 1, '\"')", "agg_trade_id % 5 <> 0"), A=("concat('\"', quantity + 1, '\"')", "true"))
    return trades(spark, sf_dir).select(text.alias("message")).select(*live.parse_bookticker(F.col("message")))


@query("WITH " + q.TRADES + " SELECT CASE WHEN agg_trade_id % 4 = 0 THEN -1 ELSE tms END AS event_time, agg_trade_id AS last_update_id, price / 100 AS bid_0_price, quantity AS bid_0_qty, price / 100 - 1 AS bid_1_price, quantity AS bid_1_qty, " + ", ".join(f"0.0::DOUBLE AS {s}_{i}_{k}" for s, i0 in (("bid", 2), ("ask", 1)) for i in range(i0, 5) for k in ("price", "qty")) + ", price / 100 + 1 AS ask_0_price, quantity + 2 AS ask_0_qty FROM trades")
def depth5_flatten(spark, sf_dir):
    level = lambda shift, more: f"concat('[\"', price / 100 + {shift}, '\",\"', quantity + {more}, '\"]')"
    text = _message(E=("timestamp", "agg_trade_id % 4 <> 0"), lastUpdateId=("agg_trade_id", "true"), bids=(f"concat('[', {level(0, 0)}, ',', {level(-1, 0)}, ']')", "true"), asks=(f"concat('[', {level(1, 2)}, ']')", "true"))
    return trades(spark, sf_dir).select(text.alias("message")).select(*live.parse_depth5(F.col("message"), F.lit(-1).cast("long")))


@query("WITH " + q.TRADES + " SELECT tms AS event_time, event_type AS symbol, 'SELL' AS side, '' AS order_type, '' AS time_in_force, quantity, price / 100 AS price, 0.0::DOUBLE AS avg_price, 'FILLED' AS order_status, tms AS trade_time FROM trades")
def parse_live_liquidation(spark, sf_dir):
    inner = _message(s=("concat('\"', event_type, '\"')", "true"), S=("'\"SELL\"'", "true"), q=("concat('\"', quantity, '\"')", "true"), p=("concat('\"', price / 100, '\"')", "true"), X=("'\"FILLED\"'", "true"), T=("timestamp", "true"))
    text = F.concat(F.lit('{"E":'), F.col("timestamp"), F.lit(',"o":'), inner, F.lit("}"))
    return trades(spark, sf_dir).select(text.alias("message")).select(*live.parse_liquidation(F.col("message")))


@query(f"WITH {q.dense(HOUR)}, {q.labels(HORIZONS)}, raw AS (SELECT * FROM buckets), gaps AS (SELECT max(g) AS max_gap FROM (SELECT timestamp_s - lag(timestamp_s) OVER ({q.W}) AS g FROM raw)) SELECT (SELECT count(*) FROM dense) AS n_rows, CAST(14 AS INTEGER) AS n_features, round((SELECT stddev_samp(buy_ratio) FROM dense), 6) AS buy_ratio_std, 0.0::DOUBLE AS null_ratio, max_gap, round((SELECT count(*) FILTER (mu_30s IS NOT NULL AND mu_1m IS NOT NULL AND mu_3m IS NOT NULL AND mu_5m IS NOT NULL) / count(*) FROM labels), 6) AS valid_labels, false AS rows_ok, true AS nulls_ok, max_gap <= 300 AS gap_ok, (SELECT stddev_samp(buy_ratio) FROM dense) >= 0.01 AS variation_ok, (SELECT count(*) FILTER (mu_30s IS NOT NULL AND mu_1m IS NOT NULL AND mu_3m IS NOT NULL AND mu_5m IS NOT NULL) / count(*) FROM labels) > 0.95 AS labels_ok, false AS passed FROM gaps")
def quality_report(spark, sf_dir):
    buckets = bucket_trades(trades(spark, sf_dir), HOUR)
    series = fill_gaps(buckets, HOUR)
    return shown(quality.check_quality(series, make_labels(series), buckets))


@query(f"WITH {q.dense(HOUR)}, {q.labels(HORIZONS)} SELECT round((" + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in _LABELS) + f") / (count(*) * {len(_LABELS)}), 6) AS null_ratio FROM labels")
def null_ratio(spark, sf_dir):
    return quality.null_ratio(make_labels(hourly(spark, sf_dir)), _LABELS)


@query(f"WITH {q.buckets(1)} SELECT max(g) AS max_gap FROM (SELECT timestamp_s - lag(timestamp_s) OVER ({q.W}) AS g FROM buckets)")
def max_gap(spark, sf_dir):
    return quality.max_gap(bucket_trades(trades(spark, sf_dir), 1))


_LEAK = ["close", "volume", "price_return", "vwap"]


@query(f"WITH {q.dense(HOUR)}, {q.labels(HORIZONS)}, b AS (SELECT timestamp_s, month, mu_30s, close, volume, price_return, vwap FROM dense JOIN labels USING (timestamp_s, month) WHERE mu_30s IS NOT NULL), s AS (SELECT *, " + ", ".join(f"lag({c}) OVER ({q.W}) AS p_{c}" for c in _LEAK) + " FROM b) " + _union("SELECT '@' AS feature, round(corr(@, mu_30s), 6) AS corr_now, round(corr(p_@, mu_30s), 6) AS corr_before, coalesce(abs(corr(@, mu_30s)) > 0.5 AND abs(corr(@, mu_30s)) > 2 * coalesce(abs(corr(p_@, mu_30s)), 0), false) AS suspicious FROM s", _LEAK))
def leakage_check(spark, sf_dir):
    series = hourly(spark, sf_dir)
    return shown(leakage(series, make_labels(series), _LEAK))


_CORR = ["close", "volume", "vwap", "buy_ratio", "price_range", "price_return", "trade_count", "volume_imbalance"]


@query(f"WITH {q.dense(HOUR)}, {q.labels(HORIZONS)}, b AS (SELECT * FROM dense JOIN labels USING (timestamp_s, month)) SELECT feature, round(corr, 6) AS corr FROM (" + _union("SELECT '@' AS feature, corr(@, mu_1m) AS corr FROM b", _CORR) + ") ORDER BY abs(corr) DESC, feature LIMIT 5")
def corr_topk(spark, sf_dir):
    series = hourly(spark, sf_dir)
    return shown(top_correlations(series, make_labels(series), _CORR, "mu_1m", 5))


@query(f"WITH {q.dense(HOUR)}, {q.labels(HORIZONS)}, b AS (SELECT * FROM dense JOIN labels USING (timestamp_s, month)) SELECT feature, round(corr, 6) AS corr FROM (" + _union("SELECT '@' AS feature, corr(@, mu_1m) AS corr FROM b", _CORR) + ") ORDER BY abs(corr), feature LIMIT 3")
def corr_last(spark, sf_dir):
    series = hourly(spark, sf_dir)
    return shown(top_correlations(series, make_labels(series), _CORR, "mu_1m", 3, last=True))


@query(f"WITH {q.buckets(1)} SELECT month, count(*) AS n_rows, max(g) AS max_gap, round(stddev_samp(buy_ratio), 6) AS buy_ratio_std FROM (SELECT *, timestamp_s - lag(timestamp_s) OVER ({q.W}) AS g FROM (SELECT b.*, buy_ratio AS br FROM buckets b)) GROUP BY month")
def quality_by_month(spark, sf_dir):
    """Rows, gaps and variation of each month's buckets of one second."""
    buckets = bucket_trades(trades(spark, sf_dir), 1)
    return quality.check_quality(buckets, make_labels(buckets), buckets).select("month", "n_rows", "max_gap", F.round("buy_ratio_std", 6).alias("buy_ratio_std"))

@query("SELECT count(DISTINCT m) AS months, min(m) AS first_month, max(m) AS last_month, count(*) AS n_rows FROM (SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS m FROM lineitem)")
def coverage_months(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    return quality.coverage(i.select(exprs.month_of(seconds(i, "l_shipdate")).alias("month")))


@query()
def file_inventory(spark, sf_dir):
    files = list_files(spark, sf_dir, "*.parquet").select(F.regexp_replace("path", r"^.*/([^/]+\.parquet(?:/[^/]+)?)$", "$1").alias("path"), "length")
    return quality.inventory(files)


@query("WITH m AS (SELECT unnest(generate_series(DATE '1994-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS d) SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS month FROM m WHERE year(d) * 100 + month(d) NOT IN (SELECT year(o_orderdate) * 100 + month(o_orderdate) FROM orders)")
def months_missing(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    done = o.select(exprs.month_of(seconds(o, "o_orderdate")).alias("month"))
    return missing_months(months_between(spark, "1994-01-01", "2001-12-01"), done)


@query("WITH " + q.TRADES + " SELECT event_type AS status, count(*) AS files, CAST(sum(quantity) AS BIGINT) AS rows, CAST(sum(price) AS BIGINT) AS bytes FROM trades GROUP BY 1")
def status_tally(spark, sf_dir):
    return quality.status_tally(trades(spark, sf_dir).select(F.col("event_type").alias("status"), F.col("quantity").cast("long").alias("rows"), F.col("price").cast("long").alias("bytes")))


@query("SELECT c_custkey AS key, c_name AS name, CAST(NULL AS BIGINT) AS suppkey FROM customer UNION ALL SELECT NULL, s_name, s_suppkey FROM supplier")
def concat_parts(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return a.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("suppkey")), allowMissingColumns=True)


@query(f"WITH {q.buckets(60)} SELECT timestamp_s, open, high, low, close, volume, quote_volume, buy_volume, sell_volume, trade_count, round(buy_ratio, 6) AS buy_ratio, round(vwap, 6) AS vwap FROM buckets")
def stream_bucket_twin(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, n: int) -> None:
        batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{folder}/out")

    run = bucket_stream(as_trades(stream), 60).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start()
    run.awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    columns = [c for c in out.columns if c not in ("batch", "month")]
    newest = out.groupBy("timestamp_s").agg(F.max_by(F.struct(*columns), "batch").alias("x")).select("x.*")
    return shown(newest)


_MATRIX = ["close", "volume_sum_60s", "volatility_60s", "vwap_300s", "range_300s", "hour_sin", "is_weekend", "block_difficulty", "mempool_tx_count", "basis", "mu_1m", "sigma_1m", "direction_1m"]


@query(f"""WITH {q.dense(HOUR)}, {q.rolling(WINDOWS)}, {q.labels(HORIZONS)}, {q.slow('signup')}, {q.slow('purchase')}, {q.slow('click')},
m AS (SELECT r.*, CASE WHEN s.event_id % 5 <> 0 THEN s.quantity END AS bd, CAST(p.price AS INTEGER) AS mtc, coalesce((f.price - r.close) / nullif(r.close, 0), 0) AS basis FROM rolled r ASOF LEFT JOIN signups s ON r.timestamp_s >= s.at ASOF LEFT JOIN purchases p ON r.timestamp_s >= p.at ASOF LEFT JOIN clicks f ON r.timestamp_s >= f.at),
c AS (SELECT timestamp_s, {q.calendar()} FROM dense)
SELECT m.timestamp_s, m.close, m.volume_sum_60s, round(m.volatility_60s, 6) AS volatility_60s, round(m.vwap_300s, 6) AS vwap_300s, m.range_300s, c.hour_sin, c.is_weekend, last_value(bd IGNORE NULLS) OVER (PARTITION BY m.month ORDER BY m.timestamp_s) AS block_difficulty, mtc AS mempool_tx_count, round(basis, 6) AS basis, round(mu_1m, 6) AS mu_1m, round(sigma_1m, 6) AS sigma_1m, direction_1m
FROM m JOIN labels l ON m.timestamp_s = l.timestamp_s AND m.month = l.month JOIN c ON c.timestamp_s = m.timestamp_s""")
def feature_matrix(spark, sf_dir):
    recipe = Recipe(grain=HOUR, windows=WINDOWS, priority=2, normalize=False)
    frames = build(trades(spark, sf_dir), recipe, signup_blocks(spark, sf_dir), purchase_mempool(spark, sf_dir), click_funding(spark, sf_dir))
    return shown(frames["features"].join(frames["labels"].drop("month"), "timestamp_s"), ["timestamp_s", *_MATRIX])


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


from . import more  # noqa: E402, F401  registers its queries
