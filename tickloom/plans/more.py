"""Further registered queries: streams with keyed state, and relational operators beyond the series."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.exprs import AMOUNT_CLASSES, month_of
from ..operators.bags import grouped_totals, reconcile, stratified_sample
from ..operators.blocks import block_records
from ..operators.frames import range_frames
from ..operators.intervals import interval_join
from ..operators.labels import HORIZONS
from ..operators.normalize import FAST, SLOW
from ..operators.ranks import rank_rows
from ..operators.sessions import sessions, sliding
from ..operators.sketches import DISTINCT_ERROR, RANK_ERROR, load_sketches, merged_statistics, month_sketches, store_sketches
from ..sources.shared import shared_folder
from ..streaming.stateful import asof_stream, fill_gaps_stream, rocksdb
from . import oracle as q
from .adapters import as_blocks, as_trades, click_funding, micros, purchase_mempool, seconds, signup_blocks, table, trades
from .catalog import HOUR, by_hour, oracle_sql, query, shown, sql_by_hour
from .dataset import Recipe, build
from .sql import register as register_sql

#: A row so far ahead of a stream that it ends it.
CLOCK_S = 4_000_000_000


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def in_parts(events: DataFrame, folder: str, parts: int, late_s: int) -> None:
    """Events by time in ``parts`` folders ``part=0`` ..., and one event far ahead in a last one. Of the last ``late_s`` seconds of a part a
    third comes with the next one: late rows."""
    at = F.floor(micros(events, "ts") / 1_000_000).cast("long")
    low, high = events.agg(F.min(at), F.max(at)).first()
    span = -(-(high - low + 1) // parts)
    part = F.floor((at - low) / span)
    part = F.when((F.col("event_id") % 3 == 0) & (F.floor((at - low + late_s) / span) > part), part + 1).otherwise(part)
    events.withColumn("part", F.least(part, F.lit(parts - 1)).cast("int")).write.partitionBy("part").parquet(folder)
    ahead = F.timestamp_seconds(F.lit(CLOCK_S)).cast(events.schema["ts"].dataType)
    events.limit(1).withColumns({"event_id": F.lit(-1).cast("long"), "ts": ahead}).write.parquet(f"{folder}/part={parts}")


def ran(stream: DataFrame, folder: str, out: str) -> None:
    """Takes what the stream has now and stops. State is kept in no more partitions than twice the cores."""
    spark, key = stream.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), 2 * spark.sparkContext.defaultParallelism))
    try:
        with rocksdb(spark):
            run = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", folder).trigger(availableNow=True).start(out)
    finally:
        spark.conf.set(key, before)
    run.awaitTermination()


def _dense_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The hourly series by a stream that is stopped and started again for each part of the events; read from what it wrote."""
    events, parts = table(spark, sf_dir, "events"), 3
    in_parts(events, f"{folder}/events", parts, 12 * HOUR)
    for k in range(parts + 1):
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/events/part=[0-{k}]")
        ran(fill_gaps_stream(as_trades(stream), HOUR, late="1 day"), f"{folder}/fill", f"{folder}/series")
    return spark.read.parquet(f"{folder}/series")


@query(oracle_sql()["gap_fill_3600s"])
def stream_gap_fill_3600s(spark, sf_dir):
    """``gap_fill_3600s`` from a stream in four runs, with late rows."""
    return shown(_dense_stream(spark, sf_dir, _folder(spark)))


@query(oracle_sql()["asof_blocks"])
def stream_asof_blocks(spark, sf_dir):
    """``asof_blocks`` from two streams: the hourly series, as the other stream writes it, and the events of the blocks, in several batches."""
    folder = _folder(spark)
    series = _dense_stream(spark, sf_dir, folder).select("timestamp_s", "month")
    clock = spark.range(1).select(F.lit(CLOCK_S).cast("long").alias("timestamp_s"), F.lit(0).alias("month"))
    clock.limit(0).write.parquet(f"{folder}/clock")
    lefts = spark.readStream.schema(series.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/series").unionByName(spark.readStream.schema(series.schema).parquet(f"{folder}/clock"))
    events = table(spark, sf_dir, "events")
    parts = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/events/part=*")
    made = as_trades(parts).where((F.col("event_type") == "signup") | (F.col("agg_trade_id") < 0))
    tie = (F.col("timestamp") % 1000).cast("long") * (1 << 40) + F.col("agg_trade_id")
    blocks = as_blocks(made.select(F.floor(F.col("timestamp") / 1000).alias("at"), F.col("agg_trade_id").alias("event_id"), "price", "quantity", tie.alias("tie")), "tie")
    columns = ["tx_count", "total_fees_btc", "difficulty"]
    named = blocks.select("block_timestamp", "tie", *(F.col(c).alias(f"block_{c}") for c in columns))
    joined = asof_stream(lefts, named, "block_timestamp", [f"block_{c}" for c in columns], "tie", late="40 days")
    ran(joined, f"{folder}/asof", f"{folder}/joined")
    # both streams end in one run: a run knows no watermark of a stream from which it had no rows
    clock.write.mode("append").parquet(f"{folder}/clock")
    spark.read.schema(events.schema).parquet(f"{folder}/events/part=3").write.mode("append").parquet(f"{folder}/events/part=3")
    ran(joined, f"{folder}/asof", f"{folder}/joined")
    return shown(spark.read.parquet(f"{folder}/joined"))


_MS = 60_000


@query(f"WITH {q.TRADES} SELECT b.agg_trade_id AS block_height, t.agg_trade_id, t.tms - b.tms AS offset_ms, t.price, t.quantity FROM trades b JOIN trades t ON t.tms BETWEEN b.tms - {_MS} AND b.tms WHERE b.event_type = 'signup'")
def interval_join_trades(spark, sf_dir):
    """All trades of the minute before each block."""
    all_trades = trades(spark, sf_dir)
    blocks = all_trades.where("event_type = 'signup'").select(F.col("agg_trade_id").alias("block_height"), F.col("timestamp").alias("at"))
    found = interval_join(blocks, all_trades.select("agg_trade_id", "timestamp", "price", "quantity"), "at", "timestamp", _MS)
    return shown(found.select("block_height", "agg_trade_id", (F.col("timestamp") - F.col("at")).alias("offset_ms"), "price", "quantity"))


_FRAMES, _FRAME_KINDS = (60_000, 3_600_000, 86_400_000), {"volume": ("sum", "quantity"), "n": ("count", "price"), "low": ("min", "price"), "high": ("max", "price")}


@query(f"WITH {q.TRADES} SELECT DISTINCT event_type, tms AS timestamp, " + ", ".join(f"CAST({kind}({column}) OVER (PARTITION BY event_type ORDER BY tms RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) AS {'BIGINT' if kind == 'count' else 'DOUBLE'}) AS {n}_{w}" for w in _FRAMES for n, (kind, column) in _FRAME_KINDS.items()) + " FROM trades")
def range_frames_trades(spark, sf_dir):
    """Volume, count and price range over a minute, an hour and a day before each trade of a kind."""
    return shown(range_frames(trades(spark, sf_dir), "timestamp", list(_FRAMES), _FRAME_KINDS, ("event_type",)))


_RANKED = "OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice)"
_NUMBERED = "OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_orderkey, l_linenumber)"


@query(f"SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice, row_number() {_NUMBERED} AS row_number, rank() {_RANKED} AS rank, dense_rank() {_RANKED} AS dense_rank, round(percent_rank() {_RANKED}, 9) AS percent_rank, round(cume_dist() {_RANKED}, 9) AS cume_dist, CAST(ntile(100) {_NUMBERED} AS INTEGER) AS tile, nth_value(l_extendedprice, 10) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS nth_value FROM lineitem")
def ranks_lineitem(spark, sf_dir):
    """All ranks of every line's price among those of its return flag, three groups of a table."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    ranked = rank_rows(lines, "l_extendedprice", ["l_orderkey", "l_linenumber"], ("l_returnflag",), tiles=100, nth=10)
    return ranked.withColumns({c: F.round(c, 9) for c in ("percent_rank", "cume_dist")})


_QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)


@query("SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(count(DISTINCT month(l_shipdate)) AS BIGINT) AS months, count(*) AS n_rows, min(l_extendedprice) AS low, max(l_extendedprice) AS high, true AS quantiles_within, true AS distinct_within FROM lineitem GROUP BY 1")
def sketched_years(spark, sf_dir):
    """Quantiles of the price and the number of parts of each year, from sketches stored by month; the bounds are checked against all rows."""
    lines, path = table(spark, sf_dir, "lineitem"), f"{shared_folder(spark)}/sketches-{uuid.uuid4().hex}"
    dated = lines.withColumn("month", month_of(seconds(lines, "l_shipdate")))
    store_sketches(month_sketches(dated, ["l_extendedprice"], ["l_partkey"]), path)
    stored = load_sketches(spark, path).withColumn("year", F.floor(F.col("month") / 100).cast("int"))
    told = merged_statistics(stored, ("year",), (0.0, *_QUANTILES, 1.0))
    prices = told.where("feature = 'l_extendedprice'").select(F.col("year").alias("y"), F.transform("quantiles", lambda x: x["value"]).alias("v"))
    parts = told.where("feature = 'l_partkey'").select(F.col("year").alias("y"), F.col("distinct").alias("parts"))
    facts = F.broadcast(prices.join(parts, "y"))  # a row a year
    rows = dated.withColumn("year", F.floor(F.col("month") / 100).cast("int")).join(facts, F.col("year") == F.col("y"))
    n = F.count(F.lit(1))
    # the ranks that the values have among all rows: from those below to those not above
    near = [(F.count_if(F.col("l_extendedprice") < F.col("v")[i + 1]) / n <= x + RANK_ERROR) & (F.count_if(F.col("l_extendedprice") <= F.col("v")[i + 1]) / n >= x - RANK_ERROR) for i, x in enumerate(_QUANTILES)]
    exact = F.count_distinct("l_partkey")
    within = near[0]
    for x in near[1:]:
        within = within & x
    return rows.groupBy("year").agg(F.count_distinct("month").alias("months"), n.alias("n_rows"), F.first("v")[0].alias("low"), F.first("v")[len(_QUANTILES) + 1].alias("high"), within.alias("quantiles_within"), (F.abs(F.first("parts") - exact) <= DISTINCT_ERROR * exact + 1).alias("distinct_within"))


@query("""WITH e AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM e)
SELECT user_id, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) + 21600000000 AS ended_us, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM s GROUP BY user_id, session""")
def sessions_by_user(spark, sf_dir):
    """A user's events less than six hours apart."""
    events = table(spark, sf_dir, "events")
    found = sessions(events, "ts", "6 hours", ("user_id",), {"n": F.count(F.lit(1)), "cents": F.sum(F.round(F.col("value") * 100).cast("long"))})
    return found.select("user_id", micros(found, "started").alias("started_us"), micros(found, "ended").alias("ended_us"), "n", "cents")


@query("""SELECT event_type, (epoch_us(ts) // 900000000 - k) * 900000000 AS started_us, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events, (SELECT unnest([0, 1, 2, 3]) AS k) GROUP BY 1, 2""")
def sliding_hours(spark, sf_dir):
    """Windows of an hour, one every quarter of an hour."""
    events = table(spark, sf_dir, "events")
    found = sliding(events, "ts", "1 hour", "15 minutes", ("event_type",), {"n": F.count(F.lit(1)), "cents": F.sum(F.round(F.col("value") * 100).cast("long"))})
    return found.select("event_type", micros(found, "started").alias("started_us"), "n", "cents")


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, o_orderstatus, grouping_id(year(o_orderdate), o_orderpriority, o_orderstatus) AS grouping_id, count(*) AS n, count(DISTINCT o_custkey) AS customers, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY GROUPING SETS ((year(o_orderdate), o_orderpriority), (o_orderpriority, o_orderstatus), (year(o_orderdate)), ())")
def totals_by_sets(spark, sf_dir):
    """Orders, different customers and prices by several sets of keys at once."""
    o = table(spark, sf_dir, "orders")
    dated = o.withColumn("year", F.year("o_orderdate"))
    totals = {"n": F.count(F.lit(1)), "customers": F.count_distinct("o_custkey"), "cents": F.sum(F.round(F.col("o_totalprice") * 100).cast("long"))}
    return grouped_totals(dated, [("year", "o_orderpriority"), ("o_orderpriority", "o_orderstatus"), ("year",), ()], ["year", "o_orderpriority", "o_orderstatus"], totals)


_LIVE = "SELECT event_id, event_type, CASE WHEN event_id % 50 = 3 THEN user_id + 1 ELSE user_id END AS user_id, CASE WHEN event_id % 40 = 1 THEN NULL ELSE cents END AS cents FROM a WHERE event_id % 30 <> 7 UNION ALL SELECT event_id, event_type, user_id, cents FROM a WHERE event_id % 25 = 9"


@query(f"""WITH a AS (SELECT event_id, event_type, user_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events), b AS ({_LIVE}),
u AS (SELECT *, 1 AS x, 0 AS y FROM a UNION ALL SELECT *, 0, 1 FROM b), c AS (SELECT event_id, event_type, user_id, cents, sum(x) AS x, sum(y) AS y FROM u GROUP BY ALL)
SELECT event_id, CAST(sum(x) AS BIGINT) AS n_a, CAST(sum(y) AS BIGINT) AS n_b, CAST(sum(least(x, y)) AS BIGINT) AS same, CAST(sum(greatest(x - y, 0)) AS BIGINT) AS missing, CAST(sum(greatest(y - x, 0)) AS BIGINT) AS extra,
 concat_ws(',', CASE WHEN list_sort(list(event_type) FILTER (x > y)) IS DISTINCT FROM list_sort(list(event_type) FILTER (y > x)) THEN 'event_type' END, CASE WHEN list_sort(list(user_id) FILTER (x > y)) IS DISTINCT FROM list_sort(list(user_id) FILTER (y > x)) THEN 'user_id' END, CASE WHEN list_sort(list(cents) FILTER (x > y)) IS DISTINCT FROM list_sort(list(cents) FILTER (y > x)) THEN 'cents' END) AS differing
FROM c GROUP BY event_id""")
def reconcile_trades(spark, sf_dir):
    """An archive of trades against a live copy that lacks some, repeats some and has other values or none in some."""
    events = table(spark, sf_dir, "events")
    archive = events.select("event_id", "event_type", "user_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    i = F.col("event_id")
    live = archive.where(i % 30 != 7).withColumns({"user_id": F.when(i % 50 == 3, F.col("user_id") + 1).otherwise(F.col("user_id")), "cents": F.when(i % 40 != 1, F.col("cents"))})
    return reconcile(archive, live.unionByName(archive.where(i % 25 == 9)), ["event_id"])


@query("SELECT event_type, CAST(least(count(*), 100) AS BIGINT) AS taken, CAST(count(*) AS DOUBLE) AS weights, true AS smallest FROM events GROUP BY 1")
def sample_by_type(spark, sf_dir):
    """100 events of each type; no event that was left out has a smaller hash."""
    events = table(spark, sf_dir, "events")
    taken = stratified_sample(events, ["event_type"], ["event_id"], 100)
    key = F.xxhash64("event_id", F.lit(42))
    worst = taken.groupBy(F.col("event_type").alias("t")).agg(F.count(F.lit(1)).alias("taken"), F.round(F.sum("weight"), 6).alias("weights"), F.max(key).alias("worst"))
    below = events.join(F.broadcast(worst), F.col("event_type") == F.col("t"))  # a row a type
    return below.groupBy("event_type").agg(F.first("taken").alias("taken"), F.first("weights").alias("weights"), (F.count_if(key <= F.col("worst")) == F.first("taken")).alias("smallest"))


@query(oracle_sql()["gap_fill_3600s"])
def sql_dense_hours(spark, sf_dir):
    """``gap_fill_3600s`` as a query of SQL table functions."""
    register_sql(spark, trades(spark, sf_dir))
    return shown(spark.sql(f"SELECT * FROM dense({HOUR})"))


@query(f"WITH {q.dense(HOUR)} SELECT timestamp_s, open, high, low, close, round(vwap, 6) AS vwap FROM dense")
def sql_fill_series(spark, sf_dir):
    """The prices of the dense series from a table function over any table."""
    register_sql(spark, trades(spark, sf_dir))
    return spark.sql(f"WITH b AS (SELECT month, timestamp_s, open, high, low, close, vwap FROM ohlcv({HOUR})) SELECT timestamp_s, open, high, low, close, round(vwap, 6) AS vwap FROM fill_series(TABLE(b) PARTITION BY month ORDER BY (timestamp_s), 'timestamp_s', {HOUR})")


@query(f"WITH {q.TRADES} SELECT p.agg_trade_id, p.user_id, s.agg_trade_id AS signup, s.price FROM trades p ASOF LEFT JOIN (SELECT * FROM trades WHERE event_type = 'signup') s ON p.user_id = s.user_id AND p.tms * 1000000 + p.agg_trade_id >= s.tms * 1000000 + s.agg_trade_id WHERE p.event_type = 'purchase'")
def sql_last_signup(spark, sf_dir):
    """Each purchase with the user's last sign-up before it."""
    register_sql(spark, trades(spark, sf_dir))
    return spark.sql("WITH u AS (SELECT user_id, timestamp, agg_trade_id, price, event_type = 'purchase' AS bought FROM trades WHERE event_type IN ('purchase', 'signup')) SELECT agg_trade_id, user_id, last_agg_trade_id AS signup, last_price AS price FROM last_before(TABLE(u) PARTITION BY user_id ORDER BY (timestamp, agg_trade_id), 'bought')")


_Z = {"volume_sum_60s": FAST, "vwap_3600s": FAST, "block_difficulty": FAST, "basis": FAST, "gn_sopr": SLOW}
_FULL = [*_Z, "buy_ratio", "is_weekend", "mu_1m", "sigma_5m"]


@query(f"""WITH {q.dense(1)}, {q.rolling((60, 3600))}, {q.labels(HORIZONS)}, {q.slow('signup')}, {q.slow('click')},
g AS (SELECT tms // 86400000 * 86400 AS at, CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) AS v FROM trades GROUP BY 1),
m AS (SELECT r.*, CASE WHEN s.event_id % 5 <> 0 THEN s.quantity END AS bd, coalesce((f.price - r.close) / nullif(r.close, 0), 0) AS basis, g.v AS sopr FROM rolled r ASOF LEFT JOIN signups s ON r.timestamp_s >= s.at ASOF LEFT JOIN clicks f ON r.timestamp_s >= f.at ASOF LEFT JOIN g ON r.timestamp_s >= g.at),
filled AS (SELECT *, last_value(bd IGNORE NULLS) OVER ({q.W}) AS block_difficulty, last_value(sopr IGNORE NULLS) OVER ({q.W}) AS gn_sopr FROM m),
z AS (SELECT month, timestamp_s, buy_ratio, CAST((timestamp_s // 86400 + 3) % 7 >= 5 AS DOUBLE) AS is_weekend, {', '.join(f'{q.zscore(c, w)} AS {c}' for c, w in _Z.items())} FROM filled),
matrix AS (SELECT z.*, mu_1m, sigma_5m FROM z JOIN labels USING (month, timestamp_s))
{sql_by_hour('matrix', _FULL)}""")
def feature_matrix_1s_by_hour(spark, sf_dir):
    """The whole build at a grain of one second: five windows, blocks, mempool, funding and daily metrics, normalised, with labels."""
    days = trades(spark, sf_dir).groupBy((F.floor(F.col("timestamp") / 86_400_000) * 86_400).alias("timestamp")).agg(F.count_if(F.col("event_type") == "purchase").cast("double").alias("value")).withColumn("metric", F.lit("sopr"))
    frames = build(trades(spark, sf_dir), Recipe(priority=2), signup_blocks(spark, sf_dir), purchase_mempool(spark, sf_dir), click_funding(spark, sf_dir), days)
    return by_hour(frames["features"].join(frames["labels"], ["month", "timestamp_s"]), _FULL)


_CLASS_COLUMNS = [f"{kind}_{name}btc" for name, _ in AMOUNT_CLASSES for kind in ("tx_count", "volume")]
_COUNT_COLUMNS = ["tx_input_count_mean", "tx_input_count_median", "tx_output_count_mean", "tx_output_count_median", "utxo_created_count", "utxo_spent_count", "utxo_net_change", "coinbase_outputs_count"]


def _classes_sql() -> str:
    low, out = 0, []
    for name, to in AMOUNT_CLASSES:
        inside = f"sats >= {low}" + ("" if to == float("inf") else f" AND sats < {round(to * 100_000_000)}")
        out += [f"CAST(count(*) FILTER ({inside}) AS INTEGER) AS tx_count_{name}btc", f"round(CAST(CAST(coalesce(sum(sats) FILTER ({inside}), 0) / 1e8 AS FLOAT) AS DOUBLE), 6) AS volume_{name}btc"]
        low = 0 if to == float("inf") else round(to * 100_000_000)
    return ", ".join(out)


@query(f"""WITH t AS (SELECT l_orderkey AS h, CAST(round(l_extendedprice * 100) AS BIGINT) // 100 * 2 * CAST(10 ** (l_linenumber - 1) AS BIGINT) AS sats, 1 + l_linenumber % 3 AS i, 1 + l_suppkey % 2 AS o FROM lineitem),
c AS (SELECT h, CAST(i AS DOUBLE) AS i, CAST(o AS DOUBLE) AS o FROM t UNION ALL SELECT DISTINCT h, 1.0, 2.0 FROM t),
n AS (SELECT h, avg(i) AS im, median(i) AS ip, avg(o) AS om, median(o) AS op, CAST(sum(o) AS INTEGER) AS made, CAST(sum(i) - 1 AS INTEGER) AS spent FROM c GROUP BY h),
a AS (SELECT h, {_classes_sql()} FROM t GROUP BY h)
SELECT CAST(h AS INTEGER) AS block_height, {', '.join(_CLASS_COLUMNS)}, {', '.join(f'round(CAST(CAST({x} AS FLOAT) AS DOUBLE), 6) AS tx_{y}' for x, y in (('im', 'input_count_mean'), ('ip', 'input_count_median'), ('om', 'output_count_mean'), ('op', 'output_count_median')))},
 made AS utxo_created_count, spent AS utxo_spent_count, made - spent AS utxo_net_change, CAST(2 AS SMALLINT) AS coinbase_outputs_count FROM a JOIN n USING (h)""")
def block_counts(spark, sf_dir):
    """Inputs, outputs and all amount classes of blocks whose transactions have one to three inputs and one or two outputs."""
    lines = table(spark, sf_dir, "lineitem")
    sats = F.floor(F.round(F.col("l_extendedprice") * 100).cast("long") / 100) * 2 * F.pow(F.lit(10.0), F.col("l_linenumber") - 1).cast("long")
    coins = (sats.cast("decimal(20,0)") / F.lit(100_000_000).cast("decimal(10,0)")).cast("decimal(20,8)")
    free, witness = F.lit(0).cast("decimal(20,8)"), F.array().cast("array<string>")
    vin = lambda value, coinbase: F.struct(coinbase.cast("string").alias("coinbase"), witness.alias("txinwitness"), F.struct(value.alias("value")).alias("prevout"))
    vout = lambda value: F.struct(value.alias("value"), F.struct(F.lit("pubkeyhash").alias("type")).alias("scriptPubKey"))
    none = F.lit(None)
    tx = lambda inputs, outputs: F.struct(F.lit(100).alias("size"), F.lit(100).alias("vsize"), inputs.alias("vin"), outputs.alias("vout"))
    paid = tx(F.concat(F.array(vin(coins, none)), F.array_repeat(vin(free, none), F.col("l_linenumber") % 3)), F.concat(F.array(vout(coins)), F.array_repeat(vout(free), (F.col("l_suppkey") % 2).cast("int"))))
    first = tx(F.array(vin(none.cast("decimal(20,8)"), F.lit("00"))), F.array(vout(F.lit(6.25).cast("decimal(20,8)")), vout(free)))
    blocks = lines.groupBy(F.col("l_orderkey").alias("block_height")).agg(F.collect_list(paid).alias("paid"))  # at most seven lines an order
    whole = [F.lit("h").alias("hash"), F.lit(0).cast("long").alias("time"), *(F.lit(1).alias(c) for c in ("version", "size", "weight", "strippedsize")), F.lit(1.0).alias("difficulty"), F.lit("1a").alias("bits"), F.lit(1).cast("long").alias("nonce")]
    documents = blocks.select("block_height", *whole, F.concat(F.array(first), "paid").alias("tx"))
    return shown(block_records(documents), ["block_height", *_CLASS_COLUMNS, *_COUNT_COLUMNS])
