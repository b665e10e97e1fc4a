"""The driver's tables as market data: events as trades and slow series, orders and line items as blocks.

Prices are whole cents held as doubles, so sums are exact in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(df: DataFrame, column: str) -> Column:
    """Epoch microseconds, for timestamps with or without a time zone."""
    if df.schema[column].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")
    return F.unix_micros(column)


def seconds(df: DataFrame, column: str) -> Column:
    return F.floor(micros(df, column) / 1_000_000).cast("long")


def as_trades(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("agg_trade_id"),
        F.floor(micros(events, "ts") / 1000).cast("long").alias("timestamp"),
        F.round(F.col("value") * 100).cast("long").cast("double").alias("price"),
        (F.get_json_object("props", "$.k").cast("long") + 1).cast("double").alias("quantity"),
        F.col("event_type").isin("error", "view").alias("is_buyer_maker"),
        "event_type",
        "user_id",
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trades(table(spark, sf_dir, "events"))


def slow_series(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The last event of a kind in each second: ``at, event_id, price, quantity``."""
    t = trades(spark, sf_dir).where(F.col("event_type") == kind)
    last = F.max_by(F.struct("agg_trade_id", "price", "quantity"), F.struct("timestamp", "agg_trade_id"))
    return t.groupBy(F.floor(F.col("timestamp") / 1000).alias("at")).agg(last.alias("x")).select("at", F.col("x.agg_trade_id").alias("event_id"), "x.price", "x.quantity")


def as_blocks(slow: DataFrame, *more: str) -> DataFrame:
    return slow.select(F.col("at").alias("block_timestamp"), F.col("event_id").alias("block_height"), F.col("price").cast("int").alias("tx_count"), (F.col("price") / 100).alias("total_fees_btc"), F.when(F.col("event_id") % 5 != 0, F.col("quantity")).alias("difficulty"), *more)


def signup_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_blocks(slow_series(spark, sf_dir, "signup"))


def purchase_mempool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slow_series(spark, sf_dir, "purchase").select(F.col("at").alias("timestamp"), F.col("price").cast("int").alias("mempool_tx_count"), F.col("quantity").alias("fee_standard_sat_vbyte"))


def click_funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slow_series(spark, sf_dir, "click").select((F.col("at") * 1000 + 7).alias("calc_time"), (F.col("quantity") / 1000).alias("last_funding_rate"), F.col("price").alias("mark_price"))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as block documents: a coinbase transaction and one for each line item, whose fee is its line number in cents."""
    o, i = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    paid = F.round(F.col("l_extendedprice") / 1000, 5).cast("decimal(20,8)")
    left = (paid - (F.col("l_linenumber") * F.lit(0.01).cast("decimal(20,8)"))).cast("decimal(20,8)")
    kind = F.when(F.col("l_returnflag") == "A", "witness_v1_taproot").when(F.col("l_returnflag") == "N", "witness_v0_keyhash").otherwise("pubkeyhash")
    no_witness = F.array().cast("array<string>")
    tx = F.struct(
        F.col("l_quantity").cast("int").alias("size"),
        F.col("l_quantity").cast("int").alias("vsize"),
        F.array(F.struct(F.lit(None).cast("string").alias("coinbase"), F.when(F.col("l_returnflag") == "R", no_witness).otherwise(F.array(F.lit("00"))).alias("txinwitness"), F.struct(paid.alias("value")).alias("prevout"))).alias("vin"),
        F.array(F.struct(left.alias("value"), F.struct(kind.alias("type")).alias("scriptPubKey"))).alias("vout"),
    )
    reward = F.lit(6.25).cast("decimal(20,8)")
    coinbase = F.struct(F.lit(100).alias("size"), F.lit(100).alias("vsize"), F.array(F.struct(F.lit("00").alias("coinbase"), no_witness.alias("txinwitness"), F.struct(F.lit(None).cast("decimal(20,8)").alias("value")).alias("prevout"))).alias("vin"), F.array(F.struct(reward.alias("value"), F.struct(F.lit("pubkeyhash").alias("type")).alias("scriptPubKey"))).alias("vout"))
    txs = i.groupBy("l_orderkey").agg(F.collect_list(tx).alias("txs"))
    at = seconds(o, "o_orderdate")
    return o.join(txs, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("block_height"), F.concat(F.lit("h"), F.col("o_orderkey")).alias("hash"), at.alias("time"), F.lit(2).alias("version"), F.lit(1000).alias("size"), F.lit(4000).alias("weight"), F.lit(900).alias("strippedsize"), F.lit(1.5).alias("difficulty"), F.lit("1a0f").alias("bits"), F.lit(4_000_000_000).cast("long").alias("nonce"), F.concat(F.array(coinbase), F.col("txs")).alias("tx"),
    )
