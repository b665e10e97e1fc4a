"""Nested block documents to flat block records, within each row: a block never leaves its task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import AMOUNT_CLASSES, SATOSHIS, blocks_since_halving, floor_rank, halving_epoch, satoshis_to_btc

PERCENTILES = (10, 25, 50, 75, 90, 99)
TX = "struct<size:int,vsize:int,vin:array<struct<coinbase:string,txinwitness:array<string>,prevout:struct<value:decimal(20,8)>>>,vout:array<struct<value:decimal(20,8),scriptPubKey:struct<type:string>>>>"
BLOCK_DOCUMENT = f"block_height long, hash string, time long, version int, size int, weight int, strippedsize int, difficulty double, bits string, nonce long, tx array<{TX}>"


def _sum(values: Column, kind: str = "long") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda a, v: a + F.coalesce(v, F.lit(0).cast(kind)))


def _mean(values: Column) -> Column:
    return F.coalesce(F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), F.size(values)), F.lit(0.0))


def _quantile(values: Column, q: float) -> Column:
    """Linear interpolation between order statistics, 0.0 for no values."""
    ordered = F.sort_array(values)
    at = (F.size(values) - 1) * F.lit(q)
    low = F.element_at(ordered, F.floor(at).cast("int") + 1)
    high = F.element_at(ordered, F.least(F.floor(at).cast("int") + 2, F.size(values)))
    return F.when(F.size(values) > 0, low + (high - low) * (at - F.floor(at))).otherwise(0.0)


def _sats(value: Column) -> Column:
    return (F.coalesce(value, F.lit(0).cast("decimal(20,8)")) * SATOSHIS).cast("long")


def _between(low: int, to: float):
    return lambda x: (x["created"] >= low) if to == float("inf") else (x["created"] >= low) & (x["created"] < round(to * SATOSHIS))


def block_records(documents: DataFrame) -> DataFrame:
    """One record for each block document (BLOCK_DOCUMENT).

    The coinbase transaction counts in tx_count, outputs, created UTXOs, sizes and in/out counts (one input) and nowhere
    else. Fees need ``prevout``; a transaction without it has fee 0. Amounts are whole satoshis until the end.
    """

    def flat(tx: Column) -> Column:
        coinbase = F.exists(tx["vin"], lambda v: v["coinbase"].isNotNull())
        spent = _sum(F.transform(tx["vin"], lambda v: _sats(v["prevout"]["value"])))
        known = F.forall(tx["vin"], lambda v: v["prevout"]["value"].isNotNull())
        created = _sum(F.transform(tx["vout"], lambda v: _sats(v["value"])))
        types = F.transform(tx["vout"], lambda v: v["scriptPubKey"]["type"])
        witness = F.exists(tx["vin"], lambda v: F.size(v["txinwitness"]) > 0)
        return F.struct(
            coinbase.alias("coinbase"), spent.alias("spent"), created.alias("created"),
            F.when(~coinbase & known, F.greatest(spent - created, F.lit(0))).otherwise(0).alias("fee"),
            tx["vsize"].alias("vsize"), tx["size"].cast("double").alias("size"),
            F.size(tx["vin"]).cast("double").alias("inputs"), F.size(tx["vout"]).cast("double").alias("outputs"),
            witness.alias("segwit"), F.exists(types, lambda t: t == "witness_v0_keyhash").alias("native"), F.exists(types, lambda t: t == "witness_v1_taproot").alias("taproot"),
        )

    shown = documents.withColumn("t", F.transform("tx", flat))
    shown = shown.withColumn("p", F.filter("t", lambda x: ~x["coinbase"])).withColumn("c", F.filter("t", lambda x: x["coinbase"]))
    of = lambda column, field: F.transform(column, lambda x: x[field])
    rates = F.transform(F.filter("p", lambda x: (x["fee"] > 0) & (x["vsize"] > 0)), lambda x: x["fee"] / x["vsize"])
    shown = shown.withColumn("rates", rates)
    n_paying = F.greatest(F.size("t") - 1, F.lit(1))
    count = lambda column, field: F.size(F.filter(column, lambda x: x[field])).cast("int")
    total_in, total_out = _sum(of("p", "spent")), _sum(of("t", "created"))
    reward = _sum(of("c", "created"))
    n_in, n_out = F.aggregate(of("p", "inputs"), F.lit(0.0), lambda a, v: a + v).cast("int"), F.aggregate(of("t", "outputs"), F.lit(0.0), lambda a, v: a + v).cast("int")
    sizes, ins, outs = of("t", "size"), F.transform("t", lambda x: F.when(x["coinbase"], 1.0).otherwise(x["inputs"])), of("t", "outputs")
    amounts: list[Column] = []
    below = 0.0
    for name, to in AMOUNT_CLASSES:
        inside = F.filter("p", _between(round(below * SATOSHIS), to))
        amounts += [F.size(inside).cast("int").alias(f"tx_count_{name}btc"), satoshis_to_btc(_sum(of(inside, "created"))).cast("float").alias(f"volume_{name}btc")]
        below = to
    height = F.col("block_height")
    return shown.select(
        height.cast("int").alias("block_height"), F.col("hash").alias("block_hash"), F.col("time").alias("block_timestamp"), F.col("version").alias("block_version"),
        F.size("t").cast("int").alias("tx_count"), F.col("size").alias("block_size_bytes"), F.col("weight").alias("block_weight"), F.col("strippedsize").alias("block_stripped_size"),
        F.col("difficulty"), F.conv("bits", 16, 10).cast("long").alias("bits"), "nonce",
        satoshis_to_btc(total_in).alias("total_input_btc"), satoshis_to_btc(total_out).alias("total_output_btc"), satoshis_to_btc(F.greatest(total_in - total_out + reward, F.lit(0))).alias("total_fees_btc"), satoshis_to_btc(reward).alias("coinbase_reward_btc"),
        F.coalesce(F.array_min("rates"), F.lit(0.0)).cast("float").alias("fee_rate_min_sat_vbyte"), *(floor_rank(F.col("rates"), p).cast("float").alias(f"fee_rate_p{p}_sat_vbyte") for p in PERCENTILES), F.coalesce(F.array_max("rates"), F.lit(0.0)).cast("float").alias("fee_rate_max_sat_vbyte"),
        *amounts,
        _mean(ins).cast("float").alias("tx_input_count_mean"), _quantile(ins, 0.5).cast("float").alias("tx_input_count_median"), _mean(outs).cast("float").alias("tx_output_count_mean"), _quantile(outs, 0.5).cast("float").alias("tx_output_count_median"),
        _mean(sizes).cast("float").alias("tx_size_mean_bytes"), _quantile(sizes, 0.5).cast("float").alias("tx_size_median_bytes"), _quantile(sizes, 0.9).cast("float").alias("tx_size_p90_bytes"),
        count("p", "segwit").alias("segwit_tx_count"), count("p", "native").alias("native_segwit_tx_count"), count("p", "taproot").alias("taproot_tx_count"),
        (count("p", "segwit") / n_paying).cast("float").alias("segwit_tx_ratio"), (count("p", "taproot") / n_paying).cast("float").alias("taproot_tx_ratio"),
        n_out.alias("utxo_created_count"), n_in.alias("utxo_spent_count"), (n_out - n_in).alias("utxo_net_change"), satoshis_to_btc(total_out).alias("utxo_created_value_btc"), satoshis_to_btc(total_in).alias("utxo_spent_value_btc"),
        halving_epoch(height).alias("halving_epoch"), blocks_since_halving(height).alias("blocks_since_halving"), F.aggregate(of("c", "outputs"), F.lit(0.0), lambda a, v: a + v).cast("short").alias("coinbase_outputs_count"),
    )


def with_block_gaps(blocks: DataFrame, span: int = 10_000) -> DataFrame:
    """seconds_since_prev_block by height, 0 for the first block. Heights are dealt in spans with the last block before each
    span carried in, over spans without blocks too, so no task orders the whole chain."""
    part = F.floor(F.col("block_height") / span)
    dealt = blocks.withColumn("__span", part).withColumn("__own", F.lit(True))
    ends = blocks.groupBy(part.alias("__span")).agg(F.max(F.struct("block_height", "block_timestamp")).alias("e"))
    before = Window.partitionBy(F.lit(0)).orderBy("__span")  # one row for each span
    edge = ends.withColumn("e", F.lag("e").over(before)).where("e is not null").select("__span", "e.*").withColumn("__own", F.lit(False))
    w = Window.partitionBy("__span").orderBy("block_height")
    gap = F.coalesce(F.col("block_timestamp") - F.lag("block_timestamp").over(w), F.lit(0)).cast("int")
    return dealt.unionByName(edge, allowMissingColumns=True).withColumn("seconds_since_prev_block", gap).where("__own").drop("__span", "__own")
