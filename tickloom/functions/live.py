"""Parsers of live JSON messages: missing fields become 0, "" or false; numbers may come as strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Message key, column, type.
AGGTRADE = (("E", "event_time", "long"), ("a", "agg_trade_id", "long"), ("p", "price", "double"), ("q", "quantity", "double"), ("f", "first_trade_id", "long"), ("l", "last_trade_id", "long"), ("T", "trade_time", "long"), ("m", "is_buyer_maker", "boolean"))
BOOKTICKER = (("u", "update_id", "long"), ("E", "event_time", "long"), ("b", "best_bid_price", "double"), ("B", "best_bid_qty", "double"), ("a", "best_ask_price", "double"), ("A", "best_ask_qty", "double"))
LIQUIDATION = (("s", "symbol", "string"), ("S", "side", "string"), ("o", "order_type", "string"), ("f", "time_in_force", "string"), ("q", "quantity", "double"), ("p", "price", "double"), ("ap", "avg_price", "double"), ("X", "order_status", "string"), ("T", "trade_time", "long"))
MEMPOOL = (("mempoolInfo.size", "mempool_tx_count", "int"), ("mempoolInfo.bytes", "mempool_vsize_bytes", "int"), ("fees.economyFee", "fee_economy_sat_vbyte", "float"), ("fees.hourFee", "fee_standard_sat_vbyte", "float"), ("fees.halfHourFee", "fee_priority_sat_vbyte", "float"), ("fees.fastestFee", "fee_urgent_sat_vbyte", "float"))
_DEFAULT = {"long": 0, "int": 0, "double": 0.0, "float": 0.0, "boolean": False, "string": ""}


def _field(message: Column, path: str, name: str, kind: str) -> Column:
    # get_json_object tells keys apart by case, which JSON schemas in Spark do not ("a" and "A" are both used)
    value = F.get_json_object(message, f"$.{path}").try_cast(kind)
    return F.coalesce(value, F.lit(_DEFAULT[kind]).cast(kind)).alias(name)


def parse_aggtrade(message: Column) -> list[Column]:
    return [_field(message, *x) for x in AGGTRADE]


def parse_bookticker(message: Column) -> list[Column]:
    return [_field(message, *x) for x in BOOKTICKER]


def parse_liquidation(message: Column) -> list[Column]:
    return [_field(message, "E", "event_time", "long")] + [_field(message, f"o.{k}", n, t) for k, n, t in LIQUIDATION]


def parse_depth5(message: Column, now_ms: Column | None = None) -> list[Column]:
    """Five levels of bids and asks, missing levels 0.0; a missing event time is ``now_ms`` (default: the clock)."""
    clock = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    sides = {s: F.from_json(F.get_json_object(message, f"$.{s}s"), "array<array<string>>") for s in ("bid", "ask")}
    levels = [F.coalesce(F.get(F.get(book, i), j).try_cast("double"), F.lit(0.0)).alias(f"{s}_{i}_{what}") for s, book in sides.items() for i in range(5) for j, what in enumerate(("price", "qty"))]
    event_time = F.coalesce(F.get_json_object(message, "$.E").try_cast("long"), clock).alias("event_time")
    return [event_time, _field(message, "lastUpdateId", "last_update_id", "long"), *levels]


def parse_mempool(message: Column, timestamp: Column) -> list[Column]:
    return [timestamp.cast("long").alias("timestamp"), *(_field(message, *x) for x in MEMPOOL)]


PARSERS = {"aggtrade": parse_aggtrade, "bookticker": parse_bookticker, "depth5": parse_depth5, "liquidations": parse_liquidation}
