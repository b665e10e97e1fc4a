"""Declared schemas and path templates."""

from __future__ import annotations

# Column names and order of the archive files.
AGGTRADES = "agg_trade_id long, price double, quantity double, first_trade_id long, last_trade_id long, timestamp long, is_buyer_maker boolean, is_best_match boolean"
KLINES = "open_time long, open double, high double, low double, close double, volume double, close_time long, quote_volume double, trade_count long, taker_buy_base_volume double, taker_buy_quote_volume double, ignore string"
BOOKTICKER = "update_id long, best_bid_price double, best_bid_qty double, best_ask_price double, best_ask_qty double, transaction_time long, event_time long"
FUNDING = "calc_time long, funding_interval_hours int, last_funding_rate double, mark_price double, symbol string"
LIQUIDATION = "time long, symbol string, side string, order_type string, time_in_force string, original_quantity double, price double, average_price double, order_status string, last_fill_quantity double, accumulated_fill_quantity double"
METRIC = "metric string, timestamp long, value double"
CSV = {"aggTrades": AGGTRADES, "klines": KLINES, "bookTicker": BOOKTICKER, "fundingRate": FUNDING, "liquidationSnapshot": LIQUIDATION}
#: Dataset folders below the root; partitions are Hive-style year=, month=.
PATHS = {"aggTrades": "raw/{market}/aggTrades", "klines": "raw/{market}/klines/{interval}", "bookTicker": "raw/{market}/bookTicker", "fundingRate": "raw/{market}/fundingRate", "liquidationSnapshot": "raw/{market}/liquidationSnapshot", "blocks": "raw/blocks", "mempool": "raw/mempool", "metrics": "raw/metrics", "live": "raw/live/{stream}", "features": "features", "labels": "labels", "reports": "reports", "stats": "stats", "state": "state"}


def dataset_path(root: str, name: str, **parts: str) -> str:
    return f"{root.rstrip('/')}/{PATHS[name].format(**parts)}"
