"""SQL building blocks of the checks, for an engine that reads the driver's tables as views."""

from __future__ import annotations

TRADES = """trades AS (
  SELECT event_id AS agg_trade_id, epoch_us(ts) // 1000 AS tms, CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) AS price,
         CAST(1 + CAST(json_extract_string(props, '$.k') AS BIGINT) AS DOUBLE) AS quantity,
         event_type IN ('error', 'view') AS is_buyer_maker, event_type, user_id
  FROM events)"""
PRICES = ("open", "high", "low", "close", "vwap")
BUCKET_COLUMNS = ("open", "high", "low", "close", "volume", "quote_volume", "buy_volume", "sell_volume", "trade_count", "buy_ratio", "vwap", "volume_imbalance", "price_range", "price_return")
W = "PARTITION BY month ORDER BY timestamp_s"


def month(t: str) -> str:
    return f"CAST(year(make_timestamp(({t}) * 1000000)) * 100 + month(make_timestamp(({t}) * 1000000)) AS INTEGER)"


def buckets(grain: int) -> str:
    return f"""{TRADES}, dealt AS (SELECT *, (tms // 1000) // {grain} * {grain} AS timestamp_s FROM trades), sums AS (
  SELECT timestamp_s, first(price ORDER BY tms, agg_trade_id) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY tms, agg_trade_id) AS close, sum(quantity) AS volume, sum(price * quantity) AS quote_volume,
         coalesce(sum(quantity) FILTER (NOT is_buyer_maker), 0) AS buy_volume, coalesce(sum(quantity) FILTER (is_buyer_maker), 0) AS sell_volume,
         count(price) AS trade_count FROM dealt GROUP BY timestamp_s
), buckets AS (
  SELECT {month('timestamp_s')} AS month, *, coalesce(buy_volume / nullif(volume, 0), 0.5) AS buy_ratio,
         coalesce(quote_volume / nullif(volume, 0), close) AS vwap,
         coalesce((buy_volume - sell_volume) / nullif(buy_volume + sell_volume, 0), 0) AS volume_imbalance, high - low AS price_range,
         coalesce(close / nullif(lag(close) OVER (PARTITION BY {month('timestamp_s')} ORDER BY timestamp_s), 0) - 1, 0) AS price_return FROM sums)"""


def dense(grain: int) -> str:
    neutral = {"buy_ratio": "0.5"}
    filled = ", ".join(f"last_value({c} IGNORE NULLS) OVER ({W}) AS {c}" if c in PRICES else f"coalesce({c}, {neutral.get(c, '0')}) AS {c}" for c in BUCKET_COLUMNS)
    return f"""{buckets(grain)}, ends AS (SELECT month, min(timestamp_s) AS lo, max(timestamp_s) AS hi FROM buckets GROUP BY month),
spine AS (SELECT month, unnest(generate_series(lo, hi, {grain})) AS timestamp_s FROM ends),
joined AS (SELECT s.month, s.timestamp_s, b.* EXCLUDE (month, timestamp_s) FROM spine s LEFT JOIN buckets b ON s.month = b.month AND s.timestamp_s = b.timestamp_s),
dense AS (SELECT month, timestamp_s, {filled} FROM joined)"""


def rows(w: int) -> str:
    return f"OVER ({W} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"


def rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def rolling(windows: tuple[int, ...]) -> str:
    out = []
    for w in windows:
        o = rows(w)
        out += [
            f"sum(volume) {o} AS volume_sum_{w}s", f"sum(quote_volume) {o} AS quote_volume_sum_{w}s",
            f"coalesce(sum(buy_volume) {o} / nullif(sum(volume) {o}, 0), 0.5) AS buy_ratio_{w}s",
            f"coalesce(stddev_samp(price_return) {o}, 0) AS volatility_{w}s",
            f"coalesce(sum(quote_volume) {o} / nullif(sum(volume) {o}, 0), close) AS vwap_{w}s",
            f"CAST(sum(trade_count) {o} AS BIGINT) AS trade_count_{w}s",
            f"coalesce((sum(buy_volume) {o} - sum(sell_volume) {o}) / nullif(sum(buy_volume) {o} + sum(sell_volume) {o}, 0), 0) AS volume_imbalance_{w}s",
            f"coalesce(close / nullif(lag(close, {w}) OVER ({W}), 0) - 1, 0) AS return_{w}s",
            f"max(high) {o} - min(low) {o} AS range_{w}s",
        ]
    return f"rolled AS (SELECT *, {', '.join(out)} FROM dense)"


def labels(horizons: dict[str, int]) -> str:
    out = []
    for n, h in horizons.items():
        ahead = f"OVER ({W} ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING)"
        out += [f"CASE WHEN lead(close, {h}) OVER ({W}) > 0 AND close > 0 THEN ln(lead(close, {h}) OVER ({W}) / close) END AS mu_{n}", f"CASE WHEN count(r) {ahead} = {h} THEN stddev_pop(r) {ahead} END AS sigma_{n}", f"CAST(coalesce(lead(close, {h}) OVER ({W}) > close, false) AS DOUBLE) AS direction_{n}"]
    return f"returns AS (SELECT month, timestamp_s, close, coalesce((close - lag(close) OVER ({W})) / greatest(close, 1e-10), 0) AS r FROM dense), labels AS (SELECT month, timestamp_s, {', '.join(out)} FROM returns)"


def slow(kind: str) -> str:
    return f"""{kind}s AS (SELECT tms // 1000 AS at, last(agg_trade_id ORDER BY tms, agg_trade_id) AS event_id, last(price ORDER BY tms, agg_trade_id) AS price,
  last(quantity ORDER BY tms, agg_trade_id) AS quantity FROM trades WHERE event_type = '{kind}' GROUP BY tms // 1000)"""


def zscore(column: str, w: int, month_rows: int | None = None) -> str:
    """``month_rows``: rows of a month's series, which a window is no longer than; they are counted if None."""
    o = rows(w if month_rows is None else min(w, month_rows))
    least = f"greatest(1, least({w}, count(*) OVER (PARTITION BY month)) // 10)" if month_rows is None else max(1, min(w, month_rows) // 10)
    z = f"({column} - avg({column}) {o}) / nullif(CASE WHEN stddev_samp({column}) {o} < 1e-9 THEN 0 ELSE stddev_samp({column}) {o} END, 0)"
    return f"CASE WHEN count({column}) {o} >= {least} AND ({z}) IS NOT NULL THEN least(greatest({z}, -6), 6) ELSE 0 END"


def calendar() -> str:
    second, day = "(timestamp_s % 86400)", "(timestamp_s // 86400)"
    date = "make_timestamp(timestamp_s * 1000000)"
    cycles = {"hour": (f"({second} // 3600 + ({second} % 3600 // 60) / 60)", 24), "dow": (f"(({day} + 3) % 7)", 7), "month": (f"month({date})", 12), "dom": (f"day({date})", 31)}
    waves = ", ".join(f"round({f}(2 * pi() * {x} / {p}), 6) AS {n}_{f}" for n, (x, p) in cycles.items() for f in ("sin", "cos"))
    return f"{waves}, CAST(({day} + 3) % 7 >= 5 AS DOUBLE) AS is_weekend, CAST({second} AS INTEGER) AS seconds_since_midnight"
