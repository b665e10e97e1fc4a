"""Scalar expressions. Every division is guarded: NULL where the divisor is 0."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed values.
AMOUNT_CLASSES = (("below_0001", 0.0001), ("0001_001", 0.01), ("001_01", 0.1), ("01_1", 1.0), ("1_10", 10.0), ("10_100", 100.0), ("above_100", 1000.0), ("above_1000", math.inf))
SCRIPT_TYPES = {"pubkeyhash": "p2pkh", "scripthash": "p2sh", "witness_v0_keyhash": "p2wpkh", "witness_v0_scripthash": "p2wsh", "witness_v1_taproot": "p2tr", "nulldata": "op_return"}
HALVING_BLOCKS, LAST_EPOCH = 210_000, 4
SATOSHIS = 100_000_000
DAY = 86_400


def ratio(a: Column, b: Column, default: Column | float | None = None) -> Column:
    """a / b, or ``default`` where b is 0 or either is NULL."""
    value = F.try_divide(a, b)
    return value if default is None else F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def ratio_or_one(a: Column, b: Column) -> Column:
    """a / b with 1 in place of a zero divisor."""
    return a / F.when(b == 0, 1).otherwise(b)


def correlation(a: Column, b: Column) -> Column:
    """Aggregate: Pearson's correlation over the rows that have both; NULL if one of them is constant."""
    x, y = F.when(b.isNotNull(), a.cast("double")), F.when(a.isNotNull(), b.cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column; to be applied at each source."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select([F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floating else F.col(c) for c in df.columns])


def select_available(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that ``df`` has, in the order wanted."""
    return [c for c in wanted if c in df.columns]


def prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns without the prefix get it."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep and not c.startswith(prefix)})


def floor_to(t: Column, grain: int) -> Column:
    return (F.floor(t / grain) * grain).cast("long")


def date_of(t: Column) -> Column:
    """The UTC date of epoch seconds, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(t / DAY).cast("int"))


def month_of(t: Column) -> Column:
    """yyyymm of epoch seconds, UTC."""
    d = date_of(t)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def calendar(t: Column) -> dict[str, Column]:
    """Cyclic encodings and flags of epoch seconds, UTC: hour with its minutes over 24, weekday (Monday 0) over 7,
    month over 12, day of month over 31."""
    second = t - floor_to(t, DAY)
    hour = F.floor(second / 3600) + F.floor((second % 3600) / 60) / 60
    weekday = F.pmod(F.floor(t / DAY) + 3, F.lit(7))
    cycles = {"hour": (hour, 24), "dow": (weekday, 7), "month": (F.month(date_of(t)), 12), "dom": (F.dayofmonth(date_of(t)), 31)}
    out = {f"{name}_{kind}": wave(F.lit(2 * math.pi) * x / period) for name, (x, period) in cycles.items() for kind, wave in (("sin", F.sin), ("cos", F.cos))}
    return out | {"is_weekend": (weekday >= 5).cast("float"), "seconds_since_midnight": second.cast("int")}


def amount_class(btc: Column) -> Column:
    """The half-open value class of an amount."""
    chain = None
    for name, below in AMOUNT_CLASSES[:-1]:
        chain = F.when(btc < below, name) if chain is None else chain.when(btc < below, name)
    return chain.when(btc.isNotNull(), AMOUNT_CLASSES[-1][0])


def script_type(kind: Column) -> Column:
    """Short name of an output script's type; ``other`` for anything unknown, NULL too."""
    chain = None
    for long, short in SCRIPT_TYPES.items():
        chain = F.when(kind == long, short) if chain is None else chain.when(kind == long, short)
    return chain.otherwise("other")


def halving_epoch(height: Column) -> Column:
    return F.least(F.greatest(F.floor(height / HALVING_BLOCKS), F.lit(0)), F.lit(LAST_EPOCH)).cast("byte")


def blocks_since_halving(height: Column) -> Column:
    return (height - halving_epoch(height) * HALVING_BLOCKS).cast("int")


def satoshis_to_btc(sats: Column) -> Column:
    return sats / F.lit(float(SATOSHIS))


def floor_rank(values: Column, percent: int) -> Column:
    """Element int(n * percent / 100) of the sorted array ``values``, 0.0 if it is empty."""
    at = F.floor(F.size(values) * percent / 100).cast("int") + 1
    return F.when(F.size(values) > 0, F.element_at(F.sort_array(values), F.least(at, F.size(values)))).otherwise(0.0)
