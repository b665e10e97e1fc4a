"""Keyed state on streams: gap filling and as-of joins that give the rows of their batch forms.

Both are processors of ``transformWithStateInPandas``, so a stream's state is kept in the state store below the checkpoint: a
restart goes on where the last batch ended. What can be done without Python is done before it: trades are made one row a bucket by a
windowed aggregation, and rows travel as JSON text, whatever their columns are.

Rows may come in any order within the watermark's delay. A bucket closes, and a left row is joined, when the watermark has passed
it; the end of a stream is told by a row that is far ahead of it in time (``clock``).
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.bucket import FILLED
from .live import bucket_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows that a processor gives at a time.
CHUNK = 50_000
_BUCKET = "open double, high double, low double, close double, volume double, quote_volume double, buy_volume double, sell_volume double, trade_count long, buy_ratio double, vwap double, volume_imbalance double, price_range double, price_return double"
_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """Within it, queries are started with the state store that keyed state needs; the session's own setting comes back after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class _Filler(StatefulProcessor):
    """Closed buckets of one series and month, in the order of time from batch to batch: each gives the gap rows before it, then itself.
    State: the last bucket."""

    def __init__(self, grain: int, keys: list[str]) -> None:
        self.grain, self.keys = grain, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "timestamp_s long, open double, high double, low double, close double, vwap double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True).sort_values("timestamp_s", ignore_index=True)
        before = dict(zip(("timestamp_s", *FILLED), self.last.get(), strict=True)) if self.last.exists() else None
        if before is not None:
            new = new[new["timestamp_s"] > before["timestamp_s"]]  # a bucket is closed once
        if not len(new):
            return
        held = new[list(FILLED)]
        if before is not None:
            held = pd.concat([pd.DataFrame([[before[c] for c in FILLED]], columns=list(FILLED), dtype=float), held], ignore_index=True)
        held = held.ffill()
        closes = new["close"].to_numpy(float)
        previous = np.concatenate([[np.nan if before is None or before["close"] is None else before["close"]], closes[:-1]]).astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            change = np.where(np.isnan(previous) | np.isnan(closes) | (previous == 0), 0.0, closes / previous - 1)
        own = held.iloc[len(held) - len(new) :].reset_index(drop=True)
        times = new["timestamp_s"].to_numpy(np.int64)
        full = new.reset_index(drop=True).assign(**{c: own[c] for c in FILLED}, price_return=change)
        self.last.update((int(times[-1]), *(None if pd.isna(v) else float(v) for v in own.iloc[-1])))
        starts = times if before is None else np.concatenate([[before["timestamp_s"]], times])
        gaps = np.diff(starts) // self.grain - 1
        ends = np.concatenate([[0], np.cumsum(gaps)])
        for a in range(0, int(ends[-1]), CHUNK):
            at = np.arange(a, min(a + CHUNK, int(ends[-1])))
            gap = np.searchsorted(ends, at, "right") - 1
            fill = held.iloc[gap].reset_index(drop=True).assign(timestamp_s=starts[gap] + (at - ends[gap] + 1) * self.grain)
            yield self._shaped(key, fill.assign(volume=0.0, quote_volume=0.0, buy_volume=0.0, sell_volume=0.0, trade_count=0, buy_ratio=0.5, volume_imbalance=0.0, price_range=0.0, price_return=0.0))
        for a in range(0, len(full), CHUNK):
            yield self._shaped(key, full.iloc[a : a + CHUNK])

    def _shaped(self, key, df: pd.DataFrame) -> pd.DataFrame:
        named = {k: v for k, v in zip(self.keys, key, strict=True)}
        return df.assign(**named)[[*self.keys, "timestamp_s", *(c.split()[0] for c in _BUCKET.split(", "))]]

    def close(self) -> None:
        pass


def fill_gaps_stream(trades: DataFrame, grain: int = 1, by: tuple[str, ...] = (), late: str = "10 seconds") -> DataFrame:
    """The dense series of a stream of trades (timestamp in ms), as ``process_trades`` makes it: a row for each ``grain`` seconds
    between a month's first and last bucket, in append mode. ``by``: keys of a series, such as the symbol. A bucket, with the gap rows before it, comes when the
    watermark (``late`` behind the newest trade) has passed its end; trades later than that are left out, repeated ones within it
    count once. Start the query within ``rocksdb``."""
    closed = bucket_stream(trades, grain, late, by)
    both = F.col("buy_volume") + F.col("sell_volume")
    ready = closed.withColumns({"volume_imbalance": F.coalesce(F.try_divide(F.col("buy_volume") - F.col("sell_volume"), both), F.lit(0.0)), "price_range": F.col("high") - F.col("low"), "price_return": F.lit(0.0)})
    keys = [*by, "month"]
    kinds = ", ".join(f"{k} {closed.schema[k].dataType.simpleString()}" for k in keys)
    names = [c.split()[0] for c in _BUCKET.split(", ")]
    return ready.select(*keys, "timestamp_s", *names).groupBy(*keys).transformWithStateInPandas(_Filler(grain, keys), f"{kinds}, timestamp_s long, {_BUCKET}", "Append", "None")


class _AsOf(StatefulProcessor):
    """Left rows wait until the watermark has passed them, then take the last right row that is not later. State: the left rows
    that wait; right rows from the last one before the watermark on. One timer a key: the first left row that waits."""

    def __init__(self, keys: list[str], lookback: int | None) -> None:
        self.keys, self.lookback = keys, lookback

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lefts = handle.getListState("lefts", "t long, row string")
        self.rights = handle.getListState("rights", "t long, tie long, row string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        lefts, rights = [], []
        for df in rows:
            left = df["tie"].isna()
            lefts += zip(df["t"][left].tolist(), df["row"][left].tolist(), strict=True)
            rights += zip(df["t"][~left].tolist(), df["tie"][~left].astype("int64").tolist(), df["row"][~left].tolist(), strict=True)
        if rights:
            self.rights.appendList(rights)
        yield from self._joined(key, lefts, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._joined(key, [], timerValues)

    def _joined(self, key, new: list[tuple], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        lefts = [*(tuple(x) for x in self.lefts.get()), *new]
        done, waiting = [x for x in lefts if x[0] <= passed], [x for x in lefts if x[0] > passed]
        if not done:
            if new:
                self.lefts.appendList(new)
        else:
            rights = sorted(tuple(x) for x in self.rights.get())
            times = np.array([x[0] for x in rights], np.int64)
            self.lefts.put(waiting) if waiting else self.lefts.clear()
            for a in range(0, len(done), CHUNK):
                part = done[a : a + CHUNK]
                t = np.array([x[0] for x in part], np.int64)
                at = np.searchsorted(times, t, "right") - 1
                near = at >= 0
                if self.lookback is not None and len(times):
                    near &= t - times[np.maximum(at, 0)] <= self.lookback
                hits = [rights[i][2] if ok else None for i, ok in zip(at.tolist(), near.tolist(), strict=True)]
                named = {k: v for k, v in zip(self.keys, key, strict=True)}
                yield pd.DataFrame({"left": [x[1] for x in part], "right": pd.Series(hits, dtype=object)}).assign(**named)[[*self.keys, "left", "right"]]
            over = int(np.searchsorted(times, passed, "right")) - 1
            if over > 0:
                self.rights.put(rights[over:])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if waiting:
            self.handle.registerTimer(min(x[0] for x in waiting) * 1000)

    def close(self) -> None:
        pass


def asof_stream(left: DataFrame, right: DataFrame, right_on: str, columns: list[str], tie: str | None = None, by: tuple[str, ...] = (), lookback: int | None = None, late: str = "10 seconds") -> DataFrame:
    """The backward as-of join of two streams, as ``asof_join`` makes it: ``left`` (timestamp_s) with ``columns`` of the last row of
    ``right`` whose ``right_on`` (epoch seconds) is not later, ties to the largest ``tie`` (a whole number), in append mode.

    A left row comes out when the watermarks of both streams (``late`` behind their newest rows) have passed it, so right rows
    that arrive after it still count; rows that come later than that are left out. A stream that is silent holds the other up, after a
    restart until its next row. ``by``:
    keys of a series; one key's rows are joined by one task, so history of a single series is better joined by ``asof_join``. Start the
    query within ``rocksdb``.
    """
    keys = list(by) or ["__all"]
    whole = (lambda d: d) if by else (lambda d: d.withColumn("__all", F.lit(0)))
    text = lambda names: F.to_json(F.struct(*names), _TEXT)
    at = lambda c: F.timestamp_seconds(F.col(c).cast("long"))
    own = T.StructType([left.schema[c] for c in left.columns])
    found = T.StructType([right.schema[c] for c in columns])
    lefts = whole(left).withColumn("event_ts", at("timestamp_s")).withWatermark("event_ts", late).select(*keys, "event_ts", F.col("timestamp_s").cast("long").alias("t"), F.lit(None).cast("long").alias("tie"), text(left.columns).alias("row"))
    rank = F.coalesce(F.col(tie).cast("long"), F.lit(-(1 << 63))) if tie else F.lit(0).cast("long")
    rights = whole(right).where(F.col(right_on).isNotNull()).withColumn("event_ts", at(right_on)).withWatermark("event_ts", late).select(*keys, "event_ts", F.col(right_on).cast("long").alias("t"), rank.alias("tie"), text(columns).alias("row"))
    both = lefts.unionByName(rights)
    kinds = "".join(f"`{k}` {both.schema[k].dataType.simpleString()}, " for k in keys)
    joined = both.groupBy(*keys).transformWithStateInPandas(_AsOf(keys, lookback), f"{kinds}left string, right string", "Append", "EventTime")
    return joined.select(F.from_json("left", own, _TEXT).alias("l"), F.from_json("right", found, _TEXT).alias("r")).select("l.*", *(F.col(f"r.{c}").alias(c) for c in columns))
