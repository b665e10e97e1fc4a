"""The engine in SQL: views over tables, table functions that Spark inlines, and Python table functions where SQL has no form.

``register(spark, trades)`` makes, in the session,

* the view ``trades``, which the functions below read,
* ``ohlcv(grain)`` and ``dense(grain)``: buckets of ``grain`` seconds with trades, and the series without gaps. They are SQL, so a
  query over them is one plan: filters and columns reach the scan;
* ``fill_series(TABLE(...) PARTITION BY ... ORDER BY (...), time, step)``: any table with a row at least every ``step`` of the whole-number column ``time``, other
  columns carried forward. One partition is filled row by row;
* ``last_before(TABLE(...) PARTITION BY ... ORDER BY (...), side)``: the rows for which the boolean column ``side`` is true, each with the columns of the last
  row before it for which it is false, as ``last_<column>``: an as-of join of a union;
* ``zip_members(content, ending)``: ``name, size, content`` of a ZIP's members whose names end so; none of a damaged ZIP.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

_OHLCV = """
CREATE OR REPLACE TEMPORARY FUNCTION ohlcv(grain BIGINT)
RETURNS TABLE (month INT, timestamp_s BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, quote_volume DOUBLE, buy_volume DOUBLE, sell_volume DOUBLE, trade_count BIGINT, buy_ratio DOUBLE, vwap DOUBLE, volume_imbalance DOUBLE, price_range DOUBLE, price_return DOUBLE)
RETURN WITH dealt AS (
    SELECT *, timestamp DIV 1000 DIV grain * grain AS timestamp_s, price * quantity AS quote, struct(timestamp, agg_trade_id) AS place FROM trades),
  sums AS (
    SELECT CAST(year(timestamp_seconds(timestamp_s)) * 100 + month(timestamp_seconds(timestamp_s)) AS INT) AS month, timestamp_s,
      min_by(price, place) AS open, max(price) AS high, min(price) AS low, max_by(price, place) AS close, sum(quantity) AS volume, sum(quote) AS quote_volume,
      coalesce(sum(quantity) FILTER (WHERE NOT is_buyer_maker), 0D) AS buy_volume, coalesce(sum(quantity) FILTER (WHERE is_buyer_maker), 0D) AS sell_volume, count(price) AS trade_count
    FROM dealt GROUP BY timestamp_s)
  SELECT month, timestamp_s, open, high, low, close, volume, quote_volume, buy_volume, sell_volume, trade_count,
    coalesce(try_divide(buy_volume, volume), 0.5D), coalesce(try_divide(quote_volume, volume), close), coalesce(try_divide(buy_volume - sell_volume, buy_volume + sell_volume), 0D),
    high - low, coalesce(try_divide(close, lag(close) OVER (PARTITION BY month ORDER BY timestamp_s)) - 1, 0D)
  FROM sums"""

_DENSE = """
CREATE OR REPLACE TEMPORARY FUNCTION dense(grain BIGINT)
RETURNS TABLE (month INT, timestamp_s BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, quote_volume DOUBLE, buy_volume DOUBLE, sell_volume DOUBLE, trade_count BIGINT, buy_ratio DOUBLE, vwap DOUBLE, volume_imbalance DOUBLE, price_range DOUBLE, price_return DOUBLE)
RETURN WITH carried AS (
    SELECT *, lead(timestamp_s) OVER w AS following, last_value(open) IGNORE NULLS OVER w AS o, last_value(high) IGNORE NULLS OVER w AS h, last_value(low) IGNORE NULLS OVER w AS l, last_value(close) IGNORE NULLS OVER w AS c, last_value(vwap) IGNORE NULLS OVER w AS v
    FROM ohlcv(grain) WINDOW w AS (PARTITION BY month ORDER BY timestamp_s)),
  spread AS (
    SELECT *, explode(sequence(timestamp_s, coalesce(following - grain, timestamp_s), grain)) AS t FROM carried)
  SELECT month, t, o, h, l, c, if(t > timestamp_s, 0D, volume), if(t > timestamp_s, 0D, quote_volume), if(t > timestamp_s, 0D, buy_volume), if(t > timestamp_s, 0D, sell_volume), if(t > timestamp_s, 0L, trade_count),
    if(t > timestamp_s, 0.5D, buy_ratio), v, if(t > timestamp_s, 0D, volume_imbalance), if(t > timestamp_s, 0D, price_range), if(t > timestamp_s, 0D, price_return)
  FROM spread"""


class FillSeries:
    """Rows of one partition, in order: missing steps before a row repeat the row before, each null in it having been carried forward."""

    @staticmethod
    def analyze(table: AnalyzeArgument, time: AnalyzeArgument, step: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable or time.value not in table.dataType.fieldNames():
            raise ValueError("fill_series takes a table, the name of its whole-number time column and a step")
        return AnalyzeResult(schema=table.dataType)

    def __init__(self) -> None:
        self.last: dict | None = None

    def eval(self, row, time: str, step: int) -> Iterator[tuple]:
        now = row.asDict(recursive=False)
        if self.last is not None and now[time] is not None and self.last[time] is not None:
            for at in range(self.last[time] + step, now[time], step):
                yield tuple({**self.last, time: at}.values())
        carried = now if self.last is None else {c: self.last[c] if x is None and c != time else x for c, x in now.items()}
        self.last = carried
        yield tuple(carried.values())


class LastBefore:
    """Rows of one partition, in order."""

    @staticmethod
    def analyze(table: AnalyzeArgument, side: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable or side.value not in table.dataType.fieldNames():
            raise ValueError("last_before takes a table and the name of its boolean column that tells the sides apart")
        own = [f for f in table.dataType if f.name != side.value]
        return AnalyzeResult(schema=T.StructType([*(T.StructField(f.name, f.dataType) for f in own), *(T.StructField(f"last_{f.name}", f.dataType) for f in own)]))

    def __init__(self) -> None:
        self.held: tuple | None = None

    def eval(self, row, side: str) -> Iterator[tuple]:
        own = tuple(x for c, x in row.asDict(recursive=False).items() if c != side)
        if row[side]:
            yield own + (self.held or (None,) * len(own))
        else:
            self.held = own


class ZipMembers:
    def eval(self, content: bytes, ending: str) -> Iterator[tuple]:
        try:
            with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                for name in z.namelist():
                    if name.endswith(ending):
                        data = z.read(name)
                        yield name, len(data), data
        except zipfile.BadZipFile:
            return


def register(spark: SparkSession, trades: DataFrame | None = None) -> None:
    """The views and functions above; without ``trades`` only the Python functions."""
    spark.udtf.register("fill_series", F.udtf(FillSeries))
    spark.udtf.register("last_before", F.udtf(LastBefore))
    spark.udtf.register("zip_members", F.udtf(ZipMembers, returnType="name string, size int, content binary"))
    if trades is not None:
        trades.createOrReplaceTempView("trades")
        spark.sql(_OHLCV)
        spark.sql(_DENSE)
