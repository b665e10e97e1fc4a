"""Streams with keyed state against their batch forms."""

from pyspark.sql import functions as F

from tickloom.operators.asof import asof_join
from tickloom.operators.bucket import process_trades
from tickloom.streaming.stateful import asof_stream, fill_gaps_stream, rocksdb

TRADES = "symbol string, timestamp long, agg_trade_id long, price double, quantity double, is_buyer_maker boolean"
FAR = 4_000_000_000


def run(stream, root, name):
    with rocksdb(stream.sparkSession):
        q = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{root}/state-{name}").trigger(availableNow=True).start(f"{root}/{name}")
    q.awaitTermination()


def rows(df, columns):
    return sorted(map(str, df.select(columns).collect()))


def test_gap_fill_stream(spark, tmp_path):
    """Two series and two months, ties, repeated trades, late rows within the delay, a restart for each part; what is later than the delay is left out."""
    root, start = str(tmp_path), 1_701_388_780_000  # the last seconds of a month
    made = lambda s, i: (s, start + 700 * i + (90_000 if i > 30 else 0), i, 10.0 + i % 5, i % 4 / 2, i % 3 == 0)
    dealt = [(min(2, i // 20 + (i % 20 > 14 and i % 3 == 0)), made(s, i // 2 * 2 if s == "AA" else i)) for s in ("AA", "BB") for i in range(60)]
    trades, late = [t for _, t in dealt], [("BB", start + 5_000, 900, 99.0, 1.0, True)]
    parts = [[t for n, t in dealt if n == k] for k in range(3)]
    for n, part in enumerate([*parts, [("AA", FAR * 1000, -1, 1.0, 1.0, True), *late], [("AA", FAR * 1000 + 1, -2, 1.0, 1.0, True), *late]]):
        spark.createDataFrame(part, TRADES).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(TRADES).parquet(f"{root}/in")
        if n != 3:
            run(fill_gaps_stream(stream, 1, ("symbol",), "60 seconds"), root, "dense")
    batch = lambda t: process_trades(spark.createDataFrame(t, TRADES).dropDuplicates(["symbol", "agg_trade_id"]), 1, by=("symbol",))
    got, want = spark.read.parquet(f"{root}/dense"), batch(trades)
    assert rows(got, want.columns) == rows(want, want.columns) != rows(batch(trades + late), want.columns)
    assert got.where("month = 202312").count() > 60 and got.where("trade_count = 0").count() > 20


def test_asof_stream(spark, tmp_path):
    """Right rows that come after their left rows, ties, NULL fields, left rows before all right rows, keys, and a limit to the age of a match."""
    root = str(tmp_path)
    left = spark.createDataFrame([(s, 1000 + 10 * i, 202001, float("nan") if i == 3 else i / 3) for s in ("AA", "BB") for i in range(20)], "symbol string, timestamp_s long, month int, x double").withColumn("month", F.lit(197001))
    right = spark.createDataFrame([("AA", 1025, 1, "a", 1.5), ("AA", 1025, 2, None, None), ("AA", 1100, 3, 'q"{', 2.5), ("AA", 1130, 4, "d", 9007199254740993.0), ("BB", 1150, 5, "e", 0.1), ("BB", None, 6, "f", 0.2)], "symbol string, at long, tie long, name string, v double")
    for n in range(2):
        left.where(f"timestamp_s < 1100 = {n == 0}").coalesce(1).write.parquet(f"{root}/left/{n}")
        right.where(f"coalesce(at, 0) > 1025 = {n == 0}").coalesce(1).write.parquet(f"{root}/right/{n}")
    joined = lambda lookback: asof_stream(spark.readStream.schema(left.schema).parquet(f"{root}/left/*"), spark.readStream.schema(right.schema).parquet(f"{root}/right/*"), "at", ["name", "v"], "tie", ("symbol",), lookback, "1 hour")
    run(joined(None), root, "all")
    assert spark.read.schema("x int").parquet(f"{root}/all").count() == 0
    ends = [(s, FAR) for s in ("AA", "BB")]
    spark.createDataFrame(ends, "symbol string, timestamp_s long").withColumns({"month": F.lit(0), "x": F.lit(0.0)}).select(left.columns).coalesce(1).write.parquet(f"{root}/left/9")
    spark.createDataFrame(ends, "symbol string, at long").withColumns({"tie": F.lit(9).cast("long"), "name": F.lit("z"), "v": F.lit(0.0)}).coalesce(1).write.parquet(f"{root}/right/9")
    for lookback, name in ((None, "all"), (40, "near")):
        run(joined(lookback), root, name)
        got, want = spark.read.parquet(f"{root}/{name}"), asof_join(left, right, "at", ["name", "v"], "tie", ("symbol",), lookback)
        assert rows(got, want.columns) == rows(want, want.columns)
