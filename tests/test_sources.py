
import io
import json
import pathlib
import time
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from tickloom.functions.live import parse_aggtrade, parse_depth5, parse_liquidation
from tickloom.operators.bucket import bucket_trades
from tickloom.operators.quality import inventory, latest_reports
from tickloom.plans import ingest
from tickloom.plans.dataset import Recipe, build, build_dataset, missing_months, months_between, write_dataset
from tickloom.sources import readers, remote, sinks
from tickloom.streaming import live
from tickloom.streaming.live import Monitor, bucket_stream, run_live, throughput

TRADES = "timestamp long, agg_trade_id long, price double, quantity double, is_buyer_maker boolean"


def local_fetch(url, params=None):
    """Transport of the tests."""
    if url.endswith("sopr"):
        return [{"t": 86400, "v": 1.5}, {"t": 172800, "v": None}]
    if "height" in (params or {}):
        if params["height"] == 3:
            raise OSError("gone")
        return {"height": params["height"]}
    return None


def test_csv_with_and_without_header_and_zip(spark, tmp_path):
    body = "1,10.5,2,1,1,1700000000000,true,true\n2,11,1,2,2,1700000001000,false,true\n"
    header = "agg_trade_id,price,quantity,first_trade_id,last_trade_id,timestamp,is_buyer_maker,is_best_match\n"
    (tmp_path / "a.csv").write_text(body)
    (tmp_path / "b.csv").write_text(header + body)
    assert readers.read_csv(spark, str(tmp_path / "*.csv"), "aggTrades").count() == 4
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("note.txt", "x")
        z.writestr("c.csv", header + body)
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    got = readers.read_zipped_csv(spark, str(tmp_path), "aggTrades")
    assert got.count() == 2 and got.agg(F.sum("price")).first()[0] == 21.5


def test_remote_sources(spark):
    remote.register(spark)
    options = {"url": "x", "transport": "tests.test_sources:local_fetch"}
    got = spark.read.format("rest_metrics").options(metrics="sopr,none", **options).load().collect()
    assert [(r.metric, r.timestamp, r.value) for r in got] == [("sopr", 86400, 1.5), ("sopr", 172800, None)]
    blocks = spark.read.format("rpc_blocks").options(first=1, last=4, span=2, **options).load().orderBy("block_height").collect()
    assert [r.error is None for r in blocks] == [True, True, False, True]
    assert remote.monthly_url("spot", "klines", "AB", 2024, 1, "1m").endswith("/spot/monthly/klines/AB/1m/AB-1m-2024-01.zip")
    assert remote.daily_url("futures_um", "aggTrades", "AB", "2024-01-05").endswith("/futures/um/daily/aggTrades/AB/AB-aggTrades-2024-01-05.zip")


def test_live_messages_with_missing_fields(spark):
    rows = [json.dumps({"E": 5, "a": 1, "p": "2.5", "m": True}), json.dumps({"bids": [["1", "2"]], "asks": []}), json.dumps({"o": {"s": "X", "q": "3"}})]
    df = spark.createDataFrame([(r,) for r in rows], "message string")
    trade, book, forced = (df.select(*f(F.col("message"))).collect() for f in (parse_aggtrade, lambda m: parse_depth5(m, F.lit(9).cast("long")), parse_liquidation))
    assert (trade[0].price, trade[0].quantity, trade[0].is_buyer_maker) == (2.5, 0.0, True)
    assert (book[1].event_time, book[1].bid_0_qty, book[1].bid_4_price, book[1].ask_0_price) == (9, 2.0, 0.0, 0.0)
    assert (forced[2].symbol, forced[2].quantity, forced[2].side) == ("X", 3.0, "")


def test_dataset_round_trip_is_idempotent(spark, tmp_path):
    rows = [(1_700_000_000_000 + 1000 * i, i, float(100 + i % 9), float(1 + i % 3), i % 2 == 0) for i in range(600)]
    trades = spark.createDataFrame(rows, TRADES)
    recipe = Recipe(windows=(5,), horizons={"5s": 5})
    for _ in range(2):
        report = write_dataset(build(trades, recipe), str(tmp_path), min_rows=100).first()
    assert report.n_rows == 600 and report.rows_ok
    features = readers.read_months(spark, f"{tmp_path}/features", 202311, 202311)
    assert features.count() == 600 and readers.read_months(spark, f"{tmp_path}/features", 202312).count() == 0
    files = readers.list_files(spark, str(tmp_path), "*.parquet").select(F.regexp_replace("path", f"^.*{tmp_path}/", "").alias("path"), "length")
    assert {r.prefix for r in inventory(files).collect()} == {"buckets", "enriched", "features", "labels", "reports", "stats"}
    assert (report.month, report.no_leakage, report.n_features > 20) == (202311, True, True)
    stats = sinks.from_months(spark.read.parquet(f"{tmp_path}/stats")).where("feature = 'close'").first()
    assert (stats.month, stats.min, stats.max, stats.nan_ratio) == (202311, 100.0, 108.0, 0.0)
    sinks.save_state(spark, f"{tmp_path}/state", "t", "k", "1")
    sinks.save_state(spark, f"{tmp_path}/state", "t", "k", "2")
    assert sinks.load_state(spark, f"{tmp_path}/state").first().value == "2"
    assert readers.path_exists(spark, f"{tmp_path}/state") and not readers.path_exists(spark, f"{tmp_path}/nothing")


def two_symbols(spark, start, n):
    rows = [(s, start + 1000 * i, i, p + i % 7, 1.0 + i % 3, i % 2 == 0) for s, p in (("AA", 10.0), ("BB", 99.0)) for i in range(n)]
    return spark.createDataFrame(rows, f"symbol string, {TRADES}")


def test_dataset_with_symbols_months_and_resume(spark, tmp_path):
    recipe = Recipe(windows=(5,), horizons={"5s": 5})
    november, december = two_symbols(spark, 1_700_000_000_000, 300), two_symbols(spark, 1_702_000_000_000, 200)
    klines = november.where("symbol = 'AA'").groupBy("symbol", (F.floor(F.col("timestamp") / 60_000) * 60_000).alias("open_time")).agg(F.max_by("price", "timestamp").alias("close"), F.sum("quantity").alias("volume"))
    report = write_dataset(build(november, recipe, by=("symbol",)), str(tmp_path), klines, min_rows=250, by=("symbol",))
    assert {(r.symbol, r.month, r.n_rows, r.rows_ok, r.status) for r in report.collect()} == {("AA", 202311, 300, True, "ok"), ("BB", 202311, 300, True, "skipped")}
    alone = build(november.where("symbol = 'BB'").drop("symbol"), recipe)["features"].orderBy("timestamp_s").select("close", "vwap_5s").collect()
    both = build(november, recipe, by=("symbol",))["features"].where("symbol = 'BB'").orderBy("timestamp_s").select("close", "vwap_5s").collect()
    assert alone == both
    later = write_dataset(build(november.unionByName(december), recipe, by=("symbol",)), str(tmp_path), min_rows=250, by=("symbol",), resume=True)
    assert {(r.symbol, r.month, r.n_rows, r.rows_ok) for r in later.collect()} == {(s, m, n, n == 300) for s in ("AA", "BB") for m, n in ((202311, 300), (202312, 200))}
    assert [r.month for r in latest_reports(later, 2).collect()] == [202312, 202312]


def test_keys_of_a_store_are_independent(spark, tmp_path):
    """A symbol built later, alone, with resuming, with a name like a number: no other key's month changes or is taken for done."""
    recipe, root = Recipe(windows=(5,), horizons={"5s": 5}), str(tmp_path)
    rows = two_symbols(spark, 1_700_000_000_000, 120).withColumn("symbol", F.when(F.col("symbol") == "BB", "007").otherwise(F.col("symbol")))
    write = lambda only, resume: write_dataset(build(rows.where(only), recipe, by=("symbol",)), root, min_rows=10, by=("symbol",), resume=resume)
    assert [r.symbol for r in write("symbol = 'AA'", False).collect()] == ["AA"]
    assert sorted(r.symbol for r in write("symbol = '007'", True).collect()) == ["007", "AA"]
    write("symbol = 'AA'", False)
    assert {(r.symbol, r.n_rows, r.month) for r in write("symbol = '007'", True).collect()} == {("007", 120, 202311), ("AA", 120, 202311)}
    for name, n in (("buckets", 240), ("features", 240), ("labels", 240), ("reports", 2)):
        assert spark.read.schema("symbol string").parquet(f"{root}/{name}").groupBy("symbol").count().count() == 2 and spark.read.parquet(f"{root}/{name}").count() == n, name


def test_archives_of_two_symbols(spark, tmp_path):
    root = str(tmp_path)
    first = ingest.ingest_archives(spark, root, "spot", "aggTrades", "AB", [202401], transport="tests.test_sources:archive").collect()
    again = ingest.ingest_archives(spark, root, "spot", "aggTrades", "XY", [202401, 202402], transport="tests.test_sources:archive").collect()
    assert [(r.status, r.rows) for r in first] == [("success", 4)] and {(r.status, r.rows) for r in again} == {("success", 4), ("not_found", None)}
    got = spark.read.parquet(f"{root}/raw/spot/aggTrades")
    assert {(r.symbol, r.year, r.month, r["count"]) for r in got.groupBy("symbol", "year", "month").count().collect()} == {("AB", 2024, 1, 4), ("XY", 2024, 1, 4)}
    assert ingest.stored_months(spark, f"{root}/raw/spot/aggTrades", "XY") == {202401} and ingest.stored_months(spark, f"{root}/raw/spot/aggTrades", "ZZ") == set()


def test_missing_ranges(spark):
    have = spark.createDataFrame([(h,) for h in (5, 6, 9, 99_999, 100_000, 100_000, 250_000, 300_005)], "block_height int")
    assert ingest.missing_ranges(spark, have, 4, 250_002) == [[4, 4], [7, 8], [10, 99_998], [100_001, 249_999], [250_001, 250_002]]
    assert ingest.missing_ranges(spark, have.limit(0), 7, 7) == [[7, 7]] and ingest.missing_ranges(spark, have, 5, 6) == []


def test_dataset_from_stored_tables_is_the_same(spark, tmp_path):
    rows, told = two_symbols(spark, 1_701_388_700_000, 150), []  # two months
    blocks = spark.createDataFrame([(s, 1_701_388_650 + 40 * i, i, i % 5) for s in ("AA", "BB") for i in range(6)], "symbol string, block_timestamp long, block_height int, tx_count int")
    recipe, one, two = Recipe(windows=(5,), horizons={"5s": 5}), f"{tmp_path}/one", f"{tmp_path}/two"
    want = write_dataset(build(rows, recipe, blocks, by=("symbol",)), one, min_rows=10, by=("symbol",))
    got = build_dataset(rows, recipe, two, blocks, min_rows=10, by=("symbol",), progress=told.append)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    for name in ("buckets", "features", "labels"):
        a, b = (spark.read.parquet(f"{root}/{name}") for root in (one, two))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect())), name
    assert told == ["buckets", "enriched", "features", "labels"]
    again = build_dataset(rows.where("symbol = 'AA'").unionByName(rows.withColumn("symbol", F.lit("CC"))), recipe, two, min_rows=10, by=("symbol",), resume=True)
    assert {(r.symbol, r.month, r.n_rows) for r in again.collect()} == {(s, m, n) for s in ("AA", "BB", "CC") for m, n in ((202311, 100), (202312, 50))}
    assert spark.read.parquet(f"{two}/features").where("symbol = 'AA' and block_tx_count is not null").count() > 0  # built with blocks, and left as it was


def test_waiting_for_streams(spark, tmp_path):
    counts, stream = [], spark.readStream.format("rate").option("rowsPerSecond", 5).load().select(F.to_json(F.struct(F.col("value").alias("a"))).alias("message"))
    live.wait(run_live(spark, {"aggtrade": stream}, str(tmp_path), {"processingTime": "200 milliseconds"}), 0.2, counts.append, lambda: sum(c["aggtrade"] for c in counts) > 5)
    assert spark.read.parquet(f"{tmp_path}/raw/live/aggtrade").count() > 3 and not spark.streams.active


def archive(url):
    """A ZIP of the kind and month that the address names; February is missing, March is damaged."""
    name = url.rsplit("/", 1)[1]
    if "-02." in name:
        return None
    if "-03." in name:
        return b"damaged"
    lines = {"aggTrades": "1,10.5,2,1,1,{t},true,true", "klines": "{t},1,2,0.5,1.5,9,{t},9,3,1,1,0", "bookTicker": "5,1.0,2,1.5,3,{t},{t}", "fundingRate": "{t},8,0.0001,42.5,AB", "liquidationSnapshot": "{t},AB,SELL,LIMIT,IOC,1.5,10,11,FILLED,1,1"}
    kind = next(k for k in lines if k in url)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("x.csv", "\n".join(lines[kind].format(t=1_704_100_000_000 + i) for i in range(4)))
    return data.getvalue()


def test_archives_to_typed_months(spark, tmp_path):
    root, months = str(tmp_path), [202401, 202402, 202403]
    for status in ("success", "skipped"):
        told = ingest.ingest_all(spark, root, "AB", months, 2, "tests.test_sources:archive").collect()
        assert {(r.kind, r.status) for r in told if "2024-01" in r.url} == {(k, status) for k in ("aggTrades", "klines", "fundingRate", "bookTicker", "liquidationSnapshot")}
        assert {(r.status, r.rows) for r in told if "2024-02" in r.url} == {("not_found", None)}
        assert all(r.rows == 0 for r in told if "2024-03" in r.url) and all(r.rows == 4 for r in told if "2024-01" in r.url and status == "success")
    for kind, column, value in (("aggTrades", "price", 10.5), ("fundingRate", "mark_price", 42.5), ("bookTicker", "best_ask_price", 1.5), ("liquidationSnapshot", "average_price", 11.0)):
        got = readers.read_months(spark, f"{root}/raw/futures_um/{kind}", 202401, 202401).select(column).collect()
        assert [r[0] for r in got] == [value] * 4, kind


def block_fetch(url, params=None):
    (pathlib.Path(url) / f"{params['height']}-{uuid.uuid4().hex}").touch()
    if params["height"] == 12:
        raise OSError("gone")
    pay = {"size": 200, "vsize": 100, "vin": [{"prevout": {"value": "1.5"}}], "vout": [{"value": "1.25", "scriptPubKey": {"type": "pubkeyhash"}}]}
    return {"height": params["height"], "hash": "h", "time": 600 * params["height"], "bits": "1d00ffff", "tx": [pay]}


def test_blocks_metrics_mempool_and_fee_history(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "asked").mkdir()
    for _ in range(2):
        failed = ingest.ingest_blocks(spark, root, str(tmp_path / "asked"), 10, 14, 2, "tests.test_sources:block_fetch").collect()
        assert [(r.block_height, "gone" in r.error) for r in failed] == [(12, True)]
    assert sorted(int(f.name[:2]) for f in (tmp_path / "asked").iterdir()) == [10, 11, 12, 12, 13, 14]  # once each, the failed one again
    got = {r.block_height: (r.tx_count, r.total_fees_btc, r.seconds_since_prev_block) for r in ingest.read_blocks(spark, root).collect()}
    assert got == {10: (1, 0.25, 0), 11: (1, 0.25, 600), 13: (1, 0.25, 1200), 14: (1, 0.25, 600)}
    told = ingest.ingest_metrics(spark, root, "x", ["sopr", "none"], "tests.test_sources:local_fetch").collect()
    assert [(r.metric, r.rows, r.first, r.last) for r in told] == [("sopr", 2, 86400, 172800)]
    assert {(r.metric, r.timestamp, r.value) for r in readers.read_metrics(spark, f"{root}/raw/metrics").collect()} == {("sopr", 86400, 1.5), ("sopr", 172800, None)}
    assert [json.loads(r.document)["t"] for r in ingest.fee_history(spark, "x/sopr", "tests.test_sources:local_fetch").orderBy("position").collect()] == [86400, 172800]
    monitor = Monitor()
    spark.streams.addListener(monitor)
    stream = ingest.ingest_mempool(spark, root, "x", "tests.test_sources:snapshot", {"processingTime": "1 second"})
    try:
        for _ in range(60):
            time.sleep(1)
            if monitor.rows.get("mempool", 0) > 0:
                break
    finally:
        stream.stop()
        spark.streams.removeListener(monitor)
    assert monitor.rows["mempool"] > 0 and not monitor.failed
    assert spark.read.parquet(f"{root}/raw/live/mempool").first().mempool_tx_count == 7


def snapshot(url, params=None):
    return {"mempoolInfo": {"size": 7, "bytes": 9}, "fees": {"fastestFee": 3}}


def test_json_and_metrics_of_the_last_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    assert sorted(r.a for r in readers.read_json(spark, str(tmp_path / "a.json")).collect()) == [1, 2]
    for name, v in (("b", 1.0), ("a", 5.0)):
        spark.createDataFrame([("m", 1, v)], "metric string, timestamp long, value double").coalesce(1).toPandas().to_parquet(tmp_path / f"{name}.parquet")
    assert [r.value for r in readers.read_metrics(spark, str(tmp_path / "*.parquet")).collect()] == [1.0]


def test_unreadable_files_are_skipped_if_asked(spark, tmp_path):
    spark.createDataFrame([(202401, 1), (202402, 2)], "month int, x int").repartition(1).transform(lambda d: sinks.write_months(d, str(tmp_path / "m")) or d)
    (tmp_path / "m/year=2024/month=1/part-broken.parquet").write_bytes(b"PAR1 broken")
    with pytest.raises(Exception, match="(?i)broken|footer|parquet"):
        readers.read_months(spark, str(tmp_path / "m"), schema="x int, year int, month int").collect()
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        assert sorted(r.x for r in readers.read_months(spark, str(tmp_path / "m"), schema="x int, year int, month int").collect()) == [1, 2]
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")


def test_months(spark):
    wanted = months_between(spark, "2023-11-17", "2024-02-01")
    assert sorted(r.month for r in missing_months(wanted, wanted.where("month = 202312")).collect()) == [202311, 202401, 202402]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join(json.dumps({"message": json.dumps({"E": i, "a": i, "p": "1", "q": "2", "T": i})}) for i in range(5)))
    messages = spark.readStream.schema("message string").json(str(tmp_path / "in"))
    running = run_live(spark, {"aggtrade": messages}, str(tmp_path), {"availableNow": True})
    running["aggtrade"].awaitTermination()
    assert throughput(running) == {"aggtrade": 5} and spark.read.parquet(f"{tmp_path}/raw/live/aggtrade").count() == 5
    rows = [(1_700_000_000_000 + 1000 * (i // 3), i // 2, 1.0 + i, 1.0, i % 2 == 0) for i in range(20)]
    spark.createDataFrame(rows, TRADES).dropDuplicates(["agg_trade_id"]).coalesce(1).write.parquet(str(tmp_path / "trades"))
    batch = spark.read.parquet(str(tmp_path / "trades"))
    stream = bucket_stream(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "trades")))
    stream.writeStream.outputMode("update").format("memory").queryName("twin").trigger(availableNow=True).start().awaitTermination()
    key = ["timestamp_s", "open", "close", "volume", "trade_count"]
    assert sorted(map(tuple, spark.table("twin").select(key).collect())) == sorted(map(tuple, bucket_trades(batch).select(key).collect()))


