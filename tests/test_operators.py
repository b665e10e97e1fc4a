import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from tickloom.functions import exprs
from tickloom.operators import rolling
from tickloom.operators.asof import Slow, asof_join, asof_joins
from tickloom.operators.blocks import BLOCK_DOCUMENT, block_records, with_block_gaps
from tickloom.operators.bucket import bucket_trades, fill_gaps, process_trades
from tickloom.operators.labels import HORIZONS, make_labels
from tickloom.operators.normalize import normalize_features, zscore
from tickloom.operators.quality import check_klines
from tickloom.operators.rolling import WINDOWS, rolling_features

TRADES = "timestamp long, agg_trade_id long, price double, quantity double, is_buyer_maker boolean"


def series(spark, closes, t0=1_700_000_000):
    df = spark.createDataFrame([(t0 + i, float(c)) for i, c in enumerate(closes)], "timestamp_s long, close double")
    return df.withColumn("month", exprs.month_of(F.col("timestamp_s")))


def test_buckets_order_gap_and_returns(spark):
    rows = [(1000, 2, 11.0, 1.0, False), (1000, 1, 10.0, 2.0, True), (1500, 3, 9.0, 1.0, True), (4000, 4, 18.0, 3.0, False)]
    dense = fill_gaps(bucket_trades(spark.createDataFrame(rows, TRADES))).orderBy("timestamp_s").collect()
    assert [r.timestamp_s for r in dense] == [1, 2, 3, 4]
    assert (dense[0].open, dense[0].high, dense[0].low, dense[0].close) == (10.0, 11.0, 9.0, 9.0)
    assert (dense[0].buy_volume, dense[0].sell_volume, dense[0].trade_count) == (1.0, 3.0, 3)
    assert (dense[1].close, dense[1].volume, dense[1].buy_ratio, dense[1].price_range, dense[1].price_return) == (9.0, 0.0, 0.5, 0.0, 0.0)
    assert dense[3].price_return == 1.0


def test_neutral_defaults_and_empty(spark):
    rows = [(1000, 1, 0.0, 0.0, True), (2000, 2, 5.0, 1.0, True)]
    first, second = bucket_trades(spark.createDataFrame(rows, TRADES)).orderBy("timestamp_s").collect()
    assert (first.buy_ratio, first.vwap, first.volume_imbalance, second.price_return) == (0.5, 0.0, 0.0, 0.0)
    assert process_trades(spark.createDataFrame([], TRADES)).count() == 0


def test_rolling_against_pandas(spark):
    rows = [(1000 * i, i, float(100 + (i * 37) % 50), float(1 + i % 7), i % 3 == 0) for i in range(300)]
    s = process_trades(spark.createDataFrame(rows, TRADES))
    got = rolling_features(s, (5, 90)).orderBy("timestamp_s").toPandas()
    p = s.orderBy("timestamp_s").toPandas()
    for w in (5, 90):
        roll = lambda c, w=w: p[c].rolling(w, min_periods=1)
        want = {"volume_sum": roll("volume").sum(), "vwap": roll("quote_volume").sum() / roll("volume").sum(), "range": roll("high").max() - roll("low").min(), "volatility": p["price_return"].rolling(w, min_periods=2).std().fillna(0), "return": (p["close"] / p["close"].shift(w) - 1).fillna(0)}
        for k, v in want.items():
            pd.testing.assert_series_equal(got[f"{k}_{w}s"], v, check_names=False, rtol=1e-9, atol=1e-9)


def test_asof_whole_row_ties_lookback_and_directions(spark):
    left = series(spark, [0] * 6, 100)
    right = spark.createDataFrame([(90, 1, 1.0, "a"), (102, 1, 2.0, "b"), (102, 2, None, "c")], "at long, k long, v double, s string")
    got = {r.timestamp_s: (r.v, r.s) for r in asof_join(left, right, "at", ["v", "s"], "k").collect()}
    assert got[100] == (1.0, "a") and got[102] == (None, "c") and got[105] == (None, "c")
    near = {r.timestamp_s: r.s for r in asof_join(left, right, "at", ["s"], "k", lookback=5).collect()}
    assert near[100] is None and near[103] == "c"
    ahead = {r.timestamp_s: r.s for r in asof_join(left, right, "at", ["s"], "k", direction="forward").collect()}
    assert ahead[100] == "b" and ahead[103] is None
    both = {r.timestamp_s: r.s for r in asof_join(left, right, "at", ["s"], "k", direction="nearest").collect()}
    assert both[100] == "b" and both[105] == "c"


def test_asof_carries_over_months(spark):
    february = 1_706_745_600
    left = series(spark, [0, 0], february)
    right = spark.createDataFrame([(february - 40 * 86_400, 7.0)], "at long, v double")
    assert {r.v for r in asof_join(left, right, "at", ["v"]).collect()} == {7.0}


def test_zscore_is_causal_clipped_and_zero_for_constants(spark):
    closes = [1.0] * 60 + [1000.0] + [1.0] * 40
    z = [r.close for r in zscore(series(spark, closes), {"close": 50}).orderBy("timestamp_s").collect()]
    assert z[:60] == [0.0] * 60 and z[60] == 6.0 and all(abs(x) <= 6 for x in z)
    changed = [r.close for r in zscore(series(spark, closes[:80] + [9.0] * 21), {"close": 50}).orderBy("timestamp_s").collect()]
    assert changed[:80] == pytest.approx(z[:80], abs=1e-6)


def test_default_windows_are_capped_by_the_month(spark):
    """The daily window of a year is no longer than the month's 400 rows: 40 values are enough."""
    df = series(spark, [float(i * i % 97) for i in range(400)]).withColumn("gn_sopr", F.col("close") * 2)
    got = normalize_features(df).orderBy("timestamp_s").select("close", "gn_sopr").toPandas()
    close = [float(i * i % 97) for i in range(400)]
    for i in (0, 38, 39, 200, 399):
        mean, std = statistics.mean(close[: i + 1]), statistics.stdev(close[: i + 1]) if i else 0
        want = 0.0 if i < 39 else (close[i] - mean) / std
        assert got.close[i] == pytest.approx(want) and got.gn_sopr[i] == pytest.approx(want)


def test_rolling_windows_of_one_second_series(spark, monkeypatch):
    """Fractional prices and quantities, all default windows, frames without volume, several chunks."""
    monkeypatch.setattr(rolling, "CHUNK_ROWS", 100)
    monkeypatch.setattr(rolling, "max", lambda *x: max(*x) // 8 if len(x) == 2 else max(*x), raising=False)
    rng = random.Random(3)
    rows = [(1_700_000_000_000 + 1000 * i, i, 100 + rng.random(), 0.1 + rng.random(), rng.random() < 0.5) for i in range(9000) if i % 200 < 120]
    s = process_trades(spark.createDataFrame(rows, TRADES))
    got = rolling_features(s).orderBy("timestamp_s").toPandas()
    for w in WINDOWS:
        frame = got.rolling(w, min_periods=1)
        volume = frame["volume"].sum()
        assert np.allclose(got[f"volume_sum_{w}s"], volume, atol=1e-6) and ((got[f"volume_sum_{w}s"] == 0) == (got["volume"].rolling(w, min_periods=1).max() == 0)).all()
        assert np.allclose(got[f"range_{w}s"], frame["high"].max() - frame["low"].min())
        assert np.allclose(got[f"volatility_{w}s"], frame["price_return"].std().fillna(0), atol=1e-9)
        empty = got[f"volume_sum_{w}s"] == 0
        assert (got.loc[empty, f"buy_ratio_{w}s"] == 0.5).all() and np.allclose(got.loc[empty, f"vwap_{w}s"], got.loc[empty, "close"])
        assert np.allclose(got.loc[~empty, f"buy_ratio_{w}s"], (frame["buy_volume"].sum() / volume)[~empty], atol=1e-6)


def test_labels_tail(spark):
    got = make_labels(series(spark, range(1, 401))).orderBy("timestamp_s").toPandas()
    for name, h in HORIZONS.items():
        assert got[f"mu_{name}"].isna().sum() == h and got[f"sigma_{name}"].isna().sum() == h
        assert (got[f"direction_{name}"].tail(h) == 0).all() and (got[f"direction_{name}"].head(400 - h) == 1).all()
    assert make_labels(series(spark, range(1, 21))).where("sigma_30s is not null").count() == 0
    with pytest.raises(ValueError):
        make_labels(series(spark, [1]).drop("close"))


def test_block_records(spark):
    coinbase = {"size": 100, "vsize": 100, "vin": [{"coinbase": "00", "txinwitness": None, "prevout": None}], "vout": [{"value": "6.25", "scriptPubKey": {"type": "pubkeyhash"}}]}
    pay = {"size": 200, "vsize": 100, "vin": [{"coinbase": None, "txinwitness": ["aa"], "prevout": {"value": "1.00000100"}}], "vout": [{"value": "1.00000000", "scriptPubKey": {"type": "witness_v1_taproot"}}]}
    blind = {"size": 300, "vsize": 100, "vin": [{"coinbase": None, "txinwitness": None, "prevout": None}], "vout": [{"value": "0.00010000", "scriptPubKey": {"type": "pubkeyhash"}}]}
    import json

    text = json.dumps({"block_height": 840_001, "hash": "h", "time": 5, "bits": "1d00ffff", "nonce": 4_294_967_295, "tx": [coinbase, pay, blind]})
    doc = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", ", ".join(f"{a} {b}" for a, b in (x.split(" ", 1) for x in BLOCK_DOCUMENT.split(", ") if " " in x))).alias("d")).select("d.*")
    r = block_records(doc).first()
    assert (r.tx_count, r.segwit_tx_count, r.taproot_tx_count, r.halving_epoch, r.blocks_since_halving) == (3, 1, 1, 4, 1)
    assert r.fee_rate_p50_sat_vbyte == 1.0 and r.tx_count_1_10btc == 1 and r.tx_count_0001_001btc == 1 and r.nonce == 4_294_967_295
    assert r.taproot_tx_ratio == 0.5 and r.bits == 0x1D00FFFF


def test_block_gaps_cross_spans(spark):
    blocks = spark.createDataFrame([(h, 600 * h) for h in range(8, 14)], "block_height long, block_timestamp long")
    got = {r.block_height: r.seconds_since_prev_block for r in with_block_gaps(blocks, 10).collect()}
    assert got == {8: 0, **{h: 600 for h in range(9, 14)}}
    sparse = spark.createDataFrame([(5, 50), (47, 90)], "block_height long, block_timestamp long")
    assert {r.seconds_since_prev_block for r in with_block_gaps(sparse, 10).collect()} == {0, 40}


def test_kline_status(spark):
    s = series(spark, [100.0] * 120, 1_700_000_040).withColumn("volume", F.lit(1.0))
    klines = lambda c: spark.createDataFrame([(1_700_000_040_000, c, 60.0)], "open_time long, close double, volume double")
    assert check_klines(s, klines(100.0)).first().status == "ok"
    assert check_klines(s, klines(101.0)).first().status == "warning"
    assert check_klines(s, klines(1.0).where("false")).first().status == "skipped"


def test_windows_are_partitioned(spark):
    plan = rolling_features(process_trades(spark.createDataFrame([(1, 1, 1.0, 1.0, True)], TRADES)), (30, 300))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and Window is not None


def test_as_of_joins_of_several_series_in_one_pass(spark):
    """Each series as alone: ties, NULL fields, rows before a month, a key without rows, a series without any."""
    left = spark.createDataFrame([(s, 1_580_000_000 + 700_000 * i, float(i)) for s in ("AA", "BB", "CC") for i in range(12)], "symbol string, timestamp_s long, x double").withColumn("month", exprs.month_of(F.col("timestamp_s")))
    one = spark.createDataFrame([("AA", 1_579_000_000, 1, "a"), ("AA", 1_583_500_000, 2, "b"), ("AA", 1_583_500_000, 3, None), ("BB", 1_582_100_000, 4, "d"), ("BB", None, 5, "e")], "symbol string, at long, tie long, name string")
    two = spark.createDataFrame([("AA", 1_580_700_000, 0.5), ("BB", 1_570_000_000, 1.5), ("BB", 1_585_600_001, 2.5)], "symbol string, t long, v double")
    none = two.where("false").withColumnRenamed("v", "nothing")
    by = ("symbol",)
    got = asof_joins(left, [Slow(one, "at", ["name", "tie"], "tie"), Slow(two, "t", ["v"]), Slow(none, "t", ["nothing"])], by)
    want = asof_join(asof_join(asof_join(left, one, "at", ["name", "tie"], "tie", by), two, "t", ["v"], None, by), none, "t", ["nothing"], None, by)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.where("name is null and tie = 3").count() > 0 and got.select("month").distinct().count() > 3 and asof_joins(left, []) is left


def test_labels_do_not_depend_on_chunks(spark, monkeypatch):
    rng = random.Random(6)
    series = spark.createDataFrame([(1_700_000_000 + i, 202311, 50 + rng.random()) for i in range(400)], "timestamp_s long, month int, close double")
    horizons = {"a": 3, "b": 7, "c": 21}
    whole = {r.timestamp_s: tuple(r) for r in make_labels(series, horizons).collect()}
    monkeypatch.setattr(rolling, "CHUNK_ROWS", 10)
    cut = {r.timestamp_s: tuple(r) for r in make_labels(series, horizons).collect()}
    assert len(cut) == 400 and cut.keys() == whole.keys()
    for t, row in whole.items():
        assert [x is None for x in row] == [x is None for x in cut[t]] and all(a == pytest.approx(b, abs=1e-12) for a, b in zip(row, cut[t], strict=True) if a is not None)
