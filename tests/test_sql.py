"""SQL functions against the DataFrame forms."""

import io
import zipfile

import pytest

from tickloom.operators.bucket import bucket_trades, process_trades
from tickloom.plans.sql import register


def test_table_functions(spark):
    rows = [(1_706_700_000_000 + 1000 * (i * i % 900), i, None if i % 11 == 5 else 10.0 + i % 7, float(i % 3), i % 2 == 0) for i in range(80)]
    trades = spark.createDataFrame(rows, "timestamp long, agg_trade_id long, price double, quantity double, is_buyer_maker boolean")
    register(spark, trades)
    for grain in (1, 60):
        for name, want in (("ohlcv", bucket_trades(trades, grain)), ("dense", process_trades(trades, grain))):
            got = spark.sql(f"SELECT * FROM {name}({grain})")
            assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())), (name, grain)
    plan = spark.sql("SELECT timestamp_s FROM ohlcv(60) WHERE month = 202401")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "lag" not in plan


def test_python_table_functions(spark):
    register(spark)
    spark.createDataFrame([("a", 10, 1.0), ("a", 16, None), ("a", 17, 3.0), ("b", None, 9.0), ("b", 5, 5.0), ("b", 5, 6.0), ("b", 7, 7.0)], "k string, t long, v double").createOrReplaceTempView("uneven")
    got = spark.sql("SELECT * FROM fill_series(TABLE(uneven) PARTITION BY k ORDER BY (t, v), 't', 2)").collect()
    assert sorted(tuple(r) for r in got if r.t is not None) == [("a", 10, 1.0), ("a", 12, 1.0), ("a", 14, 1.0), ("a", 16, 1.0), ("a", 17, 3.0), ("b", 5, 5.0), ("b", 5, 6.0), ("b", 7, 7.0)] and len(got) == 9
    spark.createDataFrame([("a", 1, True, 1.0), ("a", 2, False, None), ("a", 3, True, 2.0), ("b", 1, False, 7.0)], "k string, t long, side boolean, v double").createOrReplaceTempView("sides")
    got = spark.sql("SELECT * FROM last_before(TABLE(sides) PARTITION BY k ORDER BY (t), 'side')").collect()
    assert sorted(map(tuple, got)) == [("a", 1, 1.0, None, None, None), ("a", 3, 2.0, "a", 2, None)]
    with pytest.raises(Exception, match="time column"):
        spark.sql("SELECT * FROM fill_series(TABLE(uneven) PARTITION BY k ORDER BY (t), 'nothing', 2)").collect()
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a.csv", "1,2")
        z.writestr("b.txt", "x")
    files = spark.createDataFrame([(bytearray(data.getvalue()), 1), (bytearray(b"damaged"), 2), (None, 3)], "content binary, i int")
    files.createOrReplaceTempView("files")
    assert [(r.i, r.name, r.size, bytes(r.data)) for r in spark.sql("SELECT i, name, size, m.content AS data FROM files, LATERAL zip_members(files.content, '.csv') m").collect()] == [(1, "a.csv", 3, b"1,2")]
