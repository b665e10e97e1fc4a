"""Interval joins, frames of time, ranks, sketches, sessions, late rows, bags and samples against plain definitions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickloom.operators import ranks as rank_ops
from tickloom.operators.bags import bag_difference, grouped_totals, reconcile, stratified_sample
from tickloom.operators.frames import range_frames
from tickloom.operators.intervals import interval_join
from tickloom.operators.ranks import rank_rows
from tickloom.operators.sessions import sessions
from tickloom.operators.sketches import DISTINCT_ERROR, RANK_ERROR, load_sketches, merged_statistics, month_sketches, store_sketches
from tickloom.streaming.late import split_late, whole


@pytest.mark.parametrize(("before", "after", "hot_rows"), [(10, 0, 20_000), (7, 5, 3), (0, 0, 2), (-3, 9, 5)])
def test_interval_join(spark, before, after, hot_rows):
    """A third of both sides at one time, also where bins are split in grids; nulls, repeated rows, negative times."""
    rng = random.Random(before)
    lefts = [(rng.choice(["a", "b", None]), rng.choice([5, None, *range(-20, 60)]) if i % 3 else 5, i // 2) for i in range(60)]
    rights = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-30, 70)]) if i % 3 else 4 + (before == after), i // 2) for i in range(80)]
    left = spark.createDataFrame(lefts, "k string, t long, x int").repartition(3)
    right = spark.createDataFrame(rights, "k string, s long, y int").repartition(3)
    got = Counter(tuple(r) for r in interval_join(left, right, "t", "s", before, after, ("k",), hot_rows).collect())
    want = Counter((k, t, x, s, y) for k, t, x in lefts for j, s, y in rights if None not in (k, t, s) and k == j and t - before <= s <= t + after)
    assert got == want and sum(want.values()) > 30
    with pytest.raises(ValueError, match="empty"):
        interval_join(left, right, "t", "s", -3, 1)


def test_range_frames(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b"]), rng.choice([None, 0, 7, 7, 14, *range(-40, 300, 3)]), rng.choice([None, 1.5, -2.0, 4.25, 10.0])) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, t long, v double").repartition(4)
    kinds = {"total": ("sum", "v"), "n": ("count", "v"), "low": ("min", "v"), "high": ("max", "v")}
    got = {(r.k, r.t): r for r in range_frames(df, "t", [1, 7, 100], kinds, ("k",)).collect()}
    assert set(got) == {(k, t) for k, t, _ in rows if t is not None}
    for (k, t), r in got.items():
        for w in (1, 7, 100):
            v = [x for j, s, x in rows if j == k and s is not None and t - w <= s <= t and x is not None]
            assert (r[f"total_{w}"], r[f"n_{w}"], r[f"low_{w}"], r[f"high_{w}"]) == (sum(v) if v else None, len(v), min(v, default=None), max(v, default=None))
    assert range_frames(df.where("false"), "t", [5], kinds).count() == 0


@pytest.mark.parametrize(("by", "heavy"), [((), 1_000), (("k",), 2)])
def test_ranks(spark, monkeypatch, by, heavy):
    """Null groups and values, values of a third of all rows by broadcast and by join, more tiles than rows."""
    monkeypatch.setattr(rank_ops, "HEAVY_ROWS", heavy)
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1.0, 1.0, 2.0, 3.5, float(i)]), i) for i in range(120)] + [("few", 4.0, 1000), ("few", 2.0, 1001)]
    got = rank_rows(spark.createDataFrame(rows, "k string, v double, i int").repartition(5), "v", ["i"], by, tiles=7, nth=3).collect()
    assert len(got) == len(rows)
    for group in {r[0] for r in rows} if by else {"all"}:
        own = sorted((r for r in rows if not by or r[0] == group), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        values, n = [r[1] for r in own], len(own)
        sizes = [n // 7 + (t < n % 7) for t in range(7)]
        tiles = [t + 1 for t, size in enumerate(sizes) for _ in range(size)]
        for at, (_, v, i) in enumerate(own):
            r = next(x for x in got if x.i == i)
            first, last = values.index(v), n - 1 - values[::-1].index(v)
            order = [*dict.fromkeys(values)]
            assert (r.row_number, r.rank, r.dense_rank, r.tile, r.nth_value) == (at + 1, first + 1, order.index(v) + 1, tiles[at], values[2] if n > 2 else None)
            assert r.percent_rank == pytest.approx(first / (n - 1)) and r.cume_dist == pytest.approx((last + 1) / n)


def test_sketches_of_months(spark, tmp_path):
    """Twelve months with different distributions, one written again; nulls and NaN; a feature without values."""
    path = str(tmp_path / "sketches")
    made = lambda month, seed, n: spark.range(n).select(F.lit(month).alias("month"), F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 10 == 1, F.lit(float("nan"))).otherwise(F.rand(seed) * (month % 100)).alias("x"), (F.col("id") % (100 * (month % 100))).alias("u"), F.lit(None).cast("double").alias("none"))
    year = [made(202000 + m, m, 2_000) for m in range(1, 13)]
    all_rows = year[0]
    for part in year[1:]:
        all_rows = all_rows.unionByName(part)
    store_sketches(month_sketches(all_rows.unionByName(made(202101, 5, 50)), ["x", "none"], ["u"]), path)
    store_sketches(month_sketches(year[2], ["x", "none"], ["u"]), path)
    got = {r.feature: r for r in merged_statistics(load_sketches(spark, path, 202001, 202012), quantiles=(0, 0.1, 0.5, 0.9, 1)).collect()}
    x = sorted(r.x for r in all_rows.where("x is not null and not isnan(x)").collect())
    assert (got["x"].rows, got["x"].months, got["u"].rows, got["none"].rows, got["none"].quantiles, got["x"].distinct) == (len(x), 12, 24_000, 0, None, None)
    for q, value in got["x"].quantiles:
        assert abs(sum(v <= value for v in x) / len(x) - q) <= RANK_ERROR
    assert (got["x"].quantiles[0].value, got["x"].quantiles[-1].value) == (x[0], x[-1])
    assert abs(got["u"].distinct - 1200) <= 1200 * DISTINCT_ERROR


def test_sessions_of_a_stream_and_of_a_batch(spark, tmp_path):
    rows = [("u%d" % (i % 3), i * 40 + (i // 30) * 5000, i) for i in range(90)]
    df = spark.createDataFrame(rows, "u string, s long, v int").select("u", F.timestamp_seconds("s").alias("ts"), "v")
    totals = {"n": F.count(F.lit(1)), "v": F.sum("v")}
    batch = sessions(df, "ts", "10 minutes", ("u",), totals)
    assert batch.count() == 9 and batch.agg(F.sum("n")).first()[0] == 90
    ahead = spark.createDataFrame([("end", 10**6, 0)], "u string, s long, v int").select("u", F.timestamp_seconds("s").alias("ts"), "v")
    for k, part in enumerate((df.where("v < 45"), df.where("v >= 45"), ahead)):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in/*").withWatermark("ts", "1 hour")
    sessions(stream, "ts", "10 minutes", ("u",), totals).writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/out").select(batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_late_rows_go_to_a_side_table(spark, tmp_path):
    """Three batches, each by a restart: what is late is judged by the batches before, and nothing is lost."""
    parts = [[(1, 100), (2, 5_000)], [(3, 4_400), (4, 4_399), (5, None), (6, 9_000)], [(7, 8_500), (8, 8_300), (9, 100)]]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, "i int, s long").select("i", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        split_late(spark.readStream.schema("i int, ts timestamp").parquet(f"{tmp_path}/in/*"), "ts", "10 minutes", str(tmp_path / "out"), {"availableNow": True}).awaitTermination()
    assert {r.i: r.late for r in whole(spark, str(tmp_path / "out")).collect()} == {1: False, 2: False, 3: True, 4: True, 5: True, 6: False, 7: False, 8: True, 9: True}


def test_bags(spark):
    a = spark.createDataFrame([("x", 1, None), ("x", 1, None), ("x", 1, None), ("y", 2, 2.0), (None, 3, 3.0), ("z", 4, 4.0), ("z", 5, 4.0)], "k string, p int, q double")
    b = spark.createDataFrame([(None, "x", 1), (None, "x", 1), (2.5, "y", 2), (3.0, None, 3), (4.0, "z", 5), (9.0, "w", 9), (None, "z", 4)], "q double, k string, p int")
    counts = {tuple(r)[:3]: (r.n_a, r.n_b) for r in bag_difference(a, b).collect()}
    assert counts["x", 1, None] == (3, 2) and counts[None, 3, 3.0] == (1, 1) and len(counts) == 8
    assert sum(max(x - y, 0) for x, y in counts.values()) == a.exceptAll(b.select(a.columns)).count() and sum(min(c) for c in counts.values()) == a.intersectAll(b.select(a.columns)).count()
    got = {r.k: tuple(r)[1:] for r in reconcile(a, b, ["k"]).collect()}
    assert got == {"x": (3, 2, 2, 1, 0, "p,q"), "y": (1, 1, 0, 1, 1, "q"), None: (1, 1, 1, 0, 0, ""), "z": (2, 2, 1, 1, 1, "q"), "w": (0, 1, 0, 0, 1, "p,q")}
    totals = grouped_totals(a, [("k",), ()], ["k", "p"], {"n": F.count(F.lit(1)), "kinds": F.count_distinct("p")}).collect()
    assert {(r.k, r.grouping_id): (r.n, r.kinds) for r in totals} == {("x", 1): (3, 1), ("y", 1): (1, 1), (None, 1): (1, 1), ("z", 1): (2, 2), (None, 3): (7, 5)}


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 500 == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("k"), "id")
    one = sorted(map(str, stratified_sample(df.repartition(7), ["k"], ["id"], 10).collect()))
    taken = stratified_sample(df.coalesce(1), ["k"], ["id"], 10)
    assert sorted(map(str, taken.collect())) == one != sorted(map(str, stratified_sample(df, ["k"], ["id"], 10, seed=1).collect()))
    sizes = {r.k: (r.n, r.w) for r in taken.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()}
    want = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    assert {k: round(w) for k, (_, w) in sizes.items()} == want and {k: n for k, (n, _) in sizes.items()} == {k: min(10, n) for k, n in want.items()}
