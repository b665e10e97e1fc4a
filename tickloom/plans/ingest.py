"""Composed ingest: archives, blocks, daily metrics and mempool snapshots from a remote source to typed Parquet.

Every job can be repeated: what is stored is not asked for again, and a month is replaced as a whole. The
``transport`` is named by import path (see ``sources.remote``), so tests run without a network.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.exprs import month_of
from ..operators.blocks import BLOCK_DOCUMENT, block_records, with_block_gaps
from ..sources import remote
from ..sources.readers import path_exists, read_zipped_csv
from ..sources.schemas import dataset_path
from ..sources.sinks import from_months, write_metrics, write_months
from ..streaming.live import run_live

#: Column with the time of a row of each archive kind, in ms.
TIME_COLUMNS = {"aggTrades": "timestamp", "klines": "open_time", "bookTicker": "transaction_time", "fundingRate": "calc_time", "liquidationSnapshot": "time"}
#: What is fetched at each priority: (market, kind, interval).
TASKS = {1: (("spot", "aggTrades", None), ("spot", "klines", "1m")), 2: (("futures_um", "aggTrades", None), ("futures_um", "klines", "1m"), ("futures_um", "fundingRate", None), ("futures_um", "bookTicker", None), ("futures_um", "liquidationSnapshot", None))}


def stored_months(spark: SparkSession, path: str, symbol: str | None = None) -> set[int]:
    """The months (yyyymm) that a dataset has (of one symbol), from its partition folders."""
    where = path if symbol is None else f"{path}/symbol={symbol}"
    if not path_exists(spark, where):
        return set()
    return {r.month for r in from_months(spark.read.parquet(where)).select("month").distinct().collect()}  # one row a month


def ingest_archives(spark: SparkSession, root: str, market: str, kind: str, symbol: str, months: list[int], interval: str | None = None, transport: str | None = None) -> DataFrame:
    """Fetches the archives of ``months`` (yyyymm), types their rows and writes them by symbol and month: ``url, path, status, bytes,
    rows``. Months that are stored for the symbol are not fetched (status skipped); archives that are missing (not_found), damaged (0
    rows) or fail (error) leave their month open for the next run. Only this run's archives are read."""
    path = dataset_path(root, kind, market=market, interval=interval or "")
    have = stored_months(spark, path, symbol)
    urls = {remote.monthly_url(market, kind, symbol, m // 100, m % 100, interval): m for m in months}
    landing = f"{root.rstrip('/')}/landing/{market}/{kind}/{symbol}/{interval or 'all'}"
    wanted = [u for u, m in urls.items() if m not in have]
    skipped = spark.createDataFrame([(u, "", "skipped", 0, None) for u, m in urls.items() if m in have], "url string, path string, status string, bytes long, rows long")
    if not wanted:
        return skipped
    options = {} if transport is None else {"transport": transport}
    landed = remote.land_archives(spark, wanted, landing, **options).collect()  # one row an archive
    told = spark.createDataFrame(landed, skipped.schema)
    files = [f"{landing}/{r.path.rsplit('/', 1)[1]}" for r in landed if r.status in ("success", "skipped")]
    if not files:
        return skipped.unionByName(told)
    rows = read_zipped_csv(spark, files, kind, with_file=True)
    typed = rows.withColumns({"month": month_of(F.floor(F.col(TIME_COLUMNS[kind]) / 1000)), "symbol": F.lit(symbol)}).where(~F.col("month").isin(*have) if have else F.lit(True))
    write_months(typed.drop("file"), path, by=("symbol",))
    counts = rows.groupBy(F.col("file").alias("__file")).agg(F.count(F.lit(1)).alias("__n"))
    name = F.regexp_extract("path", r"[^/]+$", 0)
    told = told.join(counts, name == F.col("__file"), "left").withColumn("rows", F.when(F.col("status").isin("success", "skipped"), F.coalesce("__n", F.lit(0)))).drop("__file", "__n")
    return skipped.unionByName(told)


def ingest_all(spark: SparkSession, root: str, symbol: str, months: list[int], priority: int = 1, transport: str | None = None, progress: Callable[[int, int, str], None] | None = None) -> DataFrame:
    """All archive kinds up to a priority: the statuses with ``market`` and ``kind``. ``progress`` is called with the number of the kind that is
    next, of how many, and its name."""
    out, tasks = None, [t for p in range(1, priority + 1) for t in TASKS[p]]
    for i, (market, kind, interval) in enumerate(tasks):
        if progress is not None:
            progress(i, len(tasks), f"{market} {kind}")
        part = ingest_archives(spark, root, market, kind, symbol, months, interval, transport).withColumns({"market": F.lit(market), "kind": F.lit(kind)})
        out = part if out is None else out.unionByName(part)
    return out


def ingest_blocks(spark: SparkSession, root: str, url: str, first: int, last: int, span: int = 500, transport: str | None = None) -> DataFrame:
    """Fetches the blocks ``first`` .. ``last`` that are not stored, and writes their records by range of heights. Returns the
    heights that could not be had (``block_height, error``), which the next run asks for again, and no others."""
    remote.register(spark)
    path = dataset_path(root, "blocks")
    have = spark.read.parquet(path).select("block_height") if path_exists(spark, path) else spark.createDataFrame([], "block_height int")
    open_ranges = missing_ranges(spark, have, first, last)
    none = spark.createDataFrame([], "block_height long, error string")
    if not open_ranges:
        return none
    options = {"url": url, "ranges": json.dumps(open_ranges), "span": str(span)} | ({} if transport is None else {"transport": transport})
    fetched = spark.read.format("rpc_blocks").options(**options).load()
    landing = f"{root.rstrip('/')}/landing/blocks/{first}-{last}"
    fetched.write.mode("overwrite").parquet(landing)
    fetched = spark.read.parquet(landing)
    schema = ", ".join(f"{name} {kind}" for name, kind in (x.split(" ", 1) for x in BLOCK_DOCUMENT.split(", ")))
    good = fetched.where("error is null").select(F.col("block_height").alias("__at"), F.from_json("document", schema).alias("d")).select("__at", "d.*").withColumn("block_height", F.coalesce("block_height", "__at")).drop("__at")
    fresh = block_records(good).join(have, "block_height", "left_anti")
    fresh.withColumn("heights", F.floor(F.col("block_height") / 10_000).cast("int")).repartition("heights").sortWithinPartitions("block_height").write.mode("append").partitionBy("heights").parquet(path)
    return fetched.where("error is not null").select("block_height", "error")


def missing_ranges(spark: SparkSession, have: DataFrame, first: int, last: int) -> list[list[int]]:
    """Runs of heights ``[from, to]`` of ``first`` .. ``last`` that ``have`` (block_height) has not: gaps between neighbours, found in
    stretches of 100,000 heights, each of which knows its own ends."""
    size = 100_000
    spans = spark.range(first // size, last // size + 1).select(F.col("id").alias("span"))
    ends = spans.select("span", F.greatest(F.col("span") * size, F.lit(first)).alias("lo"), F.least(F.col("span") * size + size - 1, F.lit(last)).alias("hi"))
    held = have.where(F.col("block_height").between(first, last)).select(F.col("block_height").cast("long").alias("h")).distinct().withColumn("span", F.floor(F.col("h") / size))
    marks = held.select("span", "h").unionByName(ends.select("span", (F.col("lo") - 1).alias("h"))).unionByName(ends.select("span", (F.col("hi") + 1).alias("h")))
    gaps = marks.withColumn("next", F.lead("h").over(Window.partitionBy("span").orderBy("h"))).where("next > h + 1")
    found = gaps.select((F.col("h") + 1).alias("a"), (F.col("next") - 1).alias("b")).orderBy("a").collect()  # one row a hole
    out: list[list[int]] = []
    for r in found:
        if out and out[-1][1] + 1 == r.a:
            out[-1][1] = r.b
        else:
            out.append([r.a, r.b])
    return out


def read_blocks(spark: SparkSession, root: str) -> DataFrame:
    """The stored records with the seconds since the block before."""
    return with_block_gaps(spark.read.parquet(dataset_path(root, "blocks")).drop("heights").dropDuplicates(["block_height"]))


def ingest_metrics(spark: SparkSession, root: str, url: str, metrics: list[str], transport: str | None = None, **params: str) -> DataFrame:
    """Fetches daily metrics and writes them by metric and year: ``metric, rows, first, last``."""
    remote.register(spark)
    options = {"url": url, "metrics": ",".join(metrics), **params} | ({} if transport is None else {"transport": transport})
    landing = f"{root.rstrip('/')}/landing/metrics"
    spark.read.format("rest_metrics").options(**options).load().write.mode("overwrite").parquet(landing)
    fetched = spark.read.parquet(landing)
    write_metrics(fetched, dataset_path(root, "metrics"))
    return fetched.groupBy("metric").agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def ingest_mempool(spark: SparkSession, root: str, url: str, transport: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """A stream of snapshots, one a minute, to Parquet by ingest hour."""
    remote.register(spark)
    options = {"url": url, "log": feed_log(root, "mempool")} | ({} if transport is None else {"transport": transport})
    snapshots = spark.readStream.format("polled_json").options(**options).load()
    return run_live(spark, {"mempool": snapshots}, root, trigger)["mempool"]


def feed_log(root: str, stream: str) -> str:
    """The folder of a feed's received messages, beside its checkpoint."""
    return f"{root.rstrip('/')}/state/{stream}-log"


def ingest_feeds(spark: SparkSession, root: str, urls: dict[str, str], trigger: dict | None = None, subscribe: dict[str, str] | None = None, **options: str) -> dict[str, StreamingQuery]:
    """A query for each stream (aggtrade, bookticker, depth5, liquidations, mempool) that a WebSocket at its address sends, to Parquet
    by ingest hour; ``subscribe`` has what a stream sends after connecting. ``options``: those of the source."""
    remote.register(spark)
    sources = {}
    for name, url in urls.items():
        own = {"url": url, "log": feed_log(root, name), **options} | ({"subscribe": subscribe[name]} if subscribe and name in subscribe else {})
        sources[name] = spark.readStream.format("websocket").options(**own).load()
    return run_live(spark, sources, root, trigger)


def fee_history(spark: SparkSession, url: str, transport: str | None = None) -> DataFrame:
    """The recent fee history that a mempool service keeps: ``position, document`` (JSON), one row an entry."""
    remote.register(spark)
    options = {"url": url} | ({} if transport is None else {"transport": transport})
    return spark.read.format("rest_documents").options(**options).load()
