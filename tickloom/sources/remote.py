"""Remote sources as Python data sources: REST metrics and documents, JSON-RPC blocks; ``feeds`` has the live ones.

The transport is a function ``fetch(url, params) -> parsed JSON or None`` named by import path, so tests use a
local one and executors import it themselves; ``http_fetch`` is the real one.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .feeds import PollSource, WebSocketSource

ARCHIVE = "https://data.binance.vision/data"


def monthly_url(market: str, kind: str, symbol: str, year: int, month: int, interval: str | None = None, base: str = ARCHIVE) -> str:
    return _archive(market, kind, symbol, f"{year}-{month:02d}", "monthly", interval, base)


def daily_url(market: str, kind: str, symbol: str, day: str, interval: str | None = None, base: str = ARCHIVE) -> str:
    return _archive(market, kind, symbol, day, "daily", interval, base)


def _archive(market: str, kind: str, symbol: str, stamp: str, period: str, interval: str | None, base: str) -> str:
    place = "spot" if market == "spot" else f"futures/{market.removeprefix('futures_') or 'um'}"
    sub, name = (f"{symbol}/{interval}", f"{symbol}-{interval}-{stamp}") if interval else (symbol, f"{symbol}-{kind}-{stamp}")
    return f"{base}/{place}/{period}/{kind}/{sub}/{name}.zip"


def http_fetch(url: str, params: dict | None = None, wait: float = 60.0):
    """Parsed JSON, None if there is no such resource; one more try after ``wait`` seconds if told to slow down."""
    full = url + ("?" + urllib.parse.urlencode(params) if params else "")
    for last in (False, True):
        try:
            with urllib.request.urlopen(full, timeout=30) as r:
                return json.load(r)
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return None
            if e.code != 429 or last:
                raise
            time.sleep(wait)
    return None


def _transport(options: dict):
    module, name = options.get("transport", f"{__name__}:http_fetch").split(":")
    return getattr(importlib.import_module(module), name)


class _One(InputPartition):
    def __init__(self, value) -> None:
        super().__init__(value)


class MetricSource(DataSource):
    """``spark.read.format("rest_metrics").option("url", ...).option("metrics", "a,b")``: one partition for each metric, rows
    (metric, timestamp, value) from records ``{"t": ..., "v": ...}``."""

    @classmethod
    def name(cls) -> str:
        return "rest_metrics"

    def schema(self) -> str:
        return "metric string, timestamp long, value double"

    def reader(self, schema) -> DataSourceReader:
        return _MetricReader(dict(self.options))


class _MetricReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [_One(m) for m in self.options["metrics"].split(",")]

    def read(self, partition) -> Iterator[tuple]:
        params = {k: self.options[k] for k in ("since", "until", "api_key") if k in self.options}
        for x in _transport(self.options)(f"{self.options['url']}/{partition.value}", params) or []:
            yield partition.value, int(x["t"]), None if x["v"] is None else float(x["v"])


class DocumentSource(DataSource):
    """``format("rest_documents")`` with ``url``: the items of a JSON list as ``position, document``; one partition."""

    @classmethod
    def name(cls) -> str:
        return "rest_documents"

    def schema(self) -> str:
        return "position int, document string"

    def reader(self, schema) -> DataSourceReader:
        return _DocumentReader(dict(self.options))


class _DocumentReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def read(self, partition) -> Iterator[tuple]:
        for i, x in enumerate(_transport(self.options)(self.options["url"], {}) or []):
            yield i, json.dumps(x)


class BlockSource(DataSource):
    """``format("rpc_blocks")`` with ``url, first, last, span``: block documents as JSON text, one partition for each ``span``
    heights; ``ranges``, a JSON list of [first, last], in place of one range. Heights that can't be had are skipped, with the error in ``error``."""

    @classmethod
    def name(cls) -> str:
        return "rpc_blocks"

    def schema(self) -> str:
        return "block_height long, document string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _BlockReader(dict(self.options))


class _BlockReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        first, last, span = (int(self.options.get(k, d)) for k, d in (("first", 0), ("last", 0), ("span", 500)))
        ranges = json.loads(self.options["ranges"]) if "ranges" in self.options else [[first, last]]
        return [_One((a, min(a + span - 1, hi))) for lo, hi in ranges for a in range(lo, hi + 1, span)]

    def read(self, partition) -> Iterator[tuple]:
        fetch = _transport(self.options)
        for height in range(partition.value[0], partition.value[1] + 1):
            try:
                yield height, json.dumps(fetch(self.options["url"], {"height": height})), None
            except Exception as e:  # noqa: BLE001  one bad block must not end the run; it is reported
                yield height, None, repr(e)[:200]


def register(spark) -> None:
    for source in (MetricSource, DocumentSource, BlockSource, PollSource, WebSocketSource):
        spark.dataSource.register(source)


def land_archives(spark, urls: list[str], target: str, transport: str = f"{__name__}:http_bytes"):
    """Downloads each archive to ``target`` from the executors, in parallel: ``url, path, status, bytes``; status is success,
    skipped (already there), not_found or error. Tally it with ``status_tally``."""

    def land(batches):
        import pyarrow as pa
        from pyarrow import fs

        module, name = transport.split(":")
        fetch = getattr(importlib.import_module(module), name)
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                store, root = fs.FileSystem.from_uri(target)
                path = f"{root}/{url.rsplit('/', 1)[1]}"
                size, status = 0, "skipped"
                if store.get_file_info(path).type == fs.FileType.NotFound:
                    try:
                        data = fetch(url)
                        status = "not_found" if data is None else "success"
                        if data is not None:
                            store.create_dir(root)
                            with store.open_output_stream(path) as out:
                                size = out.write(data) or len(data)
                    except OSError:
                        status = "error"
                rows.append({"url": url, "path": path, "status": status, "bytes": size, "rows": None})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("url", pa.string()), ("path", pa.string()), ("status", pa.string()), ("bytes", pa.int64()), ("rows", pa.int64())]))

    jobs = spark.createDataFrame([(u,) for u in urls], "url string").repartition(max(1, min(len(urls), 200)))
    return jobs.mapInArrow(land, "url string, path string, status string, bytes long, rows long")


def http_bytes(url: str) -> bytes | None:
    try:
        with urllib.request.urlopen(url, timeout=120) as r:
            return r.read()
    except urllib.error.HTTPError as e:
        if e.code == 404:
            return None
        raise
