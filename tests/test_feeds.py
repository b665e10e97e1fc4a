"""Live feeds: a local WebSocket server that breaks off, queries that are killed and started again, the log below them."""

import base64
import hashlib
import json
import socket
import struct
import threading
import time

import pytest

from tickloom.plans import ingest
from tickloom.sources import feeds, remote


class Server:
    """Sends the messages 0, 1, ... ``limit`` of a stream, each once, in the ways that WebSockets allow; breaks off after every ``cut``."""

    def __init__(self, cut=10**9):
        self.sock, self.sent, self.limit, self.cut, self.heard, self.connections = socket.create_server(("127.0.0.1", 0)), 0, 0, cut, [], 0
        self.url = f"ws://127.0.0.1:{self.sock.getsockname()[1]}/stream?x=1"
        threading.Thread(target=self.run, daemon=True).start()

    def run(self):
        while True:
            try:
                c, _ = self.sock.accept()
            except OSError:
                return
            self.connections += 1
            threading.Thread(target=self.serve, args=(c,), daemon=True).start()

    def serve(self, c):
        try:
            head = b""
            while b"\r\n\r\n" not in head:
                head += c.recv(1000)
            if b"GET /stream?x=1 " not in head:
                c.sendall(b"HTTP/1.1 404 Not Found\r\n\r\n")
                return
            key = next(x.split(b": ")[1] for x in head.split(b"\r\n") if x.startswith(b"Sec-WebSocket-Key"))
            accept = base64.b64encode(hashlib.sha1(key + b"258EAFA5-E914-47DA-95CA-C5AB0DC85B11").digest())
            c.sendall(b"HTTP/1.1 101 Switching Protocols\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Accept: " + accept + b"\r\n\r\n")
            first = c.recv(1000)  # the masked subscription
            mask, data = first[2:6], first[6:]
            self.heard.append(bytes(b ^ mask[i % 4] for i, b in enumerate(data)).decode())
            done = 0
            while done < self.cut:
                if self.sent >= self.limit:
                    time.sleep(0.02)
                    c.sendall(bytes([0x89, 0]))  # a ping; fails once the client has gone
                    continue
                i, self.sent, done = self.sent, self.sent + 1, done + 1
                text = json.dumps({"E": i, "a": i, "p": "1.5", "q": "2", "T": i, "x": "ü\n" + "y" * (i % 3 * 40_000)}).encode()
                half = len(text) // 2
                for opcode, part in ((0x01, text[:half]), (0x80, text[half:])) if i % 2 else ((0x81, text),):
                    size = bytes([len(part)]) if len(part) < 126 else struct.pack("!BH", 126, len(part)) if len(part) < 1 << 16 else struct.pack("!BQ", 127, len(part))
                    c.sendall(bytes([opcode]) + size + part)
            c.sendall(bytes([0x88, 2, 3, 232]))
        except OSError:
            pass
        finally:
            c.close()


def until(what, seconds=60):
    for _ in range(seconds * 10):
        if what():
            return
        time.sleep(0.1)
    raise AssertionError("it took too long")


def test_websocket_loses_and_repeats_nothing(spark, tmp_path):
    """The server breaks off every 7 messages; the query is stopped with messages in the log that no batch has had, fails within a
    batch, and is started again."""
    server, root, failing = Server(7), str(tmp_path), [True]
    options = {"pause": "0.01", "flush_s": "0.1"}
    stored = lambda: [r.agg_trade_id for r in spark.read.schema("agg_trade_id long").parquet(f"{root}/raw/live/aggtrade").collect()] if (tmp_path / "raw/live/aggtrade").exists() else []
    start = lambda trigger: ingest.ingest_feeds(spark, root, {"aggtrade": server.url}, {"processingTime": trigger}, {"aggtrade": "all trades"}, **options)["aggtrade"]
    server.limit = 40
    query = start("300 milliseconds")
    until(lambda: len(stored()) == 40)
    query.stop()
    query = start("1 hour")  # its only batch comes before the messages
    server.limit = 65
    until(lambda: feeds.MessageLog(ingest.feed_log(root, "aggtrade")).end == 65)
    query.stop()
    assert len(stored()) == 40

    def fail(batch, n):
        if failing[0] and batch.count():
            failing[0] = False
            raise RuntimeError("killed")
        kept.append(sorted(json.loads(r.message)["a"] for r in batch.collect()))

    kept = []
    remote.register(spark)
    messages = spark.readStream.format("websocket").options(url=server.url, log=ingest.feed_log(root, "other"), subscribe="s", **options).load()
    server.limit = 80
    for _ in range(2):
        query = messages.writeStream.foreachBatch(fail).option("checkpointLocation", f"{root}/c").trigger(processingTime="300 milliseconds").start()
        try:
            until(lambda: query.exception() is not None or sum(map(len, kept)) >= 15)
        finally:
            query.stop()
    assert sorted(x for k in kept for x in k) == list(range(65, 80)) and not failing[0]
    query = start("300 milliseconds")
    until(lambda: len(stored()) == 65)
    server.limit = 90
    until(lambda: len(stored()) == 75)
    query.stop()
    assert sorted(stored()) == [*range(65), *range(80, 90)] and set(server.heard) == {"all trades", "s"} and server.connections > 10
    assert len(feeds.MessageLog(ingest.feed_log(root, "aggtrade")).segments()) < 20


def test_connection_errors(tmp_path):
    server = Server()
    with pytest.raises(ConnectionError):
        feeds.connected(server.url.replace("/stream", "/other"))
    reader = feeds._SocketReader({"url": "ws://127.0.0.1:1/", "log": str(tmp_path), "pause": "0.01"})
    assert reader.initialOffset() == reader.latestOffset() == {"n": 0}
    time.sleep(0.3)
    reader.stop()
    assert not reader.thread.is_alive() and reader.failed is None
    with pytest.raises(ValueError, match="log"):
        feeds._SocketReader({"url": "x"})


def queue(url, params):
    """Five messages in all, two at a time; every second call fails."""
    calls.append(params["after"])
    if len(calls) % 2 == 0:
        raise OSError("down")
    return [{"i": i} for i in range(params["after"], min(params["after"] + 2, 5))]


calls: list[int] = []


def test_polled_messages_outlive_the_reader(tmp_path):
    options = {"url": "x", "log": str(tmp_path / "log"), "transport": "tests.test_feeds:queue", "pause": "0"}
    calls.clear()
    one = feeds._PollReader(options)
    start, end = one.initialOffset(), one.latestOffset()
    two = feeds._PollReader(options)  # after a crash: the planned batch is read again, nothing is asked twice
    read = lambda r, a, b: [json.loads(m)["i"] for p in r.partitions(a, b) for _, m in r.read(p)]
    assert read(two, start, end) == read(one, start, end) == [0, 1]
    ends = [two.latestOffset()["n"] for _ in range(6)]
    assert ends == [2, 4, 4, 5, 5, 5] and read(two, {"n": 1}, {"n": 5}) == [1, 2, 3, 4]
    two.commit({"n": 5})
    assert [s[:2] for s in two.log.segments()] == [(4, 5)] and feeds._PollReader(options).initialOffset() == {"n": 4} and feeds.MessageLog(options["log"]).end == 5
    with pytest.raises(RuntimeError, match="lacks"):
        two.partitions({"n": 0}, {"n": 5})
