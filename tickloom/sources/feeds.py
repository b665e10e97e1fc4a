"""Live feeds as streaming sources: WebSockets and polled URLs, both behind a durable log.

A live feed can't be asked again for what it has sent. So messages are first written to a log below the stream's state, and an
offset is a number of logged messages: a batch that is planned again after a crash reads the same messages from the log. Executors
read the log's segments; the driver's part only receives, and never passes messages on.
"""

from __future__ import annotations

import base64
import hashlib
import importlib
import json
import os
import socket
import ssl
import struct
import threading
import time
import urllib.parse
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "received_ms long, message string"
#: Longest pause between two tries to connect, in seconds; it starts at 1 and doubles.
LONGEST_PAUSE = 60.0


class MessageLog:
    """Numbered messages in files ``<first>-<end>.jsonl`` of a folder that driver and executors share. A segment gets its name when
    it is whole, so a crash while writing leaves none. There is one writer."""

    def __init__(self, uri: str) -> None:
        self.store, self.root = fs.FileSystem.from_uri(uri)
        self.store.create_dir(self.root)
        held = self.segments()
        self.first, self.end = (held[0][0], held[-1][1]) if held else (0, 0)

    def segments(self) -> list[tuple[int, int, str]]:
        """(first, end, path), in order."""
        names = [f for f in self.store.get_file_info(fs.FileSelector(self.root, allow_not_found=True)) if f.base_name.endswith(".jsonl")]
        return sorted((*map(int, f.base_name.removesuffix(".jsonl").split("-")), f.path) for f in names)

    def append(self, messages: list[tuple[int, str]]) -> None:
        if messages:
            end = self.end + len(messages)
            path = f"{self.root}/{self.end:020d}-{end:020d}.jsonl"
            with self.store.open_output_stream(f"{path}.tmp") as out:
                out.write("".join(json.dumps(m) + "\n" for m in messages).encode())
            self.store.move(f"{path}.tmp", path)
            self.end = end

    def drop(self, before: int) -> None:
        """Segments that no batch will ask for again go; the newest stays, for its number."""
        for _, end, path in self.segments()[:-1]:
            if end <= before:
                self.store.delete_file(path)


class _Range(InputPartition):
    def __init__(self, path: str, skip: int, rows: int) -> None:
        super().__init__((path, skip, rows))


class LoggedReader(DataSourceStreamReader):
    """Reads a MessageLog; what fills it is told by ``receive``, which is called before each batch."""

    def __init__(self, options: dict) -> None:
        if "log" not in options:
            raise ValueError("a live feed needs the option log: a folder for its messages that driver and executors share")
        self.options, self.log = options, None

    def opened(self) -> MessageLog:
        self.log = self.log or MessageLog(self.options["log"])
        return self.log

    def receive(self) -> None:
        raise NotImplementedError

    def initialOffset(self) -> dict:
        return {"n": self.opened().first}

    def latestOffset(self) -> dict:
        self.opened()
        self.receive()
        return {"n": self.log.end}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        found = [(max(a, start["n"]), min(b, end["n"]), a, path) for a, b, path in self.opened().segments()]
        held = [(lo, hi, a, path) for lo, hi, a, path in found if lo < hi]
        if sum(hi - lo for lo, hi, _, _ in held) != end["n"] - start["n"]:
            raise RuntimeError(f"the log {self.options['log']} lacks messages between {start['n']} and {end['n']}")
        return [_Range(path, lo - a, hi - lo) for lo, hi, a, path in held]

    def read(self, partition) -> Iterator[tuple]:
        path, skip, rows = partition.value
        store, _ = fs.FileSystem.from_uri(self.options["log"])
        with store.open_input_stream(path) as f:
            lines = f.read().decode().split("\n")[skip : skip + rows]
        yield from (tuple(json.loads(line)) for line in lines)

    def commit(self, end: dict) -> None:
        self.opened().drop(end["n"])


class WebSocketSource(DataSource):
    """``spark.readStream.format("websocket")`` with ``url`` (ws:// or wss://), ``log`` and, if wanted, ``subscribe`` (a text that is
    sent after each connection), ``flush_s`` (a segment is written so many seconds after its first message, 1), ``flush_rows``
    (or with so many, 1,000), ``idle_s`` (connect anew after so long a silence, 60; pings are answered and don't count), ``pause``
    (factor of the pauses between tries, 1). Rows: when a message was received, and its text.

    What a server sends while there is no connection is lost, as with any client; what was received is in the log, also if the query
    fails or is stopped. The log is the stream's state: keep it beside the checkpoint, and give each stream its own."""

    @classmethod
    def name(cls) -> str:
        return "websocket"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _SocketReader(dict(self.options))


class _SocketReader(LoggedReader):
    def __init__(self, options: dict) -> None:
        super().__init__(options)
        self.thread = None

    def receive(self) -> None:
        if self.thread is None:
            self.waiting: list[tuple[int, str]] = []
            self.closing, self.failed = threading.Event(), None
            self.thread = threading.Thread(target=self._run, daemon=True)
            self.thread.start()
        if self.failed:
            raise self.failed

    def stop(self) -> None:
        if self.thread is not None:
            self.closing.set()
            self.thread.join(10)

    def _run(self) -> None:
        pause = 1.0
        try:
            while not self.closing.is_set():
                try:
                    for message in self._messages():
                        pause = 1.0
                        if message is not None:
                            self.waiting.append((int(time.time() * 1000), message))
                        self._flush()
                except OSError:
                    pass
                self._flush(True)
                self.closing.wait(min(pause, LONGEST_PAUSE) * float(self.options.get("pause", 1)))
                pause = min(2 * pause, LONGEST_PAUSE)
            self._flush(True)
        except Exception as e:  # noqa: BLE001  the next batch fails with it
            self.failed = e

    def _flush(self, now: bool = False) -> None:
        rows, wait = int(self.options.get("flush_rows", 1000)), 1000 * float(self.options.get("flush_s", 1))
        if self.waiting and (now or len(self.waiting) >= rows or time.time() * 1000 - self.waiting[0][0] >= wait):
            self.log.append(self.waiting)
            self.waiting = []

    def _messages(self) -> Iterator[str | None]:
        """Messages of one connection; None now and then while there is none."""
        with connected(self.options["url"]) as ws:
            if "subscribe" in self.options:
                ws.send(self.options["subscribe"])
            heard, idle = time.time(), float(self.options.get("idle_s", 60))
            while not self.closing.is_set():
                kind, message = ws.next(min(0.2, idle))
                if kind == "closed" or time.time() - heard > idle:
                    return
                if kind == "text":
                    heard = time.time()
                yield message


class connected:
    """The client's side of a WebSocket connection: text and binary messages, fragments, pings, closing. OSError if it breaks."""

    _GUID = "258EAFA5-E914-47DA-95CA-C5AB0DC85B11"

    def __init__(self, url: str, timeout: float = 30.0) -> None:
        at = urllib.parse.urlsplit(url)
        port = at.port or (443 if at.scheme == "wss" else 80)
        self.sock, self.buffer, self.parts = socket.create_connection((at.hostname, port), timeout), b"", []
        if at.scheme == "wss":
            self.sock = ssl.create_default_context().wrap_socket(self.sock, server_hostname=at.hostname)
        key = base64.b64encode(os.urandom(16)).decode()
        path = (at.path or "/") + (f"?{at.query}" if at.query else "")
        self.sock.sendall(f"GET {path} HTTP/1.1\r\nHost: {at.hostname}:{port}\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Key: {key}\r\nSec-WebSocket-Version: 13\r\n\r\n".encode())
        while b"\r\n\r\n" not in self.buffer:
            self._more()
        head, self.buffer = self.buffer.split(b"\r\n\r\n", 1)
        accept = base64.b64encode(hashlib.sha1((key + self._GUID).encode()).digest())
        if b" 101 " not in head.split(b"\r\n")[0] + b" " or accept not in head:
            self.sock.close()
            raise ConnectionError(f"{url} is no WebSocket: {head[:80]!r}")

    def __enter__(self) -> connected:
        return self

    def __exit__(self, *_) -> None:
        self.sock.close()

    def _more(self) -> None:
        data = self.sock.recv(1 << 16)
        if not data:
            raise ConnectionError("closed")
        self.buffer += data

    def _frame(self, opcode: int, data: bytes) -> None:
        size = bytes([128 | len(data)]) if len(data) < 126 else struct.pack("!BH", 254, len(data)) if len(data) < 1 << 16 else struct.pack("!BQ", 255, len(data))
        mask = os.urandom(4)
        self.sock.sendall(bytes([128 | opcode]) + size + mask + bytes(b ^ mask[i % 4] for i, b in enumerate(data)))

    def send(self, text: str) -> None:
        self._frame(1, text.encode())

    def _whole(self) -> tuple[bool, int, bytes] | None:
        """(last of its message, kind, content) of the first frame of the buffer, if all of it is there."""
        b = self.buffer
        if len(b) < 2:
            return None
        size, at = b[1] & 127, 2
        if size > 125:
            at = 4 if size == 126 else 10
            if len(b) < at:
                return None
            size = int.from_bytes(b[2:at], "big")
        masked = 4 if b[1] & 128 else 0
        if len(b) < at + masked + size:
            return None
        mask, data = b[at : at + masked], b[at + masked : at + masked + size]
        self.buffer = b[at + masked + size :]
        return bool(b[0] & 128), b[0] & 15, bytes(x ^ mask[i % 4] for i, x in enumerate(data)) if masked else data

    def next(self, wait: float) -> tuple[str, str | None]:
        """("text", message), ("nothing", None) after ``wait`` seconds or a ping, or ("closed", None)."""
        while (frame := self._whole()) is None:
            self.sock.settimeout(wait)
            try:
                self._more()
            except TimeoutError:
                return "nothing", None
            finally:
                self.sock.settimeout(30.0)
        last, kind, data = frame
        if kind == 8:
            self._frame(8, data[:2])
            return "closed", None
        if kind == 9:
            self._frame(10, data)
        if kind in (0, 1, 2):
            self.parts.append(data)
            if last:
                text, self.parts = b"".join(self.parts).decode("utf-8", "replace"), []
                return "text", text
        return "nothing", None


class PollSource(DataSource):
    """``spark.readStream.format("polled_json")`` with ``url`` and ``log``: each micro-batch asks once and gives (received_ms, message); a
    list gives a row for each item, an error none, after which the next try waits. It serves snapshots (a trigger of 60 s) and message queues
    alike; a queue is told by ``after`` how many messages were had. Messages are logged before a batch is planned with them."""

    @classmethod
    def name(cls) -> str:
        return "polled_json"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _PollReader(dict(self.options))


class _PollReader(LoggedReader):
    def __init__(self, options: dict) -> None:
        super().__init__(options)
        self.wait, self.again = 1.0, 0.0

    def receive(self) -> None:
        if time.time() < self.again:
            return
        module, name = self.options.get("transport", "tickloom.sources.remote:http_fetch").split(":")
        try:
            got = getattr(importlib.import_module(module), name)(self.options["url"], {"after": self.log.end})
            self.wait = 1.0
        except OSError:
            self.again = time.time() + self.wait * float(self.options.get("pause", 1))
            self.wait, got = min(2 * self.wait, LONGEST_PAUSE), None
        items = got if isinstance(got, list) else [] if got is None else [got]
        self.log.append([(int(time.time() * 1000), json.dumps(x)) for x in items])
