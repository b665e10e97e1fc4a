"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. Every window has a minimiser, the run of
``MINIMISER`` words in it with the smallest hash. Consecutive windows that share a minimiser form a
super-k-mer: their words travel once, as one packed string, to the bucket of the minimiser, so equal
windows always meet in one bucket. There a sort of the window hashes, checked on the words
themselves, tells each window's first occurrence from the others.

Hot passages: a task sends a packed string that it has sent before only as a reference (where it
was, how long), dealt by its document, which comes back as "repeated" unread; so a passage that a third of all documents
hold is sent about once by each task, and no bucket gathers its copies.

Hot minimisers, such as three words of a line that stands in a third of all documents among other words, would send
ever more different strings to one bucket. A first pass finds the minimisers with more than ``HOT_BYTES`` of packed
strings; their windows travel one by one, to the bucket of the window's own hash. The number of buckets and of
tasks follows the bytes of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .storage import small_batches
from .textkernel import Words, mixed, slices, window_hashes, words_of

WINDOW = 20
MINIMISER = 3
#: Packed bytes that a bucket gets on average; one task holds one bucket at a time.
BUCKET_BYTES = 2 << 20
#: Packed bytes that a task holds before it sends them on.
HELD_BYTES = 24 << 20
#: Packed bytes that a task remembers before it starts anew, and buckets that a task works through, one after the other.
REMEMBERED_BYTES, TASK_BUCKETS = 16 << 20, 16
#: Packed bytes of a minimiser above which its windows are dealt one by one. Minimisers that a task weighs at a time; those
#: below HOT_BYTES / (number of tasks) there are not reported, so one of 2 * HOT_BYTES or more is always found.
HOT_BYTES, WEIGHED, TASK_BYTES = 64 << 20, 2_000_000, 128 << 20
_NO_ID = np.iinfo(np.int64).max

#: What a task sends to a bucket: its documents, and two packed strings, of each super-k-mer's (step to its document,
#: start, windows, bytes) and of their words.
_SENT = "bucket int, docs array<long>, versions array<long>, places binary, packed binary"
_RUNS = "doc long, version long, start int, n int"


def _spans(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers of a batch: (first window, windows, minimiser)."""
    grams = window_hashes(hashes, MINIMISER)
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    width, low, have = WINDOW - MINIMISER + 1, grams, 1
    while have < width:  # minima of 1, 2, 4, ... grams
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    valid = words.doc[:n] == words.doc[WINDOW - 1 :]
    begins = valid.copy()
    begins[1:] &= ~(valid[:-1] & (low[1:] == low[:-1]) & (words.doc[1:n] == words.doc[: n - 1]))
    ends = valid.copy()
    ends[:-1] &= begins[1:] | ~valid[1:]
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends) + 1 - first, low[first]


def _sent(held: list[tuple], docs: list[np.ndarray], versions: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each bucket that the held super-k-mers go to."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    bucket, owner, start, n = (np.concatenate([h[i] for h in held]) for i in range(4))
    strings = [x for h in held for x in h[4]]
    doc, version = np.concatenate(docs), np.concatenate(versions)
    size = np.fromiter(map(len, strings), np.int32, len(strings))
    order = np.argsort(bucket, kind="stable")
    rows: dict[str, list] = {c: [] for c in ("bucket", "docs", "versions", "places", "packed")}
    for of_one in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        picks, local = np.unique(owner[of_one], return_inverse=True)
        rows["bucket"].append(bucket[of_one[0]])
        rows["docs"].append(doc[picks])
        rows["versions"].append(version[picks])
        rows["places"].append(squeeze(np.stack([np.diff(local, prepend=0), start[of_one], n[of_one], size[of_one]]).astype("<i4").tobytes()))
        rows["packed"].append(squeeze(b"".join([strings[i] for i in of_one.tolist()])))
    kinds = (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows.values(), kinds, strict=True)], names=list(rows))


def _weigh(least: int):
    """Packed bytes of each minimiser that has at least ``least`` of them in a task."""

    def told(keys: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        heavy = size >= least
        return pa.RecordBatch.from_arrays([pa.array(keys[heavy].view(np.int64)), pa.array(size[heavy])], names=["minimiser", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, size = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        fresh, waiting = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                first, n, low = _spans(words, words.hashes())
                fresh.append((low, words.end[first + n + WINDOW - 2] + 1 - words.start[first]))
                waiting += len(low)
                if waiting > WEIGHED:
                    keys, size = _summed([(keys, size), *fresh])
                    fresh, waiting = [], 0
                    if len(keys) > WEIGHED:
                        yield told(keys, size)
                        keys, size = keys[:0], size[:0]
        yield told(*_summed([(keys, size), *fresh]))

    return run


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(back, weights=np.concatenate([s for _, s in parts]), minlength=len(keys)).astype(np.int64)


def hot_minimisers(texts: DataFrame, total: int, hot_bytes: int = HOT_BYTES) -> np.ndarray:
    """The minimisers whose super-k-mers have more than ``hot_bytes``: at most (packed bytes) / hot_bytes of them."""
    least = max(1, int(hot_bytes * min(1.0, TASK_BYTES / max(total, 1))))
    weights = texts.select("text").mapInArrow(_weigh(least), "minimiser long, size long").groupBy("minimiser").agg(F.sum("size").alias("size"))
    return np.sort(weights.where(F.col("size") > hot_bytes).select("minimiser").toArrow().column(0).to_numpy().view(np.uint64))


def _dealt(first: np.ndarray, n: np.ndarray, low: np.ndarray, hashes: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, key of the bucket): super-k-mers of hot minimisers are cut in single windows."""
    split = np.isin(low, hot) if len(hot) else np.zeros(len(low), bool)
    if not split.any():
        return first, n, low
    per = np.where(split, n, 1)
    begin = np.repeat(first, per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    single = np.repeat(split, per)
    key = np.repeat(low, per)
    key[single] = window_hashes(hashes, WINDOW)[begin[single]]
    return begin, np.where(single, 1, np.repeat(n, per)), key


def _joined(own: np.ndarray, start: np.ndarray, n: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows to keep, windows): references (not ``held``) that go on where the one before ends become one."""
    ends = start + n
    on = np.zeros(len(own), bool)
    on[1:] = ~held[1:] & ~held[:-1] & (own[1:] == own[:-1]) & (start[1:] == ends[:-1])
    heads = np.flatnonzero(~on)
    return heads, np.add.reduceat(n, heads) if len(heads) else n


#: Rows that a task remembers as packed; then it begins anew, which costs no more than sending some rows again.
REMEMBERED_ROWS = 500_000


def _once(batch: pa.RecordBatch, rows: set[tuple]) -> pa.RecordBatch:
    """The batch without rows whose document and text are in ``rows`` already, to which its others are added."""
    pairs = list(zip(batch.column("doc").to_pylist(), batch.column("version").to_pylist(), strict=True))
    fresh = np.zeros(len(pairs), bool)
    for i, pair in enumerate(pairs):
        fresh[i] = pair not in rows
        rows.add(pair)
    if len(rows) > REMEMBERED_ROWS:
        rows.clear()
    return batch if fresh.all() else batch.filter(pa.array(fresh))


def _pack(n_buckets: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        rows: set[tuple] = set()
        known = 0
        held, docs, versions, n_docs, size = [], [], [], 0, 0
        for batch in batches:
            for part in slices(_once(batch, rows), "text"):
                words = words_of(part.column("text"))
                hashes = words.hashes()
                first, n, low = _dealt(*_spans(words, hashes), hashes, hot)
                if not len(first):
                    continue
                doc, version = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "version"))
                own = words.doc[first]
                start = first - words.first[own]
                raw = words.buf.tobytes()
                strings = [raw[a:b] for a, b in zip(words.start[first].tolist(), (words.end[first + n + WINDOW - 2] + 1).tolist(), strict=True)]
                for i, at in enumerate(zip(doc[own].tolist(), version[own].tolist(), start.tolist(), strict=True)):
                    was = seen.get(strings[i])
                    if was is not None and was < at:
                        strings[i] = b""
                    else:
                        known += 0 if was is not None else len(strings[i]) + 200
                        seen[strings[i]] = at
                if known > REMEMBERED_BYTES:
                    seen, known = {}, 0
                kept, n = _joined(own, start, n, np.fromiter(map(bool, strings), bool, len(strings)))
                strings = [strings[i] for i in kept.tolist()]
                own, start, low = own[kept], start[kept], low[kept]
                whole = np.fromiter(map(bool, strings), bool, len(strings))
                key = np.where(whole, low, mixed(doc[own].view(np.uint64) + start.astype(np.uint64)))
                held.append(((key % np.uint64(n_buckets)).astype(np.int32), n_docs + own, start, n, strings))
                docs.append(doc)
                versions.append(version)
                n_docs, size = n_docs + len(doc), size + sum(map(len, strings))
                if size > HELD_BYTES:
                    yield _sent(held, docs, versions)
                    held, docs, versions, n_docs, size = [], [], [], 0, 0
        if held:
            yield _sent(held, docs, versions)

    return run


def repeated_windows(buf: bytes, size: np.ndarray) -> np.ndarray:
    """Which windows of the packed strings, given in document order, occurred before: a flag for each
    word that starts a window. ``size`` has the strings' bytes."""
    flat = np.frombuffer(buf, np.uint8)
    end = np.flatnonzero(flat == 32)
    start = np.concatenate([[0], end[:-1] + 1])
    entry = np.repeat(np.arange(len(size)), np.diff(np.searchsorted(end, np.concatenate([[0], np.cumsum(size)]))))
    words = Words(flat, start, end, entry, entry)
    hashes = window_hashes(words.hashes(), WINDOW)
    flags = np.zeros(len(end), bool)
    at = np.flatnonzero(entry[: len(hashes)] == entry[WINDOW - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    if not len(at):
        return flags
    order = np.argsort(hashes[at], kind="stable")
    ranked, here = hashes[at][order], at[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    origin = np.full(len(end), -1, np.int64)
    origin[here] = here[new][np.cumsum(new) - 1]
    later = np.flatnonzero((origin >= 0) & (origin != np.arange(len(end))))
    if not len(later):
        return flags
    flags[later] = True
    # equal hashes are compared on the words: runs that repeat a run are compared at once
    o = origin[later]
    cut = np.concatenate([[True], (np.diff(later) != 1) | (np.diff(o) != 1) | (entry[later[1:]] != entry[later[:-1]]) | (entry[o[1:]] != entry[o[:-1]])])
    heads = np.flatnonzero(cut)
    tails = np.concatenate([heads[1:], [len(later)]]) - 1
    odd = [(h, t) for h, t, a, b, c, d in zip(heads.tolist(), tails.tolist(), start[later[heads]].tolist(), end[later[tails] + WINDOW - 1].tolist(), start[o[heads]].tolist(), end[o[tails] + WINDOW - 1].tolist(), strict=True) if buf[a:b] != buf[c:d]]
    if odd:  # different windows with one hash: settle those hashes by the words alone
        clash = np.unique(np.concatenate([hashes[later[h : t + 1]] for h, t in odd]))
        known: set[bytes] = set()
        for i in at[np.isin(hashes[at], clash)].tolist():
            window = buf[start[i] : end[i + WINDOW - 1]]
            flags[i] = window in known
            known.add(window)
    return flags


def _find(table: pa.Table) -> pa.Table:
    """Runs of repeated windows in one bucket."""
    columns: dict[str, list] = {c: [] for c in ("doc", "version", "start", "n", "size")}
    strings = []
    for row in table.select(["docs", "versions", "places", "packed"]).to_pylist():
        step, *rest = np.frombuffer(zstandard.decompress(row["places"]), "<i4").reshape(4, -1)
        owner = np.cumsum(step)
        for c, x in zip(columns, (np.array(row["docs"])[owner], np.array(row["versions"])[owner], *rest), strict=True):
            columns[c].append(x)
        strings.append(zstandard.decompress(row["packed"]))
    cols = {c: np.concatenate(x) for c, x in columns.items()}
    blob = b"".join(strings)
    del strings
    offset = np.concatenate([[0], np.cumsum(cols["size"], dtype=np.int64)])
    order = np.lexsort((cols["start"], cols["version"], cols["doc"]))
    order = order[cols["size"][order] > 0]
    new = np.ones(len(order), bool)  # a row that is there again is the same document, not an earlier one
    new[1:] = np.any([np.diff(cols[c][order]) != 0 for c in ("doc", "version", "start")], axis=0) if len(order) else []
    order = order[new]
    buf = b"".join([blob[offset[i] : offset[i + 1]] for i in order.tolist()])
    runs = {c: [cols[c][cols["size"] == 0]] for c in ("doc", "version", "start", "n")}  # sent before by the same task
    if len(order):
        flags = repeated_windows(buf, cols["size"][order])
        words_in = cols["n"][order] + WINDOW - 1
        first = np.concatenate([[0], np.cumsum(words_in)])
        owner = np.repeat(np.arange(len(order)), words_in)
        begin = flags & ~(np.concatenate([[False], flags[:-1]]) & (np.concatenate([[-1], owner[:-1]]) == owner))
        heads = np.flatnonzero(begin)
        n = np.add.reduceat(flags.astype(np.int32), heads) if len(heads) else np.zeros(0, np.int32)
        own = order[owner[heads]]
        runs["doc"].append(cols["doc"][own])
        runs["version"].append(cols["version"][own])
        runs["start"].append(cols["start"][own] + (heads - first[owner[heads]]))
        runs["n"].append(n)
    return pa.table({c: pa.array(np.concatenate(x).astype(np.int64 if c in ("doc", "version") else np.int32)) for c, x in runs.items()})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = words_of(part.column("text"))
            change = np.zeros(len(words.doc) + 1, np.int32)
            runs = part.column("runs")
            per = np.diff(runs.offsets.to_numpy(zero_copy_only=False)) if len(runs) else np.zeros(0, np.int64)
            found = runs.flatten()
            if len(found):
                at = found.field("start").to_numpy(zero_copy_only=False) + np.repeat(words.first[:-1], per)
                np.add.at(change, at, 1)
                np.add.at(change, at + found.field("n").to_numpy(zero_copy_only=False) + WINDOW - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])[words.first]
            n_words, n_gone = np.diff(words.first), np.diff(total)
            left = np.repeat(~gone, words.end - words.start + 1)
            raw = words.buf[left].tobytes()
            bytes_kept = np.concatenate([[0], np.cumsum(np.where(gone, 0, words.end - words.start + 1))])[words.first].tolist()
            kept = [raw[a : b - 1] if b > a else b"" for a, b in zip(bytes_kept[:-1], bytes_kept[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


def drop_repeated_passages(docs: DataFrame, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Documents without the words of repeated 20-word windows: ``doc_id, n_words, n_removed, kept_text``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a window that covers it has a word sequence that
    also starts earlier: in a document with a smaller doc_id, or earlier in the same document. Windows
    are judged on the input. Kept words are joined by one space.

    Null or empty texts, and texts under 20 words, lose nothing. A null doc_id stands after all others.
    Rows with one doc_id and one text are the same document and get the same result; rows with one
    doc_id and different texts are ordered by a hash of the text. Other columns are ignored.
    """
    keyed = small_batches(docs).select("doc_id", F.coalesce("doc_id", F.lit(int(_NO_ID))).cast("long").alias("doc"), F.xxhash64("text").alias("version"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, -(-int(total) * 3 // BUCKET_BYTES))
    hot = hot_minimisers(keyed, int(total), hot_bytes)
    sent = keyed.select("doc", "version", "text").mapInArrow(_pack(n_buckets, hot), _SENT)
    runs = sent.repartition(-(-n_buckets // TASK_BUCKETS), "bucket").groupBy("bucket").applyInArrow(_find, _RUNS)
    by_doc = runs.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = keyed.join(by_doc, ["doc", "version"], "left").select("doc_id", "text", F.coalesce("runs", F.array().cast("array<struct<start:int,n:int>>")).alias("runs"))
    return joined.mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_text string")
