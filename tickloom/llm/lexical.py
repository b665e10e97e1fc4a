"""Ranked lexical search over compressed postings, document at a time.

The index is made where the texts are read: each task turns its documents into shards of bounded size, whose postings (place of
a document in the shard, occurrences) are sorted by doc_id, cut in blocks and packed as variable-length bytes of gaps. No text
is shuffled. A shard is searched by a heap that merges the blocks of an item's terms by the first document of each: blocks
come off in the order of documents, all documents before the heap's top are complete and are scored, and a heap of the best k,
keyed by score, then doc_id, keeps what may still be among an item's results. The shards' best are merged at the end.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .storage import small_batches, written
from .textkernel import range_hashes, slices, words_of

K = 50
#: A shard ends with the document that reaches one of these; postings of a block.
SHARD_DOCS, SHARD_BYTES, BLOCK = 16_384, 16 << 20, 1_024
#: Pairs of item and term that are searched together in a shard, about; shards whose postings of a term are joined by one task, about.
PARTY_TERMS, JOINED_SHARDS = 65_536, 64
#: Postings that are gathered before complete documents are scored.
GATHERED = 8_192

#: Bytes outside terms: ASCII but digits and letters.
BREAKS = np.ones(256, bool)
BREAKS[128:] = False
BREAKS[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = False
_OTHER_BASE = 0xE7037ED1A0B428DB

_INDEX = "shard long, term string, first int, n long, total long, postings binary, ids array<long>, sizes array<long>"
_HITS = "party int, item int, doc_id long, score long"


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of integers from 0, seven bits a byte, the last byte of each below 128."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1 << 7 * k)
    offsets = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(offsets[-1]), np.uint8)
    for k in range(int(size.max(initial=0))):
        held = size > k
        more = np.where(size[held] > k + 1, 128, 0).astype(np.uint64)
        out[offsets[:-1][held] + k] = (v[held] >> np.uint64(7 * k)) & np.uint64(127) | more
    return out, offsets


def unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    if not len(ends):
        return np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


def _taken(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ranges of ``buf`` one after another, offsets)."""
    offsets = np.concatenate([[0], np.cumsum(length)])
    return buf[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)], offsets


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before; the first does."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


class _Shard:
    """Postings of the documents that a task has read since its last shard. Each part of a batch is counted where it is added: what
    stays are its distinct terms and (term, document, occurrences) in 32 bits each, not every word."""

    def __init__(self) -> None:
        self.ids, self.null, self.sizes, self.terms, self.postings, self.texts = [], [], [], [], [], []
        self.docs = self.bytes = self.held = self.told = 0

    def add(self, part: pa.RecordBatch) -> None:
        ids = part.column("doc_id")
        self.ids.append(ids.fill_null(0).to_numpy(zero_copy_only=False))
        self.null.append(ids.is_null().to_numpy(zero_copy_only=False))
        w = words_of(part.column("text"), lower=True, breaks=BREAKS)
        self.sizes.append(np.diff(w.first))
        if len(w.start):
            one, two = w.hashes(), range_hashes(w.buf, w.start, w.end, _OTHER_BASE)
            order = np.lexsort((w.doc, two, one))
            first = _changes(one[order], two[order])
            term = np.cumsum(first) - 1
            posting = np.flatnonzero(first | _changes(w.doc[order]))
            word = order[first]
            text, ends = _taken(w.buf, w.start[word], w.end[word] - w.start[word])
            self.terms.append((one[word], two[word], ends[:-1] + self.held, np.diff(ends)))
            self.postings.append(tuple(x.astype(np.int32) for x in (term[posting] + self.told, w.doc[order][posting] + self.docs, np.diff(posting, append=len(order)))))
            self.texts.append(text)
            self.held += len(text)
            self.told += len(word)
        self.docs += part.num_rows
        self.bytes += len(w.buf)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        ids, null, sizes = (np.concatenate(x) for x in (self.ids, self.null, self.sizes))
        by_id = np.lexsort((ids, null))
        place = np.empty(len(ids), np.int64)
        place[by_id] = np.arange(len(ids))
        shown = pa.array(ids[by_id], pa.int64(), mask=null[by_id])
        whole = lambda x, kind: pa.array([x], kind)
        yield pa.RecordBatch.from_arrays([whole(shard, pa.int64()), whole("", pa.string()), whole(0, pa.int32()), whole(int((sizes > 0).sum()), pa.int64()), whole(int(sizes.sum()), pa.int64()), whole(None, pa.binary()), whole(shown.to_pylist(), pa.list_(pa.int64())), whole(sizes[by_id].tolist(), pa.list_(pa.int64()))], names=_names(_INDEX))
        if not self.terms:
            return
        one, two, start, length = (np.concatenate(x) for x in zip(*self.terms, strict=True))
        buf = np.concatenate(self.texts)
        by_hash = np.lexsort((two, one))  # terms that share a hash are told apart by the other
        fresh = _changes(one[by_hash], two[by_hash])
        number = np.empty(len(one), np.int32)  # of each part's terms in the shard
        number[by_hash] = np.cumsum(fresh) - 1
        word = by_hash[fresh]
        start, length = start[word], length[word]
        term, doc, often = (np.concatenate(x) for x in zip(*self.postings, strict=True))
        self.terms = self.texts = self.postings = None  # a shard is sent once
        term, doc = number[term], place[doc].astype(np.int32)
        order = np.lexsort((doc, term))  # a document lies in one part, so each pair is there once
        term, doc, often = term[order], doc[order], often[order]
        del order, one, two, by_hash
        begins = np.flatnonzero(_changes(term))  # of each term's postings
        del term
        count = np.diff(np.concatenate([begins, [len(doc)]]))
        block = np.flatnonzero((np.arange(len(doc)) - np.repeat(begins, count)) % BLOCK == 0)
        bounds = np.append(block, len(doc))
        for at in range(0, len(block), 10_000):  # packed as they are sent
            cut = bounds[at : at + 10_001]
            yield _packed_blocks(shard, doc[cut[0] : cut[-1]], often[cut[0] : cut[-1]], cut - cut[0], buf, start, length, np.searchsorted(begins, cut[:-1], "right") - 1)


def _packed_blocks(shard: int, doc: np.ndarray, often: np.ndarray, cut: np.ndarray, buf: np.ndarray, start: np.ndarray, length: np.ndarray, term: np.ndarray) -> pa.RecordBatch:
    """A row for each block of postings, which begin at ``cut``; its term is ``buf[start:start + length]`` of number ``term``."""
    block, n = cut[:-1], np.diff(cut)
    gaps = np.diff(doc, prepend=0)
    gaps[block] = 0
    data, at = packed(np.stack([gaps, often], axis=1).ravel())
    text, ends = _taken(buf, start[term], length[term])
    fill = lambda kind: pa.nulls(len(block), kind)
    terms = pa.Array.from_buffers(pa.string(), len(block), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text)])
    blobs = pa.Array.from_buffers(pa.binary(), len(block), [None, pa.py_buffer(at[2 * cut].astype(np.int32)), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(block), shard)), terms, pa.array(doc[block].astype(np.int32)), pa.array(n), fill(pa.int64()), blobs, fill(pa.list_(pa.int64())), fill(pa.list_(pa.int64()))], names=_names(_INDEX))


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, shard = TaskContext.get().partitionId() << 24, _Shard()
    for batch in batches:
        for part in slices(batch, "text"):
            shard.add(part)
            if shard.docs >= SHARD_DOCS or shard.bytes >= SHARD_BYTES:
                yield from shard.rows(number)
                number, shard = number + 1, _Shard()
    if shard.docs:
        yield from shard.rows(number)


def build_index(docs: DataFrame) -> DataFrame:
    """The index of all rows of ``docs`` (doc_id, text), a written table: for each shard a row with the term "", the documents' ids and
    numbers of terms, and a row for each block of a term's postings. ``n``: documents with terms, or postings; ``total``: all terms."""
    small = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(small.mapInArrow(_shards, _INDEX), "postings")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            w = words_of(part.column("text"), lower=True, breaks=BREAKS)
            text, ends = _taken(w.buf, w.start, w.end - w.start)
            terms = pa.Array.from_buffers(pa.string(), len(w.start), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text)])
            yield pa.RecordBatch.from_arrays([part.column("party").take(pa.array(w.doc)), part.column("item").take(pa.array(w.doc)), terms], names=["party", "item", "term"])


class _Block:
    """Postings of a term, unpacked when first needed: the documents' places and the term's part of their scores."""

    def __init__(self, first: int, data: bytes, weight: int, lengths: np.ndarray) -> None:
        self.first, self.data, self.weight, self.lengths = first, data, weight, lengths

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        if self.data is not None:
            pairs = unpacked(np.frombuffer(self.data, np.uint8)).reshape(-1, 2)
            self.docs = self.first + np.cumsum(pairs[:, 0])
            self.score = self.weight * (1_000_000_000 * pairs[:, 1] // (1000 * pairs[:, 1] + 20 * self.lengths[self.docs]))
            self.data = None
        return self.docs, self.score


def merged(terms: list[list[_Block]], k: int) -> list[tuple[int, int]]:
    """(score, document) of the best ``k`` documents with a score above 0, of blocks in the order of documents for each term."""
    heap = [(blocks[0].first, t, 0) for t, blocks in enumerate(terms)]
    heapq.heapify(heap)
    docs, scores, waiting, enough, best = [], [], 0, GATHERED, []
    while heap or waiting:
        if not heap or waiting >= enough:
            d, s = np.concatenate(docs), np.concatenate(scores)
            over = d < heap[0][0] if heap else np.ones(len(d), bool)  # no block to come has these documents
            docs, scores, waiting = [d[~over]], [s[~over]], int((~over).sum())
            enough = 2 * waiting + GATHERED
            _keep(best, d[over], s[over], k)
        if heap:
            _, t, b = heap[0]
            d, s = terms[t][b].parts()
            docs.append(d)
            scores.append(s)
            waiting += len(d)
            if b + 1 < len(terms[t]):
                heapq.heapreplace(heap, (terms[t][b + 1].first, t, b + 1))
            else:
                heapq.heappop(heap)
    return [(s, -d) for s, d in best]


def _keep(best: list[tuple[int, int]], docs: np.ndarray, scores: np.ndarray, k: int) -> None:
    """Adds complete documents to the heap of the best ``k``, keyed by score, then the smaller document."""
    if not len(docs):
        return
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], scores[order]
    begins = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    docs, scores = docs[begins], np.add.reduceat(scores, begins)
    may = scores > 0 if len(best) < k else scores > best[0][0]  # later documents lose ties
    docs, scores = docs[may], scores[may]
    for i in np.lexsort((docs, -scores))[:k].tolist():
        entry = (int(scores[i]), -int(docs[i]))
        if len(best) < k:
            heapq.heappush(best, entry)
        elif entry > best[0]:
            heapq.heapreplace(best, entry)


def _lengths(sizes: np.ndarray, n: int, total: int) -> np.ndarray:
    """100 - 50 + (50 * size * n) div total, in whole numbers."""
    if 50 * int(sizes.max(initial=0)) * n < 1 << 63:
        return 50 + 50 * sizes * n // max(total, 1)
    return np.array([50 + 50 * x * n // max(total, 1) for x in sizes.tolist()], np.int64)


def _search(k: int, n: int, total: int):
    def run(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        rows = table.drop_columns(["ids", "sizes"]).to_pylist()
        at = next((i for i, r in enumerate(rows) if r["term"] == ""), None)
        if at is not None and len(rows) > 1:
            ids = table.column("ids")[at].as_py()
            lengths = _lengths(np.array(table.column("sizes")[at].as_py(), np.int64), n, total)
            terms: dict[str, list[_Block]] = {}
            items: dict[int, list[str]] = {}
            for r in sorted((r for r in rows if r["term"] != ""), key=lambda r: (r["term"], r["first"])):
                if r["term"] not in terms:
                    for item in r["items"]:
                        items.setdefault(item, []).append(r["term"])
                terms.setdefault(r["term"], []).append(_Block(r["first"], r["postings"], r["weight"], lengths))
            for item, held in items.items():
                out += [(rows[at]["party"], item, ids[d], s) for s, d in merged([terms[t] for t in held], k)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=_names(_HITS))

    return run


def search_index(index: DataFrame, items: DataFrame, k: int = K, party_terms: int = PARTY_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` (item_id, text) the ``k`` best documents of an index with a score
    above 0, ties to the smaller doc_id; fewer if there are fewer, none for an item without a known term.

    Terms are runs of digits, letters and characters beyond ASCII; only A-Z are lower-cased. A term's weight is
    floor(1000 * ln((2N + 2) / (2df + 1))), N counting the documents with a term; a document's part of a term's score is the weight times
    (10**9 * tf) div (1000 * tf + 20 * m), m being 50 + (50 * length * N) div (all terms), in whole numbers. Items that
    repeat an id and a text count once; items that share an id with different texts each have their results under it. Documents that share
    an id are each ranked; those without an id come after all others of their score. Null texts have no terms. Other columns are ignored.
    """
    n, total = index.where("term = ''").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    shards = index.where("term = ''").count()
    asked = items.select("item_id", "text").distinct()
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    parties = max(1, -(-chars // (4 * party_terms)))
    party = F.pmod(F.xxhash64("text", "item_id"), F.lit(parties)).cast("int")
    within = Window.partitionBy("party").orderBy("item_id", "text")
    asked = written(asked.withColumn("party", party).withColumn("item", F.row_number().over(within)), "items")
    pairs = small_batches(asked).select("party", "item", "text").mapInArrow(_terms, "party int, item int, term string").distinct()
    wanted = written(pairs.groupBy("party", "term").agg(F.collect_list("item").alias("items")), "wanted")  # at most a party's items
    terms = wanted.select("term").distinct()
    weight = F.floor(1000 * F.log((2.0 * n + 2) / (2 * F.col("df") + 1)))
    weights = index.where("term <> ''").join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df")).select("term", weight.alias("weight"))
    salts = max(1, shards // JOINED_SHARDS)
    keyed = wanted.join(weights, "term").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    postings = index.where("term <> ''").select("shard", "term", "first", "postings", F.pmod(F.xxhash64("shard"), F.lit(salts)).cast("int").alias("salt"))
    found = postings.join(keyed, ["term", "salt"]).select("shard", "party", "term", "first", "postings", "weight", "items")
    none = {"first": "int", "postings": "binary", "weight": "long", "items": "array<int>"}
    documents = index.where("term = ''").select("shard", F.explode(F.sequence(F.lit(0), F.lit(parties - 1))).alias("party"), "term", "ids", "sizes", *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    both = found.unionByName(documents, allowMissingColumns=True)
    hits = both.groupBy("shard", "party").applyInArrow(_search(k, n, total), _HITS)
    order = Window.partitionBy("party", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("party", "item", "item_id"), ["party", "item"]).select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``search_index`` over an index made of all ``docs`` (doc_id, text)."""
    return search_index(build_index(docs), items, k)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
sizes AS (SELECT r, doc_id, len(t) AS n FROM texts WHERE len(t) > 0),
all_of AS (SELECT count(*) AS n, CAST(sum(n) AS BIGINT) AS l FROM sizes),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM texts) GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, all_of WHERE term IN (SELECT term FROM asked) GROUP BY term),
lengths AS (SELECT r, doc_id, 50 + (50 * sizes.n * all_of.n) // l AS m FROM sizes, all_of),
scored AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (r) GROUP BY item_id, r),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS k, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM ranked WHERE k <= 50
"""
