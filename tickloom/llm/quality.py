"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and word pairs are hashed to ``BUCKETS`` buckets. Two multinomials over the buckets are counted:
one from trusted documents, one from all documents. A document's score is the mean of
``log p_target - log p_raw`` over its n-grams, so length plays no part. A document is kept if it passes
the base rules and its score is not below a threshold that the trusted documents set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import placed, small_batches, written
from .textkernel import IS_SPACE, Words, flat, range_hashes, slices, window_hashes, words_of

BUCKETS = 1 << 14
#: Share of trusted documents that may fall below the threshold, and the slack below it.
BELOW, SLACK = 0.001, 0.02
#: Added to each bucket's raw count; weight of the raw multinomial in the target's, which bounds every ratio from below.
SMOOTHING, PRIOR = 0.5, 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE_BASE = 0xA0761D6478BD642F


@dataclass(frozen=True)
class QualityModel:
    """``ratio`` has log p_target - log p_raw for each bucket."""

    ratio: np.ndarray
    threshold: float


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of each word and each pair of neighbours."""
    one = words.hashes()
    two = window_hashes(one, 2)
    inner = words.doc[1:] == words.doc[:-1] if len(two) else np.zeros(0, bool)
    mask = np.uint64(BUCKETS - 1)
    return (np.concatenate([one, two[inner]]) & mask).astype(np.int64), np.concatenate([words.doc, words.doc[1:][inner] if len(two) else words.doc[:0]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            held += np.bincount(_grams(words_of(part.column("text")))[0], minlength=BUCKETS)
    used = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["bucket", "n"])


def _counted(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all of ``texts``."""
    out = np.zeros(BUCKETS)
    for bucket, n in texts.mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():  # BUCKETS rows at most
        out[bucket] = n
    return out


def _ratio(target: np.ndarray, share: np.ndarray) -> np.ndarray:
    return np.log((target / target.sum() + PRIOR * share) / ((1 + PRIOR) * share))


def _repeats(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of keys that their document has twice or more, those of them that aren't the first)."""
    order = np.argsort(keys, kind="stable")
    same = (keys[order][1:] == keys[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.union1d(order[1:][same], order[:-1][same]), order[1:][same]


def signals(texts: pa.Array, ratio: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts and the score of each text of a batch."""
    raw, off = flat(texts)
    words = words_of(texts)
    docs = len(off) - 1
    n_words = np.diff(words.first)

    def per_doc(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])

    chars = (words.buf & 0xC0) != 0x80
    bounds = np.concatenate([[0], words.end + 1])[words.first] if len(words.end) else np.zeros(docs + 1, np.int64)
    out = {"n_words": n_words, "word_chars": per_doc(chars, bounds) - n_words, "n_symbols": per_doc(_SYMBOL[raw], off)}

    # lines with a word, equal to an earlier line of the document
    breaks = np.flatnonzero(raw == 10)
    begin = np.unique(np.concatenate([off[:-1], breaks + 1]))
    begin = begin[begin < len(raw)]
    end = np.minimum(np.concatenate([begin[1:], [len(raw)]]), np.concatenate([breaks, [len(raw)]])[np.searchsorted(breaks, begin)]) if len(begin) else begin
    owner = np.searchsorted(off, begin, "right") - 1
    inked = np.concatenate([[0], np.cumsum(~IS_SPACE[raw])])
    told = inked[end] > inked[begin]
    lines = range_hashes(raw, begin[told], end[told], _LINE_BASE)
    out["n_dup_lines"] = np.bincount(owner[told][_repeats(lines, owner[told])[1]], minlength=docs)

    # words in windows of five that occur again
    fives = window_hashes(words.hashes(), 5)
    inner = np.flatnonzero(words.doc[: len(fives)] == words.doc[4:]) if len(fives) else np.zeros(0, np.int64)
    twice = inner[_repeats(fives[inner], words.doc[inner])[0]]
    change = np.zeros(len(words.doc) + 1, np.int32)
    change[twice] += 1
    change[twice + 5] -= 1
    out["n_repeat_words"] = per_doc(np.cumsum(change[:-1]) > 0, words.first)

    bucket, doc = _grams(words)
    grams = np.bincount(doc, minlength=docs)
    out["score"] = np.bincount(doc, weights=ratio[bucket], minlength=docs) / np.maximum(grams, 1)
    return out


def _judge(model: QualityModel, passed_on: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                s = signals(part.column("text"), model.ratio)
                failed = (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])
                kept = ~failed & (s["score"] >= model.threshold)
                names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in passed_on] + [pa.array(s[c].astype(np.int64)) for c in names] + [pa.array(failed), pa.array(kept), pa.array(s["score"])], names=passed_on + [f"quality_{c}" for c in (*names, "base_failed", "kept", "score")])

    return run


def _quantile(scores: DataFrame, at: float) -> float | None:
    """The exact quantile ``at`` of the column ``quality_score``, between two neighbours in proportion; None without rows.

    All scores are sorted over range partitions; equal ones are spread over several by a number of the row.
    """
    spread = written(scores.select(F.col("quality_score").alias("score")), "scores").withColumn("row", F.monotonically_increasing_id())
    ordered = written(spread.orderBy("score", "row").select("score"), "sorted")
    place = at * (ordered.count() - 1)
    near = placed(ordered, "place").where(F.col("place").between(math.floor(place), math.floor(place) + 1))
    held = [r.score for r in near.orderBy("place").collect()]  # two rows at most
    if not held:
        return None
    return held[0] + (place - math.floor(place)) * (held[-1] - held[0])


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Counts over all rows of ``docs``, and the threshold by all trusted ones.

    ``labels`` (doc_id, quality, toxic) names the trusted documents: quality 1 and not toxic. Every one of them counts in
    the target multinomial and in the threshold. For the threshold they are dealt to two halves by a hash of their id and each is
    scored by the counts of the other half, so a score that a document owes to its own n-grams does not move it. Ids are
    joined by a shuffle, as they grow with the input. Without any trusted document every ratio is 0; without one in either half
    nothing falls below the threshold.
    """
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    half = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2)).cast("int").alias("half")
    trusted = written(small_batches(docs).select("doc_id", "text").join(good.hint("merge"), "doc_id", "left_semi").select(half, "text"), "trusted")
    halves = [trusted.where(F.col("half") == h) for h in (0, 1)]
    raw, targets = _counted(docs.select("text")) + SMOOTHING, [_counted(rows.select("text")) for rows in halves]
    target, share = sum(targets), raw / raw.sum()
    if not target.sum():
        return QualityModel(np.zeros(BUCKETS), -math.inf)
    low = None
    if all(t.sum() for t in targets):
        scored = [rows.mapInArrow(_judge(QualityModel(_ratio(other, share), -math.inf), ["half"]), _verdict("half int")) for rows, other in zip(halves, reversed(targets), strict=True)]
        low = _quantile(scored[0].union(scored[1]).where("not quality_base_failed"), BELOW)
    return QualityModel(_ratio(target, share), -math.inf if low is None else low - SLACK)


def _verdict(first: str) -> str:
    return first + "".join(f", quality_{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) + ", quality_base_failed boolean, quality_kept boolean, quality_score double"


def judge_quality(docs: DataFrame, model: QualityModel, carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (default: all) of each row and ``quality_*``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, score.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. Null and empty texts have no words, so they
    fail. Repeated rows get equal verdicts. ``docs`` may have further columns; those whose names start with
    ``quality_`` would clash and are dropped.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if not c.startswith("quality_")]
    taken = small_batches(docs).select([c for c in docs.columns if c in carry or c == "text"])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema if f.name in carry)
    return taken.mapInArrow(_judge(model, [c for c in taken.columns if c in carry]), _verdict(ddl))
