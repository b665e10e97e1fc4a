"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

A document becomes DIM statistics of its text. Cosines of random projections of them approximate a Gaussian kernel, so a linear
fit in FEATURES of those is a kernel fit. Each partition of the labelled rows sums its part of the normal equations, the sums
are added up and solved once; labelled rows that the fit has not seen then calibrate its scores by isotonic regression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .quality import signals
from .storage import small_batches, written
from .textkernel import flat, slices, words_of

#: Most labelled rows that the model is fitted on, those with the smallest hash of their id; partitions that sum them up.
LABELLED, PARTS = 50_000, 16
FEATURES, RIDGE = 384, 1e-3
#: One labelled row of CALIBRATED is kept from the fit, for the calibration.
CALIBRATED = 4
#: Share of the uncalibrated score in the result, which tells rows of one step of the calibration apart.
FINE = 0.01

_KIND = np.zeros(256, np.int8)  # 0 other, 1 space, 2 digit, 3 upper, 4 lower, 5 punctuation, 6 first of a longer character, 7 rest of one
_KIND[[0x20, *range(0x09, 0x0E)]] = 1
_KIND[0x30:0x3A], _KIND[0x41:0x5B], _KIND[0x61:0x7B] = 2, 3, 4
_KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 5
_KIND[0xC0:], _KIND[0x80:0xC0] = 6, 7

#: What is measured of a text; shares are between 0 and 1.
STATISTICS = (
    "log_words", "log_characters", "word_length", "word_length_spread", "longest_word", "symbols", "digits", "upper", "lower", "punctuation", "beyond_ascii", "spaces", "other",
    "distinct_words", "as_before", "repeated_fives", "repeated_lines", "words_a_line", "bare_words", "capital_words", "ends_in_punctuation", "entropy", "doubled_bytes",
)
DIM = len(STATISTICS)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text; null counts as empty, and an empty text has zeros."""
    raw, off = flat(texts)
    words = words_of(texts)
    docs = len(off) - 1
    base = signals(texts, np.zeros(1 << 14))
    n_words = np.maximum(base["n_words"], 1)
    doc_of = np.repeat(np.arange(docs), np.diff(off))
    kinds = np.bincount(doc_of * 8 + _KIND[raw], minlength=8 * docs).reshape(docs, 8)
    chars = np.maximum(kinds[:, :7].sum(axis=1), 1)
    size = np.maximum(np.diff(off), 1)

    by_word = lambda x: np.bincount(words.doc, weights=x, minlength=docs)
    length = (words.end - words.start).astype(np.float64)
    mean = by_word(length) / n_words
    spread = np.sqrt(np.maximum(by_word(length**2) / n_words - mean**2, 0))
    longest = np.zeros(docs)
    np.maximum.at(longest, words.doc, length)
    hashes = words.hashes()
    order = np.lexsort((hashes, words.doc))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (words.doc[order][1:] != words.doc[order][:-1])
    distinct = np.bincount(words.doc[order], weights=new, minlength=docs)
    before = np.zeros(len(hashes), bool)
    before[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    kind = _KIND[words.buf]
    inked = np.concatenate([[0], np.cumsum((kind == 2) | (kind == 3) | (kind == 4) | (kind == 6))])
    small = np.concatenate([[0], np.cumsum((kind == 4) | (kind == 2))])
    bare = inked[words.end] == inked[words.start]
    capital = ~bare & (small[words.end] == small[words.start]) & (length > 1)
    ends = kind[np.maximum(words.end - 1, 0)] == 5 if len(words.end) else np.zeros(0, bool)
    lines = np.bincount(doc_of, weights=raw == 10, minlength=docs) + 1
    counts = np.bincount(doc_of * 256 + raw, minlength=256 * docs).reshape(docs, 256)
    p = counts / size[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1) / 8
    doubled = np.zeros(len(raw), bool)
    doubled[1:] = (raw[1:] == raw[:-1]) & (doc_of[1:] == doc_of[:-1])
    share = lambda x, of: np.sqrt(np.asarray(x) / of)  # noqa: E731  small shares count more
    out = np.stack([
        np.log1p(base["n_words"]), np.log1p(np.diff(off)), np.log1p(mean), np.log1p(spread), np.log1p(longest), share(base["n_symbols"], chars), share(kinds[:, 2], chars), share(kinds[:, 3], chars), share(kinds[:, 4], chars), share(kinds[:, 5], chars), share(kinds[:, 6], chars), share(kinds[:, 1], chars), share(kinds[:, 0], chars),
        distinct / n_words, share(by_word(before), n_words), share(base["n_repeat_words"], n_words), share(base["n_dup_lines"], lines), np.log1p(base["n_words"] / lines), share(by_word(bare), n_words), share(by_word(capital), n_words), share(by_word(ends), n_words), entropy, share(np.bincount(doc_of, weights=doubled, minlength=docs), size),
    ], axis=1)
    out[np.diff(off) == 0] = 0
    return out


@dataclass(frozen=True)
class QualityClassifier:
    """``steps`` and ``levels``: uncalibrated scores and what they are calibrated to, both rising."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return (1 - FINE) * np.interp(raw, self.steps, self.levels) + FINE * (1 / (1 + np.exp(-4 * (raw - 0.5))))


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """FEATURES cosines of random projections, the same for every call, and a constant: their inner products approximate a Gaussian
    kernel of width sqrt(DIM) between standardised statistics, which are cut at 6 deviations."""
    rng = np.random.default_rng(20_250_613)
    turn, phase = rng.standard_normal((DIM, FEATURES)) / np.sqrt(DIM), rng.uniform(0, 2 * np.pi, FEATURES)
    waves = np.sqrt(2 / FEATURES) * np.cos(np.clip((x - mean) / scale, -6, 6) @ turn + phase)
    return np.concatenate([waves, np.ones((len(x), 1))], axis=1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps and levels of the rising function nearest to ``y``: neighbours that fall are pooled until none does, equal x from the
    start. A pool stands at the mean of its x; between pools the function is straight."""
    at, which, rows = np.unique(x, return_inverse=True, return_counts=True)
    pools: list[list[float]] = []  # sum of y, rows, sum of x
    for a, b, n in zip(at.tolist(), np.bincount(which, weights=y).tolist(), rows.tolist(), strict=True):
        pools.append([b, n, a * n])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), DIM)


def _measured(carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = statistics(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, DIM, dtype=np.int32)), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carry), lists], names=[*carry, "statistics"])

    return run


def measure(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Columns ``carry`` and ``statistics`` of the whole text of each row."""
    taken = small_batches(docs).select(*carry, "text")
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken.schema if f.name in carry)
    return taken.mapInArrow(_measured(carry), ddl + "statistics array<double>")


def _summed(mean: np.ndarray, scale: np.ndarray):
    """The part of the normal equations of a partition: Z'Z and Z'y, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            z = fourier(_matrix(batch.column("statistics")), mean, scale)
            square += z.T @ z
            right += z.T @ batch.column("y").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()], pa.binary()), pa.array([right.tobytes()], pa.binary())], names=["square", "rhs"])

    return run


def fit_classifier(measured: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED) -> QualityClassifier:
    """The model of ``labels`` (doc_id and the column ``label``, 0 or 1) on ``measured`` (doc_id, statistics).

    At most ``labelled`` ids, with the smallest hash, are used, each with the mean of its labels; ids and labels that are null take no
    part. Without any labelled row every score is 0.5, with labels of one value near that value. What reaches the driver is bounded: PARTS sums, ``labelled`` / CALIBRATED
    scores and a row of means.
    """
    told = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.avg(label).alias("y"))
    told = F.broadcast(told.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(labelled))  # ``labelled`` rows of 16 bytes
    late = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(CALIBRATED)) == 0
    rows = written(measured.join(told, "doc_id").select("statistics", "y", late.alias("late")).repartition(PARTS), "labelled")
    stats = [f(F.col("statistics")[i]) for i in range(DIM) for f in (F.avg, F.stddev_pop)]
    first = rows.agg(F.count_if(~F.col("late")), F.count_if("late"), *stats).first()
    if not first[0] + first[1]:
        return QualityClassifier(np.zeros(DIM), np.ones(DIM), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    if not first[0] or not first[1]:  # too few rows to keep some from the fit
        rows = rows.withColumn("late", F.lit(False)).unionByName(rows.withColumn("late", F.lit(True)))
    mean, scale = np.array(first[2::2], float), np.array(first[3::2], float)
    scale = np.where(scale > 1e-9, scale, 1.0)
    square, right, n = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1), rows.where("not late").count()
    for part in rows.where("not late").coalesce(PARTS).mapInArrow(_summed(mean, scale), "square binary, rhs binary").toLocalIterator():
        square += np.frombuffer(part.square).reshape(square.shape)
        right += np.frombuffer(part.rhs)
    weights = np.linalg.solve(square + RIDGE * np.sqrt(n) * np.eye(FEATURES + 1), right)
    model = QualityClassifier(mean, scale, weights, np.zeros(1), np.full(1, 0.5))
    kept = rows.where("late").select("statistics", "y").toArrow()  # ``labelled`` / CALIBRATED rows
    raw = model.raw(_matrix(kept.column("statistics").combine_chunks()))
    return QualityClassifier(mean, scale, weights, *isotonic(raw, kept.column("y").to_numpy()))


def _classed(model: QualityClassifier, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column("statistics")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[*carry, "score", "predicted"])

    return run


def classify_quality(docs: DataFrame, labels: DataFrame, learn_from: Column, label: str = "quality") -> DataFrame:
    """``doc_id, learned_from, score, predicted`` for each row of ``docs`` (doc_id, text): score is between 0 and 1, the higher the likelier
    the label is 1; predicted is 1 from 0.5 on.

    Only labels of ids that ``learn_from`` (a condition on doc_id; null is false) picks are learned from, and only the text is measured.
    Repeated rows get equal scores, a null id a score too. Null and empty texts count as texts without words. Other columns are ignored.
    """
    picked = F.coalesce(learn_from, F.lit(False))
    measured = written(measure(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"]), "statistics")
    model = fit_classifier(measured, labels.where(picked), label)
    scored = measured.mapInArrow(_classed(model, ["doc_id"]), "doc_id long, score double, predicted int")
    return scored.select("doc_id", picked.alias("learned_from"), "score", "predicted")
