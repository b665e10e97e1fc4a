"""Hard negatives, lexical search and the quality classifier against brute force."""

import math
import os
import random
import re
import string
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import classifier, lexical, negatives

SF = "/root/testdata/sf0.01"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def brute_negatives(rows, anchors, negative=10, positive=5):
    whole = {i: (label, [math.floor(256 * v) for v in x]) for i, label, x in rows}
    out = []
    for a in sorted(i for i in whole if anchors(i)):
        label, x = whole[a]
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, other) for i, (other, y) in whole.items() if i != a and len(y) == len(x))
        for s, p, _ in [r for r in scored if r[2] == label][:positive]:
            near = [(i, -t) for t, i, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s][:negative]
            out += [(a, p, k, i, -s, t) for k, (i, t) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize(("block_rows", "block_anchors", "scale"), [(10, 3, 1.0), (10_000, 10_000, 1.0), (40, 2, 2e6)])
def test_hard_negatives(spark, block_rows, block_anchors, scale):
    """Blocks of both sides, ties, a label of a third of all rows, scores beyond doubles, rows that take no part."""
    rng = np.random.default_rng(3)
    good = [(i, int(rng.choice([0, 0, 1, 2])), [float(v) for v in rng.integers(-3, 6, 4) / 4 * scale]) for i in range(150)]
    bad = [(500, None, [1.0] * 4), (510, 1, None), (520, 1, [1.0, None, 0.0, 0.0]), (530, 1, [1.0, float("nan"), 0.0, 0.0]), (540, 1, [float("inf")] * 4), (None, 1, [1.0] * 4), good[3], (10, 9, [9.0] * 4), (610, 1, []), (620, 2, []), (630, 1, []), (640, 1, [1.0, 2.0]), (650, 2, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "clash") for r in good + bad], "vec_id long, label int, vector array<double>, rank string").repartition(5)
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, block_rows=block_rows, block_anchors=block_anchors).collect()
    want = brute_negatives(good + [(610, 1, []), (620, 2, []), (630, 1, []), (640, 1, [1.0, 2.0]), (650, 2, [1.0, 1.0])], lambda i: i % 10 == 0)
    assert sorted(tuple(r) for r in got) == want and len(want) > 400
    assert negatives.hard_negatives(df.where("false"), F.lit(True)).count() == 0


def test_scores_beyond_64_bits_are_the_nearest_that_fit():
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**40, 3.0], [-(2.0**40), 3.0], [5.0, 7.0]])
    assert negatives.products(a, b).tolist() == [[(1 << 63) - 1, 1 - (1 << 63), 5 * 2**40 + 7]]
    assert negatives.integers(np.array([[-0.001, 1e300]]), 256).tolist() == [[-1, int(1e300) * 256]]


def brute_search(docs, items, k=50):
    fold = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    terms = lambda t: re.findall(TERM, (t or "").translate(fold))
    held = [(d, Counter(terms(t))) for d, t in docs]
    n, total = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = set()
    for item, text in set(items):
        scored = []
        for d, c in held:
            m = 50 + 50 * sum(c.values()) * n // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            scored.append((-s, d is None, d or 0, d)) if s > 0 else None
        out |= {(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("block", [lexical.BLOCK, 2])
def test_ranked_search(spark, monkeypatch, block):
    """Small and large blocks and shards, common and rare terms, equal documents, null and empty and long texts, letters of many
    alphabets, repeated and null items."""
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "GATHERED", 3 * block)
    rng = random.Random(4)
    words = [*(f"w{i}" for i in range(40)), "Ärger", "ÄRGER", "漢字", "x1y2", "été"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 30])))) for i in range(300)]
    docs += [(1000, docs[7][1]), (7, docs[7][1]), (None, docs[7][1]), (1001, None), (1002, ""), (1003, "--\x00 \n"), (1004, "w1 w2 " * 50_000), (-5, "W1-w1_W1")]
    items = [(1, "w1 W1 w2, w3"), (2, "Ärger 漢字"), (3, "ÄRGER"), (4, "no such thing"), (5, None), (6, ""), (1, "w1 W1 w2, w3"), (None, "x1y2"), (7, docs[7][1]), (7, "été")]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, score int").repartition(4)
    got = lexical.ranked_search(d, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {tuple(r) for r in got} == brute_search(docs, items)
    assert lexical.ranked_search(d.where("false"), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert lexical.ranked_search(d, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_search_by_parties_and_salts(spark, monkeypatch):
    """Items in several parties, postings of a term joined by several tasks."""
    monkeypatch.setattr(lexical, "JOINED_SHARDS", 2)
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choices([f"w{i}" for i in range(30)], k=12))) for i in range(200)]
    items = [(i, docs[i][1] + " w1") for i in range(40)]
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))
    got = lexical.search_index(index, spark.createDataFrame(items, "item_id long, text string"), 7, party_terms=60)
    assert {tuple(r) for r in got.collect()} == brute_search(docs, items, 7)


def test_a_shard_is_made_in_little_memory():
    """16 MB of texts, of frequent and rare words: numpy's memory at its highest, beside the texts."""
    rng = np.random.default_rng(2)
    words = np.array([f"word{i}" for i in range(60_000)])
    texts = [" ".join(words[(60_000 * rng.random(300) ** 4).astype(int)]) for _ in range(6_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6_000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    shard = lexical._Shard()
    for part in lexical.slices(batch, "text"):
        shard.add(part)
    n = sum(sum(b.column("n").to_pylist()) for b in shard.rows(0) if b.column("term")[0].as_py())
    highest = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == sum(len(set(t.split())) for t in texts)
    assert shard.bytes > 14 << 20 and highest < 220 << 20, highest


def test_packed_integers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**62])
    data, offsets = lexical.packed(values)
    assert lexical.unpacked(data).tolist() == values.tolist() and np.diff(offsets).tolist() == [1, 1, 1, 2, 2, 3, 5, 9]
    assert lexical.unpacked(lexical.packed(values[:0])[0]).tolist() == []


def test_isotonic_calibration():
    x, y = np.array([1.0, 2, 3, 4, 5, 6, 6]), np.array([0.0, 1, 0, 1, 1, 0, 1])
    steps, levels = classifier.isotonic(x, y)
    assert (np.diff(levels) > 0).all() and levels.tolist() == [0, 0.5, 0.75] and steps.tolist() == [1, 2.5, 5.25]


def test_statistics_of_odd_texts():
    texts = pa.array([None, "", " ", "\x00\x01", "é漢\U0001f600", "a" * 300_000, "Ab b b\nAb b b", "A B C !!"])
    found = classifier.statistics(texts)
    assert found.shape == (8, classifier.DIM) and np.isfinite(found).all() and not found[:2].any()
    alone = np.concatenate([classifier.statistics(texts[i : i + 1]) for i in range(8)])
    assert np.allclose(found, alone)
    at = {name: found[:, i] for i, name in enumerate(classifier.STATISTICS)}
    assert at["as_before"][6] == pytest.approx((2 / 6) ** 0.5) and at["repeated_lines"][6] == pytest.approx(0.5**0.5) and at["bare_words"][7] == 0.5 and at["beyond_ascii"][4] == 1


def test_normal_equations_of_partitions_are_those_of_all_rows(spark):
    rng = np.random.default_rng(1)
    x, y = rng.standard_normal((400, classifier.DIM)), rng.integers(0, 2, 400)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "doc_id long, statistics array<double>").repartition(7)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, quality int")
    model = classifier.fit_classifier(df, labels)
    late = {r.doc_id for r in labels.where(F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(classifier.CALIBRATED)) == 0).collect()}
    fit = [i for i in range(400) if i not in late]
    z = classifier.fourier(x[fit], x.mean(axis=0), x.std(axis=0))
    want = np.linalg.solve(z.T @ z + classifier.RIDGE * math.sqrt(len(fit)) * np.eye(z.shape[1]), z.T @ y[fit])
    assert np.allclose(model.weights, want, atol=1e-6) and 60 < len(late) < 140


def test_cosines_approximate_a_gaussian_kernel():
    x = np.random.default_rng(2).standard_normal((50, classifier.DIM))
    z = classifier.fourier(x, np.zeros(classifier.DIM), np.ones(classifier.DIM))[:, :-1]
    gap = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-gap / (2 * classifier.DIM))).max() < 0.25


def test_classifier_without_labels_and_with_one_class(spark):
    docs = spark.createDataFrame([(1, "some words here", 5), (2, None, 5), (None, "", 5), (1, "some words here", 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (9, 0)], "doc_id long, quality int")
    none = classifier.classify_quality(docs, labels.where("false"), F.lit(True)).collect()
    assert [r.score for r in none] == pytest.approx([0.5 * (1 - classifier.FINE) + classifier.FINE / (1 + math.exp(2))] * 4) and not any(r.predicted for r in none)
    one = classifier.classify_quality(docs, labels, F.col("doc_id") < 5).collect()
    assert len(one) == 4 and all(0 <= r.score <= 1 for r in one) and all(r.predicted == 1 for r in one if r.doc_id == 1)
    assert {r.doc_id: r.learned_from for r in one} == {1: True, 2: True, None: False}
    assert classifier.classify_quality(docs.where("false"), labels, F.lit(True)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_classifier_on_labels_that_it_has_not_seen(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    got = classifier.classify_quality(docs, labels, learn).where("not learned_from").join(labels, "doc_id").toPandas()
    rank = got.score.rank()
    good = got.quality == 1
    area = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert len(got) > 80 and area > 0.99 and (got.predicted == got.quality).mean() > 0.97
    # labels that the model must not see do not change it
    other = labels.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    again = classifier.classify_quality(docs, other, learn).where("not learned_from").toPandas().set_index("doc_id").score
    assert np.allclose(again[got.doc_id].to_numpy(), got.score.to_numpy(), atol=1e-9)
