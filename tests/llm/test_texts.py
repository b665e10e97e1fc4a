"""Text operators against brute force, with nulls, empty and long texts, ties, repeats, clashing columns and empty tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import components, neardup, pieces, quality, sharding, substring_dedup
from tickloom.llm.queries import tokenizer_path

WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, source string, kept string, n_words long"


def corpus():
    rng = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 8, 25, 60]))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts += [f"{t}\n{passage} {rng.choice(words)}" for t in texts[:10]] + texts[:5]
    base = [rng.choice(words) for _ in range(80)]
    for k in range(12):
        copy = list(base)
        copy[5 * k % 80] = "changed%d" % k
        texts.append(" ".join(copy))
    texts += [None, "", " \t\n", "Aé b\x0bc " * 30, "漢字 " * 25, "x" * 5000, "a b " * 3000, passage.upper()]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "s", "clash", -1) for i, t in corpus()], DOCS).repartition(5).cache()


@pytest.mark.parametrize("hot_bytes", [substring_dedup.HOT_BYTES, 300, 0])
def test_substring_dedup(docs, hot_bytes):
    """Also with hot minimisers, whose windows are dealt one by one: some, and all."""
    assert (len(substring_dedup.hot_minimisers(docs, 1, hot_bytes)) > 0) == (hot_bytes < 1000)
    got = {r.doc_id: r for r in substring_dedup.drop_repeated_passages(docs, hot_bytes).collect()}
    seen = set()
    for i, t in corpus():
        w = re.findall(WORD, t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))


def test_repeated_rows_are_one_document(spark):
    text = " ".join("r%d" % i for i in range(30))
    rows = [(4, text), (4, text), (None, text + " x"), (None, text + " x"), (5, text + " end")]
    got = substring_dedup.drop_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id or 99, r.n_words, r.n_removed) for r in got) == [(4, 30, 0), (4, 30, 0), (5, 31, 30), (99, 31, 30), (99, 31, 30)]


def test_hash_collisions_are_settled_on_words(monkeypatch):
    real = substring_dedup.window_hashes
    monkeypatch.setattr(substring_dedup, "window_hashes", lambda h, n: real(h, n) & np.uint64(1))
    a = [" ".join("%s%d" % (c, i) for i in range(25)) + " " for c in "aba"]
    flags = substring_dedup.repeated_windows("".join(a).encode(), np.array([len(x) for x in a]))
    assert flags.tolist() == [False] * 50 + [True] * 6 + [False] * 19


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates(docs, shingle):
    got = {r.doc_id: r for r in neardup.near_duplicates(docs, shingle, 80).collect()}
    sets = {}
    for i, t in corpus():
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set())
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def test_null_ids_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, "a b c d e f", None, None, None), (1, "a b c d e f", None, None, None), (1, "a b c d e f", None, None, None)], DOCS)
    assert sorted((r.doc_id is None, r.kept) for r in neardup.near_duplicates(rows).collect()) == [(False, True), (False, True), (True, True)]
    assert substring_dedup.drop_repeated_passages(rows).count() == 3
    none = rows.where("false")
    assert substring_dedup.drop_repeated_passages(none).count() == 0 and neardup.near_duplicates(none).count() == 0
    assert sharding.shard_by_vector_packing(none).count() == 0 and sharding.shard_by_vector_packing(rows).count() == 3
    assert pieces.encode(none, tokenizer_path()).count() == 0


def test_sentencepiece_equals_library(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    for r in pieces.decode(pieces.encode(docs, tokenizer_path()), tokenizer_path()).collect():
        text = corpus()[r.doc_id][1] or ""
        want = sp.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.decoded == sp.decode(want)


def test_long_words_equal_the_library():
    """Words without a space of up to 100,000 characters: prose, random letters, base64, runs, other scripts, unknown characters."""
    import sentencepiece

    rng = random.Random(8)
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    model = pieces.load(tokenizer_path())
    prose = "thequickbrownfoxisreadingtheinternationalnewspaperwithoutspacesinterestinglyenough"
    alphabets = ["ab", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "éèüßñ漢字仮名交\n\t", "the", "a\U0001f600\u0301x"]
    words = ["".join(rng.choice(a) for _ in range(n)) for a in alphabets for n in (1, 30, 45, 300, 3000)]
    words += ["a" * 5000, "abracadabra" * 400, "=-" * 700, prose * 30, "".join(rng.sample(prose * 40, 2000))]
    words += ["".join(rng.choice(alphabets[2]) for _ in range(100_000))]
    for word, got in zip(words, model.encode_words([b" " + w.encode() for w in words]), strict=True):
        assert got.tolist() == sp.encode(word)


def test_quality_counts_and_held_out_accuracy(spark):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["the", "of", "and", "in", "river", "stone", "light", "path"]) + str(rng.randrange(40)) for _ in range(60))
    bad = lambda: " | ".join(rng.choice(["BUY!!", "WIN!!", "$$$"]) + str(rng.randrange(40)) for _ in range(40))
    rows = [(i, good() if i % 4 else bad()) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    verdicts = {r.doc_id: r for r in quality.judge_quality(docs, quality.fit_quality(docs, labels)).collect()}
    held_out = [verdicts[i].quality_kept == bool(i % 4) for i in range(200, 400) if not verdicts[i].quality_base_failed]
    assert sum(held_out) / len(held_out) > 0.97
    nobody = quality.fit_quality(docs, labels.where("false"))
    assert all(r.quality_kept != r.quality_base_failed for r in quality.judge_quality(docs, nobody).collect())
    odd = spark.createDataFrame([(1, None, 5), (2, "a b c d e a b c d e\n\na b\na b", 6)], "doc_id long, text string, kept int")
    got = {r.doc_id: r for r in quality.judge_quality(odd, nobody).collect()}
    assert (got[1].quality_n_words, got[1].quality_base_failed, got[1].kept) == (0, True, 5)
    assert (got[2].quality_n_dup_lines, got[2].quality_n_repeat_words, got[2].quality_word_chars) == (1, 12, 14)


def test_quality_model_counts_every_trusted_document(spark):
    """52,000 trusted documents, toxic, unlabelled and failing ones and one with two rows: the ratios and the threshold by their definitions."""
    n = 55_000
    rng = random.Random(11)
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(11 if i % 50 else 4)) for i in range(n)]
    docs = pd.DataFrame({"doc_id": [*range(n - 1), 0], "text": texts})
    labels = pd.DataFrame({"doc_id": range(n - 2000), "quality": 1, "toxic": [int(i % 53 == 1) for i in range(n - 2000)]})
    model = quality.fit_quality(spark.createDataFrame(docs), spark.createDataFrame(labels))
    grams = [np.sort(quality._grams(quality.words_of(pa.array([t])))[0]) for t in texts]
    good = [k for k, i in enumerate(docs.doc_id) if i < n - 2000 and i % 53 != 1]
    assert len(good) > 51_000
    raw = np.bincount(np.concatenate(grams), minlength=quality.BUCKETS) + 0.5
    target = np.bincount(np.concatenate([grams[k] for k in good]), minlength=quality.BUCKETS)
    share = raw / raw.sum()
    assert np.allclose(model.ratio, np.log((target / target.sum() + 0.5 * share) / (1.5 * share)), atol=1e-12)
    halves = [r[0] for r in spark.createDataFrame(docs).select(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2))).collect()]
    other = []
    for h in (1, 0):
        t = np.bincount(np.concatenate([grams[k] for k in good if halves[k] == h]), minlength=quality.BUCKETS)
        other.append(np.log((t / t.sum() + 0.5 * share) / (1.5 * share)))
    scores = [other[halves[k]][grams[k]].mean() for k in good if len(texts[k].split()) >= 10]
    assert abs(model.threshold - (np.quantile(scores, 0.001) - 0.02)) < 1e-9
    alone = quality.fit_quality(spark.createDataFrame(docs), spark.createDataFrame(labels.iloc[2:3]))
    assert alone.threshold == -math.inf and alone.ratio.any()


def test_sharding_is_balanced_whole_and_splits_hot_groups(spark):
    rows = [(i, "copy " * 20) for i in range(700)] + [(i, "text%d " % i * (1 + i % 40)) for i in range(700, 2100)]
    got = sharding.shard_by_vector_packing(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(got) == 2100 and len(size) == 24 and size.max() / size.min() < 1.1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert got[got.doc_id < 700].shard.nunique() > 4


def test_quality_counts_equal_their_definitions(spark):
    rng = random.Random(17)
    parts = ["aa", "b", "é", "漢字", "#", "<|", "%$", " ", " ", "\n", "\n", "\t", "\x0b", "aa b aa b aa b", "same line\n", "\r\n"]
    texts = [" ".join(rng.choice(["x", "y", "zé#"]) for _ in range(rng.randrange(0, 40))) if i % 2 else "".join(rng.choice(parts) for _ in range(rng.randrange(0, 60))) for i in range(400)] + [None, "", "same line " * 4000]
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in enumerate(texts)], "doc_id long, text string, quality_kept int, kept string").repartition(3)
    got = {r.doc_id: r for r in quality.judge_quality(df, quality.QualityModel(np.zeros(quality.BUCKETS), -1.0)).collect()}
    for i, t in enumerate(texts):
        w, lines, seen, dup = re.findall(WORD, t or ""), (t or "").split("\n"), set(), 0
        for line in lines:
            if re.search(WORD, line):
                dup += line in seen
                seen.add(line)
        fives, covered = {}, set()
        for k in range(len(w) - 4):
            fives.setdefault(tuple(w[k : k + 5]), []).append(k)
        for places in fives.values():
            if len(places) > 1:
                covered.update(k + j for k in places for j in range(5))
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        assert got[i][3:] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered), failed, not failed, 0.0), t


def test_items_go_where_the_dot_product_is_highest():
    rng = np.random.default_rng(4)
    items, capacity = rng.random((200, 3)) ** 3, np.ones((5, 3)) * 10
    left, want = capacity.tolist(), {}
    for i in sorted(range(200), key=lambda i: -max(items[i])):
        dots = [sum(a * b for a, b in zip(left[k], items[i].tolist())) for k in range(5)]
        want[i] = dots.index(max(dots))
        left[want[i]] = [a - b for a, b in zip(left[want[i]], items[i].tolist())]
    assert sharding.place(items, capacity).tolist() == [want[i] for i in range(200)]


def test_sharding_columns_and_slots(spark, docs, monkeypatch):
    """Many small batches; sizes, checksums and slots by their definitions; equal texts stay together."""
    monkeypatch.setattr(sharding, "BATCH_ITEMS", 5)
    monkeypatch.setattr(sharding, "HEAVY", 0.02)
    got = sharding.shard_by_vector_packing(docs, shards=3).collect()
    text = dict(corpus())
    assert sorted(r.doc_id for r in got) == sorted(text)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.tokens) == (len(raw) + 8, zlib.crc32(raw), len(re.findall(WORD, text[r.doc_id] or "")))
    for k in range(3):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    homes = {}
    for r in got:
        homes.setdefault(text[r.doc_id] or "", set()).add(r.shard)
    assert all(len(h) == 1 for t, h in homes.items() if t)  # the empty texts are a hot group here


def test_masked_digest(spark):
    from tickloom.llm import spans

    df = spark.createDataFrame([("ab cd ef",)], "t string").withColumn("s", spans.spans(F.col("t"), "[ce].", 0, lambda v: F.lit(True), F.lit(True)))
    assert df.select(spans.masked(F.col("t"), F.col("s"), "*")).first()[0] == "ab * *"
    assert df.select(spans.joined(F.col("s"), ["k"])).first()[0] == "k:3:5,k:6:8" and hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_rows_that_share_an_id_with_different_texts_are_one_document(spark):
    a, b = (" ".join("%s%d" % (c, i) for i in range(60)) for c in "ab")
    rows = [(3, a), (7, a + " x"), (7, b), (9, b + " y"), (11, None), (11, "z " * 9)]
    for order in (rows, rows[::-1]):
        got = neardup.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(3), 4, 80).collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (7, 3), (7, 3), (9, 3), (11, 11), (11, 11)]


def test_links_that_stars_miss_are_found_on_prefixes(spark, monkeypatch):
    """With one key for all documents of a template, a bucket holds many components; all links must be found."""
    monkeypatch.setattr(neardup, "_sign", one_key(neardup._sign))
    rng = random.Random(6)
    base = ["t%d" % i for i in range(120)]
    texts = []
    for k in range(40):
        own = ["o%d_%d" % (k, i) for i in range(rng.choice([3, 20, 60]))]
        texts += [" ".join(base + own), " ".join(base + own + ["more%d" % k])]
    rng.shuffle(texts)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), 4, 80).collect()}
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, w in enumerate(t.split() for t in texts)}
    assert got == by_links(sets) and 1 < len(set(got.values())) < 80


def one_key(real):
    """Signs sets as usual but gives all of them equal hashes."""

    def sign(n):
        def run(batches):
            for batch in real(n)(batches):
                at = batch.schema.get_field_index("halves")
                yield batch.set_column(at, "halves", pa.array([[1] * 2 * neardup.SIDE] * batch.num_rows, pa.list_(pa.int64())))

        return run

    return sign


def by_links(sets, percent=80):
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    return {i: root(i) for i in sets}


def test_heavy_keys_are_joined_like_any(spark, monkeypatch):
    monkeypatch.setattr(components, "LIGHT", 3)
    rows = spark.createDataFrame([(k % 7 if k % 3 else 0, k) for k in range(60)] + [(None, 60)], "c long, id long")
    keyed = rows.where("c is not null and c <> 5").groupBy("c").count().selectExpr("c", "c * 10 as into", "count as sets")
    expected = sorted(map(tuple, rows.join(keyed.drop("sets"), "c").collect()))
    assert sorted(map(tuple, components.joined_by(rows, keyed, "c", "sets", 61).collect())) == expected and len(expected) > 40
