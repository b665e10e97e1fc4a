"""The pipeline's stages against brute force, each on what its predecessor kept."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

import corpus_pipeline
from tickloom.llm import mixing
from tickloom.llm.queries import WEIGHTS, tokenizer_path
from tickloom.llm.storage import written

WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality_kept boolean, mix_slot int, component_id string"


def corpus():
    rng = random.Random(21)
    words = ["w%d" % i for i in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(30, 120))) for _ in range(150)]
    texts += texts[:20] + [t + " tail" for t in texts[20:40]]
    fresh = lambda: " ".join(rng.choice(words) for _ in range(50))
    texts += [f'{fresh()} password = "aB3dE5gH{k}" {fresh()}' for k in range(10)] + [f"{fresh()} {'0f1e2d3c' * 5} {fresh()}" for _ in range(10)]
    texts += [None, "", " \n", "too short", "spam spam spam spam spam " * 30, texts[70] + " é漢字" * 3, " ".join(rng.choice(words) for _ in range(6000))]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", None if i % 11 == 0 else "hot" if i % 3 else "cold", None if t is None else len(t), False, 1, "clash") for i, t in corpus()]
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 150, 3)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def states(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), name.replace(" ", "-"))
        out.append(docs)
    return [{r.doc_id: r for r in d.collect()} for d in out]


def test_columns_and_no_repeats(states):
    for before, after in zip(states[1:5], states[2:5]):
        assert set(after) <= set(before)
    assert all(list(next(iter(s.values())).asDict()) == corpus_pipeline.COLUMNS for s in states[1:5])


def test_quality_rules_reject_what_the_base_rules_reject_and_keep_clean_documents(states):
    kept = states[1]
    for i, t in corpus():
        w = re.findall(WORD, t or "")
        fives = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        again = {k for k, f in enumerate(fives) if fives.count(f) > 1} if len(w) < 1000 else set()
        covered = {k + j for k in again for j in range(5)}
        if len(w) < 10 or 100 * len(covered) > 20 * len(w):
            assert i not in kept
        elif i < 150:
            assert kept[i].text == t


def test_quality_rules_learn_from_every_trusted_document(spark, tmp_path):
    """Of 51,000 trusted documents the 300 with the largest hash of their id are on a subject of their own, as is an unlabelled one."""
    n = 51_000
    ids = spark.range(n).withColumn("rank", F.row_number().over(Window.orderBy(F.xxhash64("id"), "id")))
    text = lambda word: F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda k: F.concat(F.lit(word), k.cast("string"))), " ")
    docs = ids.select(F.col("id").alias("doc_id"), F.when(F.col("rank") > n - 300, text("rare")).otherwise(text("usual")).alias("text"))
    junk = spark.range(n, n + 2000).select("id", text("junk")).union(spark.range(n + 2000, n + 2001).select("id", text("rare")))
    whole = docs.union(junk).select("*", F.lit("en").alias("lang"), F.lit("hot").alias("source"), F.length("text").cast("long").alias("n_chars"))
    spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality_rules(spark, whole, str(tmp_path)).groupBy(F.substring("text", 1, 4)).count().collect()
    assert {tuple(r) for r in kept} == {("usua", n - 300), ("rare", 301)}


def test_near_dedup_keeps_one_of_each_group(states):
    before, after = states[1], states[2]
    sets = {}
    for i, r in before.items():
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    assert set(after) == {i for i in sets if root(i) == i} and len(after) < len(before)


def test_secrets_are_masked_and_nothing_else_changes(states):
    before, after = states[2], states[3]
    secret = re.compile(r"""(?ia:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}|[0-9a-f]{32,}""")
    assert set(before) == set(after) and sum(after[i].text != r.text for i, r in before.items()) == 20
    for i, r in before.items():
        assert after[i].text == secret.sub("[secret]", r.text) and after[i].n_chars == len(after[i].text)


def test_mixture_is_the_same_rows(states):
    assert states[4] == states[3]


def test_token_ids_equal_the_library(states, spark, folder):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    for i, r in states[5].items():
        want = sp.encode(states[4][i].text, add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(want).encode()).hexdigest()
    assert {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()} == states[5] and set(states[5]) == set(states[4])


def test_positions_are_the_mixture_over_several_files(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(corpus_pipeline.COLUMNS)
    want = {r.doc_id: r.mix_position for r in mixing.mix_sources(docs, WEIGHTS).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = written(corpus_pipeline.source_mixture(spark, docs, folder), "several")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(mixed.inputFiles()) > 1
    got = {r.doc_id: r.position for r in corpus_pipeline.token_ids(spark, mixed, folder).collect()}
    assert got == want and sorted(got.values()) == list(range(len(want)))


def test_stages_take_null_and_repeated_ids_and_empty_tables(spark, folder):
    """Rows that repeat an id share its fate; rows without one stay through near-dedup; no stage needs a row."""
    long = " ".join("v%d" % i for i in range(40))
    rows = [(None, long, "en", "a", 5), (None, long, "en", None, 5), (7, long, "en", "a", 5), (7, long, "en", "a", 5), (7, long + " end", "en", "a", 5), (8, long, "en", "a", 5), (9, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for begin, want in ((docs, [None, None, 7, 7, 7]), (docs.where("false"), [])):
        state = begin
        for name, stage in corpus_pipeline.STAGES:
            state = written(stage(spark, state, folder), name.replace(" ", "-"))
        got = state.collect()
        assert sorted((r.doc_id for r in got), key=lambda i: i or 0) == want and sorted(r.position for r in got) == list(range(len(want)))


def test_token_ids_take_one_python_process_a_task(spark, tmp_path):
    texts = ["", None, "one two", "\u2581 \u00e9t\u00e9  \n", "word " * 400]
    path = corpus_pipeline.tokenizer_path()
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    got = corpus_pipeline.token_ids(spark, docs, "")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    both = corpus_pipeline.pieces.decode(corpus_pipeline.pieces.encode(docs, path), path).select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256))
    assert sorted(map(tuple, got.drop("position").collect())) == sorted(map(tuple, both.collect())) and got.count() == len(texts)
