"""Work that must not grow with the square of anything: templates, repeated rows, texts full of hits."""

import random
import time

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import mixing, neardup, substring_dedup
from tickloom.llm.spans import masked


def templated(n, seed=1):
    """Documents of 100 words, 13 of them their own, in one place so that most shingles are the template's; every 50th has a near copy."""
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(100)]
    out = []
    for i in range(n):
        own = [f"d{i}x{k}" for k in range(13)]
        at = rng.randrange(0, 87)
        words = base[:at] + own + base[at + 13 :]
        out.append((i, " ".join(words)))
        if i % 50 == 0:
            out.append((n + i, " ".join([*words[:-1], f"other{i}"])))
    return out


def test_pairs_of_templated_documents_follow_the_documents(spark, monkeypatch):
    kept, counts = neardup.written, []

    def watched(df, name):
        out = kept(df, name)
        if name == "met":
            sizes = out.groupBy("token").agg(F.count_if("short").alias("s"), F.count(F.lit(1)).alias("n"))
            counts.append(sizes.agg(F.coalesce(F.sum(F.col("s") * F.col("n")), F.lit(0))).first()[0])
        return out

    monkeypatch.setattr(neardup, "written", watched)
    for n in (300, 1200):
        got = neardup.near_duplicates(spark.createDataFrame(templated(n), "doc_id long, text string").repartition(4)).collect()
        of = {r.doc_id: r.component_id for r in got}
        assert all(of[n + i] == of[i] for i in range(0, n, 50)) and len(set(of.values())) == n
    print("pairs", counts)
    assert counts[1] <= 5 * max(counts[0], 1_000)


def test_rows_repeated_many_times_are_packed_once(spark):
    """20,000 rows of one document, and as many without an id."""
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(400)}" for _ in range(300))
    rows = [(7, text)] * 20_000 + [(None, text)] * 20_000 + [(9, text)]
    df = spark.createDataFrame(pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows]}).to_pandas().astype({"doc_id": "Int64"}).astype(object).where(lambda x: x.notna(), None), "doc_id long, text string").repartition(4)
    keyed = df.select(F.coalesce("doc_id", F.lit(int(substring_dedup._NO_ID))).cast("long").alias("doc"), F.xxhash64("text").alias("version"), "text")
    packed = keyed.mapInArrow(substring_dedup._pack(4, substring_dedup.np.zeros(0, substring_dedup.np.uint64)), substring_dedup._SENT)
    assert packed.agg(F.sum(F.length("packed"))).first()[0] < 100_000
    got = substring_dedup.drop_repeated_passages(df).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert {(r.doc_id, r.n_words, r.n_removed): r["count"] for r in got} == {(7, 300, 0): 20_000, (9, 300, 300): 1, (None, 300, 300): 20_000}


@pytest.mark.parametrize("hits", [0, 1, 255, 256, 257, 700])
def test_masking_in_groups(spark, hits):
    """Overlapping, nested, touching and equal spans, characters beyond ASCII."""
    rng = random.Random(hits)
    text = "".join(rng.choice("aé漢\U0001f600 ") for _ in range(3000))
    found = [(a, a + rng.randrange(1, 9)) for a in (rng.randrange(0, 2900) for _ in range(hits))]
    df = spark.createDataFrame([(text, found)], "text string, found array<struct<start:int,end:int>>")
    covered = [any(a <= i < b for a, b in found) for i in range(len(text))]
    want, i = "", 0
    for a, b in sorted(found):
        if a >= i:
            want += text[i:a] + "#"
        i = max(i, b)
    got = df.select(masked(F.col("text"), F.col("found"), "#")).first()[0]
    assert got == want + text[i:] and sum(covered) == len(text) - len(got.replace("#", ""))


def test_masking_takes_time_by_the_text(spark):
    hits = 40_000
    rows = spark.createDataFrame([(0,)], "i int").select(F.expr(f"repeat('{'x' * 90} secret99 ', {hits})").alias("text"), F.expr(f"transform(sequence(0, {hits - 1}), i -> named_struct('start', i * 100 + 91, 'end', i * 100 + 99))").alias("found"))
    began = time.time()
    size, left = rows.select(F.length(masked(F.col("text"), F.col("found"), "#")), F.length("text")).first()
    assert left - size == hits * 7 and time.time() - began < 60


def test_stretches_of_a_schedule_are_the_schedule():
    """Also where sources end early, and where one goes on alone for long."""
    rng = random.Random(8)
    for _ in range(60):
        keys = [f"s{i}" for i in range(rng.randrange(1, 6))]
        parts = {s: rng.choice([1, 2, 3, 5, 10, 40]) for s in keys}
        blocks = {s: rng.choice([1, 7, 60, 200]) for s in keys}
        n = {s: 10 * b - rng.randrange(0, 10) for s, b in blocks.items()}
        length = mixing.period(parts)
        many = max(-(-b * sum(parts.values()) // (parts[s] * length)) for s, b in blocks.items())
        whole = list(mixing.pfair(blocks, parts))
        assert whole == [x for k in range(many) for x in mixing.pfair(blocks, parts, k * length, (k + 1) * length)]
        made = pd.concat(list(mixing._schedule(blocks, parts, n, 10)(iter([pd.DataFrame({"id": range(many)})]))))
        sizes = [min(10, n[s] - 10 * j) for s, j, *_ in whole]
        assert made.slot.tolist() == list(range(len(whole))) and made.begins.tolist() == [sum(sizes[:i]) for i in range(len(whole))] and list(zip(made.source_key, made.block, strict=True)) == [x[:2] for x in whole]
