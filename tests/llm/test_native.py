"""Native operators, mixing and search."""

import math
import random
import re
import string
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import ann, chat, mixing, pii, secrets, spans

DOCS = "doc_id long, text string, spans string, base long"


def found(df, names):
    return {r.doc_id: (r.b, r.s) for r in df.select("doc_id", spans.joined(F.col("base"), names).alias("b"), spans.joined(F.col("spans"), names).alias("s")).collect()}


def test_personal_data(spark):
    texts = {1: "x a@b.co y +1 (743) 555-3824 z 10.0.0.256 10.0.0.255", 2: None, 3: "", 4: "4111 1111 1111 1111; 4111111111111112", 5: "1" * 3000, 6: "a@" + "b." * 3000, 7: "clean text, 12 of 34"}
    texts |= {100 + i: f"mail: user{i}@host{i}.com, phone +1 (212) 555-{1000 + i}" for i in range(60)}
    texts |= {200 + i: f"call 212-555-{1000 + i}. or mail bob{i} [at] host [dot] com" for i in range(3)}
    got = found(pii.find_personal_data(spark.createDataFrame([(k, t, "clash", 0) for k, t in texts.items()], DOCS)), pii.KINDS)
    assert got[1][0] == "email:2:8,phone:11:28,ip:42:52" and got[2] == got[3] == got[7] == ("", "") and got[4][0] == "card:0:19" and got[5][0] == ""
    assert all(set(b.split(",")) <= set(s.split(",")) | {""} for b, s in got.values())
    assert "phone:5:17" in got[200][1]
    assert pii.find_personal_data(spark.createDataFrame([], DOCS)).count() == 0


def labelled_spans(n, seed):
    """Texts with one candidate each that the base patterns leave, and whether it is personal."""
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choices(string.digits, k=k))

    def card():
        while True:
            d = "4" + num(15)
            if sum(sum(divmod(int(c) * (1 + (i % 2 == 0)), 10)) for i, c in enumerate(d)) % 10:
                return d

    date = lambda lo, hi: f"{rng.randrange(1, 29):02d}.{rng.randrange(1, 13):02d}.{rng.randrange(lo, hi)}"
    good = [lambda: (f"call {rng.randrange(201, 990)}-555-{num(4)}, please", 3), lambda: (f"his card {card()} was used", 2), lambda: (f"her SSN {rng.randrange(101, 660)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}.", 4), lambda: (f"mail bob{num(2)} [at] host{num(1)} [dot] com now", 0), lambda: (f"signed by Mr. John Abel{rng.choice('abcdef')}, sales", 5), lambda: (f"he was born on {date(1940, 2005)}, far away", 7), lambda: (f"she lives at {num(3)} Green Oak Street, near us", 6)]
    bad = [lambda: (f"order #{num(3)}-555-{num(4)}/x shipped", 3), lambda: (f"serial number: 20{rng.randrange(10, 24)}0{rng.randrange(1, 9)}1{rng.randrange(0, 9)}{num(9)}/a", 2), lambda: (f"part no. 000-{rng.randrange(10, 99)}-{num(4)}/b", 4), lambda: (f"updated on {date(2020, 2026)}", 7), lambda: (f"item {num(2)} Final Long Way/c", 6)]
    return [(*rng.choice(good if i % 2 else bad)(), i % 2 == 1) for i in range(n)]


def test_personal_data_on_labelled_candidates(spark):
    """Every second candidate is personal; precision and recall of the spans added."""
    rows = labelled_spans(1200, 1)
    df = spark.createDataFrame([(i, f"some words here {t} and more", "clash", 0) for i, (t, _, _) in enumerate(rows)], DOCS)
    hits = {"right": 0, "wrong": 0, "missed": 0}
    for r in pii.find_personal_data(df).collect():
        _, kind, personal = rows[r.doc_id]
        added = {s.kind for s in r.spans} - {s.kind for s in r.base}
        hits["right" if personal else "wrong"] += kind in added
        hits["missed"] += personal and kind not in added
    print(hits)
    assert hits["right"] / (hits["right"] + hits["wrong"]) >= 0.95 and hits["right"] / (hits["right"] + hits["missed"]) >= 0.9, hits


def base_by_definition(text):
    """Plain reading of the contract's patterns, for texts of ASCII and others."""
    out = []
    for kind, regex in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"), ("card", r"[0-9](?:[\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(regex, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + (i % 2)), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            if kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))) or (kind == "card" and 14 <= len(digits) <= 19 and luhn) or (kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), ("email", "ip", "card", "phone").index(kind), m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def secrets_by_definition(text):
    out = []
    for kind, regex, group in (("assign", r"""(?ia:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1), ("access", "AKIA[A-Z0-9]+", 0), ("hex", "[0-9a-f]+", 0)):
        for m in re.finditer(regex, text):
            if len(m[group]) >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), ("assign", "access", "hex").index(kind), m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_equal_their_definition_on_random_texts(spark):
    rng = random.Random(12)
    parts = ["+1 (212) 555-1234", "a@b.co", "x..y@z-1.a.b", "@", ".", "10.0.0.1", "300.1.2.3.4", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 2", "0" * 14, "é", "漢", "\U0001f600", " ", " ", "\n", "-", "+", "(", ")", "7", "99", "token", "TOKEN = ", "api_key:", "api_key'", '"', "=", ": ", "passwd=", "Secret", "AKIA", "AKIAAAAABBBBCCCC1", "deadbeef" * 4, "0f" * 15, "abcdefgh", "A-Z_9", "ſecret="]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(600)] + ["a@b.co " * 700]
    df = spark.createDataFrame([(i, t, "clash", 0) for i, t in enumerate(texts)], DOCS)
    got, scanned = found(pii.find_personal_data(df), pii.KINDS), found(secrets.find_secrets(df), secrets.KINDS)
    for i, t in enumerate(texts):
        assert got[i][0] == base_by_definition(t), t
        assert scanned[i][0] == secrets_by_definition(t), t


def test_reliabilities_rank_labelers():
    counts = {(0, 1, 1, 1, 1, 1): 80, (0, 0, -1, -1, -1, -1): 40, (0, 0, 1, 1, 1, 1): 5}
    post = pii.reliabilities(counts)
    assert post[0, 1, 1, 1, 1, 1] > 0.9 > 0.1 > post[0, 0, -1, -1, -1, -1]


def test_secrets(spark):
    token = "aB3dE5gH7jK9mN1pQ2rS4tUv"
    texts = {1: f'token = "{"0f" * 10}" and {token}', 2: None, 3: "", 4: f"example{token}", 5: "token=token:abcdefgh1", 6: "AKIAABCDEFGHIJKL AKIA12", 7: "the_long_identifier_of_a_thing_2024", 8: "aB3/" * 4000}
    df = spark.createDataFrame([(k, t, "clash", 0) for k, t in texts.items()], DOCS)
    got = found(secrets.find_secrets(df), secrets.KINDS)
    assert got[1] == ("assign:0:29", f"assign:0:29,entropy:35:{35 + len(token)}")
    assert got[2] == got[3] == got[4] == got[5] == got[7] == ("", "") and got[6][0] == "access:0:16"
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(df).collect()}
    assert clean[1] == "[secret]\" and [secret]" and clean[2] is None and clean[7] == texts[7]


def test_secrets_of_other_alphabets_in_company_and_with_slashes(spark):
    rng, lower, upper, digits = random.Random(4), string.ascii_lowercase, string.ascii_uppercase, string.digits
    key = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    token, base64 = "aB3dE5gH7jK9mN1pQ2rS4tUv", lower + upper + digits + "+/"
    secret = [key(base64, 344) for _ in range(60)] + [key(a, 40) for a in (lower + digits, upper + "234567", lower + upper, lower, upper) for _ in range(40)]
    secret += [f"sample_key={token}", f"12345678/{token}", f"/home/ann/keys/{token}", "0123456789abcdef" * 2 + "XyZ" + token]
    harmless = ["/usr/local/share/doc/packages/MyProject2/SourceFiles3", "id=550e8400-e29b-41d4-a716-446655440000", "AbstractSingletonProxyFactoryBean", "internationalization2024", "MAX_BUFFER_SIZE_1024_BYTES", "thanbleshaningtionnt", "2024-01-02/2024-03-04/17", f"/a/b/example{token}/c"]
    df = spark.createDataFrame([(i, f"see {t} there", "clash", 0) for i, t in enumerate(secret + harmless)], DOCS)
    got = found(secrets.find_secrets(df), secrets.KINDS)
    hits = [got[i][1].endswith(f"entropy:4:{4 + len(t)}") for i, t in enumerate(secret[:-1])]
    for begin, end in [(0, 60)] + [(b, b + 40) for b in range(60, 260, 40)]:
        assert sum(hits[begin:end]) >= 0.95 * (end - begin), (begin, sum(hits[begin:end]))
    assert all(hits[260:]) and got[len(secret) - 1] == ("hex:4:36", "hex:4:36,entropy:36:63")
    assert [got[len(secret) + i][1] for i in range(len(harmless))] == [""] * len(harmless)


def test_incremental_entropy(spark):
    alphabet, window, *_ = secrets.CLASSES["hex"]
    for value in ("deadbeef" * 5, "0123456789abcdef" * 2, "0" * 30, "abc"):
        want = max((-sum(c / window * math.log2(c / window) for c in Counter(value[i : i + window]).values()) for i in range(len(value) - window + 1)), default=0.0)
        assert abs(spark.range(1).select(secrets.peak_entropy(F.lit(value), alphabet, window)).first()[0] - want) < 1e-9


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 70, "ann", "bye"), (1, None, None, "?"), (2, 0, "system", "alone"), (None, 0, "cy", "x")]
    got = {(r.conv_id, r.speaker, r.chunk): r for r in chat.rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {(1, s, c) for s in ("ann", "bob") for c in (-1, 0, 1)} | {(None, "cy", 0)}
    r = got[1, "ann", 0]
    assert r.rendered == "<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user:bob|>\n<|end|>\n"
    (a, b), = [map(int, x.split(":")) for x in r["mask"].split(",")]
    assert r.rendered[a:b] == "hi<|end|>" and got[1, "bob", 1]["mask"] == ""


def test_perspectives_of_crowded_turns_long_texts_and_clashing_columns(spark):
    rows = [(1, None if i % 2 else 3, "ann" if i % 3 else "bob", "t%03d" % (i // 4), "clash") for i in range(60)] + [(2, 0, "cy", "é" * 200_000, "clash"), (2, 0, "cy", "é" * 200_000, "clash")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mask string").repartition(3)
    got = {}
    for r in chat.rotate_perspectives(df, part_rows=7).orderBy("conv_id", "speaker", (F.col("chunk") < 0), "chunk", "part").collect():
        assert r.n_turns <= 7 and all(r.rendered[int(a) : int(b)].endswith("<|end|>") for a, b in (m.split(":") for m in r["mask"].split(",") if m))
        got[r.conv_id, r.speaker] = got.get((r.conv_id, r.speaker), "") + r.rendered
    for conv, speaker in ((1, "ann"), (1, "bob"), (2, "cy")):
        said = sorted(((t is None, t or 0), who, text) for c, t, who, text, _ in rows if c == conv)
        assert got[conv, speaker] == "".join(("<|assistant|>" if who == speaker else f"<|user:{who}|>") + f"\n{text}<|end|>\n" for _, who, text in said)
    assert len(got) == 3 and chat.rotate_perspectives(df.where("false")).count() == 0


def naive_schedule(blocks, parts):
    """Every slot looks at all sources: of the released blocks the one due first."""
    total, done, t, out = sum(parts.values()), dict.fromkeys(blocks, 0), 0, []
    while any(done[s] < n for s, n in blocks.items()):
        ready = [(math.ceil(Fraction((done[s] + 1) * total, parts[s])), s) for s in blocks if done[s] < blocks[s] and math.floor(Fraction(done[s] * total, parts[s])) <= t]
        if ready:
            due, s = min(ready)
            out.append((s, done[s], t, due))
            done[s] += 1
        t += 1
    return out


def test_schedule_equals_a_naive_one():
    rng = random.Random(2)
    for _ in range(30):
        names = "abcdefg"[: rng.randrange(1, 8)]
        blocks, parts = {s: rng.randrange(1, 40) for s in names}, {s: rng.randrange(1, 1000) for s in names}
        got = list(mixing.pfair(blocks, parts))
        assert [(s, j, t, due) for s, j, t, _, due in got] == naive_schedule(blocks, parts)
        assert all(release <= t < due for _, _, t, release, due in got)


def test_mixing_deviation_and_wholeness(spark):
    rows = [(i, "big", 5) for i in range(600)] + [(1000 + i, "mid", 5) for i in range(200)] + [(2000 + i % 90, None, 5) for i in range(100)] + [(None, "mid", 5)] * 2
    df = spark.createDataFrame(rows, "doc_id long, source string, mix_slot long").repartition(3)
    got = sorted(mixing.mix_sources(df, {"big": 0.5, "mid": 0.3}, block_rows=10).collect(), key=lambda r: r.mix_position)
    assert [r.mix_position for r in got] == list(range(902)) and Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, s, _ in rows)
    weight, had = {r.source: r.mix_weight for r in got}, Counter()
    assert weight == {"big": 0.5, "mid": 0.3, None: pytest.approx(0.2)}
    slots = sorted({(r.mix_slot, r.source, r.mix_block, r.mix_time, r.mix_deadline) for r in got})
    assert [(s or "null", b, t, d) for _, s, b, t, d in slots] == [(s.strip("="), b, t, d) for s, b, t, d in naive_schedule({"=big": 60, "=mid": 21, "null": 10}, {"=big": 500_000, "=mid": 300_000, "null": 200_000})]
    for slot, s, _, t, _ in slots:
        if len(had) < 3 or all(had[x] < n for x, n in (("big", 60), ("mid", 21), (None, 10))):
            had[s] += 1
            assert all(abs(had[x] - weight[x] * (t + 1)) < 1 for x in weight)
    assert all(g.mix_slot <= h.mix_slot for g, h in zip(got, got[1:]))
    assert mixing.mix_sources(df.where("false")).count() == 0


def test_search_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 24))
    x = centres[rng.integers(0, 40, 3000)] + 0.4 * rng.standard_normal((3000, 24))
    x[100:140] = x[100]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(9000, None), (9050, [0.0] * 24), (9100, [float("nan")] * 24), (9150, [1.0, None] + [0.0] * 22), (9200, [1.0]), (9250, [])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = ann.nearest_by_codes(df, F.col("vec_id") % 50 == 0).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for i in range(0, 3000, 50):
        score = unit @ unit[i]
        score[i] = -9
        want = np.lexsort((np.arange(3000), -np.round(score, 12)))[:5]
        mine = got[got.query_id == i].sort_values("rank")
        assert len(mine) == 5 and np.allclose(mine.score, score[mine.vec_id], atol=1e-12)
        hits += len(set(mine.vec_id) & set(want))
    assert hits / 300 >= 0.9 and got.query_id.max() < 3000
    assert got[got.query_id == 100].sort_values("rank").vec_id.tolist() == [101, 102, 103, 104, 105]
    assert ann.nearest_by_codes(df.where("false"), F.lit(True)).count() == 0
    assert re.match("long|bigint", dict(ann.nearest_by_codes(df.limit(4), F.lit(True)).dtypes)["vec_id"])


def test_search_ties_go_to_the_smaller_id_however_many(spark):
    base = np.random.default_rng(8).standard_normal(16)
    rows = [(1 + i, [float(v) for v in base * 2.0 ** (i * 37 % 201 - 100)]) for i in range(201)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(4)
    got = {}
    for r in ann.nearest_by_codes(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [1, 2, 3, 4, 5] for q in (50, 100, 150, 200)}


@pytest.mark.parametrize("clusters", [40, 0])
def test_recall_where_lists_are_left_out(spark, clusters, monkeypatch):
    """30 lists, as many of them looked into as hold the true neighbours of a sample, blocks of both sides; clustered vectors and
    vectors without any structure."""
    looked = []
    real = ann.measured_probes
    monkeypatch.setattr(ann, "measured_probes", lambda *a: looked.append(real(*a)) or looked[-1])
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 32))
    if clusters:
        x = rng.standard_normal((clusters, 32))[rng.integers(0, clusters, 3000)] + 0.4 * x
    df = spark.createDataFrame([(i, [float(v) for v in row], "clash") for i, row in enumerate(x)], "vec_id long, vector array<double>, score string")
    got = ann.nearest_by_codes(df, F.col("vec_id") % 50 == 0, list_vectors=100, query_block=7).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for i in range(0, 3000, 50):
        score = unit @ unit[i]
        score[i] = -9
        hits += len(set(np.argsort(-score)[:5]) & set(got[got.query_id == i].vec_id))
    print("recall", clusters, hits / 300, looked)
    assert hits / 300 >= 0.95 and len(got) == 300 and (looked[0] < 30 or not clusters)


def test_recall_on_the_tables_in_many_lists(spark):
    """The tables' embeddings cut in 40 lists."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    got = ann.nearest_by_codes(rows, F.col("vec_id") % 50 == 0, list_vectors=50).toPandas()
    all_rows = rows.toPandas().sort_values("vec_id")
    x = np.stack(all_rows.vector.to_numpy()).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for i in range(0, len(x), 50):
        score = unit @ unit[i]
        score[i] = -9
        hits += len(set(np.argsort(-score)[:5]) & set(got[got.query_id == i].vec_id))
    assert hits / len(got) >= 0.95


def test_huge_and_tiny_vectors_and_ids_of_several_vectors(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 1e-300]), (2, [1e300, -1e300]), (3, [3.0, 3.0]), (3, [1.0, 0.0]), (3, [3.0, 3.0]), (None, [1.0, 1.0])]
    got = ann.nearest_by_codes(spark.createDataFrame(rows, "vec_id long, vector array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in got] == [(1, 1), (2, 3), (3, 2)] and abs(got[0].score - 1) < 1e-15 and abs(got[2].score) < 1e-15
