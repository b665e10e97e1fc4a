"""Approximate nearest neighbours by randomly rotated one-bit codes.

A unit vector x, less the centroid of its list, is turned by one random rotation; the signs of the result
are its code, D bits packed in bytes, and the scalar <x, sign(x) / sqrt(D)> corrects the estimate of an inner
product made from the bits. The estimate's error stays with high probability within
``EPSILON * sqrt(1 - c * c) / (c * sqrt(D - 1))`` times the residual norms, c being that scalar; a
candidate is reranked with its original vector only if its upper bound reaches the K-th best
lower bound.

Lists: centroids from a bounded sample split the vectors; a query looks into the nearest lists. How many, is measured: the true
neighbours of a bounded sample of queries are found by brute force, and as many lists are looked into as hold RECALL of them. Equal
vectors are one entry with their smallest ids. Lists and their queries are cut in blocks, so no task gathers a list
or its queries: it compares one block of entries with one block of queries.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import written

K = 5
#: Vectors that the centroids are fitted on (those with the smallest hash of their id).
SAMPLE = 20_000
#: Most lists; below, about one for each LIST_VECTORS vectors.
MOST_LISTS, LIST_VECTORS = 1_024, 2_000
#: Share of true neighbours that the lists looked into must hold, measured on at most MEASURED queries; the fewest lists looked into.
RECALL, MEASURED, MIN_PROBES = 0.98, 256, 12
#: Entries of a list and queries that one task compares, about; queries that it compares at a time.
ENTRY_BLOCK, QUERY_BLOCK, AT_A_TIME = 8_192, 8_192, 512
EPSILON = 3.0


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every call."""
    q, r = np.linalg.qr(np.random.default_rng(20_240_501).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def code(unit: np.ndarray, centroid: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, residual norms, correction scalars) of unit vectors."""
    residual = (unit - centroid) @ turn
    norm = np.linalg.norm(residual, axis=1)
    safe = np.where(norm > 0, norm, 1.0)
    scalar = np.abs(residual).sum(axis=1) / (safe * math.sqrt(unit.shape[1]))
    return np.packbits(residual > 0, axis=1), norm, np.where(norm > 0, scalar, 1.0)


def bounds(bits: np.ndarray, norm: np.ndarray, scalar: np.ndarray, queries: np.ndarray, centroid: np.ndarray, units_dot: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x entries) and their error bounds; ``units_dot`` has <x, centroid>."""
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    q = (queries - centroid) @ turn
    q_norm = np.linalg.norm(q, axis=1)
    cross = (q.astype(np.float32) @ signs.T) / math.sqrt(dim) * (norm / scalar)
    # <x, q> = <x - c, q - c> + <x, c> + <q, c> - <c, c>
    estimate = cross + units_dot + (queries @ centroid)[:, None] - centroid @ centroid
    error = EPSILON * np.sqrt(np.maximum(1 - scalar**2, 0)) / scalar / math.sqrt(max(dim - 1, 1)) * norm
    return estimate, q_norm[:, None] * error + 1e-6


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows by a power of two, so that squares neither overflow nor vanish and no cosine changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _in_order(x: np.ndarray) -> np.ndarray:
    """Sums of rows, term after term."""
    return np.add.accumulate(x, axis=1)[:, -1]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _probes(centroids: np.ndarray, many: int):
    def nearest(vectors: pd.Series) -> pd.Series:
        score = _unit(_matrix(vectors)) @ centroids.T
        part = np.argpartition(-score, min(many, score.shape[1] - 1), axis=1)[:, :many] if many < score.shape[1] else np.tile(np.arange(score.shape[1]), (len(score), 1))
        if many == 1:
            part = score.argmax(axis=1)[:, None]
        return pd.Series(list(part.astype(np.int32)))

    return nearest


def _centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means, from a fixed start."""
    rng = np.random.default_rng(7)
    centres = sample[rng.permutation(len(sample))[:lists]]
    for _ in range(10):
        owner = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return centres


def _truth(units: np.ndarray, query_ids: list[int], k: int):
    """Over all entries of a partition: lists and scores of the ``k`` nearest of each query, its own row left out."""

    def run(batches):
        place = {q: i for i, q in enumerate(query_ids)}
        score, lists = np.full((len(units), k), -np.inf), np.full((len(units), k), -1)
        for pdf in batches:
            if not len(pdf):
                continue
            found = units @ _unit(_matrix(pdf["vector"])).T
            for j, ids in enumerate(pdf["ids"]):
                if len(ids) == 1 and ids[0] in place:
                    found[place[ids[0]], j] = -np.inf
            both = np.concatenate([score, found], axis=1)
            held = np.concatenate([lists, np.broadcast_to(pdf["list"].to_numpy(), found.shape)], axis=1)
            top = np.argpartition(-both, k - 1, axis=1)[:, :k]
            score, lists = np.take_along_axis(both, top, 1), np.take_along_axis(held, top, 1)
        q, at = np.nonzero(np.isfinite(score))
        yield pd.DataFrame({"q": q, "list": lists[q, at], "score": score[q, at]})

    return run


def measured_probes(listed: DataFrame, queries: DataFrame, centroids: np.ndarray, k: int, recall: float, least: int) -> int:
    """The fewest lists (nearest first, ``least`` at least) that hold ``recall`` of the true neighbours of MEASURED queries. Those
    queries, and ``k`` lists for each, are what reaches the driver."""
    if len(centroids) <= least:
        return len(centroids)
    asked = queries.orderBy(F.xxhash64("query_id", F.lit(9)), "query_id", "vector").limit(MEASURED).toPandas()
    if not len(asked):
        return least
    units = _unit(_matrix(asked["vector"]))
    near = listed.select("ids", "vector", "list").mapInPandas(_truth(units, asked["query_id"].tolist(), k), "q long, list long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "list")
    told = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("q", "list").toPandas()
    place = (-(units @ centroids.T)).argsort(axis=1).argsort(axis=1)[told["q"], told["list"]]
    return min(len(centroids), max(least, int(np.ceil(np.quantile(place, recall))) + 1)) if len(place) else least


def _codes(centroids: np.ndarray):
    def run(batches):
        turn = rotation(centroids.shape[1])
        for pdf in batches:
            unit = _unit(_matrix(pdf["vector"])) if len(pdf) else np.zeros((0, centroids.shape[1]))
            base = centroids[pdf["list"].to_numpy()]
            bits, norm, scalar = code(unit, base, turn)
            yield pdf[["list", "block", "ids", "vector"]].assign(bits=[b.tobytes() for b in bits], norm=norm, scalar=scalar, dot=(unit * base).sum(axis=1))

    return run


def _search(centroids: np.ndarray, k: int):
    def run(key, entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(queries):
            turn, centre = rotation(centroids.shape[1]), centroids[int(key[0])]
            bits = np.frombuffer(b"".join(entries["bits"]), np.uint8).reshape(len(entries), -1)
            norm, scalar, dot = (entries[c].to_numpy() for c in ("norm", "scalar", "dot"))
            x = _scaled(_matrix(entries["vector"]))
            xx = _in_order(x * x)
            ids = entries["ids"].tolist()
            for begin in range(0, len(queries), AT_A_TIME):
                part = queries.iloc[begin : begin + AT_A_TIME]
                q = _scaled(_matrix(part["vector"]))
                qq = _in_order(q * q)
                estimate, error = bounds(bits, norm, scalar, _unit(q), centre, dot, turn)
                low = estimate - error
                # a query's own vector may be an entry: one entry more than k
                cut = np.partition(low, -(k + 1), axis=1)[:, -(k + 1)] if low.shape[1] > k + 1 else np.full(len(low), -np.inf)
                for row, query_id in enumerate(part["query_id"].tolist()):
                    picks = np.flatnonzero(estimate[row] + error[row] >= cut[row])
                    score = _in_order(x[picks] * q[row]) / np.sqrt(xx[picks] * qq[row])
                    # all entries tied with the (k + 1)-th best: ids decide among them
                    least = np.partition(score, -(k + 1))[-(k + 1)] if len(score) > k + 1 else -np.inf
                    near = score >= least
                    best = [(-s, i) for p, s in zip(picks[near].tolist(), score[near].tolist(), strict=True) for i in ids[p] if i != query_id]
                    out += [(query_id, i, -s) for s, i in sorted(best)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def nearest_by_codes(vectors: DataFrame, is_query: Column, k: int = K, sample: int = SAMPLE, list_vectors: int = LIST_VECTORS, recall: float = RECALL, min_probes: int = MIN_PROBES, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` (vec_id, vector) that ``is_query`` picks, the ``k``
    nearest other rows that the index finds, by cosine in double precision of the original vectors, ties to the smaller
    id; fewer if there are fewer candidates in the lists it looks into.

    Vectors that are null, zero or hold a null or a non-finite component take no part, nor do rows with a null id and
    vectors of another length than the most frequent one. Rows that repeat an id and vector count once; of rows that
    share an id with different vectors, each is a candidate under that id. Other columns are ignored. The index has a list
    for each ``list_vectors`` entries; a query looks into as many as hold ``recall`` of the true neighbours, ``min_probes`` at least.
    """
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"), is_query.alias("is_query")).where("vec_id is not null and vector is not null and size(vector) > 0")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    clean = clean.where(finite).where(F.exists("vector", lambda v: v != 0)).distinct()
    lengths = clean.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return vectors.sparkSession.createDataFrame([], empty)
    dim = lengths[0]["dim"]
    rows = written(clean.where(F.size("vector") == dim).withColumn("same", F.xxhash64("vector")), "vectors")
    # equal vectors are one entry; any query needs at most its own id and k others of them
    few = Window.partitionBy("same", "vector").orderBy("vec_id")
    entries = rows.withColumn("n", F.row_number().over(few)).where(F.col("n") <= k + 1).groupBy("same", "vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    entries = written(entries, "entries")
    n = entries.count()
    fitted = entries.orderBy(F.xxhash64("same", F.lit(3)), "same").limit(sample).select("vector").toPandas()  # bounded by ``sample``
    lists = int(min(MOST_LISTS, max(1, n // list_vectors)))
    centroids = _centroids(_unit(_matrix(fitted["vector"])), lists)
    one = F.pandas_udf(_probes(centroids, 1), "array<int>")
    listed = entries.withColumn("list", one("vector")[0])
    queries = rows.where("is_query").select(F.col("vec_id").alias("query_id"), "vector")
    some = F.pandas_udf(_probes(centroids, measured_probes(listed, queries, centroids, k, recall, min_probes)), "array<int>")
    asked = written(queries.withColumn("list", F.explode(some("vector"))), "asked")

    def cut(df: DataFrame, size: int) -> tuple[Column, Column]:
        """(blocks of the row's list, the block of a hash)."""
        sizes = {r["list"]: r["count"] for r in df.groupBy("list").count().collect()}  # one row for each list
        many = F.create_map(*(F.lit(x) for i in range(lists) for x in (i, max(1, -(-sizes.get(i, 0) // size)))))[F.col("list")]
        return many, F.pmod(F.xxhash64(df.columns[0], F.lit(5)), many).cast("int")

    blocks, block = cut(listed, ENTRY_BLOCK)
    query_blocks, asked_block = cut(asked, query_block)
    indexed = listed.withColumn("block", block).select("list", "block", "ids", "vector")
    kinds = "list int, block int, ids array<long>, vector array<double>, bits binary, norm double, scalar double, dot double"
    coded = indexed.mapInPandas(_codes(centroids), kinds).withColumn("asked", F.explode(F.sequence(F.lit(0), query_blocks - 1)))
    asked = asked.withColumn("asked", asked_block).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    meet = ["list", "block", "asked"]
    found = coded.groupBy(*meet).cogroup(asked.groupBy(*meet)).applyInPandas(_search(centroids, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The exact answer over ``embeddings``, which is the index's where every list is looked into.
ORACLE_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (SELECT vec_id, x, list_inner_product(x, x) AS xx FROM v WHERE vec_id IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(c.x, q.x) / sqrt(c.xx * q.xx) AS score FROM ok q JOIN ok c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""
