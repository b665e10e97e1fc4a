"""Hard negatives by a full sort of each anchor's integer scores.

Vectors are made integer component by component, so scores are exact and ties are real ties. An anchor's scores
against a block of rows are sorted by (score, id); a binary search finds where scores fall to a positive's upper limit, and the
first rows of another label from there on, down to the lower limit, are its negatives in that block. The best of all blocks are
its negatives.

Anchors and rows are both cut in blocks, and one task compares one block with one block: no task gathers all rows of an anchor,
a label or a positive. Positives come first (one pass over all blocks), negatives in a second pass, whose limits depend on them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import written

#: Rows of a block and anchors of a block, about; a table has at least LEAST_BLOCKS blocks of rows, so small ones are shared out too.
BLOCK_ROWS, BLOCK_ANCHORS, LEAST_BLOCKS = 16_384, 16_384, 32
#: Anchors that are scored at a time.
AT_A_TIME = 64
LARGEST = (1 << 63) - 1

_POSITIVE = "anchor_id long, vec_id long, score long"
_NEGATIVE = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, exact: as doubles below 2**52, else as Python integers."""
    if not x.size or np.abs(x).max() < 2.0**52 / scale:
        return np.floor(x * scale)
    whole = lambda v: int(v) * scale if abs(v) >= 2.0**52 else math.floor(v * scale)
    return np.array([[whole(v) for v in row] for row in x.tolist()], object)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows: doubles hold them below 2**53, Python integers beyond. A product that 64 bits don't hold
    counts as the nearest number that they do."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    held = np.frompyfunc(lambda x: min(max(x, -LARGEST), LARGEST), 1, 1)
    return held(whole(a).dot(whole(b).T)).astype(np.int64)


def _rows(table: pa.Table, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, integer vectors) of a block, whose vectors have one length."""
    flat = table.column("vector").combine_chunks().flatten().to_numpy()
    dim = len(flat) // table.num_rows
    return table.column("vec_id").to_numpy(), table.column("label").to_numpy(), integers(flat.reshape(table.num_rows, dim), scale)


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    names = [c.split()[0] for c in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def _scored(anchors: pa.Table, rows: pa.Table, scale: int):
    """(place, id, label, scores, ids and labels of the block) for each anchor."""
    if anchors.num_rows and rows.num_rows:
        a_ids, a_labels, a = _rows(anchors, scale)
        ids, labels, x = _rows(rows, scale)
        for begin in range(0, len(a_ids), AT_A_TIME):
            for i, score in enumerate(products(a[begin : begin + AT_A_TIME], x), begin):
                yield i, a_ids[i], a_labels[i], score, ids, labels


def _positives(many: int, scale: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        for _, anchor, label, score, ids, labels in _scored(anchors, rows, scale):
            same = np.flatnonzero((labels == label) & (ids != anchor))
            first = same[np.lexsort((ids[same], -score[same]))[:many]]
            out += [(anchor, i, s) for i, s in zip(ids[first].tolist(), score[first].tolist(), strict=True)]
        return _table(out, _POSITIVE)

    return run


def _negatives(many: int, scale: int, lower: int, upper: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        told = anchors.column("positives").to_pylist()
        for i, anchor, label, score, ids, labels in _scored(anchors, rows, scale):
            order = np.lexsort((ids, -score))
            falling = -score[order]
            other = np.flatnonzero(labels[order] != label)
            for p in told[i]:
                # lower * positive <= 100 * score <= upper * positive, in whole numbers
                begin = np.searchsorted(falling, max(-(upper * p["score"] // 100), -LARGEST), "left")
                end = np.searchsorted(falling, min(lower * p["score"] // -100, LARGEST), "right")
                at = np.searchsorted(other, begin)
                near = other[at : at + many]
                out += [(anchor, p["vec_id"], i, p["score"], s) for i, s in zip(ids[order[near[near < end]]].tolist(), score[order[near[near < end]]].tolist(), strict=True)]
        return _table(out, _NEGATIVE)

    return run


def hard_negatives(rows: DataFrame, is_anchor: Column, negatives: int = 10, positives: int = 5, lower: int = 30, upper: int = 90, scale: int = 256, block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each row of ``rows`` (vec_id, vector,
    label) that ``is_anchor`` picks and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of other
    labels with ``lower`` to ``upper`` per cent of the positive's score.

    Components become ``floor(scale * x)``; a score is the inner product, the larger the better, ties to the smaller id. Rows
    with a null id, label or vector or a null or non-finite component take no part. Of rows that share an id (such as repeated
    rows) the one with the smallest label and vector counts. Vectors of different lengths have no score and don't meet; empty
    ones have the score 0. A positive without negatives has no row, nor has an anchor without positives. Other columns are
    ignored.
    """
    clean = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<double>").alias("vector"), is_anchor.alias("is_anchor")).where("vec_id is not null and label is not null and vector is not null")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    one = clean.where(finite).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("x"), F.bool_or("is_anchor").alias("is_anchor"))
    table = written(one.select("vec_id", "x.label", "x.vector", F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"), F.size("x.vector").alias("dim")), "vectors")
    n, asking = table.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    blocks, parties = max(LEAST_BLOCKS, -(-n // block_rows)), max(1, -(-asking // block_anchors))
    dealt = lambda many, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(many)).cast("int")
    everywhere = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    meet = ["dim", "block", "party"]
    held = table.select("dim", "vec_id", "label", "vector", dealt(blocks, 1).alias("block"), everywhere(parties).alias("party")).groupBy(*meet)
    anchors = table.where("is_anchor").select("dim", "vec_id", "label", "vector", dealt(parties, 2).alias("party"))

    def met(asked: DataFrame, compare, ddl: str) -> DataFrame:
        return asked.withColumn("block", everywhere(blocks)).groupBy(*meet).cogroup(held).applyInArrow(compare, ddl)

    def best(df: DataFrame, keys: list[str], score: str, name: str, many: int) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), name))).where(F.col("rank") <= many)

    near = best(met(anchors, _positives(positives, scale), _POSITIVE), ["anchor_id"], "score", "vec_id", positives)
    told = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))  # at most ``positives`` each
    asked = written(anchors.join(told, "vec_id"), "anchors")
    far = best(met(asked, _negatives(negatives, scale, lower, upper), _NEGATIVE), ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: The same over ``embeddings``, as the query asks.
ORACLE_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
ok AS (SELECT vec_id, label, list_transform(x, lambda c: floor(256 * c)) AS q FROM v WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
met AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_inner_product(c.q, a.q) AS BIGINT) AS score FROM ok a JOIN ok c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
near AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM met WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
far AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS r
  FROM near JOIN met USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM far WHERE r <= 10
"""
