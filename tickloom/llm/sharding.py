"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

The items are groups of equal texts. An item is a vector (bytes, tokens, rows), each in parts of the
fair share of a shard, and goes to the shard whose residual capacity has the largest dot product with
it; items come in order of their largest component, so the small ones even out what the large ones left.

Placement is sequential only within a batch. Items above ``HEAVY`` of the whole (at most 3 / HEAVY)
are the first batch; the others are dealt by hash to batches of about ``BATCH_ITEMS``, and every batch fills the
same fraction of the capacity that the first left, so batches need not know of each other. Tables of all sizes take
this way. A group above a quarter of a shard's share is split in pieces by a hash of the rows' ids (at most 12 such groups a
shard, so their table can be sent to all tasks).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .ranking import numbered
from .storage import written

SHARDS = 24
#: Part of a shard's share above which a group of copies is split; part of the whole above which an item is in the first batch.
HOT, HEAVY = 1 / 4, 1e-4
#: Items of a batch on average, and batches that one task places, one after the other.
BATCH_ITEMS, TASK_BATCHES = 20_000, 4
_DIMS = ("bytes", "tokens", "n_rows")


def place(items: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """The shard of each item (n x 3) given each shard's capacity (shards x 3), in one pass."""
    shard = np.zeros(len(items), np.int64)
    left = capacity.copy()
    for i in np.argsort(-items.max(axis=1), kind="stable").tolist() if len(items) else []:
        k = shard[i] = int((left @ items[i]).argmax())
        left[k] -= items[i]
    return shard


def _placer(capacity: np.ndarray, share: np.ndarray):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["grp", "piece"], kind="stable")
        return pdf[["grp", "piece"]].assign(shard=place(pdf[list(_DIMS)].to_numpy(float) / share, capacity).astype("int32"))

    return run


def shard_by_vector_packing(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, tokens, shard, slot`` for each row of ``docs`` (doc_id, text).

    size: UTF-8 bytes of the text plus 8; text_crc32: unsigned, of the UTF-8 bytes; tokens: words;
    slot: 0, 1, ... within the shard. Equal texts go together unless their group is above ``HOT`` of a shard's share.
    Null counts as the empty text. Repeated rows are rows like others. Null ids are allowed. An empty
    table gives an empty result. Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.when(F.trim(text) == "", 0).otherwise(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")))
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), words.cast("long").alias("tokens"), F.md5(text.cast("binary")).alias("grp")), "shard-rows")
    vector = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")]
    whole = np.array([float(x or 0) for x in rows.agg(*vector).first()])
    share = np.maximum(whole / shards, 1e-9)
    part = F.greatest(*(F.col(d) / F.lit(float(max(w, 1.0))) for d, w in zip(_DIMS, whole, strict=True)))

    groups = rows.groupBy("grp").agg(*vector)
    most = HOT / shards
    hot = groups.withColumn("part", part).where((F.col("part") > most) & (F.col("n_rows") > 1)).select("grp", F.ceil(F.col("part") / most).cast("int").alias("pieces"))
    piece = F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("pieces")), F.lit(0)).cast("int")
    pieced = rows.join(F.broadcast(hot), "grp", "left").withColumn("piece", piece).drop("pieces")
    items = written(pieced.groupBy("grp", "piece").agg(*vector).withColumn("heavy", part > HEAVY), "shard-items")

    light = items.where("not heavy")
    batches = max(1, -(-light.count() // BATCH_ITEMS))
    schema = "grp string, piece int, shard int"
    first = written(items.where("heavy").withColumn("batch", F.lit(0)).groupBy("batch").applyInPandas(_placer(np.ones((shards, 3)), share), schema), "shard-first")
    loads = np.zeros((shards, 3))
    for k, *load in first.join(items, ["grp", "piece"]).groupBy("shard").agg(*(F.sum(d).cast("double") for d in _DIMS)).collect():  # one row for each shard
        loads[k] = np.array(load) / share
    dealt = light.withColumn("batch", F.pmod(F.xxhash64("grp", "piece"), F.lit(batches))).repartition(-(-batches // TASK_BATCHES), "batch")
    placed = first.unionByName(dealt.groupBy("batch").applyInPandas(_placer((1 - loads) / batches, share), schema))
    sharded = written(pieced.join(placed, ["grp", "piece"]).select("doc_id", "size", "text_crc32", "tokens", "shard"), "sharded")
    return numbered(sharded, "shard", [F.col("doc_id"), F.col("text_crc32"), F.col("size")], int(whole[2]))
