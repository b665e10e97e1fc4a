"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import written

#: A key with more rows than this, and than LIGHT_SHARE of all rows, is joined by broadcast: at most 1 / LIGHT_SHARE keys (2 / LIGHT_SHARE nodes,
#: whose links are counted at both ends).
LIGHT, LIGHT_SHARE = 1_000, 1e-5


def _state(edges: DataFrame) -> tuple:
    """Number of links and sums of two hashes of them: equal tables of distinct links have equal ones."""
    sums = [F.sum(F.xxhash64("u", "v", F.lit(seed)).cast("decimal(38,0)")) for seed in (1, 2)]
    return tuple(edges.agg(F.count(F.lit(1)), *sums).first())


def joined_by(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` joined with ``keyed``, which has a row for each value of ``key`` and in ``count`` the number of rows that have it.
    ``total`` is the number of all rows or more. Heavy values are joined by broadcast, so that none gathers in a task."""
    heavy = F.broadcast(written(keyed.where(F.col(count) > max(LIGHT, int(total * LIGHT_SHARE))).drop(count), "heavy"))
    light = rows.join(heavy, key, "left_anti").join(keyed.drop(count), key)
    return rows.join(heavy, key).unionByName(light)


def components(links: DataFrame) -> DataFrame:
    """``id, component_id`` for every id of ``links`` (``a, b``, long); component_id is the smallest id reachable.

    Alternates large-star and small-star steps: each id points to the smallest id it has seen, which
    takes a number of rounds in the order of the logarithm of the longest chain. Each round is a
    grouped minimum (combined before the shuffle) and a join, and is written to the shared folder. The links of
    heavy nodes, such as the centre of a star that holds a third of all ids, are joined without a shuffle.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("k"))
        large = joined_by(both.where("v > u"), low, "u", "k", state[0]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return stars.unionByName(stars.select(F.col("component_id").alias("id"), "component_id")).distinct()
