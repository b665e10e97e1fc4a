"""Tables as bags of rows: comparison with multiplicities, totals over sets of keys, samples of each stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """``columns of a, n_a, n_b`` for each different row of the two (with the same columns, in any order): how often each table has it.
    Nulls equal nulls. One grouped count of both, combined before the shuffle: no join, and a row that is repeated a million times travels once a task.
    ``n_a > n_b`` rows, ``n_a - n_b`` times, are EXCEPT ALL; ``least(n_a, n_b)`` times, INTERSECT ALL."""
    both = a.withColumns({"n_a": F.lit(1), "n_b": F.lit(0)}).unionByName(b.select(a.columns).withColumns({"n_a": F.lit(0), "n_b": F.lit(1)}))
    return both.groupBy(*a.columns).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))


def reconcile(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each key: ``keys, n_a, n_b, same, missing, extra, differing``: its rows in either table, rows that both have (with
    multiplicities), rows of a that b lacks, rows of b that a lacks, and the columns (comma-joined, in their order) whose values the
    rows without a partner don't share. Keys may be null."""
    values = [c for c in a.columns if c not in keys]
    rows = bag_difference(a, b)
    same, missing, extra = F.least("n_a", "n_b"), F.greatest(F.col("n_a") - F.col("n_b"), F.lit(0)), F.greatest(F.col("n_b") - F.col("n_a"), F.lit(0))
    left, right = missing > 0, extra > 0
    # the values of a column on either side as a hash that doesn't depend on their order
    bag = lambda c, side, n: F.coalesce(F.sum(F.when(side, F.xxhash64(F.lit(c), F.col(c), F.col(c).isNull()).cast("decimal(38,0)") * n)), F.lit(0))
    unlike = [F.when(bag(c, left, missing) != bag(c, right, extra), F.lit(c)) for c in values]
    told = rows.groupBy(*keys).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.sum(same).alias("same"), F.sum(missing).alias("missing"), F.sum(extra).alias("extra"), F.concat_ws(",", *unlike).alias("differing"))
    return told


def grouped_totals(df: DataFrame, sets: list[tuple[str, ...]], keys: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """``keys, grouping_id`` and the aggregates for each of ``sets`` of keys, in one pass; a key that a set has not is null there, which grouping_id tells
    from a null in the data: its bits, the first key's the highest, are 1 for absent keys."""
    found = df.groupingSets([[F.col(k) for k in s] for s in sets], *(F.col(k) for k in keys))
    return found.agg(F.grouping_id().alias("grouping_id"), *(x.alias(n) for n, x in aggregates.items())).select(*keys, "grouping_id", *aggregates)


def stratified_sample(df: DataFrame, strata: list[str], identity: list[str], k: int, seed: int = 42) -> DataFrame:
    """``df``'s rows with the ``k`` smallest hashes of ``identity`` (and the seed) in each stratum, all of a smaller one, with ``weight``: rows of
    the stratum for each row taken. The same rows whatever the partitions. Rows with equal identities are taken by the order of all
    columns' text. A stratum's rows are cut to k in each task before they are shuffled."""
    hashed = df.withColumn("__h", F.xxhash64(*identity, F.lit(seed)))
    order = [F.col("__h"), *(F.col(c).asc_nulls_first() for c in identity), F.xxhash64(*df.columns)]
    best = hashed.withColumn("__k", F.row_number().over(Window.partitionBy(*strata).orderBy(*order))).where(F.col("__k") <= k)
    sizes = df.groupBy(*(F.col(s).alias(f"__s{i}") for i, s in enumerate(strata))).agg(F.count(F.lit(1)).alias("__n"))
    met = F.lit(True)
    for i, s in enumerate(strata):
        met = met & best[s].eqNullSafe(sizes[f"__s{i}"])
    joined = best.join(sizes, met)
    return joined.select(*df.columns, (F.col("__n") / F.least(F.col("__n"), F.lit(k))).alias("weight"))
