"""Joins of rows whose times are near: an equi-join on bins of time, then the exact condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A bin with more rows of a side than this, and than HOT_SHARE of the side, is split: at most 2 / HOT_SHARE bins, which are broadcast.
HOT_ROWS, HOT_SHARE = 20_000, 1e-4


def interval_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, before: int, after: int = 0, by: tuple[str, ...] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """All pairs of a left and a right row with the same keys ``by`` whose times (whole numbers of one unit) satisfy
    ``left_on - before <= right_on <= left_on + after``: the left columns, then those of the right that are no keys. Rows with a null
    time or key have no pair; repeated rows are pairs of their own. The sides' other columns must have different names.

    A right row lies in the bin of its time, of the interval's width, and a left row looks into the two or fewer bins that its
    interval touches, so a pair is met once. A bin with many rows is a grid of cells: its left rows are dealt to the rows of
    the grid and repeated over its columns, its right rows the other way round, so no task has all pairs of a bin. Rows are
    dealt by a hash of their columns, which a retried task repeats.
    """
    if before + after < 0:
        raise ValueError("the interval is empty")
    width = max(1, before + after)
    bin_of = lambda c: F.floor(c / width).cast("long")
    at = F.col(left_on).cast("long")
    lefts = left.where(at.isNotNull()).withColumn("__bin", F.explode(F.sequence(bin_of(at - before), bin_of(at + after))))
    rights = right.where(F.col(right_on).isNotNull()).withColumn("__bin", bin_of(F.col(right_on).cast("long")))
    keys = [*by, "__bin"]
    sizes = lefts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__l"), F.lit(0).cast("long").alias("__r")).unionByName(rights.groupBy(*keys).agg(F.lit(0).cast("long").alias("__l"), F.count(F.lit(1)).alias("__r")))
    sizes = sizes.groupBy(*keys).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))
    n_left, n_right = left.count(), right.count()
    many = lambda c, n: F.ceil(F.col(c) / max(hot_rows, int(2 * n * HOT_SHARE))).cast("int")
    grid = sizes.select(*keys, F.greatest(many("__l", n_left), F.lit(1)).alias("__rows"), F.greatest(many("__r", n_right), F.lit(1)).alias("__columns")).where("__rows > 1 or __columns > 1")

    def dealt(df: DataFrame, own: str, other: str, time: str) -> DataFrame:
        split = df.join(F.broadcast(grid), keys, "left")  # a hot bin a row
        names = [c for c in df.columns if c not in keys]
        place: Column = F.pmod(F.xxhash64(time, *[c for c in names if c != time]), F.coalesce(own, F.lit(1))).cast("int")
        return split.select(*df.columns, place.alias(own), F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)).alias(other))

    met = dealt(lefts, "__rows", "__columns", left_on).join(dealt(rights, "__columns", "__rows", right_on), [*keys, "__rows", "__columns"])
    near = met.where(F.col(right_on).between(F.col(left_on) - before, F.col(left_on) + after))
    return near.select(*left.columns, *[c for c in right.columns if c not in by])
