"""Ranks within groups of any size, without a group in one task."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.shared import shared_folder

#: Order values with more rows than this, and than HEAVY_SHARE of all rows, get their ranks by broadcast: at most 1 / HEAVY_SHARE values.
HEAVY_ROWS, HEAVY_SHARE = 1_000, 1e-5


def positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` as a written table with ``name``: the place (0, 1, ...) of each row in the order of ``order``, which must tell all rows
    apart. Rows are sorted by range partitions and written; a row's place is that in its file and the rows of the files before."""
    folder = f"{shared_folder(df.sparkSession)}/sorted-{uuid.uuid4().hex}"
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", 0).parquet(folder)
    rows = df.sparkSession.read.schema(df.schema).parquet(folder).select("*", F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    before = Window.partitionBy("one").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    counts = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1))
    offsets = counts.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return rows.join(F.broadcast(offsets), "__file").withColumn(name, F.col("__before") + F.col("__row")).select(*df.columns, name)


def _met(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be null; without keys ``facts`` has one row."""
    facts = facts if keys else F.broadcast(facts)
    named = facts.withColumnsRenamed({k: f"__key{i}" for i, k in enumerate(keys)})
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__key{i}"))
    return rows.join(named, on, how).drop(*(f"__key{i}" for i in range(len(keys))))


def rank_rows(df: DataFrame, order: str, tie: list[str], by: tuple[str, ...] = (), tiles: int = 4, nth: int = 1) -> DataFrame:
    """``df`` with ``row_number, rank, dense_rank, percent_rank, cume_dist, tile`` and ``nth_value`` (the value of ``order`` of the group's
    ``nth`` row, null if there are fewer) of each row in its group ``by``, by ascending ``order``, nulls first; ``tie`` decides among
    equal values, for row_number and tile, and must then tell rows apart.

    The whole table is sorted once, by group, value and tie, over range partitions, so a large group or a frequent value is
    spread over many. A rank is a difference of places: of the row, of the first and last row with its value, and of its
    group's first. Groups and values are counted by partial aggregates.
    """
    keys, peers = list(by), [*by, order]
    placed = positions(df, [*peers, *tie], "__at")
    values = placed.groupBy(*peers).agg(F.min("__at").alias("__first"), F.max("__at").alias("__last"))
    values = positions(values, peers, "__value")
    groups = values.groupBy(*keys).agg(F.min("__first").alias("__start"), (F.max("__last") - F.min("__first") + 1).alias("__n"), F.min("__value").alias("__v"))
    told = _met(values, groups, keys)
    total = placed.count()
    size = F.col("__last") - F.col("__first") + 1
    heavy = size > max(HEAVY_ROWS, int(total * HEAVY_SHARE))

    few = F.broadcast(told.where(heavy))
    many = _met(placed, few, peers).unionByName(_met(_met(placed, few.select(*peers), peers, "left_anti"), told.where(~heavy), peers))
    number = F.col("__at") - F.col("__start")  # from 0
    n, rank = F.col("__n"), F.col("__first") - F.col("__start")
    wide, long = F.floor(n / tiles), n % tiles  # the first ``long`` tiles have a row more
    tile = F.when(number < long * (wide + 1), F.floor(number / (wide + 1))).otherwise(long + F.floor(F.try_divide(number - long * (wide + 1), wide)))
    out = many.select(*df.columns, (number + 1).alias("row_number"), (rank + 1).alias("rank"), (F.col("__value") - F.col("__v") + 1).alias("dense_rank"), F.coalesce(F.try_divide(rank, n - 1), F.lit(0.0)).alias("percent_rank"), ((F.col("__last") - F.col("__start") + 1) / n).alias("cume_dist"), (tile + 1).cast("int").alias("tile"))
    chosen = told.where((F.col("__first") - F.col("__start") < nth) & (F.col("__last") - F.col("__start") >= nth - 1)).select(*keys, F.col(order).alias("nth_value"))  # a row a group
    return _met(out, chosen, keys, "left")
