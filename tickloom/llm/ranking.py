"""Gapless numbering of rows within large groups, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


#: Rows of a group that are numbered together on average, and the fewest cells there are.
CELL_ROWS, LEAST_CELLS = 50_000, 1_024


def numbered(df: DataFrame, group: str, order: list[Column], rows: int, name: str = "slot", cell_rows: int = CELL_ROWS) -> DataFrame:
    """``df`` with ``name``: 0, 1, ... within each ``group`` (a column without nulls), gapless.

    Rows are dealt to cells by a hash of ``order``; each (group, cell) is numbered by a window, and the
    cells' counts, summed up in cell order, give its offset. ``rows`` (the number of rows of ``df``) sets
    the number of cells, so a group that holds a third of all rows is numbered by many tasks. The order
    within a group is by cell, then by ``order``. ``df`` should be a written table: it is read twice.
    """
    cells = max(LEAST_CELLS, -(-rows // cell_rows))
    cell = F.pmod(F.xxhash64(*order, F.lit(name)), F.lit(cells))
    dealt = df.withColumn("__cell", cell)
    counts = dealt.groupBy(group, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = dealt.withColumn("__row", F.row_number().over(Window.partitionBy(group, "__cell").orderBy(*order)))
    joined = local.join(offsets, [group, "__cell"])  # both sides are dealt by these already
    return joined.withColumn(name, F.col("__before") + F.col("__row") - 1).drop("__cell", "__row", "__before")
