"""Rolling aggregates over frames of time on uneven series, without filling gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: How the aggregates of two parts of a frame become one, and how rows become one.
_JOIN = {"sum": lambda a, b: F.coalesce(a + b, a, b), "count": lambda a, b: F.coalesce(a + b, a, b), "min": F.least, "max": F.greatest}
_FOLD = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_ROWS = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def range_frames(df: DataFrame, time: str, windows: list[int], aggregates: dict[str, tuple[str, str]], by: tuple[str, ...] = ()) -> DataFrame:
    """``by``, ``time`` and for each window w and aggregate name a column ``<name>_<w>``: (kind, column) over all rows of the same keys
    whose time is from ``time - w`` to ``time``, both included. kind: sum, count (of values that aren't null), min or max; time
    is a whole number in the unit of the windows. One row for each keys and time: rows of one time share a frame. Rows with a null
    time are left out; a frame without values gives null, and 0 for a count.

    Rows of one time are first made one. Then time is cut in blocks as long as the window: a frame is the end of one block and
    the beginning of the next, whose aggregates are running ones, so the cost does not depend on the window, nothing is subtracted, and a task has one
    block, with no more rows than it has different times.
    """
    names = list(aggregates)
    kind = {n: aggregates[n][0] for n in names}
    out = df.where(F.col(time).isNotNull()).groupBy(*by, F.col(time).cast("long").alias(time)).agg(*(_ROWS[k](c).alias(n) for n, (k, c) in aggregates.items()))
    for w in windows:
        block = F.floor(F.col(time) / w).cast("long")
        cut = out.withColumn("__block", block)
        ahead = Window.partitionBy(*by, "__block").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
        back = Window.partitionBy(*by, "__block").orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, 0)
        run = cut.withColumns({f"__a_{n}": _FOLD[kind[n]](n).over(ahead) for n in names} | {f"__e_{n}": _FOLD[kind[n]](n).over(back) for n in names})
        # the end of the block before, from a row on, is met where that row's time plus the window is
        moved = run.select(*by, (F.col("__block") + 1).alias("__block"), (F.col(time) + w).alias("__at"), F.lit(0).alias("__side"), F.struct(*(F.col(f"__e_{n}").alias(n) for n in names)).alias("__end"))
        own = run.select(*by, "__block", F.col(time).alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast(moved.schema["__end"].dataType).alias("__end"), F.struct(*out.columns, *(f"__a_{n}" for n in names)).alias("__row"))
        both = own.unionByName(moved.withColumn("__row", F.lit(None).cast(own.schema["__row"].dataType)))
        later = Window.partitionBy(*by, "__block").orderBy(F.desc("__at"), "__side").rowsBetween(Window.unboundedPreceding, 0)
        met = both.withColumn("__end", F.last("__end", ignorenulls=True).over(later)).where("__side = 1")
        out = met.select("__row.*", "__end").select(*out.columns, *(_JOIN[kind[n]](F.col(f"__a_{n}"), F.col(f"__end.{n}")).alias(f"{n}_{w}") for n in names))
    return out.drop(*names)
