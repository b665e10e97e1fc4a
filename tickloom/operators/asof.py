"""Backward, forward and nearest as-of joins by union and window: no range join, one shuffle."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import month_of


def asof_join(left: DataFrame, right: DataFrame, right_on: str, columns: list[str], tie: str | None = None, by: tuple[str, ...] = (), lookback: int | None = None, direction: str = "backward") -> DataFrame:
    """``left`` (timestamp_s, month) with ``columns`` of the last row of ``right`` whose ``right_on`` (epoch seconds) is not
    later; exact matches count, and of equal times the largest ``tie`` wins. The whole right row is taken, its NULLs
    included; without a match the columns are NULL. ``lookback``: the most seconds a match may be old.

    ``right`` is cut by month like ``left``; the last right row before a month is carried into it, which takes one
    row for each month. ``direction``: backward, forward (first row not earlier) or nearest (the later one if
    two are equally near).
    """
    if direction == "nearest":
        return _nearest(left, right, right_on, columns, tie, by, lookback)
    sign = 1 if direction == "backward" else -1
    keys = [*by, "month"]
    row = F.struct(F.col(right_on).alias("__at"), *columns)
    rank = F.col(tie) if tie else F.lit(0)
    slow = right.where(F.col(right_on).isNotNull()).select(*by, month_of(F.col(right_on)).alias("month"), F.col(right_on).cast("long").alias("__t"), rank.alias("__tie"), row.alias("__row"))
    order = F.struct("__t", "__tie")
    ends = slow.groupBy(*keys).agg((F.max_by if sign == 1 else F.min_by)("__row", order).alias("__row"))
    months = left.select(*keys).distinct().withColumn("__row", F.lit(None).cast(ends.schema["__row"].dataType)).unionByName(ends).groupBy(*keys).agg(F.first("__row", ignorenulls=True).alias("__row"))
    in_order = F.col("month") if sign == 1 else F.col("month").desc()
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(in_order).rowsBetween(Window.unboundedPreceding, -1)
    carried = months.select(*keys, F.last("__row", ignorenulls=True).over(before).alias("__row")).where("__row is not null").select(*keys, F.lit(None).cast("long").alias("__t"), F.lit(None).cast(slow.schema["__tie"].dataType).alias("__tie"), "__row")
    none = F.lit(None)
    lefts = left.select(*keys, F.col("timestamp_s").cast("long").alias("__t"), none.cast(slow.schema["__tie"].dataType).alias("__tie"), none.cast(slow.schema["__row"].dataType).alias("__row"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__left"))
    rights = slow.unionByName(carried).select("*", F.lit(0).alias("__side"), none.cast(lefts.schema["__left"].dataType).alias("__left"))
    sort = [F.asc_nulls_first("__t"), "__side", F.asc_nulls_first("__tie")] if sign == 1 else [F.asc_nulls_first(-F.col("__t")), "__side", F.desc("__tie")]
    w = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    found = lefts.unionByName(rights).withColumn("__hit", F.last("__row", ignorenulls=True).over(w)).where("__side = 1")
    hit = F.col("__hit") if lookback is None else F.when(F.abs(F.col("__left.timestamp_s") - F.col("__hit.__at")) <= lookback, F.col("__hit"))
    return found.select("__left.*", hit.alias("__hit")).select(*left.columns, *(F.col(f"__hit.{c}").alias(c) for c in columns))


@dataclass(frozen=True)
class Slow:
    """A slow series of an as-of join: its rows, their time (epoch seconds), the columns to take, and what decides among equal times."""

    rows: DataFrame
    on: str
    columns: list[str]
    tie: str | None = None


def asof_joins(left: DataFrame, series: list[Slow], by: tuple[str, ...] = ()) -> DataFrame:
    """``left`` with the columns of all ``series``, each as ``asof_join`` (backward) gives them, in one pass: the union of all is dealt
    and sorted once, however many series there are. Of equal times of a series one row is left before the union."""
    if not series:
        return left
    keys, names = [*by, "month"], [f"__r{i}" for i in range(len(series))]
    slow = []
    for s in series:
        at = F.col(s.on).cast("long")
        row = F.max_by(F.struct(*s.columns), F.col(s.tie)) if s.tie else F.any_value(F.struct(*s.columns))
        slow.append(s.rows.where(F.col(s.on).isNotNull()).groupBy(*by, at.alias("__t")).agg(row.alias("__row")).withColumn("month", month_of(F.col("__t"))))
    kinds = [df.schema["__row"].dataType for df in slow]

    def wide(df: DataFrame, i: int) -> DataFrame:
        """The rows of series i with the places of the others empty."""
        return df.select(*keys, "__t", *(F.col("__row").alias(n) if k == i else F.lit(None).cast(kinds[k]).alias(n) for k, n in enumerate(names)))

    rights = reduce(DataFrame.unionByName, (wide(df, i) for i, df in enumerate(slow)))
    # the last rows before a month are carried into it: one row a month and series
    ends = reduce(DataFrame.unionByName, (wide(df.groupBy(*keys).agg(F.max("__t").alias("__t"), F.max_by("__row", "__t").alias("__row")), i) for i, df in enumerate(slow)))
    none = [F.lit(None).cast(k).alias(n) for k, n in zip(kinds, names, strict=True)]
    months = left.select(*keys).distinct().select(*keys, F.lit(None).cast("long").alias("__t"), *none).unionByName(ends)
    months = months.groupBy(*keys).agg(*(F.first(n, ignorenulls=True).alias(n) for n in names))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    carried = months.select(*keys, F.lit(None).cast("long").alias("__t"), *(F.last(n, ignorenulls=True).over(before).alias(n) for n in names))
    lefts = left.select(*keys, F.col("timestamp_s").cast("long").alias("__t"), *none, F.lit(1).alias("__side"), F.struct(*left.columns).alias("__left"))
    others = rights.unionByName(carried).select("*", F.lit(0).alias("__side"), F.lit(None).cast(lefts.schema["__left"].dataType).alias("__left"))
    w = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("__t"), "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = lefts.unionByName(others).select("__side", "__left", *(F.last(n, ignorenulls=True).over(w).alias(n) for n in names)).where("__side = 1")
    taken = [F.col(f"{n}.{c}").alias(c) for n, s in zip(names, series, strict=True) for c in s.columns]
    return found.select("__left.*", *names).select(*left.columns, *taken)


def _nearest(left: DataFrame, right: DataFrame, right_on: str, columns: list[str], tie: str | None, by: tuple[str, ...], lookback: int | None) -> DataFrame:
    slow = right.withColumn("__time", F.col(right_on).cast("long"))
    wanted = ["__time", *columns]
    back = asof_join(left, slow, right_on, wanted, tie, by, lookback, "backward").withColumn("__b", F.struct(*wanted)).drop(*wanted)
    both = asof_join(back, slow, right_on, wanted, tie, by, lookback, "forward").withColumn("__f", F.struct(*wanted)).drop(*wanted)
    gap: dict[str, Column] = {s: F.abs(F.col("timestamp_s") - F.col(f"{s}.__time")) for s in ("__b", "__f")}
    near = F.when(gap["__f"].isNotNull() & (gap["__b"].isNull() | (gap["__f"] <= gap["__b"])), F.col("__f")).otherwise(F.col("__b"))
    return both.withColumn("__near", near).select(*left.columns, *(F.col(f"__near.{c}").alias(c) for c in columns))
