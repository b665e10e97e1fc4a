"""Row frames of any length at a cost that grows with the logarithm of the frame.

A frame is put together from shorter frames that end earlier: the last 60 rows are the last 30 and, 30 rows before, the
last 30. Sums, maxima and minima thus need additions and comparisons of lagged values only: no running sum is subtracted
from another, and a large value leaves no trace after its frame. Longer windows continue from shorter ones. All lags have
one partitioning and one order, so all windows together are one shuffle and one sort. A month is cut in chunks, each with
the rows before it that its frames reach, so a month's features are made by many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import ratio
from .bucket import series_window

#: A frame grows by these factors, by one unit where none divides it.
FACTORS = (2, 3, 5, 7)
#: Rows of a chunk, at least; it is also at least eight times the longest frame.
CHUNK_ROWS = 86_400
WINDOWS = (30, 60, 300, 900, 3600)
FEATURES = ("volume_sum", "quote_volume_sum", "buy_ratio", "volatility", "vwap", "trade_count", "volume_imbalance", "return", "range")
#: Part of the sum of squares (of a frame, or up to the row where frames are differences) below which a difference is noise.
NOISE = 1e-12


def running_sums(df: DataFrame, columns: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    so_far = series_window(by).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({name: F.sum(c).over(so_far) for name, c in columns.items()})


def trailing(prefix: str, w: int, by: tuple[str, ...] = ()) -> Column:
    """Sum over the last ``w`` rows, this one included, from a running sum."""
    return F.col(prefix) - F.coalesce(F.lag(prefix, w).over(series_window(by)), F.lit(0))


def variance(n: Column, s: Column, ss: Column, noise: Column, ddof: int) -> Column:
    """Variance from count, sum and sum of squares; differences within NOISE of ``noise`` are 0."""
    spread = ss - F.try_divide(s * s, n)
    return F.when(n > ddof, F.when(spread <= noise * NOISE, 0.0).otherwise(spread) / (n - ddof))


_PICKS = {"sum": lambda a, b: a + b, "max": F.greatest, "min": F.least}


def _steps(times: int) -> list[int]:
    """Factors that lead from 1 to ``times``; 0 stands for one more."""
    steps = []
    while times > 1:
        steps.append(next((f for f in FACTORS if times % f == 0), 0))
        times = times // steps[-1] if steps[-1] else times - 1
    return steps[::-1]


def lengthened(df: DataFrame, unit: int, times: int, kinds: dict[str, str], by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` whose columns ``kinds`` (name -> sum, max or min), which hold frames of the last ``unit`` rows, hold frames of
    ``unit * times`` rows, or of as many as there are. Columns that are summed must not be NULL."""
    series, steps, length = series_window(by), _steps(times), unit

    def before(column: str, rows: int, kind: str) -> Column:
        found = F.lag(column, rows).over(series)
        return F.coalesce(found, F.lit(0)) if kind == "sum" else found

    def joined(kind: str, parts: list[Column]) -> Column:
        return reduce(_PICKS[kind], parts)

    if 0 in steps:
        df = df.withColumns({f"__unit_{name}": F.col(name) for name in kinds})
    for step in steps:
        if step:
            df = df.withColumns({name: joined(kind, [F.col(name), *(before(name, length * i, kind) for i in range(1, step))]) for name, kind in kinds.items()})
            length *= step
        else:
            df = df.withColumns({name: joined(kind, [F.col(f"__unit_{name}"), before(name, unit, kind)]) for name, kind in kinds.items()})
            length += unit
    return df.drop(*(f"__unit_{name}" for name in kinds))


def chunked(series: DataFrame, reach: int, by: tuple[str, ...] = (), ahead: bool = False) -> DataFrame:
    """``series`` with ``__chunk`` and ``__own``: months in chunks, and before each chunk (``ahead``: behind it), not its own, the ``reach``
    rows that lead up to it (that follow it)."""
    size = max(CHUNK_ROWS, 8 * reach)
    at = F.row_number().over(series_window(by)) - 1
    numbered = series.withColumn("__at", at)
    home = F.floor(F.col("__at") / size).cast("int")
    within = F.col("__at") % size
    led = F.when((within < reach) & (home > 0), F.array(home - 1, home)) if ahead else F.when(within >= size - reach, F.array(home, home + 1))
    return numbered.withColumn("__home", home).withColumn("__chunk", F.explode(led.otherwise(F.array(home)))).withColumn("__own", F.expr("__chunk = __home")).drop("__at", "__home")


def rolling_features(series: DataFrame, windows: tuple[int, ...] = WINDOWS, by: tuple[str, ...] = ()) -> DataFrame:
    """Nine columns for each window over the dense series: volume_sum, quote_volume_sum, buy_ratio, volatility, vwap,
    trade_count, volume_imbalance, return, range."""
    keys = (*by, "__chunk")
    x = F.col("price_return")
    raw = {"__v": F.col("volume"), "__q": F.col("quote_volume"), "__b": F.col("buy_volume"), "__s": F.col("sell_volume"), "__n": F.col("trade_count"), "__x": F.coalesce(x, F.lit(0.0)), "__xx": F.coalesce(x * x, F.lit(0.0)), "__k": F.when(x.isNotNull(), 1).otherwise(0), "__hi": F.col("high"), "__lo": F.col("low")}
    kinds = {name: {"__hi": "max", "__lo": "min"}.get(name, "sum") for name in raw}
    v, q, b, s, n, sx, sxx, k = (F.col(name) for name in raw if kinds[name] == "sum")
    made = chunked(series, max(windows), by).withColumns(raw)
    last = 1
    for w in sorted(windows):
        if w % last:  # no multiple of the window before: from single rows again
            made, last = made.withColumns(raw), 1
        made, last = lengthened(made, last, w // last, kinds, keys), w
        close_before = F.lag("close", w).over(series_window(keys))
        made = made.withColumns({
            f"volume_sum_{w}s": v,
            f"quote_volume_sum_{w}s": q,
            f"buy_ratio_{w}s": ratio(b, v, 0.5),
            f"volatility_{w}s": F.coalesce(F.sqrt(variance(k, sx, sxx, sxx, 1)), F.lit(0.0)),
            f"vwap_{w}s": ratio(q, v, F.col("close")),
            f"trade_count_{w}s": n,
            f"volume_imbalance_{w}s": ratio(b - s, b + s, 0.0),
            f"return_{w}s": F.coalesce(ratio(F.col("close"), close_before) - 1, F.lit(0.0)),
            f"range_{w}s": F.col("__hi") - F.col("__lo"),
        })
    names = [f"{kind}_{w}s" for w in windows for kind in FEATURES]
    return made.where("__own").select(*series.columns, *names)
