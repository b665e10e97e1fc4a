"""Forward-looking labels and the leakage check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import correlation, ratio
from .bucket import series_window
from .rolling import chunked, lengthened, variance

HORIZONS = {"30s": 30, "1m": 60, "3m": 180, "5m": 300}


def make_labels(series: DataFrame, horizons: dict[str, int] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """``timestamp_s, month`` and for each horizon h rows ahead: mu = ln(close[t+h] / close[t]); sigma = population std of
    the returns of rows t+1 .. t+h, NULL unless all are there; direction = 1.0 if the later close is higher, else
    0.0 (also where there is none). A return is (close - previous close) / close, 0 for the first row.

    ``series`` must hold raw prices. A month is cut in chunks, each with the rows behind it that its horizons reach."""
    horizons = horizons or HORIZONS
    if "close" not in series.columns:
        raise ValueError("labels need the column close")
    r = F.coalesce((F.col("close") - F.lag("close").over(series_window(by))) / F.greatest(F.col("close"), F.lit(1e-10)), F.lit(0.0))
    raw = {"__s": F.col("__r"), "__q": F.col("__r") * F.col("__r")}
    keys = (*by, "__chunk")
    w = series_window(keys)
    out = chunked(series.select(*by, "month", "timestamp_s", "close").withColumn("__r", r), max(horizons.values()), by, ahead=True).withColumns(raw)
    last = 1
    for n, h in sorted(horizons.items(), key=lambda x: x[1]):
        if h % last:  # no multiple of the horizon before: from single rows again
            out, last = out.withColumns(raw), 1
        out, last = lengthened(out, last, h // last, {"__s": "sum", "__q": "sum"}, keys), h  # of the last h rows: h rows ahead, of the next
        out = out.withColumns({f"__{x}": F.lead(c, h).over(w) for x, c in (("later", "close"), ("sh", "__s"), ("qh", "__q"))})
        later, s, q = F.col("__later"), F.col("__sh"), F.col("__qh")
        out = out.withColumns({f"mu_{n}": F.ln(ratio(later, F.col("close"))), f"sigma_{n}": F.sqrt(variance(F.when(s.isNotNull(), h), s, q, q, 0)), f"direction_{n}": F.coalesce(later > F.col("close"), F.lit(False)).cast("float")})
    return out.where("__own").select(*by, "month", "timestamp_s", *(f"{kind}_{n}" for n in horizons for kind in ("mu", "sigma", "direction")))


def leakage(features: DataFrame, labels: DataFrame, columns: list[str], label: str = "mu_30s", rows: int | None = None, seed: int = 42, by: tuple[str, ...] = (), report: tuple[str, ...] = ()) -> DataFrame:
    """``feature, corr_now, corr_before, suspicious`` (for each key of ``report``, such as the month): the correlation of a
    feature with the label, and of its value one row earlier; suspicious if |now| > 0.5 and |now| > 2 |before|. ``rows`` takes
    that many rows, by hash of the key."""
    keys = [*by, "month", "timestamp_s"]
    joined = features.select(*keys, *columns).join(labels.select(*keys, label), keys).where(F.col(label).isNotNull())
    shifted = joined.withColumns({f"__before_{c}": F.lag(c).over(series_window(by)) for c in columns})
    if rows is not None:
        shifted = shifted.orderBy(F.xxhash64(*by, "timestamp_s", F.lit(seed)), *by, "timestamp_s").limit(rows)
    pairs = [F.struct(F.lit(c).alias("feature"), correlation(F.col(c), F.col(label)).alias("corr_now"), correlation(F.col(f"__before_{c}"), F.col(label)).alias("corr_before")) for c in columns]
    found = shifted.groupBy(*report).agg(F.array(*pairs).alias("p")).select(*report, F.explode("p").alias("p")).select(*report, "p.*")
    now, before = F.abs("corr_now"), F.coalesce(F.abs("corr_before"), F.lit(0.0))
    return found.withColumn("suspicious", F.coalesce((now > 0.5) & (now > 2 * before), F.lit(False)))


def no_leakage(features: DataFrame, labels: DataFrame, columns: list[str], label: str = "mu_30s", by: tuple[str, ...] = ()) -> DataFrame:
    """One row a month (and key of ``by``) ``n_rows, n_common, no_leakage``: true under 1,000 rows or 100 common keys, else if no
    feature is suspicious."""
    keys = [*by, "month"]
    rows = features.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    common = features.select(*keys, "timestamp_s").join(labels.select(*keys, "timestamp_s"), [*keys, "timestamp_s"], "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_common"))
    verdict = leakage(features, labels, columns, label, by=by, report=tuple(keys)).groupBy(*keys).agg(F.coalesce(~F.bool_or("suspicious"), F.lit(True)).alias("clean"))
    few = (F.col("n_rows") < 1000) | (F.col("n_common") < 100)
    told = rows.join(common, keys, "left").join(verdict, keys, "left").na.fill(0, ["n_common"])
    return told.select(*keys, "n_rows", "n_common", (few | F.coalesce("clean", F.lit(True))).alias("no_leakage"))


def top_correlations(features: DataFrame, labels: DataFrame, columns: list[str], label: str, top: int = 20, by: tuple[str, ...] = (), last: bool = False) -> DataFrame:
    """The ``top`` features by absolute correlation with the label, or the ``last`` ones."""
    keys = [*by, "month", "timestamp_s"]
    joined = features.select(*keys, *columns).join(labels.select(*keys, label), keys)
    wide = joined.agg(*(correlation(F.col(c), F.col(label)).alias(c) for c in columns))
    size = F.abs("corr")
    return wide.unpivot([], columns, "feature", "corr").where("corr is not null").orderBy(size.asc() if last else size.desc(), "feature").limit(top)
