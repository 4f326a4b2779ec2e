"""Summary statistics: effects with confidence intervals (A15), histograms (A25), pivots
with differences (A22), median bands (A23), before/after summaries (A24), correlations (A11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.operators.quantiles import with_median
from gridmart.operators.shares import with_group_totals
from gridmart.operators.unpivot import flags_to_long

Z95 = 1.96  # fixed value: two-sided 95% normal quantile used by the reference


def effect_ci(df: DataFrame, keep: Sequence[str], flags: Sequence[str], outcome: str,
              z: float = Z95, event: str = "event") -> DataFrame:
    """Mean, sample sd and ``mean +- z*sd/sqrt(n)`` of ``outcome`` for each 0/1 flag.

    The flags are unpivoted once (instead of one UNION branch per flag), so the input is
    scanned once and aggregated once.
    """
    long = flags_to_long(df.select(*keep, *flags, outcome), [*keep, outcome], flags, event)
    agg = long.groupBy(*keep, event).agg(
        F.count(F.lit(1)).alias("n"), F.avg(outcome).alias("mean_effect"),
        F.stddev_samp(outcome).alias("sd_effect"))
    half = F.lit(z) * F.col("sd_effect") / F.sqrt(F.col("n"))
    return agg.withColumns({"ci_lo": F.col("mean_effect") - half, "ci_hi": F.col("mean_effect") + half})


def histogram(df: DataFrame, value: str, max_bins: int = 30, group: Sequence[str] = ()) -> DataFrame:
    """Fixed-width histogram with at most ``max_bins`` bins between min and max of ``value``.

    Min and max come from one partial aggregate (a row per group) joined back; the bin
    counts are a second grouped aggregate. The top edge falls into the last bin.
    """
    x = F.col(value)
    v = df.select(*group, value).filter(x.isNotNull())
    v = with_group_totals(v, list(group), {"__mn": F.min(value), "__mx": F.max(value)})
    width = (F.col("__mx") - F.col("__mn")) / F.lit(max_bins)
    raw = F.when(width > 0, F.floor((x - F.col("__mn")) / width)).otherwise(F.lit(0))
    binned = v.withColumn("bin", F.least(raw, F.lit(max_bins - 1)).cast("int"))
    out = binned.groupBy(*group, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("__mn").alias("__mn"), F.first("__mx").alias("__mx"))
    w = (F.col("__mx") - F.col("__mn")) / F.lit(max_bins)
    return out.select(*group, "bin", "n", (F.col("__mn") + F.col("bin") * w).alias("bin_lo"),
                      (F.col("__mn") + (F.col("bin") + 1) * w).alias("bin_hi"))


def pivot_diff(df: DataFrame, group: Sequence[str], category: str, values: Sequence[str],
               measure: str, minuend: str, subtrahend: str, diff: str = "diff") -> DataFrame:
    """Average ``measure`` per category as columns (missing category = 0), plus
    ``minuend - subtrahend``. ``values`` is the fixed category list, so the pivot needs no
    extra distinct pass."""
    wide = df.groupBy(*group).pivot(category, list(values)).agg(F.avg(measure))
    wide = wide.fillna(0.0, subset=list(values))
    return wide.withColumn(diff, F.col(minuend) - F.col(subtrahend))


def median_band(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Exact median and median +- one sample standard deviation."""
    agg = with_median(df.groupBy(*group).agg(F.stddev_samp(value).alias("sd")), df, group, value, "median")
    return agg.select(*group, "median", "sd", (F.col("median") - F.col("sd")).alias("band_lo"),
                      (F.col("median") + F.col("sd")).alias("band_hi"))


def delta_summary(df: DataFrame, group: Sequence[str], delta: str) -> DataFrame:
    """Count, share with a positive delta, and exact median delta per group."""
    known = df.filter(F.col(delta).isNotNull())
    agg = known.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), (F.count_if(F.col(delta) > 0) / F.count(F.lit(1))).alias("share_improved"))
    return with_median(agg, known, group, delta, "median_delta")


def correlation(df: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """Rows with both values, population and sample covariance and Pearson correlation per
    group. The co-moments merge on the map side, so no rows are paired or gathered. The
    correlation is NULL where an input is constant (a single row too), where plain ``corr``
    divides by zero or gives NaN; the test compares minimum and maximum, not a rounded variance."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    constant = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return both.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop(x, y).alias("covar_pop"),
        F.when(F.count(F.lit(1)) > 1, F.covar_samp(x, y)).alias("covar_samp"),
        F.when(~constant, F.try_divide(F.covar_pop(x, y), spread)).alias("corr"))
