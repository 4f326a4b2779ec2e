"""Landing-zone readers and clean-ups.

The reference fetches upstream files over the network; here the same files are read
from a landing directory (``{landing}/{dataset}/{year}.{fmt}``) and cleaned with column
expressions. Fetching itself is out of scope.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_years(spec: str | int | Sequence[int]) -> list[int]:
    """``"1999-2024"`` (inclusive range), ``"1999,2001"`` (list) or a single year."""
    if isinstance(spec, int):
        return [spec]
    if not isinstance(spec, str):
        return sorted({int(y) for y in spec})
    years: set[int] = set()
    for part in spec.split(","):
        part = part.strip()
        if not part:
            continue
        if "-" in part:
            lo, hi = (int(x) for x in part.split("-", 1))
            years.update(range(min(lo, hi), max(lo, hi) + 1))
        else:
            years.add(int(part))
    return sorted(years)


def read_landing(spark: SparkSession, landing: str, dataset: str, years: str | Sequence[int],
                 fmt: str = "parquet", options: Mapping[str, str] | None = None) -> DataFrame:
    """One read over the landed files of the requested years (missing years skipped).

    ``season`` is taken from the file name when the file lacks it, so partition columns
    are always present.
    """
    from gridmart.sources.lake import _exists

    paths = [f"{landing.rstrip('/')}/{dataset}/{y}.{fmt}" for y in parse_years(years)]
    paths = [p for p in paths if _exists(spark, p, fmt)]
    if not paths:
        raise FileNotFoundError(f"no landed files for {dataset} {years}")
    reader = spark.read.format(fmt).options(**(options or {}))
    df = reader.load(paths)
    if "season" not in df.columns:
        # ``{year}.{fmt}`` is a file or a directory of part files.
        year = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4})\." + fmt + r"(?:/|$)", 1).try_cast("int")
        df = df.withColumn("season", year)
    return df


def with_constant(df: DataFrame, col: str, value) -> DataFrame:
    """Add ``col`` as a constant, or fill its NULLs without overwriting values."""
    if col in df.columns:
        return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    return df.withColumn(col, F.lit(value))


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M17 (rosters): numeric text to DOUBLE, bad values NULL (``errors='coerce'``)."""
    return df.withColumns({c: F.col(c).cast("string").try_cast("double") for c in cols if c in df.columns})


def depth_chart_position(df: DataFrame) -> DataFrame:
    """M17 (depth charts): ``position`` from ``pos_abb``, else ``pos_name``."""
    parts = [F.col(c) for c in ("position", "pos_abb", "pos_name") if c in df.columns]
    return df.withColumn("position", F.coalesce(*parts)) if parts else df


def ids_as_text(df: DataFrame) -> DataFrame:
    """M17 (ids, players): every ``*_id`` column as trimmed text, empty -> NULL."""
    cols = {}
    for c in df.columns:
        if c.endswith("_id") or c == "gsis_id":
            t = F.trim(F.col(c).cast("string"))
            cols[c] = F.when(F.length(t) > 0, t)
    return df.withColumns(cols)


def unresolved_ids(df: DataFrame, col: str = "player_id") -> DataFrame:
    """Count of rows whose id could not be resolved (one aggregate row)."""
    return df.agg(F.count_if(F.col(col).isNull()).alias("unresolved"), F.count(F.lit(1)).alias("rows"))
