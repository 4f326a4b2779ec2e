"""Id resolution: crosswalks through lookup tables (J10), prefixed fallbacks (J11),
outer merge of id tables (J12).

Each lookup is reduced to one row per source id before it is joined (no fan-out,
SURVEY Q8); an id table is small next to the facts and key-unique after that step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(c: Column) -> Column:
    """Non-empty trimmed text or NULL."""
    t = F.trim(c.cast("string"))
    return F.when(F.length(t) > 0, t)


def fill_id_fallbacks(df: DataFrame, fallbacks: Sequence[tuple[str, str]], target: str = "player_id") -> DataFrame:
    """Keep ``target`` where set, else the first fallback column present, each with
    its prefix (``[("gsis_id", ""), ("pfr_player_id", "pfr_")]``)."""
    parts = [F.col(target).cast("string")] if target in df.columns else []
    for col, prefix in fallbacks:
        if col in df.columns:
            v = F.col(col).cast("string")
            parts.append(F.concat(F.lit(prefix), v) if prefix else v)
    return df.withColumn(target, F.coalesce(*parts) if parts else F.lit(None).cast("string"))


def resolve_ids(df: DataFrame, lookup: DataFrame, candidates: Sequence[tuple[str, str]],
                canonical: str = "gsis_id", target: str = "resolved_id", source: str | None = None) -> DataFrame:
    """Try ``(source column, lookup column)`` pairs in order; a source already in the
    canonical id space is taken as is, others map through ``lookup``; first non-null wins.
    ``source`` names a column for the source column that won."""
    out = df
    parts, names = [], []
    for i, (src, look) in enumerate(candidates):
        if src not in df.columns:
            continue
        names.append(src)
        if look == canonical:
            parts.append(_text(F.col(src)))
            continue
        m = (lookup.select(_text(F.col(look)).alias(f"__k{i}"), _text(F.col(canonical)).alias(f"__v{i}"))
             .dropna().groupBy(f"__k{i}").agg(F.min(f"__v{i}").alias(f"__v{i}")))
        out = out.join(m, _text(out[src]) == m[f"__k{i}"], "left").drop(f"__k{i}")
        parts.append(F.col(f"__v{i}"))
    resolved = F.coalesce(*parts) if parts else F.lit(None).cast("string")
    new = {target: resolved}
    if source:
        new[source] = F.coalesce(*[F.when(v.isNotNull(), F.lit(n)) for v, n in zip(parts, names, strict=True)], F.lit(None))
    return out.withColumns(new).drop(*[c for c in out.columns if c.startswith("__v")])


def enrich_names(df: DataFrame, key: str, lookups: Sequence[tuple[str, DataFrame, str, str]], target: str = "player_name",
                 source: str | None = None) -> DataFrame:
    """The first non-null name of ``lookups`` ((label, table, key column, name column), best
    first) for every row; a name that the row has already stays. Each lookup is reduced to one
    row per key (the smallest name) before its join, so no row is multiplied. ``source`` names a
    column for the label that won (NULL for the row's own name)."""
    out = df
    parts = [F.col(target)] if target in df.columns else []
    labels: list[Column] = [F.when(F.col(target).isNotNull(), F.lit(None).cast("string"))] if parts else []
    for i, (label, table, k, name) in enumerate(lookups):
        one = table.filter(F.col(name).isNotNull()).groupBy(F.col(k).alias(f"__n{i}")).agg(F.min(name).alias(f"__name{i}"))
        out = out.join(one, out[key] == one[f"__n{i}"], "left").drop(f"__n{i}")
        parts.append(F.col(f"__name{i}"))
    new = {target: F.coalesce(*parts)}
    if source:
        expr = F.when(parts[0].isNotNull(), F.lit(None)) if labels else None
        for (label, *_), v in zip(lookups, parts[len(labels):], strict=True):
            expr = F.when(v.isNotNull(), F.lit(label)) if expr is None else expr.when(v.isNotNull(), F.lit(label))
        new[source] = expr.cast("string")
    return out.withColumns(new).drop(*[f"__name{i}" for i in range(len(lookups))])


def merge_id_tables(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """FULL OUTER JOIN of id tables on a shared key (columns other than the key
    must be distinct across tables)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, key, "full")
    return out
