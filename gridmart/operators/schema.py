"""Schema harmonisation for drifting datasets.

The common type of two columns follows the reference's lattice:
equal -> same; NULL(void) -> the other; any text -> text; integer + integer -> BIGINT;
any other numeric mix -> DOUBLE; anything else -> text. Casts are non-strict
(``try_cast``), so a value that does not fit becomes NULL instead of failing the job.

Spark's own union coercion is not used on purpose: with ANSI on it turns
BOOLEAN u STRING into BOOLEAN and ``mergeSchema`` rejects FLOAT vs DOUBLE.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (*_INTEGRAL, T.FloatType, T.DoubleType, T.DecimalType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The reference's merge lattice on Spark types."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        return T.StringType()
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return T.LongType()
    if isinstance(a, _NUMERIC) and isinstance(b, _NUMERIC):
        return T.DoubleType()
    return T.StringType()


def target_schema(schemas: Sequence[T.StructType]) -> dict[str, T.DataType]:
    """Column -> common type over all schemas, in first-seen column order."""
    out: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            out[f.name] = common_type(out[f.name], f.dataType) if f.name in out else f.dataType
    return {k: (T.StringType() if isinstance(v, T.NullType) else v) for k, v in out.items()}


def conform(df: DataFrame, target: dict[str, T.DataType]) -> DataFrame:
    """Cast ``df`` to ``target`` (missing columns as typed NULLs), in target order."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name, dtype in target.items():
        if name not in have:
            cols.append(F.lit(None).cast(dtype).alias(name))
        elif have[name] == dtype:
            cols.append(F.col(name))
        else:
            cols.append(F.col(name).try_cast(dtype).alias(name))
    return df.select(*cols)


def union_harmonised(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name after casting every frame to the common schema."""
    if not frames:
        raise ValueError("nothing to union")
    target = target_schema([f.schema for f in frames])
    return reduce(lambda a, b: a.unionByName(b), [conform(f, target) for f in frames])


def normalise_common(df: DataFrame) -> DataFrame:
    """M7: ``*_id`` (except ``play_id``) as text; ``play_id`` via double -> round -> BIGINT;
    ``year``/``season`` as BIGINT; all-NULL (void) columns as text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name == "play_id":
            c = F.round(c.try_cast("double"), 0).try_cast("bigint")
        elif f.name.endswith("_id"):
            c = c.cast("string")
        elif f.name in ("year", "season"):
            c = c.try_cast("bigint")
        elif isinstance(f.dataType, T.NullType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)
