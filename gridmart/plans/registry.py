"""Registry of driver queries: name -> (Spark builder, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    fn: QueryFn
    sql: str | None


_REGISTRY: dict[str, Registered] = {}


def portable_round(sql: str) -> str:
    """Rewrite every two-argument ``round(x, d)`` as ``floor(x * 1ed + 0.5) / 1ed``,
    the same rule as :func:`gridmart.functions.columns.round_half_up` on the Spark side,
    so both engines round an identical double identically (their ``round`` functions
    disagree on ties). One-argument ``round(x)`` is left alone."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner = sql[j + 6:k - 1]
        if comma < 0:
            out.append(sql[i:j] + "round(" + portable_round(inner) + ")")
        else:
            expr, digits = portable_round(sql[j + 6:comma]), sql[comma + 1:k - 1].strip()
            bound = 9e15 / 10 ** int(digits)
            out.append(sql[i:j] + f"(CASE WHEN abs({expr}) < {bound!r} THEN floor(({expr}) * 1e{digits} + 0.5)"
                       f" / 1e{digits} ELSE CAST({expr} AS DOUBLE) END)")
        i = k


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its DuckDB oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = Registered(name, fn, portable_round(sql) if sql else None)
        return fn

    return deco


def _load_all() -> None:
    # Importing the modules runs their @register decorators.
    from gridmart.plans import (  # noqa: F401
        q_core, q_gold, q_joins, q_windows, q_marts, q_lake, q_league, q_pbp)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: r.fn for k, r in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: r.sql for k, r in _REGISTRY.items() if r.sql}
