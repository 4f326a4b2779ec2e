"""Landing readers, constants and id helpers on rows of their own."""

from __future__ import annotations

import os

import pytest

from gridmart.functions.football import leverage
from gridmart.operators.crosswalk import fill_id_fallbacks, merge_id_tables, resolve_ids
from gridmart.plans.reports import run_reports, write_quality
from gridmart.sources.landing import parse_years, read_landing, with_constant
from gridmart.sources.lake import read_precomputed


@pytest.mark.parametrize("spec,years", [
    ("2031-2034", [2031, 2032, 2033, 2034]), ("2034-2032", [2032, 2033, 2034]), (" 2040 , 2038,,2040", [2038, 2040]),
    ("2029,2031-2032", [2029, 2031, 2032]), (2050, [2050]), ([2041, 2039, 2041], [2039, 2041]), ("", [])])
def test_year_lists(spec, years):
    assert parse_years(spec) == years


def test_a_constant_fills_gaps_only(spark):
    df = spark.createDataFrame([("kept",), (None,), ("",)], "label STRING")
    assert [r.label for r in with_constant(df, "label", "new").collect()] == ["kept", "new", ""]
    assert {(r.label, r.run) for r in with_constant(df, "run", 7).collect()} == {("kept", 7), (None, 7), ("", 7)}


def test_fallback_ids_keep_their_order_and_prefix(spark):
    df = spark.createDataFrame([("own", "b", 3), (None, "b", 3), (None, None, 3), (None, None, None)],
                               "id STRING, second STRING, third INT")
    out = fill_id_fallbacks(df, [("absent", "x_"), ("second", "s:"), ("third", "t:")], "id")
    assert [r.id for r in out.collect()] == ["own", "s:b", "t:3", None]
    assert fill_id_fallbacks(df.drop("id", "second", "third"), [("absent", "")], "id").columns == ["id"]


def test_crosswalk_tries_candidates_and_never_multiplies(spark):
    lookup = spark.createDataFrame([("c2", "k", None), ("c1", "k", None), (None, "m", "w"), ("c9", None, " w ")],
                                   "canon STRING, alpha STRING, beta STRING")
    rows = spark.createDataFrame([(1, " c5 ", "k", None), (2, "", "k", "w"), (3, None, "m", "w"), (4, None, None, "zz")],
                                 "i INT, canon_id STRING, a STRING, b STRING")
    got = resolve_ids(rows, lookup, [("canon_id", "canon"), ("a", "alpha"), ("b", "beta"), ("gone", "alpha")], "canon", "id")
    assert {r.i: r.id for r in got.collect()} == {1: "c5", 2: "c1", 3: "c9", 4: None} and got.count() == 4


def test_id_tables_meet_in_an_outer_merge(spark):
    a, b, c = (spark.createDataFrame(rows, f"k INT, {n} STRING")
               for n, rows in (("x", [(1, "x1"), (2, "x2")]), ("y", [(2, "y2"), (3, "y3")]), ("z", [(3, "z3")])))
    got = {r.k: (r.x, r.y, r.z) for r in merge_id_tables([a, b, c], "k").collect()}
    assert got == {1: ("x1", None, None), 2: ("x2", "y2", None), 3: (None, "y3", "z3")}


def test_read_landing_and_reports(spark, tmp_dir):
    for y in (2023, 2024):
        spark.createDataFrame([(1, "x")], "v INT, s STRING").write.parquet(os.path.join(tmp_dir, "weekly", f"{y}.parquet"))
    df = read_landing(spark, tmp_dir, "weekly", "2022-2024")
    assert sorted(r.season for r in df.collect()) == [2023, 2024]
    out = os.path.join(tmp_dir, "reports")
    run_reports(spark, "", out, {"one": lambda s, _: s.createDataFrame([(1,)], "x INT")})
    assert read_precomputed(spark, os.path.join(out, "one")).count() == 1
    write_quality(spark.createDataFrame([("weekly", 3)], "dataset STRING, rows INT"), os.path.join(tmp_dir, "q"))
    assert spark.read.json(os.path.join(tmp_dir, "q")).count() == 1


def test_leverage(spark):
    df = spark.createDataFrame([(10.0, 0.25), (8.0, None)], "proj DOUBLE, own DOUBLE")
    assert [r.x for r in df.select(leverage("proj", "own").alias("x")).collect()] == [7.5, 8.0]
