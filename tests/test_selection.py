"""As-of join, exact quantiles, correlation and role aggregates against plain Python."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from gridmart.operators.asof import asof_nearest
from gridmart.operators.once import held, pinned, with_rollup
from gridmart.operators.quantiles import exact_quantiles
from gridmart.operators.roles import Role, group_totals, role_aggregate
from gridmart.operators.stats import correlation, delta_summary

START = dt.datetime(2024, 1, 1)


def _best(left, right, direction, seconds):
    """(smallest) nearest right row of one left row."""
    key, at = left[1], left[2]
    found = []
    for k, t, tag in right:
        if key is None or k != key or t is None or at is None:
            continue
        gap = (t - at).total_seconds()
        if abs(gap) > seconds or (direction == "backward" and gap > 0) or (direction == "forward" and gap < 0):
            continue
        found.append((abs(gap), t, tag))
    return min(found)[2] if found else None


@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
@pytest.mark.parametrize("slices", [1, 4])
def test_asof_against_all_pairs(spark, direction, slices):
    rng = random.Random(11)
    keys = ["hot"] * 6 + ["a", "b", None]

    def when(dense):
        if rng.random() < 0.03:
            return None
        return START + dt.timedelta(seconds=rng.randrange(3000) if dense else rng.randrange(200_000))

    left = [(i, rng.choice(keys), when(i % 2)) for i in range(400)]
    left += left[:5]  # repeated rows
    right = [(rng.choice(keys), when(i % 2), rng.randrange(40)) for i in range(300)]
    l_df = spark.createDataFrame(left, "id INT, k STRING, lt TIMESTAMP").repartition(3)
    r_df = spark.createDataFrame(right, "k STRING, rt TIMESTAMP, tag INT").repartition(3)
    got = asof_nearest(l_df, r_df, ["k"], "lt", "rt", 900, direction, slices)
    assert got.columns == ["id", "k", "lt", "rt", "tag"]
    want = sorted((i, _best((i, k, t), right, direction, 900)) for i, k, t in left)
    assert sorted(((r.id, r.tag) for r in got.collect()), key=str) == sorted(want, key=str)


def test_asof_pairs_nothing(spark):
    """400 left and 400 right rows in one slice: no join makes pairs of them."""
    side = spark.range(400).select(F.lit("k").alias("k"), (F.lit(START) + F.make_dt_interval(secs=F.col("id"))).alias("t"))
    got = asof_nearest(side.withColumnRenamed("t", "lt"), side.withColumnRenamed("t", "rt"), ["k"], "lt", "rt", 86400)
    assert got.filter("lt = rt").count() == 400
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_exact_quantiles(spark):
    rng = random.Random(3)
    groups = {"hot": [rng.choice([1.5, 2.0, 2.25, 9.0, rng.random()]) for _ in range(501)], "even": [4.0, 1.0, 3.0, 2.0],
              "one": [7.0], None: [5.0, 6.0], "same": [2.0] * 10}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE").repartition(5)
    got = {r.g: r for r in exact_quantiles(df, ["g"], "x", {"q1": 0.25, "med": 0.5, "top": 1.0}, partitions=6).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        s = sorted(xs)
        at = (len(s) - 1) * 0.25
        low = s[int(at)]
        q1 = low + (s[min(int(at) + 1, len(s) - 1)] - low) * (at - int(at))
        assert (got[g].med, got[g].top) == (statistics.median(xs), s[-1])
        assert got[g].q1 == pytest.approx(q1)


def test_delta_summary_median(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -2.0), ("a", 4.0), ("a", None), ("b", None)], "g STRING, d DOUBLE")
    assert [tuple(r) for r in delta_summary(df, ["g"], "d").collect()] == [("a", 3, pytest.approx(2 / 3), 1.0)]


def test_correlation_guards(spark):
    rows = [("line", 1.0, 2.0), ("line", 2.0, 4.0), ("line", 3.0, 6.0), ("flat", 5.0, 1.0), ("flat", 5.0, 9.0),
            ("one", 3.0, 3.0), ("gap", None, 1.0), ("tiny", 0.1 + 0.2, 1.0), ("tiny", 0.1 + 0.2, 2.0)]
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE, y DOUBLE")
    got = {r.g: r for r in correlation(df, ["g"], "x", "y").collect()}
    assert got["line"].corr == pytest.approx(1.0) and got["line"].covar_samp == pytest.approx(2.0)
    assert got["flat"].corr is None and got["flat"].covar_pop == 0.0 and got["tiny"].corr is None
    assert (got["one"].n, got["one"].covar_samp, got["one"].corr) == (1, None, None)
    assert "gap" not in got


def test_role_aggregate(spark):
    rows = [("t", "p", "q", 1), ("t", "p", "p", 2), ("t", None, "q", 3), ("u", "p", None, 4), ("u", None, None, 5)]
    df = spark.createDataFrame(rows, "team STRING, a STRING, b STRING, x INT")
    roles = {"from": Role(F.col("a"), {"sent": F.lit(1), "amount": F.col("x")}),
             "to": Role(F.col("b"), {"got": F.lit(1)}, {"most": F.col("x")})}
    out = role_aggregate(df, ["team"], roles, {"n": F.lit(1), "all": F.col("x")})
    got = {(r.team, r.member): r for r in out.collect()}
    assert (got["t", "p"].sent, got["t", "p"].amount, got["t", "p"].got, got["t", "p"].most) == (2, 3, 1, 2)
    assert (got["t", "q"].sent, got["t", "q"].got, got["t", "q"].most) == (None, 2, 3)
    assert set(got) == {("t", "p"), ("t", "q"), ("u", "p"), ("u", None)}
    totals = {r.team: (r.n, r["all"]) for r in group_totals(out, ["team"], ["n", "all"]).collect()}
    assert totals == {"t": (3, 6), "u": (2, 9)}
    few = role_aggregate(df, ["team"], {"from": roles["from"], "idle": Role(F.col("b"))}, {})
    assert few.columns == ["team", "member", "sent", "amount"] and few.count() == 4


def test_role_aggregate_of_events_with_one_member(spark):
    """Grouped by the member's column, not exploded; an event without a member counts for the group."""
    rows = [("t", "p", "p", None, 1), ("t", "p", None, "p", 2), ("t", "q", None, None, 3), ("t", None, None, None, 4)]
    df = spark.createDataFrame(rows, "team STRING, who STRING, a STRING, b STRING, x INT")
    roles = {"from": Role(F.col("a"), {"sent": F.lit(1)}), "to": Role(F.col("b"), {"got": F.col("x")}, {"most": F.col("x")})}
    out = role_aggregate(df, ["team"], roles, {"n": F.lit(1), "all": F.col("x")}, "who", "who")
    assert sorted((tuple(r) for r in out.collect()), key=str) == [
        ("t", "p", 1, 2, 2, 2, 3), ("t", "q", None, None, None, 1, 3), ("t", None, None, None, None, 1, 4)]
    usual = role_aggregate(df, ["team"], roles, {"n": F.lit(1), "all": F.col("x")}, "who")
    assert (sorted(tuple(r) for r in out.filter("sent > 0 OR got > 0").drop("n", "all").collect())
            == sorted(tuple(r) for r in usual.filter("sent > 0 OR got > 0").drop("n", "all").collect()))
    for a in (out, usual):
        assert [tuple(r) for r in group_totals(a, ["team"], ["n", "all"]).collect()] == [("t", 4, 10)]


def test_nothing_gets_below_held_rows(spark, tmp_dir):
    """Readers that filter and select differently share the exchange of dealt rows."""
    spark.range(100).selectExpr("id % 5 AS g", "id % 25 AS h", "IF(id % 7 = 0, NULL, id) AS x").write.parquet(f"{tmp_dir}/h")
    dealt = held(spark.read.parquet(f"{tmp_dir}/h").repartition("g"))
    out = dealt.filter("h > 3 AND x IS NOT NULL").groupBy("g").agg(F.sum("h").alias("s")).join(
        dealt.groupBy("g").agg(F.count("x").alias("n")).filter("g < 4"), "g")
    got = sorted(tuple(r) for r in out.collect())
    assert [g for g, *_ in got] == [0, 1, 2, 3] and sum(n for *_, n in got) == sum(i % 7 > 0 and i % 5 < 4 for i in range(100))
    executed = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert executed.count("FileScan") == 1


def test_pinned_results_may_be_read_any_number_of_times(spark, tmp_dir):
    spark.range(100).selectExpr("id % 5 AS g", "id % 25 AS h", "id AS x").write.parquet(f"{tmp_dir}/t")
    agg = spark.read.parquet(f"{tmp_dir}/t").groupBy("g", "h").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    out = with_rollup(agg, ["g"], {"total": F.sum("s")})
    twice = out.join(out.groupBy("h").agg(F.max("total").alias("m")), "h").join(pinned(agg).groupBy("g").count(), "g")
    assert twice.count() == 25 and out.agg(F.sum("total")).first()[0] == 5 * 4950
    out.collect()
    executed = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert executed.count("FileScan") == 1
