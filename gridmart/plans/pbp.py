"""Efficiency tables and leader boards over true plays.

A table is declared once (:class:`PlayTable`) and built as one aggregate over the plays: counts
of conditions, sums, means and rates by keys, with thresholds and an optional best-n per season.
``season`` and ``through_week`` become literal predicates on the raw columns; without them all
seasons are computed at once, each with its own leader board.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions import football as fb
from gridmart.functions.columns import share
from gridmart.operators.once import pinned
from gridmart.operators.ranking import top_n_per_group
from gridmart.operators.shares import null_safe_join
from gridmart.plans.league import mean6

TRUE_PLAYS, QUALIFYING = "true", "qualifying"


@dataclass(frozen=True)
class PlayTable:
    """``keys`` / ``labels`` / ``counts`` / ``sums`` / ``means``: column -> SQL expression over a play
    (labels are its largest value, counts conditions); ``rates``: column -> (numerator,
    denominator) among the columns; ``having`` and ``best`` (column, n) over the columns."""

    keys: Mapping[str, str]
    where: str = "true"
    counts: Mapping[str, str] = field(default_factory=dict)
    sums: Mapping[str, str] = field(default_factory=dict)
    means: Mapping[str, str] = field(default_factory=dict)
    labels: Mapping[str, str] = field(default_factory=dict)
    rates: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    having: str = "true"
    best: tuple[str, int] | None = None
    plays: str = TRUE_PLAYS
    hidden: tuple[str, ...] = ()


_TEAM = {"team": "posteam"}
_PASSER = {"player_id": "passer_player_id", "player_name": "COALESCE(passer_player_name, passer)"}
_RECEIVER, _RUSHER = "COALESCE(receiver_player_id, receiver_id)", "COALESCE(rusher_player_id, rusher_id)"
_RECEIVER_NAME, _RUSHER_NAME = "COALESCE(receiver_player_name, receiver)", "COALESCE(rusher_player_name, rusher)"

# Thresholds, buckets and board sizes of the saved queries.
TABLES: dict[str, PlayTable] = {
    "league_efficiency": PlayTable(  # D23
        {"week": "week"}, plays=QUALIFYING, means={
            "epa_all": "epa", "epa_pass": "CASE WHEN pass = 1 THEN epa END",
            "epa_rush": "CASE WHEN rush_attempt = 1 THEN epa END"}),
    "defense_epa_by_week": PlayTable(  # D29
        {"team": "defteam", "week": "week"}, "defteam IS NOT NULL", {"plays": "true"}, {"epa": "epa"},
        {"success_rate_allowed": "success", "opponent_pass_rate": "pass", "opponent_rush_rate": "rush"},
        rates={"epa_per_play_allowed": ("epa", "plays")}, hidden=("epa",)),
    "offense_epa_by_week": PlayTable(  # D38
        {**_TEAM, "week": "week"}, "posteam IS NOT NULL", {"plays": "true"}, {"epa": "epa"},
        {"success_rate": "success", "pass_rate": "pass", "rush_rate": "rush"},
        rates={"epa_per_play": ("epa", "plays")}, hidden=("epa",)),
    "explosive_play_rate": PlayTable(  # D31
        _TEAM, "posteam IS NOT NULL",
        {"plays": "true", "explosive_passes": "pass = 1 AND yards_gained >= 20",
         "explosive_rushes": "rush = 1 AND yards_gained >= 10",
         "explosive_total": "pass = 1 AND yards_gained >= 20 OR rush = 1 AND yards_gained >= 10"},
        rates={"explosive_pass_rate": ("explosive_passes", "plays"), "explosive_rush_rate": ("explosive_rushes", "plays"),
               "explosive_play_rate": ("explosive_total", "plays")}),
    "fourth_down_go_rate": PlayTable(  # D32
        _TEAM, "posteam IS NOT NULL AND down = 4",
        {"fourth_down_plays": "true", "go_for_it_plays": "pass = 1 OR rush = 1",
         "successful_go_plays": "(pass = 1 OR rush = 1) AND first_down = 1"},
        rates={"go_rate": ("go_for_it_plays", "fourth_down_plays"),
               "go_success_rate": ("successful_go_plays", "go_for_it_plays")}, having="fourth_down_plays >= 5"),
    "red_zone_performance": PlayTable(  # D36
        _TEAM, "posteam IS NOT NULL AND yardline_100 <= 20",
        {"rz_plays": "true", "rz_tds": "touchdown = 1", "made_fgs": "field_goal_attempt = 1 AND field_goal_result = 'good'"},
        {"epa": "epa"}, {"rz_success_rate": "success"}, rates={"rz_epa_per_play": ("epa", "rz_plays")}, hidden=("epa",)),
    "third_down_conversion": PlayTable(  # D39
        {**_TEAM, "togo_bucket": "CASE WHEN ydstogo <= 2 THEN '1-2' WHEN ydstogo <= 5 THEN '3-5' WHEN ydstogo <= 8 THEN '6-8' "
                                 "WHEN ydstogo <= 12 THEN '9-12' ELSE '13+' END"},
        "down = 3", {"attempts": "true", "conversions": "first_down = 1"}, means={"pass_rate": "pass"},
        rates={"conversion_rate": ("conversions", "attempts")}),
    "pass_location_length": PlayTable(  # D40
        {"pass_length": "pass_length", "pass_location": "pass_location"}, "pass = 1", {"attempts": "true"},
        means={"success_rate": "success", "epa_per_att": "epa"}),
    "run_gap_location": PlayTable(  # D49
        {"run_location": "run_location", "run_gap": "run_gap"}, "rush = 1", {"attempts": "true"},
        means={"success_rate": "success", "epa_per_rush": "epa"}),
    "passing_leaders": PlayTable(  # D41
        _PASSER, "passer_player_id IS NOT NULL",
        {"att": "pass_attempt = 1", "cmp": "complete_pass = 1", "td": "pass_touchdown = 1", "ints": "interception = 1"},
        {"yds": "COALESCE(passing_yards, 0)"}, rates={"ypa": ("yds", "att")}, best=("yds", 100)),
    "qb_air_yac_split": PlayTable(  # D42
        _PASSER, "passer_player_id IS NOT NULL", {"attempts": "pass_attempt = 1", "completions": "complete_pass = 1"},
        {"air": "air_epa", "yac": "yac_epa", "total": "epa"},
        {"avg_air_yards": "air_yards", "avg_yac_on_comp": "CASE WHEN complete_pass = 1 THEN yards_after_catch END"},
        rates={"air_epa_per_att": ("air", "attempts"), "yac_epa_per_att": ("yac", "attempts"),
               "total_epa_per_att": ("total", "attempts")}, having="attempts >= 100", hidden=("air", "yac", "total")),
    "qb_epa_cpoe": PlayTable(  # D43
        _PASSER, "passer_player_id IS NOT NULL",
        {"dropbacks": "qb_dropback = 1", "attempts": "pass_attempt = 1", "completions": "complete_pass = 1", "sacks": "sack = 1",
         "interceptions": "interception = 1", "pass_tds": "pass_touchdown = 1"},
        {"epa": "epa"}, {"avg_cpoe": "CASE WHEN pass_attempt = 1 THEN cpoe END", "avg_cp": "CASE WHEN pass_attempt = 1 THEN cp END"},
        rates={"epa_per_db": ("epa", "dropbacks")}, having="dropbacks >= 100", best=("epa_per_db", 100), hidden=("epa",)),
    "qb_scramble_rate": PlayTable(  # D44
        _PASSER, "passer_player_id IS NOT NULL", {"dropbacks": "qb_dropback = 1", "scrambles": "qb_scramble = 1"},
        {"epa": "CASE WHEN qb_scramble = 1 THEN epa ELSE 0 END", "yds": "CASE WHEN qb_scramble = 1 THEN rushing_yards ELSE 0 END"},
        rates={"scramble_rate": ("scrambles", "dropbacks"), "epa_per_scramble": ("epa", "scrambles"),
               "yds_per_scramble": ("yds", "scrambles")},
        having="dropbacks >= 50 AND scrambles >= 10", hidden=("epa", "yds")),
    "receiving_leaders": PlayTable(  # D46
        {"player_id": _RECEIVER, "player_name": _RECEIVER_NAME}, f"{_RECEIVER} IS NOT NULL",
        {"rec": "complete_pass = 1", "tgt": "pass_attempt = 1", "td": "pass_touchdown = 1"},
        {"yds": "COALESCE(receiving_yards, 0)", "yac": "CASE WHEN complete_pass = 1 THEN COALESCE(yards_after_catch, 0) ELSE 0 END"},
        {"avg_ay": "air_yards"}, best=("yds", 100)),
    "receiving_yards_leaders": PlayTable(  # D47
        {"player_id": _RECEIVER}, f"pass = 1 AND {_RECEIVER} IS NOT NULL", sums={"yds": "COALESCE(receiving_yards, 0)"},
        labels={"player_name": _RECEIVER_NAME}, best=("yds", 50)),
    "rushing_leaders": PlayTable(  # D50
        {"player_id": _RUSHER, "player_name": _RUSHER_NAME}, f"{_RUSHER} IS NOT NULL",
        {"att": "rush_attempt = 1", "td": "rush_touchdown = 1"}, {"yds": "COALESCE(rushing_yards, 0)"},
        rates={"yds_per_att": ("yds", "att")}, best=("yds", 100)),
    "kickoff_touchback_rate": PlayTable(  # D51
        {"kicking_team": "posteam"}, "posteam IS NOT NULL AND kickoff_attempt = 1",
        {"kickoffs": "true", "in_endzone": "kickoff_in_endzone = 1", "touchbacks": "touchback = 1"},
        rates={"touchback_rate": ("touchbacks", "kickoffs"), "in_endzone_rate": ("in_endzone", "kickoffs")}),
    "punt_efficiency": PlayTable(  # D52
        _TEAM, "posteam IS NOT NULL AND punt_attempt = 1",
        {"punts": "true", "inside_20": "punt_inside_twenty = 1", "touchbacks": "punt_in_endzone = 1 OR touchback = 1",
         "returned": "return_yards > 0"},
        rates={"i20_rate": ("inside_20", "punts"), "touchback_rate": ("touchbacks", "punts"), "return_rate": ("returned", "punts")}),
}


def selected(pbp: DataFrame, plays: str = TRUE_PLAYS, season: int | None = None, through_week: int | None = None,
             season_type: str | None = None) -> DataFrame:
    """True (or qualifying) plays of the asked seasons and weeks."""
    for column, value in (("season", season), ("season_type", season_type)):
        if value is not None:
            pbp = pbp.filter(F.col(column) == value)
    if through_week is not None:
        pbp = pbp.filter(F.col("week") <= through_week)
    return pbp.filter(fb.is_true_play() if plays == TRUE_PLAYS else fb.is_qualifying())


def play_table(pbp: DataFrame, spec: PlayTable, season: int | None = None, through_week: int | None = None,
               season_type: str | None = None) -> DataFrame:
    """The declared table. Ties on a leader board go to the smaller keys."""
    p = selected(pbp, spec.plays, season, through_week, season_type)
    if spec.where != "true":
        p = p.filter(F.expr(spec.where))
    aggs = [F.max(F.expr(e)).alias(n) for n, e in spec.labels.items()]
    aggs += [F.count_if(F.expr(c)).alias(n) for n, c in spec.counts.items()]
    aggs += [F.sum(F.expr(e)).cast("double").alias(n) for n, e in spec.sums.items()]
    aggs += [F.avg(F.expr(e)).alias(n) for n, e in spec.means.items()]
    out = p.groupBy("season", *[F.expr(e).alias(n) for n, e in spec.keys.items()]).agg(*aggs)
    if spec.rates:
        out = out.withColumns({n: share(a, b) for n, (a, b) in spec.rates.items()})
    if spec.having != "true":
        out = out.filter(F.expr(spec.having))
    if spec.best:
        column, n = spec.best
        order = [F.col(column).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in spec.keys]]
        out = top_n_per_group(out, ["season"], n, order)
    return out.drop(*spec.hidden)


def team_share(pbp: DataFrame, member: str, name: str, count: str, measures: Mapping[str, str], least: int,
               best: int | None = 200) -> DataFrame:
    """A player's part of the team's season (D45, D48): ``measures`` (column -> SQL value per play) of
    plays that satisfy ``count``; players with at least ``least`` of the first measure, the best
    by its share per season. Team totals hold the plays without a player too and are added up
    from the players' aggregate, which is computed once."""
    team = ["season", "team"]
    per = pinned(selected(pbp).filter(F.expr(count)).groupBy("season", F.col("posteam").alias("team"),
                                                             F.expr(member).alias("player_id")).agg(
        F.max(F.expr(name)).alias("player_name"), *[F.sum(F.expr(e)).alias(m) for m, e in measures.items()]))
    total = per.groupBy(*team).agg(*[F.sum(m).alias(f"__team_{m}") for m in measures])
    first = next(iter(measures))
    out = null_safe_join(per.filter(F.col("player_id").isNotNull() & (F.col(first) >= least)), F.broadcast(total), team, "inner")
    out = out.select(*team, "player_id", "player_name", *measures,
                     *[share(m, f"__team_{m}").alias(f"{m}_share") for m in measures])
    if best is None:
        return out
    order = [F.col(f"{first}_share").desc_nulls_last(), F.col("player_id"), F.col("team")]
    return top_n_per_group(out, ["season"], best, order)


def receiver_market_share(pbp: DataFrame, least: int = 30) -> DataFrame:
    """Target and air-yard shares from pass attempts."""
    return team_share(pbp, _RECEIVER, _RECEIVER_NAME, "pass_attempt = 1",
                      {"targets": "1", "air_yards": "COALESCE(air_yards, 0)"}, least)


def rb_carry_share(pbp: DataFrame, least: int = 50) -> DataFrame:
    """Shares of the team's rush attempts."""
    return team_share(pbp, _RUSHER, _RUSHER_NAME, "true", {"rush_att": "CASE WHEN rush_attempt = 1 THEN 1 ELSE 0 END"}, least)


def personnel_usage(pbp: DataFrame) -> DataFrame:
    """Usage of each personnel group within the team's true plays."""
    per = pinned(selected(pbp).filter(F.col("offense_personnel").isNotNull()).groupBy(
        "season", F.col("posteam").alias("team"), "offense_personnel").agg(F.count(F.lit(1)).alias("plays")))
    total = per.groupBy("season", "team").agg(F.sum("plays").alias("__all"))
    return null_safe_join(per, total, ["season", "team"], "inner").select(
        "season", "team", "offense_personnel", "plays", (100.0 * share("plays", "__all")).alias("usage_pct"))


def snap_share_leaders(snaps: DataFrame, through_week: int = 18, n: int = 200) -> DataFrame:
    """Mean offense snap share of a season's weeks, the best ``n`` per season."""
    per = snaps.filter(F.col("week") <= through_week).groupBy("season", "player_id").agg(
        F.max("team").alias("team"), F.sum("offense_snaps").alias("off_snaps"), mean6("offense_pct").alias("avg_off_snap_pct"))
    return top_n_per_group(per, ["season"], n, [F.col("avg_off_snap_pct").desc_nulls_last(), F.col("player_id")])
