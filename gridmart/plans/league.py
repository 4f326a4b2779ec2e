"""League and team trend marts over ``pbp``.

All of them are grouped aggregates over the play table (map-side partial aggregation)
followed by joins of small, key-unique results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.functions import football as fb
from gridmart.functions.classify import ROOF_POLICIES, policy_classify
from gridmart.functions.columns import csum, round_half_up, share
from gridmart.operators.once import pinned
from gridmart.operators.quantiles import exact_quantiles
from gridmart.operators.shares import null_safe_join


MAX_GAP = 45  # fixed value: seconds between two plays count up to this


def _disc(col: str, p: float) -> F.Column:
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {col})")


def mean6(c: str) -> F.Column:
    """Mean of the non-null values at six decimals, summed exactly: the same in any order."""
    v = round_half_up(c, 6).cast("decimal(24,6)")
    return F.sum(v).cast("double") / F.count(v)


def qualifying(pbp: DataFrame) -> DataFrame:
    return pbp.filter(fb.is_qualifying())


def with_play_gaps(pbp: DataFrame) -> DataFrame:
    """``gap_sec``, seconds since the offense's previous qualifying play of the game (negative
    ones unknown, at most 45); NULL for other plays. A game's plays of one team are its window."""
    game = Window.partitionBy("season", "week", "game_id", "posteam", "qualifies").orderBy(
        F.col("order_sequence").asc_nulls_last(), F.col("game_seconds_remaining").desc_nulls_last(),
        F.col("epa").asc_nulls_last())
    gap = F.lag("game_seconds_remaining").over(game) - F.col("game_seconds_remaining")
    return pbp.withColumn("qualifies", fb.is_qualifying()).withColumn(
        "gap_sec", F.when(F.col("qualifies") & (gap >= 0), F.least(gap, F.lit(MAX_GAP))))


def team_games(pbp: DataFrame, *extra: str) -> DataFrame:
    """:func:`_team_games`, pinned: games, teams and the league read it."""
    return pinned(_team_games(pbp, *extra))


def _team_games(pbp: DataFrame, *extra: str) -> DataFrame:
    """One row per game and team (and ``extra``) from one pass over the plays: counts, sums and
    pace of its qualifying plays, all and neutral ones, explosive plays (X13), touchdowns and
    scores of all its plays."""
    q, neutral = F.col("qualifies"), F.col("qualifies") & fb.is_neutral()
    is_pass, is_rush = fb.flag("pass"), fb.flag("rush_attempt")
    gain, gain_epa = F.col("yards_gained"), F.when(F.col("epa") > 0, F.col("epa")).otherwise(0.0)
    counts = {
        "plays": q, "pass_plays": q & is_pass, "rush_plays": q & is_rush, "no_huddle_plays": q & fb.flag("no_huddle"),
        "shotgun_plays": q & fb.flag("shotgun"), "neutral_plays": neutral, "neutral_pass_plays": neutral & is_pass,
        "pass_20": q & is_pass & (gain >= 20), "rush_10": q & is_rush & (gain >= 10), "rush_15": q & is_rush & (gain >= 15)}
    sums = {
        "epa_pass_sum": (q & is_pass, "epa"), "epa_rush_sum": (q & is_rush, "epa"), "epa_sum": (q, "epa"),
        "xpass_sum": (q, "xpass"), "gap_sum": (q, "gap_sec"), "neutral_gap_sum": (neutral, "gap_sec"), "neutral_xpass_sum": (neutral, "xpass")}
    return with_play_gaps(pbp).groupBy("season", "week", "game_id", "posteam", *extra).agg(
        *[csum(c).alias(n) for n, c in counts.items()],
        *[F.sum(F.when(c, F.col(v))).alias(n) for n, (c, v) in sums.items()],
        *[F.count(F.when(c, F.col(v))).alias(n.replace("_sum", "_n")) for n, (c, v) in sums.items()],
        F.sum(F.when(q & is_pass, gain_epa)).alias("pass_gain"),
        F.sum(F.when(q & is_pass & (gain >= 20), gain_epa)).alias("pass_gain_20"),
        F.sum(F.when(q & is_rush, gain_epa)).alias("rush_gain"),
        F.sum(F.when(q & is_rush & (gain >= 10), gain_epa)).alias("rush_gain_10"),
        csum(fb.flag("touchdown")).alias("tds"), F.max("total_home_score").alias("home"),
        F.max("total_away_score").alias("away"))


def _per_game(tg: DataFrame) -> DataFrame:
    """Scores and touchdowns of each game."""
    return tg.groupBy("season", "week", "game_id").agg(
        (F.max("home") + F.max("away")).alias("points"), F.sum("tds").alias("tds"))


def _of_game(value: F.Column, *game: str) -> F.Column:
    """``value`` over a game's few grouped rows, which are together already."""
    return value.over(Window.partitionBy(*game))


def _rates(tg: DataFrame) -> DataFrame:
    """Per team-game rates; teams without a qualifying play have none."""
    return tg.filter(F.col("plays") > 0).withColumns({
        "epa_all": share("epa_sum", "epa_n"), "epa_pass": share("epa_pass_sum", "epa_pass_n"),
        "epa_rush": share("epa_rush_sum", "epa_rush_n"), "no_huddle_rate": share("no_huddle_plays", "plays"),
        "shotgun_rate": share("shotgun_plays", "plays"), "sec_per_play_all": share("gap_sum", "gap_n"),
        "sec_per_play_neutral": share("neutral_gap_sum", "neutral_gap_n"),
        "proe": share("neutral_pass_plays", "neutral_plays") - share("neutral_xpass_sum", "neutral_xpass_n")})


def _explosive(epa_share: bool) -> list[F.Column]:
    """X13, aggregates over :func:`_rates`: rates of explosive passes (20+) and rushes (10+, 15+)
    and, by kind, the share of the positive EPA that they bring."""
    def rate(part: str, whole: str) -> F.Column:
        return share(F.sum(part), F.sum(whole))

    out = {"explosive_pass_rate": rate("pass_20", "pass_plays"), "explosive_rush10_rate": rate("rush_10", "rush_plays"),
           "explosive_rush15_rate": rate("rush_15", "rush_plays")}
    if epa_share:
        out |= {f"explosive_epa_share_{kind}": share(F.coalesce(F.sum(part), F.lit(0.0)), F.sum(f"{kind}_gain"))
                for kind, part in (("pass", "pass_gain_20"), ("rush", "rush_gain_10"))}
    return [v.alias(k) for k, v in out.items()]


TEAM_RATES = ("epa_all", "epa_pass", "epa_rush", "sec_per_play_all", "no_huddle_rate", "shotgun_rate")


def league_by_week(pbp: DataFrame) -> DataFrame:
    """League metrics by week, means over team-games: plays, EPA, pace (all and neutral),
    formation rates, explosive rates and EPA shares, PROE of neutral team-games with its
    interquartile range (discrete quantiles), points and touchdowns a game."""
    week = ["season", "week"]
    tg = team_games(pbp)
    rates = _rates(tg)
    means = rates.groupBy(*week).agg(
        F.avg("plays").alias("plays_pg"), mean6("sec_per_play_neutral").alias("sec_per_play_neutral"),
        *[mean6(c).alias(c) for c in TEAM_RATES],
        mean6("proe").alias("proe_mean"), (_disc("proe", 0.75) - _disc("proe", 0.25)).alias("proe_iqr"), *_explosive(True))
    games = _per_game(tg).groupBy(*week).agg(F.avg("points").alias("ppg"), F.avg("tds").alias("tds_pg"))
    return null_safe_join(means, games, week, "inner").select(
        "season", "week", "plays_pg", "sec_per_play_neutral", *TEAM_RATES, "proe_mean", "proe_iqr", "ppg", "tds_pg",
        "explosive_pass_rate", "explosive_rush10_rate", "explosive_rush15_rate", "explosive_epa_share_pass",
        "explosive_epa_share_rush")


def league_yoy(pbp: DataFrame) -> DataFrame:
    """Season pass rate, EPA all / pass / rush, explosive rates by kind, points per game."""
    tg = team_games(pbp)
    total = tg.groupBy("season").agg(*[F.sum(c).alias(c) for c in (
        "plays", "pass_plays", "rush_plays", "pass_20", "rush_10", "epa_sum", "epa_n", "epa_pass_sum", "epa_pass_n",
        "epa_rush_sum", "epa_rush_n")]).filter(F.col("plays") > 0)
    points = (tg.groupBy("season", "game_id").agg((F.max("home") + F.max("away")).alias("points"))
              .groupBy("season").agg(F.avg("points").alias("ppg")))
    return null_safe_join(total, points, ["season"], "inner").select(
        "season", share("pass_plays", "plays").alias("pass_rate"), share("epa_sum", "epa_n").alias("epa_all"),
        share("epa_pass_sum", "epa_pass_n").alias("epa_pass"), share("epa_rush_sum", "epa_rush_n").alias("epa_rush"),
        share("pass_20", "pass_plays").alias("explosive_pass_rate"),
        share("rush_10", "rush_plays").alias("explosive_rush10_rate"), "ppg")


def league_by_class(pbp: DataFrame, policy: str = "open_is_outdoor",
                    policies: Mapping[str, Mapping[str, Sequence[str]]] = ROOF_POLICIES) -> DataFrame:
    """Weekly league metrics per roof class under a named policy; points and touchdowns are
    means of the games' totals over the class's team-games. One reader, so nothing is pinned and
    measures that it does not read are not computed."""
    group = ["season", "week", "roof_class"]
    tg = _team_games(pbp.withColumn("roof_class", policy_classify("roof", policies, policy)), "roof_class")
    game = ["season", "week", "game_id"]
    rates = _rates(tg.withColumns({
        "points": _of_game(F.max("home"), *game) + _of_game(F.max("away"), *game),
        "game_tds": _of_game(F.sum("tds"), *game)}))
    return rates.groupBy(*group).agg(F.avg("plays").alias("plays_pg"), F.avg("points").alias("ppg"),
                                     F.avg("game_tds").alias("tds_pg"), *[mean6(c).alias(c) for c in TEAM_RATES],
                                     *_explosive(False))


def league_per_game(pbp: DataFrame) -> DataFrame:
    """Mean and exact median by season of team-game counts (plays, passes, explosive plays,
    touchdowns, pass rate) and of the games' points, all and by roof, on true plays. Every
    measure is one value of a long table, so one selection finds all the medians."""
    p = pbp.filter(fb.is_true_play())
    is_pass, is_rush, gain = fb.flag("pass"), fb.flag("rush"), F.col("yards_gained")
    game = ["season", "game_id"]
    teams = pinned(p.groupBy(*game, "posteam").agg(
        F.count(F.lit(1)).alias("team_plays"), csum(is_pass).alias("pass_plays"),
        csum(is_pass & (gain >= 20)).alias("explosive_passes"), csum(is_rush & (gain >= 10)).alias("explosive_rushes"),
        csum(fb.flag("touchdown")).alias("team_tds"), F.max("total_home_score").alias("home"),
        F.max("total_away_score").alias("away"), F.max("roof").alias("roof")))
    scored = teams.withColumns({"home_points": _of_game(F.max("home"), *game), "away_points": _of_game(F.max("away"), *game),
                                "game_roof": _of_game(F.max("roof"), *game)})
    indoor = F.lower("game_roof").isin("dome", "closed")
    total = F.col("home_points") + F.col("away_points")
    j = scored.drop("home", "away", "roof").withColumns({
        "total_points": total, "points_dome": F.when(indoor, total), "points_outdoor": F.when(~indoor, total),
        "pass_rate": share("pass_plays", "team_plays"), "explosive_play_rate": share("explosive_passes", "team_plays"),
        "explosive_rush_rate": share("explosive_rushes", "team_plays")})
    medians = ["team_plays", "pass_plays", "explosive_passes", "explosive_rushes", "team_tds", "home_points",
               "away_points", "total_points", "points_dome", "points_outdoor", "pass_rate"]
    means = [*medians, "explosive_play_rate", "explosive_rush_rate"]
    long = j.select("season", *[F.col(c).cast("double").alias(c) for c in medians]).unpivot(
        ["season"], medians, "measure", "value")
    wide = (exact_quantiles(long, ["season", "measure"], "value", {"median": 0.5})
            .groupBy("season").agg(*[F.max(F.when(F.col("measure") == c, F.col("median"))).alias(f"med_{c}") for c in medians]))
    return null_safe_join(j.groupBy("season").agg(*[mean6(c).alias(f"avg_{c}") for c in means]), wide, ["season"], "inner")


def regular_plays(pbp: DataFrame) -> DataFrame:
    """Regular-season plays; ``__run`` marks those that were run and not deleted."""
    return pbp.filter(F.col("season_type") == "REG").withColumn(
        "__run", F.coalesce(fb.flag("play") & ~fb.flag("play_deleted"), F.lit(False)))


def _ran(value: str | F.Column) -> F.Column:
    return F.when(F.col("__run"), F.col(value) if isinstance(value, str) else value)


def _scored(plays: DataFrame, extra: Sequence[F.Column], aggs: Sequence[F.Column]) -> DataFrame:
    """:func:`regular_plays` by game (and ``extra``) from one pass: ``aggs`` where a play was run, and
    the points of the game, from all of its plays (none for an unknown season or game)."""
    game = ["season", "game_id"]
    rows = plays.groupBy(*game, *extra).agg(
        F.count(_ran(F.lit(1))).alias("plays"), *aggs,
        F.max("total_home_score").alias("__home"), F.max("total_away_score").alias("__away"))
    points = _of_game(F.max("__home"), *game) + _of_game(F.max("__away"), *game)
    known = F.col("season").isNotNull() & F.col("game_id").isNotNull()
    return rows.withColumn("total_points", F.when(known, points)).filter(F.col("plays") > 0)


def _by_kind(value: str, name: str) -> list[F.Column]:
    """Means of ``value`` over the passes and over the rushes that were run."""
    return [F.avg(_ran(F.when(fb.flag(kind), F.col(value)))).alias(name.format(kind)) for kind in ("pass", "rush")]


def environment_splits(pbp: DataFrame) -> DataFrame:
    """Seasons by roof (a game is a dome's if most of its plays name one) and surface, means
    over games (P12, A12)."""
    place = F.coalesce("roof", "stadium", F.lit(""))
    dome = F.when(place.ilike("%dome%") | place.ilike("%closed%"), 1).otherwise(0)
    turf = F.coalesce(F.col("surface").ilike("%turf%") | F.col("surface").ilike("%artificial%"), F.lit(False))
    games = _scored(regular_plays(pbp), [F.when(turf, "turf").otherwise("grass").alias("surface_class")], [
        F.avg(_ran(dome)).alias("__dome"), F.avg(_ran("epa")).alias("epa_play"), *_by_kind("epa", "epa_{}"),
        F.avg(_ran("success")).alias("success_rate"),
        F.avg(_ran(F.when(F.col("yards_gained") >= 20, 1).otherwise(0))).alias("explosive_rate")])
    return games.groupBy(
        "season", F.when(F.col("__dome") >= 0.5, "dome").otherwise("outdoor").alias("roof_class"), "surface_class").agg(
        F.count(F.lit(1)).alias("games"), F.avg("plays").alias("plays_per_game"),
        *[mean6(c).alias(c) for c in ("epa_play", "epa_pass", "epa_rush", "success_rate", "explosive_rate")],
        F.avg("total_points").alias("points_per_game"))


TREND_RATES = ("shotgun_rate", "no_huddle_rate", "air_yards", "epa_play", "epa_pass", "epa_rush", "success_rate", "pass_success",
               "rush_success", "xpass", "pass_oe", "explosive_rate", "median_sec_per_play", "mean_sec_per_play")


def season_trends(pbp: DataFrame) -> DataFrame:
    """Seasons as means over games: formation, efficiency and pace (gaps between plays of 0 to
    45 seconds, their mean and median in each game). A game's plays are its window and buffer."""
    order = Window.partitionBy("season", "game_id", "__run").orderBy(
        F.col("order_sequence").asc_nulls_last(), F.col("game_seconds_remaining").desc_nulls_last())
    gap = F.lag("game_seconds_remaining").over(order) - F.col("game_seconds_remaining")
    p = regular_plays(pbp).withColumn("__gap", gap).withColumn(
        "__gap", _ran(F.when(F.col("__gap").between(0, MAX_GAP), F.col("__gap"))))
    games = _scored(p, [], [
        F.sum(_ran(F.col("pass").cast("bigint"))).alias("pass_plays"),
        *[F.avg(_ran(c)).alias(n) for n, c in {
            "shotgun_rate": "shotgun", "no_huddle_rate": "no_huddle", "air_yards": "air_yards", "epa_play": "epa",
            "success_rate": "success", "xpass": "xpass", "pass_oe": "pass_oe"}.items()],
        *_by_kind("epa", "epa_{}"), *_by_kind("success", "{}_success"),
        F.avg(_ran(F.when(F.col("yards_gained") >= 20, 1).otherwise(0))).alias("explosive_rate"),
        F.median("__gap").alias("median_sec_per_play"), F.avg("__gap").alias("mean_sec_per_play")])
    return games.groupBy("season").agg(
        F.count(F.lit(1)).alias("games"), F.avg("plays").alias("avg_plays_per_game"),
        share(F.sum("pass_plays"), F.sum("plays")).alias("pass_rate"), *[mean6(c).alias(c) for c in TREND_RATES],
        F.avg("total_points").alias("points_per_game"))


def rate_over_expected(pbp: DataFrame) -> DataFrame:
    """Pass rate, expected pass rate and mean pass over expected per season and team, on true
    plays; beside them every week's qualifying plays outside the last 120 seconds of a half: their
    number, rates, PROE and the pace proxy ``30 * 60 / plays`` (X9, X10). A season without such
    plays has one row without a week; a week without true plays in its season has no season rates."""
    team = ["season", "team"]
    p = pbp.withColumnRenamed("posteam", "team")
    season = p.filter(fb.is_true_play()).groupBy(*team).agg(
        F.avg("pass").alias("pass_rate"), F.avg("xpass").alias("exp_pass_rate"), F.avg("pass_oe").alias("proe"))
    weeks = p.filter(fb.is_qualifying() & ~fb.within_half_seconds(120)).groupBy("season", "week", "team").agg(
        F.count(F.lit(1)).alias("plays"), F.avg("pass").alias("week_pass_rate"), F.avg("xpass").alias("week_xpass_rate"))
    weeks = weeks.withColumns({"week_proe": F.col("week_pass_rate") - F.col("week_xpass_rate"),
                               "sec_per_play_proxy": share(F.lit(1800.0), "plays")}).withColumnsRenamed(
        {"season": "w_season", "team": "w_team"})
    same = season["season"].eqNullSafe(weeks["w_season"]) & season["team"].eqNullSafe(weeks["w_team"])
    return season.join(weeks, same, "full").select(
        *[F.coalesce(c, f"w_{c}").alias(c) for c in team], "pass_rate", "exp_pass_rate", "proe", "week", "plays",
        "week_pass_rate", "week_xpass_rate", "week_proe", "sec_per_play_proxy")


def team_proe_and_pace(pbp: DataFrame) -> DataFrame:
    """Per team-week, PROE and the pace proxy ``30 / n * 60`` (X9, X10) over dropbacks outside
    the last 120 seconds of a half."""
    base = pbp.filter(fb.flag("qb_dropback") & (F.col("half_seconds_remaining") > 120))
    return base.groupBy("season", "week", "season_type", F.col("posteam").alias("team")).agg(
        (F.avg(F.col("pass").cast("int")) - F.avg("xpass")).alias("proe_neutral"),
        (F.lit(30.0) / F.count(F.lit(1)) * 60.0).alias("sec_per_play_neutral"))


def opponent_adjusted(pbp: DataFrame) -> DataFrame:
    """Offense EPA of true plays minus what each opponent allows on average.

    The opponent average is fixed at 1e-6 and the differences are summed as DECIMAL, so
    the adjusted mean does not depend on summation order."""
    q = pbp.filter(fb.is_true_play())
    allowed = q.groupBy("season", "defteam").agg(
        round_half_up(F.avg("epa"), 6).cast("decimal(18,6)").alias("opp_epa_allowed"))
    j = q.join(allowed, ["season", "defteam"])
    diff = F.col("epa").cast("decimal(18,6)") - F.col("opp_epa_allowed")
    return j.groupBy("season", "posteam").agg(
        F.count(F.lit(1)).alias("plays"), F.avg("epa").alias("epa_per_play"),
        (F.sum(diff).cast("double") / F.count(diff)).alias("adj_epa_per_play"))


def pct_filter_counts(pbp: DataFrame) -> DataFrame:
    """Per defense, the pressure rate and the man / zone percentages of true pass plays."""
    p = pbp.filter(fb.is_true_play() & fb.flag("pass"))
    n = F.count(F.lit(1))
    kind = F.lower(F.coalesce("defense_man_zone_type", F.lit("")))
    return p.groupBy("season", "season_type", F.col("defteam").alias("team")).agg(
        F.avg(F.when(F.coalesce("was_pressure", F.lit(False)), 1.0).otherwise(0.0)).alias("pressure_rate"),
        (100.0 * F.count_if(kind.like("%man%")) / n).alias("man_pct"),
        (100.0 * F.count_if(kind.like("%zone%")) / n).alias("zone_pct"))


def penalties_by_team(pbp: DataFrame) -> DataFrame:
    """Penalties and their yards on true plays by team (the penalised one, else the
    offense, else the defense) x type."""
    p = pbp.filter(fb.is_true_play() & fb.flag("penalty"))
    return p.groupBy("season", "season_type", F.coalesce("penalty_team", "posteam", "defteam").alias("team"),
                     "penalty_type").agg(
        F.count(F.lit(1)).alias("penalties"),
        F.sum(F.coalesce("penalty_yards", F.lit(0.0))).alias("penalty_yards"))


def team_context(pbp: DataFrame, snaps: DataFrame, context: str = "attempts") -> DataFrame:
    """Team denominators per week with the team's offense snaps: D66 (``attempts``: pass attempts
    without sacks, X8, and rush attempts) or D76 (``flags``: plain pass and rush flags)."""
    passes, rushes = ((fb.is_pass_attempt_context(), fb.flag("rush_attempt")) if context == "attempts"
                      else (fb.flag("pass"), fb.flag("rush")))
    counts = pbp.groupBy("season", "week", "season_type", F.col("posteam").alias("team")).agg(
        csum(fb.flag("qb_dropback")).alias("team_dropbacks"), csum(passes).alias("team_pass_attempts"),
        csum(rushes).alias("team_carries"))
    most = snaps.groupBy("season", "week", "team").agg(F.max("offense_snaps").alias("team_offense_snaps"))
    return counts.join(most, ["season", "week", "team"], "left")


def formation_target_shares(pbp: DataFrame) -> DataFrame:
    """A player's share of the team's targets from shotgun and without a huddle."""
    team = ["season", "week", "season_type", "team"]
    t = fb.is_target()
    per = pinned(pbp.groupBy(*team[:-1], F.col("posteam").alias("team"), F.col("receiver_player_id").alias("player_id")).agg(
        csum(t & fb.flag("shotgun")).alias("shotgun_targets"), csum(t & fb.flag("no_huddle")).alias("no_huddle_targets")))
    total = per.groupBy(*team).agg(F.sum("shotgun_targets").alias("team_shotgun"),
                                   F.sum("no_huddle_targets").alias("team_no_huddle"))
    return null_safe_join(per, total, team, "inner").select(
        *team, "player_id", "shotgun_targets", "no_huddle_targets",
        share("shotgun_targets", "team_shotgun").alias("shotgun_target_share"),
        share("no_huddle_targets", "team_no_huddle").alias("no_huddle_target_share"))


def personnel_target_shares(pbp: DataFrame) -> DataFrame:
    """A player's share of the team's targets within each personnel group. Plays without
    personnel are left out; players (and the NULL player) without a target stay with 0."""
    group = ["season", "week", "season_type", "team", "offense_personnel"]
    plays = pbp.withColumn("team", F.col("posteam")).filter(F.col("offense_personnel").isNotNull())
    per = plays.groupBy(*group, F.col("receiver_player_id").alias("player_id")).agg(
        csum(fb.is_target()).alias("targets"))
    team = per.groupBy(*group).agg(F.sum("targets").alias("team_targets"))
    return per.join(team, group).select(*group, "player_id", "targets",
                                        share("targets", "team_targets").alias("target_share_in_personnel"))


def season_rollup(util: DataFrame, sums: Sequence[str], means: Sequence[str]) -> DataFrame:
    """Season roll-up of a weekly mart: sums for counts, means (NULLs skipped) for
    shares. Shares enter the mean at 1e-6 and are summed as DECIMAL (order independent)."""
    def mean(c: str) -> F.Column:
        v = round_half_up(c, 6).cast("decimal(18,6)")
        return F.sum(v).cast("double") / F.count(v)

    return util.groupBy("season", "season_type", "player_id").agg(
        F.max("player_name").alias("player_name"), F.max("position").alias("position"),
        F.max("team").alias("primary_team"), F.count(F.lit(1)).alias("games"),
        *[F.sum(c).alias(c) for c in sums], *[mean(c).alias(c) for c in means])


def drive_summary(pbp: DataFrame) -> DataFrame:
    """D30 (P7, A4, X16): per drive the offense, EPA, success rate and naive points
    (7 per touchdown play, 3 per made field goal)."""
    p = pbp.filter(fb.is_true_play())
    pts = (F.when(fb.flag("touchdown"), 7)
           .when(fb.flag("field_goal_attempt") & (F.col("field_goal_result") == "good"), 3).otherwise(0))
    return p.groupBy("game_id", F.col("drive").alias("drive_num")).agg(
        F.max("posteam").alias("offense"), F.sum("epa").alias("drive_epa"),
        F.avg("success").alias("success_rate"), F.sum(pts).alias("naive_points"))
