"""Play tables, leader boards, league marts and the event study on small tables of plays."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridmart.plans import calendar, league, pbp
from gridmart.plans.adapters import play_columns

NUMBERS = ["pass", "rush", "pass_attempt", "rush_attempt", "complete_pass", "passing_yards", "rushing_yards", "yards_gained",
           "epa", "success", "touchdown", "pass_touchdown", "rush_touchdown", "interception", "down", "ydstogo", "first_down",
           "qb_dropback", "qb_scramble", "shotgun", "no_huddle", "xpass", "total_home_score", "total_away_score"]
TEXT = ["passer_player_id", "passer_player_name", "passer", "posteam", "defteam", "home_team", "away_team", "roof", "stadium"]
ZEROS = ["qb_spike", "qb_kneel", "play_deleted", "aborted_play", "score_differential", "quarter_seconds_remaining"]


@pytest.fixture()
def plays(spark):
    """Rows of keyword values; everything else is NULL, flags 0."""
    def build(rows):
        whole = []
        for k, r in enumerate(rows):
            base = {"season": 2040, "week": 1, "season_type": "REG", "game_id": "g", "play": 1.0, "qtr": 1, "home_wp": 0.5,
                    "away_wp": 0.5, "order_sequence": k, "game_seconds_remaining": 3600 - 20 * k, "game_date": "2040-09-01"}
            base |= dict.fromkeys(ZEROS, 0.0) | dict.fromkeys(NUMBERS) | dict.fromkeys(TEXT)
            whole.append(base | r)
        schema = ", ".join([f"{c} DOUBLE" for c in (*NUMBERS, *ZEROS, "play", "home_wp", "away_wp")] + [f"{c} STRING" for c in TEXT]
                           + ["season INT", "week INT", "season_type STRING", "game_id STRING", "qtr INT",
                              "order_sequence BIGINT", "game_seconds_remaining BIGINT", "game_date STRING"])
        names = [c.split()[0] for c in schema.split(", ")]
        return spark.createDataFrame([tuple(float(r[n]) if r[n] is not None and f"{n} DOUBLE" in schema else r[n] for n in names)
                                      for r in whole], schema)
    return build


def test_explosive_and_fourth_down(plays):
    p = plays([{"posteam": "A", "pass": 1, "yards_gained": 20, "down": 1}, {"posteam": "A", "rush": 1, "yards_gained": 9, "down": 4},
               {"posteam": "A", "rush": 1, "yards_gained": 10, "down": 4, "first_down": 1}, {"posteam": "A", "down": 4},
               {"posteam": "A", "rush": 1, "yards_gained": 50, "aborted_play": 1}, {"pass": 1, "yards_gained": 40},
               *[{"posteam": "B", "down": 4, "pass": 1, "first_down": k % 2} for k in range(5)]])
    a = {r.team: r for r in pbp.play_table(p, pbp.TABLES["explosive_play_rate"]).collect()}
    assert set(a) == {"A", "B"}
    assert (a["A"].plays, a["A"].explosive_passes, a["A"].explosive_rushes, a["A"].explosive_play_rate) == (4, 1, 1, 0.5)
    go = pbp.play_table(p, pbp.TABLES["fourth_down_go_rate"]).collect()  # A has three fourth downs only
    assert [(r.team, r.fourth_down_plays, r.go_rate, r.go_success_rate) for r in go] == [("B", 5, 1.0, 0.4)]


def test_leaders_by_season_week_and_ties(plays):
    row = {"pass_attempt": 1, "complete_pass": 1}
    p = plays([{**row, "passer_player_id": "x", "passer": "X", "passing_yards": 30, "week": 1},
               {**row, "passer_player_id": "y", "passer_player_name": "Y", "passing_yards": 30, "week": 2},
               {**row, "passer_player_id": "z", "passing_yards": 5, "season": 2041},
               {"passer_player_id": "x", "passer": "X", "passing_yards": None}, {"passing_yards": 99}])
    got = [(r.season, r["rank"], r.player_id, r.player_name, r.att, r.yds, r.ypa)
           for r in pbp.play_table(p, pbp.TABLES["passing_leaders"]).orderBy("season", "rank").collect()]
    assert got == [(2040, 1, "x", "X", 1, 30.0, 30.0), (2040, 2, "y", "Y", 1, 30.0, 30.0), (2041, 1, "z", None, 1, 5.0, 5.0)]
    early = pbp.play_table(p, pbp.TABLES["passing_leaders"], season=2040, through_week=1).collect()
    assert [r.player_id for r in early] == ["x"]


def test_league_week_and_pace(plays):
    base = {"posteam": "A", "home_team": "A", "away_team": "B", "roof": "dome", "down": 1}
    p = plays([{**base, "pass": 1, "epa": 2, "yards_gained": 25, "xpass": 0.5, "total_home_score": 7, "touchdown": 1},
               {**base, "rush": 1, "rush_attempt": 1, "epa": -1, "yards_gained": 12, "xpass": 0.25, "total_away_score": 3},
               {**base, "rush": 1, "epa": 9, "qtr": 1},  # a scramble: no rush attempt, no qualifying play
               {**base, "pass": 1, "epa": 1, "xpass": 0.75, "game_seconds_remaining": 3000}])
    r = league.league_by_week(p).collect()[0]
    assert (r.plays_pg, r.ppg, r.tds_pg, r.explosive_pass_rate, r.explosive_rush10_rate, r.explosive_rush15_rate) == (
        3.0, 10.0, 1.0, 0.5, 1.0, 0.0)
    assert r.epa_all == pytest.approx(2 / 3, abs=1e-6) and r.epa_pass == 1.5 and r.epa_rush == -1.0
    assert r.sec_per_play_all == 32.5  # 20 seconds, then 580 counted as 45
    assert r.explosive_epa_share_pass == pytest.approx(2 / 3) and r.explosive_epa_share_rush is None
    assert r.proe_mean == pytest.approx(2 / 3 - 0.5, abs=1e-6)


def test_calendar_effects(plays):
    def game(n, day, ot=False, stadium=None, epa=0.0):
        return [{"game_id": f"g{n}", "week": n, "game_date": f"2040-09-{day:02d}", "posteam": "A", "home_team": "A",
                 "away_team": f"V{n}", "pass": 1, "epa": epa, "xpass": 0.5, "qtr": 5 if ot else 1, "stadium": stadium}] * 2
    p = plays([*game(1, 1, ot=True, epa=1), *game(2, 5, epa=2), *game(3, 15, epa=3), *game(4, 29, stadium="wembley", epa=6)])
    got = {(r.event_type, r.outcome): r for r in calendar.calendar_effects(p).collect()}
    means = {"prev_ot": 2 - 3, "short_week": 2 - 3, "mini_bye": 3 - 3, "post_bye": 6 - 3, "international": 6 - 3}
    for event, effect in means.items():
        r = got[event, "epa_all"]
        assert (r.effect, r.n, r.ci_low) == (effect, 1, None), event
    assert got["post_bye", "epa_rush"].effect is None and got["post_bye", "proe"].effect == 0.0


def test_personnel_and_shares(spark):
    cols = "season INT, posteam STRING, offense_personnel STRING, rusher_player_id STRING, rusher_id STRING, rusher STRING, " \
           "rusher_player_name STRING, rush_attempt DOUBLE, play DOUBLE, aborted_play DOUBLE"
    rows = [(2040, "A", "11", "p", None, "P", None, 1.0, 1.0, 0.0)] * 3 + [(2040, "A", "12", None, "q", "Q", "Qq", 1.0, 1.0, None),
                                                                            (2040, "A", None, None, None, None, None, 1.0, 1.0, 0.0)]
    p = spark.createDataFrame(rows, cols)
    assert {(r.offense_personnel, r.plays, r.usage_pct) for r in pbp.personnel_usage(p).collect()} == {("11", 3, 75.0), ("12", 1, 25.0)}
    got = [(r["rank"], r.player_id, r.player_name, r.rush_att, r.rush_att_share) for r in pbp.rb_carry_share(p, 1).orderBy("rank").collect()]
    assert got == [(1, "p", "P", 3, 0.6), (2, "q", "Qq", 1, 0.2)]


def test_one_text_for_both_engines():
    columns = play_columns()
    names = [c.rsplit("AS ", 1)[-1].strip() for c in columns]
    assert len(names) == len(set(names)) and {"pass", "rush_attempt", "qb_dropback", "return_yards"} <= set(names)
    assert not any("VARCHAR" in c for c in columns)
