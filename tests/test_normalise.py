import pytest
from pyspark.sql import functions as F

from courtside.plans import normalise as N
from courtside.sources.landing import read_landing, records
from tests.conftest import rows


def test_box_scores_union_zero_fill(spark):
    active = spark.createDataFrame([("g1", 7, "A", "B", 1, "C", "N", "AAA", "23", "G", "30:00", 12)],
                                   "gameId string, personId long, firstName string, familyName string, teamId long, "
                                   "teamCity string, teamName string, teamTricode string, jerseyNum string, "
                                   "position string, minutes string, points long")
    inactive = spark.createDataFrame([("g1", 8, "D", "E", 1, "C", "N", "AAA")],
                                     "game_id string, personId long, firstName string, familyName string, "
                                     "teamId long, teamCity string, teamName string, teamTricode string")
    out = N.normalise_box_scores(active, inactive, "2026-03-22T10:00:00")
    got = {r.player_id: r for r in out.collect()}
    assert got[7].status == "ACTIVE" and got[7].points == 12
    assert got[8].status == "INACTIVE" and got[8].minutes == "00:00" and got[8].points == 0
    assert got[8].jersey_number is None and got[8].fg_pct == 0
    assert rows(N.distinct_game_ids(out)) == [("g1",)]


def test_first_row_per_team_and_player(spark):
    bg = spark.createDataFrame([(1, 0, "AAA"), (1, 1, "AAX"), (2, 0, "BBB")], "team_id long, row_no int, ABBREVIATION string")
    td = N.normalise_team_details(bg, "2026-03-22T10:00:00", [F.col("row_no").asc()])
    assert rows(td, "team_id", "abbreviation") == [(1, "AAA"), (2, "BBB")]
    info = spark.createDataFrame([(5, 0, "Pat Doe", "2020")], "player_id long, row_no int, DISPLAY_FIRST_LAST string, TO_YEAR string")
    pd_ = N.normalise_player_details(info, "2026-03-22T10:00:00", [F.col("row_no").asc()])
    assert pd_.first().full_name == "Pat Doe" and pd_.first().to_year == "2020"


def test_standings_and_teams_rename(spark):
    st = spark.createDataFrame([(1, "Aces", "East", "37-9", 5)],
                               "TeamID long, TeamName string, Conference string, ConferenceRecord string, CurrentStreak long")
    r = N.normalise_standings(st, "2026-03-22T10:00:00").first()
    assert r.team_id == 1 and r.conference_rank == "37-9" and r.streak == 5 and r.updated_at == r.fetched_at
    assert r.division is None  # a column that was not fetched is NULL, where the producer reads it so
    few = spark.createDataFrame([(1, "Ashford Aces", "AAA")], "id long, full_name string, abbreviation string")
    with pytest.raises(ValueError):  # and fails where the producer fails
        N.normalise_teams(few, "x")
    tm = few.selectExpr("*", "'Aces' nickname", "'Ashford' city", "null state", "1950 year_founded")
    assert N.normalise_teams(tm, "x").first().team_name == "Ashford Aces"


def test_backfill_one_partition_per_date(spark, tmp_path):
    season = spark.createDataFrame([("0022500001", "2025-10-21", "AAA vs. BBB", 1, 100, 5, "W"),
                                    ("0022500001", "2025-10-21", "BBB @ AAA", 2, 95, -5, "L"),
                                    ("0022500002", "2025-10-22", "CCC vs. AAA", 3, 90, 1, "W")],
                                   "GAME_ID string, GAME_DATE string, MATCHUP string, TEAM_ID long, PTS long, "
                                   "PLUS_MINUS long, WL string")
    N.backfill_games(season, "2025-26", str(tmp_path))
    raw = read_landing(spark, str(tmp_path), "games", batch_ts="2026-04-12 01:00:00")
    assert rows(raw.groupBy("date").count()) == [("20251021", 2), ("20251022", 1)]
    rec = records(raw).select(F.variant_get("value", "$.fetched_at", "string").alias("f")).distinct()
    assert rows(rec) == [(N.BACKFILL_MARKER,)]
