"""Landing normalisers (L1-L9): already-fetched API frames -> feed records.

The API calls themselves are not part of this library; these are the
reshaping steps as DataFrame projections, so a fetched frame of any size is
renamed, stamped and written by Spark tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.operators.dedup import latest_per_key
from courtside.sources.landing import write_landing

# API field -> feed field, as the producers name them.
GAMES_RENAME = {"GAME_ID": "game_id", "GAME_DATE": "game_date", "MATCHUP": "matchup", "TEAM_ID": "team_id",
                "PTS": "pts", "PLUS_MINUS": "plus_minus", "WL": "wl"}
BOX_ACTIVE_RENAME = {
    "gameId": "game_id", "personId": "player_id", "firstName": "first_name", "familyName": "family_name",
    "teamId": "team_id", "teamCity": "team_city", "teamName": "team_name", "teamTricode": "team_abbreviation",
    "jerseyNum": "jersey_number", "position": "position", "minutes": "minutes", "points": "points",
    "reboundsOffensive": "rebounds_offensive", "reboundsDefensive": "rebounds_defensive",
    "reboundsTotal": "rebounds_total", "assists": "assists", "steals": "steals", "blocks": "blocks",
    "turnovers": "turnovers", "foulsPersonal": "fouls", "fieldGoalsMade": "fg_made",
    "fieldGoalsAttempted": "fg_attempted", "fieldGoalsPercentage": "fg_pct", "threePointersMade": "fg3_made",
    "threePointersAttempted": "fg3_attempted", "threePointersPercentage": "fg3_pct", "freeThrowsMade": "ft_made",
    "freeThrowsAttempted": "ft_attempted", "freeThrowsPercentage": "ft_pct", "plusMinusPoints": "plus_minus"}
BOX_INACTIVE_RENAME = {"personId": "player_id", "firstName": "first_name", "familyName": "family_name",
                       "teamId": "team_id", "teamCity": "team_city", "teamName": "team_name",
                       "teamTricode": "team_abbreviation"}
INACTIVE_ZERO_STATS = ("points", "rebounds_offensive", "rebounds_defensive", "rebounds_total", "assists", "steals",
                       "blocks", "turnovers", "fouls", "fg_made", "fg_attempted", "fg_pct", "fg3_made",
                       "fg3_attempted", "fg3_pct", "ft_made", "ft_attempted", "ft_pct", "plus_minus")
STANDINGS_RENAME = {"TeamID": "team_id", "TeamName": "team_name", "Conference": "conference",
                    "Division": "division", "WINS": "wins", "LOSSES": "losses", "WinPCT": "win_pct",
                    "ConferenceRecord": "conference_rank", "HOME": "home_record", "ROAD": "road_record",
                    "L10": "last_10", "CurrentStreak": "streak"}
TEAMS_RENAME = {"id": "team_id", "full_name": "team_name", "abbreviation": "abbreviation", "nickname": "nickname",
                "city": "city", "state": "state", "year_founded": "year_founded"}
TEAM_DETAILS_RENAME = {"ABBREVIATION": "abbreviation", "NICKNAME": "nickname", "YEARFOUNDED": "year_founded",
                       "CITY": "city", "ARENA": "arena", "ARENACAPACITY": "arena_capacity", "OWNER": "owner",
                       "GENERALMANAGER": "general_manager", "HEADCOACH": "head_coach",
                       "DLEAGUEAFFILIATION": "dleague_affiliation"}
PLAYER_DETAILS_RENAME = {"DISPLAY_FIRST_LAST": "full_name", "TEAM_ID": "team_id", "TEAM_NAME": "team_name",
                         "TEAM_ABBREVIATION": "team_abbreviation", "JERSEY": "jersey_number",
                         "POSITION": "position", "HEIGHT": "height", "WEIGHT": "weight", "BIRTHDATE": "birthdate",
                         "COUNTRY": "country", "DRAFT_YEAR": "draft_year", "DRAFT_ROUND": "draft_round",
                         "DRAFT_NUMBER": "draft_number", "FROM_YEAR": "from_year", "TO_YEAR": "to_year"}
BACKFILL_MARKER = "2026-04-12T00:00:00"


def _rename(df: DataFrame, mapping: dict[str, str], strict: bool = False) -> list[Column]:
    """The mapped columns. One that the frame lacks is NULL, or fails the job where the producer does."""
    missing = sorted(set(mapping) - set(df.columns))
    if strict and missing:
        raise ValueError(f"fetched columns are missing: {', '.join(missing)}")

    def empty(name: str) -> Column:
        kind = "string" if name not in INACTIVE_ZERO_STATS else "double" if name.endswith("_pct") else "bigint"
        return F.lit(None).cast(kind)

    return [(F.col(src) if src in df.columns else empty(dst)).alias(dst) for src, dst in mapping.items()]


def _ts(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def normalise_games(frame: DataFrame, season: str, fetched_at: str | Column) -> DataFrame:
    """L1: rename, constant season, fetch time."""
    return frame.select(*_rename(frame, GAMES_RENAME, strict=True), F.lit(season).alias("season"),
                        _ts(fetched_at).alias("fetched_at"))


def normalise_box_scores(active: DataFrame, inactive: DataFrame, fetched_at: str | Column,
                         inactive_game_id: str = "game_id") -> DataFrame:
    """L2 + L3 + U3: active rows renamed with status ACTIVE; inactive rows with
    status INACTIVE, minutes '00:00' and zero statistics; appended by name."""
    a = active.select(*_rename(active, BOX_ACTIVE_RENAME), F.lit("ACTIVE").alias("status"),
                      _ts(fetched_at).alias("fetched_at"))
    i = inactive.select(F.col(inactive_game_id).alias("game_id"), *_rename(inactive, BOX_INACTIVE_RENAME),
                        F.lit("INACTIVE").alias("status"), F.lit("00:00").alias("minutes"),
                        *[F.lit(0).alias(s) for s in INACTIVE_ZERO_STATS], _ts(fetched_at).alias("fetched_at"))
    return a.unionByName(i, allowMissingColumns=True)


def distinct_game_ids(games: DataFrame) -> DataFrame:
    """L4: the day's distinct game ids (drives the box-score fetch)."""
    return games.select("game_id").distinct()


def normalise_standings(frame: DataFrame, fetched_at: str | Column) -> DataFrame:
    """Rename, fetch and update time."""
    ts = _ts(fetched_at)
    return frame.select(*_rename(frame, STANDINGS_RENAME), ts.alias("fetched_at"), ts.alias("updated_at"))


def normalise_teams(frame: DataFrame, fetched_at: str | Column) -> DataFrame:
    """Rename the static team list."""
    ts = _ts(fetched_at)
    return frame.select(*_rename(frame, TEAMS_RENAME, strict=True), ts.alias("fetched_at"), ts.alias("updated_at"))


def _first_per(frame: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return latest_per_key(frame, [key], order)


def normalise_team_details(background: DataFrame, fetched_at: str | Column, order: Sequence[Column],
                           key: str = "team_id") -> DataFrame:
    """First background row of each team (teams without one are absent)."""
    first = _first_per(background, key, order)
    ts = _ts(fetched_at)
    return first.select(F.col(key).alias("team_id"), *_rename(first, TEAM_DETAILS_RENAME),
                        ts.alias("fetched_at"), ts.alias("updated_at"))


def normalise_player_details(info: DataFrame, fetched_at: str | Column, order: Sequence[Column],
                             key: str = "player_id") -> DataFrame:
    """First info row of each player (players without one are absent)."""
    first = _first_per(info, key, order)
    ts = _ts(fetched_at)
    return first.select(F.col(key).alias("player_id"), *_rename(first, PLAYER_DETAILS_RENAME),
                        ts.alias("fetched_at"), ts.alias("updated_at"))


def backfill_games(season_frame: DataFrame, season: str, root: str, marker: str = BACKFILL_MARKER,
                   file_rows: int = 100_000) -> None:
    """A whole season split by game date into one landing partition per date,
    stamped with the constant backfill fetch marker. Files are planned to about ``file_rows`` rows:
    a hot date is written by many tasks, small dates by few."""
    games = normalise_games(season_frame, season, marker)
    day = F.date_format(F.col("game_date").cast("timestamp_ntz"), "yyyyMMdd")
    write_landing(games.withColumn("date", day), root, "games", file_rows=file_rows)
