"""The six landed feeds: how a JSON record becomes a bronze row.

Each spec lists (column, json path, type) in the reference's bronze column
order, the unique key parts, and whether the model keeps only the newest row
per entity inside a batch. Column names, paths and key parts are fixed values
of the reference's data model.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeedSpec:
    name: str
    key_name: str
    key_parts: tuple[tuple[str, str], ...]   # (json path, "text" | "date")
    columns: tuple[tuple[str, str, str], ...]  # (column, json path, type)
    entity: str | None = None                  # newest row per entity kept in the batch (I4)


S, I, F_, T = "string", "int", "float", "timestamp_ntz"

# Bronze schemas of the reference's models.
GAMES = FeedSpec(
    "games", "game_team_id", (("$.game_id", "text"), ("$.team_id", "text")),
    (("game_date", "$.game_date", T), ("game_id", "$.game_id", S), ("matchup", "$.matchup", S),
     ("season", "$.season", S), ("team_id", "$.team_id", I), ("plus_minus", "$.plus_minus", I),
     ("pts", "$.pts", I), ("wl", "$.wl", S)))

BOX_SCORES = FeedSpec(
    "box_scores", "box_score_id", (("$.game_id", "text"), ("$.player_id", "text")),
    (("game_id", "$.game_id", S), ("player_id", "$.player_id", I), ("team_id", "$.team_id", I),
     ("first_name", "$.first_name", S), ("last_name", "$.family_name", S),
     ("jersey_number", "$.jersey_number", S), ("position", "$.position", S), ("status", "$.status", S),
     ("team_city", "$.team_city", S), ("team_name", "$.team_name", S),
     ("team_abbreviation", "$.team_abbreviation", S), ("minutes_played", "$.minutes", S),
     ("points", "$.points", I), ("assists", "$.assists", I), ("steals", "$.steals", I), ("blocks", "$.blocks", I),
     ("turnovers", "$.turnovers", I), ("personal_fouls", "$.fouls", I), ("plus_minus", "$.plus_minus", I),
     ("o_reb", "$.rebounds_offensive", I), ("d_reb", "$.rebounds_defensive", I),
     ("total_reb", "$.rebounds_total", I), ("fg_made", "$.fg_made", I), ("fg_attempted", "$.fg_attempted", I),
     ("fg_pct", "$.fg_pct", F_), ("fg3_made", "$.fg3_made", I), ("fg3_attempted", "$.fg3_attempted", I),
     ("fg3_pct", "$.fg3_pct", F_), ("ft_made", "$.ft_made", I), ("ft_attempted", "$.ft_attempted", I),
     ("ft_pct", "$.ft_pct", F_)))

PLAYER_DETAILS = FeedSpec(
    "player_details", "player_record_id", (("$.player_id", "text"), ("$.updated_at", "text")),
    (("player_id", "$.player_id", I), ("full_name", "$.full_name", S), ("birthdate", "$.birthdate", T),
     ("country", "$.country", S), ("height", "$.height", S), ("weight_lbs", "$.weight", S),
     ("jersey_number", "$.jersey_number", S), ("position", "$.position", S), ("team_id", "$.team_id", I),
     ("team_name", "$.team_name", S), ("team_abbreviation", "$.team_abbreviation", S),
     ("draft_year", "$.draft_year", S), ("draft_round", "$.draft_round", S), ("draft_number", "$.draft_number", S),
     ("career_from_year", "$.from_year", S), ("career_to_year", "$.to_year", S),
     ("api_updated_at", "$.updated_at", T)),
    entity="player_id")

STANDINGS = FeedSpec(
    "standings", "standings_id",
    (("$.team_id", "text"), ("$.wins", "text"), ("$.losses", "text"), ("$.fetched_at", "date")),
    (("conference", "$.conference", S), ("conference_rank", "$.conference_rank", S),
     ("division", "$.division", S), ("home_record", "$.home_record", S), ("last_10", "$.last_10", S),
     ("losses", "$.losses", I), ("road_record", "$.road_record", S), ("streak", "$.streak", I),
     ("team_id", "$.team_id", I), ("team_name", "$.team_name", S), ("win_pct", "$.win_pct", F_),
     ("wins", "$.wins", I)))

TEAM_DETAILS = FeedSpec(
    "team_details", "team_version_id", (("$.team_id", "text"), ("$.fetched_at", "date")),
    (("team_id", "$.team_id", I), ("abbreviation", "$.abbreviation", S), ("nickname", "$.nickname", S),
     ("city", "$.city", S), ("state", "$.state", S), ("arena_name", "$.arena", S),
     ("arena_capacity", "$.arena_capacity", I), ("head_coach", "$.head_coach", S),
     ("general_manager", "$.general_manager", S), ("owner", "$.owner", S),
     ("dleague_affiliation", "$.dleague_affiliation", S), ("year_founded", "$.year_founded", I)),
    entity="team_id")

TEAMS = FeedSpec(
    "teams", "team_version_id", (("$.team_id", "text"), ("$.fetched_at", "date")),
    (("abbreviation", "$.abbreviation", S), ("city", "$.city", S), ("nickname", "$.nickname", S),
     ("state", "$.state", S), ("team_id", "$.team_id", I), ("team_name", "$.team_name", S),
     ("year_founded", "$.year_founded", I)))

ALL_FEEDS = (BOX_SCORES, GAMES, PLAYER_DETAILS, STANDINGS, TEAM_DETAILS, TEAMS)
FEEDS = {f.name: f for f in ALL_FEEDS}

# Snapshot settings (fixed values): unique key, check columns, version time column.
SNAPSHOTS = {
    "player_details_snapshot": ("player_details", "player_id",
                                ("full_name", "country", "jersey_number", "position", "height", "weight_lbs",
                                 "team_id"), "api_fetched_at"),
    "standings_snapshot": ("standings", "team_id", ("conference_rank",), "api_fetched_at"),
    "team_details_snapshot": ("team_details", "team_id",
                              ("head_coach", "general_manager", "owner", "arena_name", "city"), None),
}
