"""The reference's table jobs (M1-M23) as DataFrame functions.

Bronze: RAW rows -> watermark filter (before the flatten) -> flatten -> typed
columns + surrogate key -> newest row per key in the batch -> upsert.
Snapshots: newest bronze row per entity -> check-strategy history.
Silver / facts / dims / gold: full rebuilds from the layer below.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.keys import key_text, surrogate_key
from courtside.functions.scalars import blank_default, guarded_ratio, status_bucket
from courtside.functions.semistruct import typed_fields, typed_path, whole_number
from courtside.operators.dedup import latest_per_key
from courtside.operators.incremental import new_rows, upsert_stored
from courtside.operators.scd2 import current_versions, snapshot_check
from courtside.operators.star import enrich, fill_orphans, looked_up, orphan_keys, placeholder_defaults, resolve_counterpart
from courtside.plans.feeds import FeedSpec
from courtside.plans.marts import PLAYER_BASIC, TEAM_BASIC, player_mart, team_mart
from courtside.session import materialize
from courtside.sources.landing import records

META = ("source_file", "loaded_at_utc", "api_fetched_at")


# ---- bronze (M1-M6) ------------------------------------------------------------

def _key_part(v: Column, path: str, kind: str) -> Column:
    if kind == "date":  # a time that does not parse stays in the key as its text
        text = F.try_variant_get(v, path, "string")
        return F.coalesce(F.to_date(F.try_variant_get(v, path, "timestamp_ntz")).cast("string"), text)
    return F.try_variant_get(v, path, "string")


def bronze_rows(raw: DataFrame, spec: FeedSpec, tolerant: bool = False, digest: bool = True) -> DataFrame:
    """Flatten RAW rows of one feed and type them (V1-V4, P3). Without ``digest`` the key stays the text that its digest is made from."""
    v, s = F.col("rec"), F.col("__fields")
    paths = {path: t for _, path, t in spec.columns} | {"$.fetched_at": "timestamp_ntz"}
    rec = records(raw, value="rec").withColumn("__fields", typed_fields(v, paths, tolerant))
    field = lambda path: s[path.removeprefix("$.")]
    # A text is a text for every type of value, so a column of texts serves the key as well.
    part = lambda p, k: field(p) if k == "text" and paths.get(p) == "string" else _key_part(v, p, k)
    key = (surrogate_key if digest else key_text)(*[part(p, k) for p, k in spec.key_parts]).alias(spec.key_name)
    cols = [whole_number(field(path), t).alias(name) for name, path, t in spec.columns]
    meta = [F.col("file_name").alias("source_file"), F.col("inserted_at").alias("loaded_at_utc"),
            field("$.fetched_at").alias("api_fetched_at")]
    return rec.select(key, *cols, *meta)


def newest_first(*extra: str) -> list[Column]:
    cols = ["loaded_at_utc", "api_fetched_at", *extra, "source_file"]
    return [F.col(c).desc_nulls_first() for c in cols]


def bronze(raw: DataFrame, target: DataFrame | None, spec: FeedSpec, tolerant: bool = False, digest: bool = True) -> DataFrame:
    """M1-M6: incremental bronze table after one load.

    Only RAW rows loaded after the target's newest ``loaded_at_utc`` are read
    (filter placed before the flatten). The batch keeps the newest row per
    entity where the reference does (player and team details), and always the
    newest row per unique key, so the upsert is deterministic; then rows
    replace target rows with the same key. ``target`` is a stored table; ``digest`` as in ``bronze_rows``, alike for all loads of it.
    """
    batch = bronze_batch(raw, target, spec, tolerant, digest)
    return batch if target is None else upsert_stored(target, materialize(batch), [spec.key_name], newest_first())


def bronze_batch(raw: DataFrame, target: DataFrame | None, spec: FeedSpec, tolerant: bool = False, digest: bool = True) -> DataFrame:
    """The rows one load adds or replaces (watermark, flatten, type, dedup)."""
    batch = bronze_rows(new_rows(raw, target, "inserted_at", "loaded_at_utc"), spec, tolerant, digest)
    if spec.entity:
        batch = latest_per_key(batch, [spec.entity], newest_first(spec.key_name))
    return latest_per_key(batch, [spec.key_name], newest_first())


# ---- snapshots (M7-M9) ---------------------------------------------------------

def snapshot(previous: DataFrame | None, bronze_table: DataFrame, key: str, check_cols: Sequence[str],
             updated_at_col: str | None, now: Column) -> DataFrame:
    """M7-M9: newest bronze row per entity, then one check-strategy step."""
    batch = latest_per_key(bronze_table, [key], newest_first())
    return snapshot_check(previous, batch, key, check_cols, updated_at_col=updated_at_col, now=now)


# ---- silver (M10-M15) ----------------------------------------------------------

SILVER_BOX_COLS = ("box_score_id", "game_id", "player_id", "team_id", "jersey_number", "position", "status",
                   "minutes_played", "points", "assists", "steals", "blocks", "turnovers", "personal_fouls",
                   "plus_minus", "o_reb", "d_reb", "total_reb", "fg_made", "fg_attempted", "fg_pct", "fg3_made",
                   "fg3_attempted", "fg3_pct", "ft_made", "ft_attempted", "ft_pct", "api_fetched_at")


def newest_fetched() -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in ("api_fetched_at", "loaded_at_utc", "source_file")]


def _latest_by_fetch(df: DataFrame, key: str, deal: Sequence[str] = ()) -> DataFrame:
    return latest_per_key(df, [*deal, key], newest_fetched())


def silver_box_scores(bronze_box: DataFrame, deal: Sequence[str] = ()) -> DataFrame:
    """Newest row per box score, blank minutes -> '00:00' (P4). ``deal``: columns the rows lie by, see ``upsert``."""
    latest = _latest_by_fetch(bronze_box, "box_score_id", deal)
    return latest.select(*deal, *[blank_default("minutes_played").alias(c) if c == "minutes_played" else F.col(c)
                           for c in SILVER_BOX_COLS])


def silver_games(bronze_games: DataFrame, deal: Sequence[str] = ()) -> DataFrame:
    """Newest row per game_team_id. ``deal``: columns the rows lie by, see ``upsert``."""
    cols = ("game_date", "game_team_id", "game_id", "matchup", "season", "api_fetched_at", "team_id",
            "plus_minus", "pts", "wl")
    return _latest_by_fetch(bronze_games, "game_team_id", deal).select(*deal, *cols)


def silver_teams(bronze_teams: DataFrame) -> DataFrame:
    """M15 (and M23, repaired to use api_fetched_at): newest row per team."""
    cols = ("team_version_id", "team_id", "team_name", "abbreviation", "nickname", "city", "state",
            "year_founded", "api_fetched_at")
    return _latest_by_fetch(bronze_teams, "team_id").select(*cols)


def _current(snap: DataFrame, cols: Sequence[str]) -> DataFrame:
    cur = current_versions(snap, loaded_col="loaded_at_utc")
    return cur.select(*cols, "record_effective_date", "last_updated_at", "is_current_record")


def silver_player_details(snap: DataFrame) -> DataFrame:
    """M12."""
    return _current(snap, ("player_id", "full_name", "birthdate", "country", "height", "weight_lbs",
                           "jersey_number", "position", "team_id", "team_name", "team_abbreviation", "draft_year",
                           "draft_round", "draft_number", "career_from_year", "career_to_year"))


def silver_standings(snap: DataFrame) -> DataFrame:
    """M13."""
    return _current(snap, ("conference", "conference_rank", "division", "home_record", "last_10", "losses",
                           "road_record", "streak", "team_id", "team_name", "win_pct", "wins"))


def silver_team_details(snap: DataFrame) -> DataFrame:
    """M14."""
    return _current(snap, ("team_id", "abbreviation", "nickname", "city", "state", "arena_name", "arena_capacity",
                           "head_coach", "general_manager", "owner", "dleague_affiliation", "year_founded"))


# ---- facts and dimensions (M16-M19) -----------------------------------------------

def fact_player_performances(box: DataFrame, games: DataFrame, deal: Sequence[str] = ()) -> DataFrame:
    """Box score LEFT JOIN game on (game_id, team_id) + computed FG %.

    ``deal``: columns made from the game id alone that both frames lie by. They are then the join's only keys, so
    that it needs no shuffle, and the two ids are compared as ranges inside them.
    """
    if deal:
        g = games.select(*[F.col(c).alias(f"__g_{c}") for c in (*deal, "game_id", "team_id")], "game_date", "season")
        same = [F.col(c) == F.col(f"__g_{c}") for c in deal]
        same += [F.col(c).between(F.col(f"__g_{c}"), F.col(f"__g_{c}")) for c in ("game_id", "team_id")]
        j = box.join(g, on=reduce(Column.__and__, same), how="left")
    else:
        j = box.join(games.select("game_id", "team_id", "game_date", "season"), on=["game_id", "team_id"], how="left")
    cols = [c for c in SILVER_BOX_COLS if c not in ("box_score_id", "jersey_number", "position", "api_fetched_at")]
    return j.select(surrogate_key("game_id", "player_id").alias("performance_pk"), *cols,
                    guarded_ratio("fg_made", "fg_attempted").alias("fg_pct_calc"), "game_date", "season")


def fact_team_games(games: DataFrame, teams: DataFrame, since: str, id_prefix: str | None) -> DataFrame:
    """Team games since ``since`` (and with the game-id prefix), with the
    opponent resolved from the matchup text (J1, J5, F3)."""
    g = games.filter(F.col("game_date") >= F.lit(since).cast("timestamp_ntz"))
    if id_prefix:
        g = g.filter(F.left(F.col("game_id"), F.lit(len(id_prefix))) == F.lit(id_prefix))
    teams = looked_up(teams.select("team_id", "abbreviation"))
    own = teams.withColumnRenamed("abbreviation", "__own")
    g = enrich(g, own, on="team_id").withColumn("team_game_pk", surrogate_key("game_id", "team_id"))  # before rows fan out
    out = resolve_counterpart(g, teams, "matchup", "__own", "abbreviation",
                              {"opponent_team_id": "team_id", "opponent_abbreviation": "abbreviation"})
    return out.select("team_game_pk", "game_id", "team_id", "game_date", "matchup", "plus_minus", "wl", "season",
                      F.col("pts").alias("team_total_point"), "opponent_team_id", "opponent_abbreviation")


def dim_players(player_details: DataFrame, facts: DataFrame, now: Column, retired_before: int = 2024) -> DataFrame:
    """Current players + status bucket (P6) + placeholder members for fact
    players without a dimension row (J6, U2)."""
    base = player_details.select(
        surrogate_key("player_id").alias("player_pk"), "player_id", "full_name", "birthdate", "country", "height",
        "weight_lbs", "jersey_number", "position", "team_id", "draft_year", "draft_round", "draft_number",
        "career_from_year", "career_to_year", status_bucket("career_to_year", retired_before).alias("player_status"),
        F.col("last_updated_at").alias("data_freshness_at"))
    # Stored: only the keys are wanted, and the facts behind them are settled in tasks of bounded size.
    keys = materialize(facts.select("player_id").distinct())
    orphans = orphan_keys(keys, base, "player_id")
    defaults = placeholder_defaults("player_id", "Unknown Player (", now, "full_name", ["country", "position"],
                                    status_col="player_status", freshness_col="data_freshness_at")
    defaults["player_pk"] = surrogate_key("player_id")
    return fill_orphans(base, orphans, "player_id", defaults)


def dim_teams(teams: DataFrame, team_details: DataFrame) -> DataFrame:
    """Teams LEFT JOIN current team details."""
    d = team_details.select("team_id", "arena_name", "arena_capacity", "head_coach", "general_manager", "owner",
                            "dleague_affiliation", F.col("last_updated_at").alias("data_freshness_at"))
    j = enrich(teams.select("team_id", "team_name", "abbreviation", "nickname", "city", "state", "year_founded"),
               d, on="team_id")
    return j.select(surrogate_key("team_id").alias("team_pk"), "team_id", "team_name", "abbreviation", "nickname",
                    "city", "state", "year_founded", "arena_name", "arena_capacity", "head_coach",
                    "general_manager", "owner", "dleague_affiliation", "data_freshness_at")


# ---- gold (M20, M21) -----------------------------------------------------------

def mart_team_analytics(dim: DataFrame, conference_seed: DataFrame, facts: DataFrame, season: str) -> DataFrame:
    order = [F.col("game_date").desc_nulls_first(), F.col("game_id").desc(),
             F.col("opponent_team_id").asc_nulls_first()]
    return team_mart(dim, conference_seed, facts, season, order, 10, basic_cols=TEAM_BASIC)


def mart_player_analytics(dim: DataFrame, facts: DataFrame, season: str) -> DataFrame:
    order = [F.col("game_date").desc_nulls_first(), F.col("game_id").desc(), F.col("team_id").asc()]
    return player_mart(dim, facts, season, order, 10, basic_cols=PLAYER_BASIC)


# ---- ad-hoc analyses (M22, M23) -------------------------------------------------

def adhoc_games_flatten(raw: DataFrame) -> DataFrame:
    """Games flattened with the team id kept as text."""
    rec = records(raw, value="value")
    v = F.col("value")
    return rec.select(typed_path(v, "$.game_date", "timestamp_ntz").alias("game_date"),
                      typed_path(v, "$.game_id", "string").alias("game_id"),
                      typed_path(v, "$.matchup", "string").alias("matchup"),
                      typed_path(v, "$.season", "string").alias("season"),
                      typed_path(v, "$.team_id", "string").alias("team_id"),
                      F.col("file_name").alias("source_file"), F.col("inserted_at").alias("loaded_at_utc"),
                      typed_path(v, "$.fetched_at", "timestamp_ntz").alias("api_fetched_at"))


def adhoc_latest_teams(bronze_teams: DataFrame) -> DataFrame:
    """Newest bronze row per team (the reference names columns that do not
    exist; the fetch time column is used instead)."""
    return silver_teams(bronze_teams).drop("team_version_id")
