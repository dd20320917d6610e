"""DuckDB SQL for the table jobs and landing normalisers over the derived feeds."""

from __future__ import annotations

from courtside.plans import normalise as N
from courtside.plans.feed_bindings import FETCHED, LOADED, TABLES, feed_sql, source_file
from courtside.plans.feeds import FEEDS, SNAPSHOTS
from courtside.plans.models import SILVER_BOX_COLS
from courtside.plans.oracle import sk

KINDS = {"int": "BIGINT", "float": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
NAMES = {t: t for t in TABLES}


def feed(name: str, load: int) -> str:
    return f"({feed_sql(name, load, **NAMES)})"


def bronze_load(name: str, load: int) -> str:
    spec = FEEDS[name]
    sql = feed_sql(name, load, **NAMES)
    parts = [f"CAST(CAST({p[2:]} AS TIMESTAMP) AS DATE)" if k == "date" else p[2:] for p, k in spec.key_parts]
    cols = [f"CAST({p[2:] if f' AS {p[2:]}' in sql else 'NULL'} AS {KINDS[t]}) AS {c}" for c, p, t in spec.columns]
    return (f"(SELECT {sk(*parts)} AS {spec.key_name}, {', '.join(cols)}, '{source_file(name, load)}' AS source_file, "
            f"TIMESTAMP '{LOADED[load]}' AS loaded_at_utc, CAST(fetched_at AS TIMESTAMP) AS api_fetched_at FROM ({sql}) AS f)")


def bronze(name: str) -> str:
    key = FEEDS[name].key_name
    two = bronze_load(name, 2)
    return f"(SELECT * FROM {bronze_load(name, 1)} WHERE {key} NOT IN (SELECT {key} FROM {two}) UNION ALL SELECT * FROM {two})"


def snapshot(name: str) -> str:
    feed_name, key, checks, updated = SNAPSHOTS[name]
    at = {n: updated or f"TIMESTAMP '{LOADED[n]}'" for n in (1, 2)}
    differs = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in checks)
    return f"""(WITH a AS (SELECT *, {at[1]} AS t FROM {bronze_load(feed_name, 1)}),
  b AS (SELECT *, {at[2]} AS t FROM {bronze_load(feed_name, 2)}),
  moved AS (SELECT b.* FROM a JOIN b ON a.{key} = b.{key} WHERE {differs})
  SELECT a.* EXCLUDE (t), a.t AS valid_from, moved.t AS valid_to, {sk(f'a.{key}', 'a.t')} AS version_id,
         a.t AS version_updated_at FROM a LEFT JOIN moved ON a.{key} = moved.{key}
  UNION ALL SELECT * EXCLUDE (t), t, NULL, {sk(key, 't')}, t FROM moved)"""


def newest(source: str, key: str) -> str:
    return f"(SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY api_fetched_at DESC) = 1)"


def current(name: str, cols: str) -> str:
    return (f"(SELECT {cols}, valid_from AS record_effective_date, loaded_at_utc AS last_updated_at, TRUE AS is_current_record "
            f"FROM {snapshot(name)} WHERE valid_to IS NULL)")


MINUTES = "coalesce(nullif(minutes_played, ''), '00:00') AS minutes_played"
SILVER = {
    "silver_box_scores": f"(SELECT {', '.join(MINUTES if c == 'minutes_played' else c for c in SILVER_BOX_COLS)} "
                         f"FROM {bronze('box_scores')})",
    "silver_games": "(SELECT game_date, game_team_id, game_id, matchup, season, api_fetched_at, team_id, plus_minus, pts, wl "
                    f"FROM {bronze('games')})",
    "silver_teams": "(SELECT team_version_id, team_id, team_name, abbreviation, nickname, city, state, year_founded, "
                    f"api_fetched_at FROM {newest(bronze('teams'), 'team_id')})",
    "silver_player_details": current("player_details_snapshot", "player_id, full_name, birthdate, country, height, weight_lbs, "
                                     "jersey_number, position, team_id, team_name, team_abbreviation, draft_year, draft_round, "
                                     "draft_number, career_from_year, career_to_year"),
    "silver_standings": current("standings_snapshot", "conference, conference_rank, division, home_record, last_10, losses, "
                                "road_record, streak, team_id, team_name, win_pct, wins"),
    "silver_team_details": current("team_details_snapshot", "team_id, abbreviation, nickname, city, state, arena_name, "
                                   "arena_capacity, head_coach, general_manager, owner, dleague_affiliation, year_founded"),
}
BOX_FACT = ", ".join(f"s.{c}" for c in SILVER_BOX_COLS if c not in ("box_score_id", "jersey_number", "position", "api_fetched_at"))

ORACLE = {("bronze_box_scores_all_columns" if f == "box_scores" else f"bronze_{f}"): f"SELECT * FROM {bronze(f)}" for f in FEEDS}
ORACLE |= {n: f"SELECT * FROM {snapshot(n)}" for n in SNAPSHOTS}
ORACLE |= {n: f"SELECT * FROM {sql}" for n, sql in SILVER.items()}
ORACLE |= {
    "fact_player_performances": f"""
SELECT {sk('s.game_id', 's.player_id')} AS performance_pk, {BOX_FACT},
  CASE WHEN fg_attempted > 0 THEN fg_made::DOUBLE / fg_attempted ELSE 0 END AS fg_pct_calc, g.game_date, g.season
FROM {SILVER['silver_box_scores']} s LEFT JOIN {SILVER['silver_games']} g ON s.game_id = g.game_id AND s.team_id = g.team_id""",
    "fact_team_games": f"""
WITH t AS {SILVER['silver_teams']},
g AS (SELECT n.*, t.abbreviation AS own FROM {SILVER['silver_games']} n LEFT JOIN t ON n.team_id = t.team_id
  WHERE game_date >= TIMESTAMP '1996-01-01 00:00:00' AND starts_with(game_id, '002')),
c AS (SELECT game_team_id, own, left(matchup, 3) AS code FROM g UNION SELECT game_team_id, own, right(matchup, 3) FROM g),
o AS (SELECT game_team_id, t.team_id AS opponent_team_id, code AS opponent_abbreviation
  FROM c JOIN t ON code = abbreviation WHERE code <> own)
SELECT {sk('game_id', 'team_id')} AS team_game_pk, game_id, team_id, game_date, matchup, plus_minus, wl, season,
  pts AS team_total_point, opponent_team_id, opponent_abbreviation FROM g LEFT JOIN o USING (game_team_id)""",
    "dim_players": f"""
WITH p AS {SILVER['silver_player_details']},
known AS (SELECT {sk('player_id')} AS player_pk, player_id, full_name, birthdate, country, height, weight_lbs, jersey_number,
  position, team_id, draft_year, draft_round, draft_number, career_from_year, career_to_year,
  CASE WHEN TRY_CAST(career_to_year AS INTEGER) < 2024 THEN 'Retired' ELSE 'Active' END AS player_status,
  last_updated_at AS data_freshness_at FROM p),
lost AS (SELECT DISTINCT player_id FROM {SILVER['silver_box_scores']} EXCEPT SELECT player_id FROM p)
SELECT * FROM known UNION ALL BY NAME
SELECT {sk('player_id')} AS player_pk, player_id, 'Unknown Player (' || player_id || ')' AS full_name, 'N/A' AS country,
  'N/A' AS position, 'Unknown' AS player_status, TIMESTAMP '{LOADED[2]}' AS data_freshness_at FROM lost""",
    "dim_teams": f"""
SELECT {sk('t.team_id')} AS team_pk, t.team_id, t.team_name, t.abbreviation, t.nickname, t.city, t.state, t.year_founded,
  d.arena_name, d.arena_capacity, d.head_coach, d.general_manager, d.owner, d.dleague_affiliation,
  d.last_updated_at AS data_freshness_at
FROM {SILVER['silver_teams']} t LEFT JOIN {SILVER['silver_team_details']} d ON t.team_id = d.team_id""",
    "adhoc_games_flatten": " UNION ALL ".join(f"""
SELECT CAST(game_date AS TIMESTAMP) AS game_date, game_id, matchup, season, CAST(team_id AS VARCHAR) AS team_id,
  '{source_file('games', n)}' AS source_file, TIMESTAMP '{LOADED[n]}' AS loaded_at_utc,
  CAST(fetched_at AS TIMESTAMP) AS api_fetched_at FROM {feed('games', n)}""" for n in (1, 2)),
    "adhoc_latest_teams": f"SELECT * EXCLUDE (team_version_id) FROM {SILVER['silver_teams']}",
    "landing_games": f"SELECT * REPLACE ('2025-26' AS season) FROM {feed('games', 1)}",
    "landing_box_scores": f"""
SELECT * FROM {feed('box_scores', 1)} WHERE status = 'ACTIVE' UNION ALL BY NAME
SELECT game_id, player_id, team_id, first_name, family_name, team_city, team_name, team_abbreviation, status, fetched_at,
  '00:00' AS minutes, {', '.join(f'0 AS {c}' for c in N.INACTIVE_ZERO_STATS)}
FROM {feed('box_scores', 1)} WHERE status = 'INACTIVE'""",
    "landing_standings": f"SELECT *, fetched_at AS updated_at FROM {feed('standings', 1)}",
    "landing_teams": f"SELECT *, fetched_at AS updated_at FROM {feed('teams', 1)}",
    "landing_team_details": f"""
SELECT * REPLACE ('{FETCHED[1]}' AS fetched_at), '{FETCHED[1]}' AS updated_at
FROM (SELECT * FROM {feed('team_details', 1)} UNION ALL SELECT * FROM {feed('team_details', 2)})
QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY head_coach DESC, general_manager ASC NULLS LAST) = 1""",
    "landing_player_details": f"""
SELECT * REPLACE ('{FETCHED[1]}' AS fetched_at, '{FETCHED[1]}' AS updated_at)
FROM (SELECT * FROM {feed('player_details', 1)} UNION ALL SELECT * FROM {feed('player_details', 2)})
QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY height DESC) = 1""",
    "landing_backfill": f"""
SELECT game_id, team_id, CAST(game_date AS TIMESTAMP) AS game_date, pts, '{N.BACKFILL_MARKER}' AS fetched_at,
  replace(game_date, '-', '') AS folder FROM {feed('games', 1)}""",
    "landing_roundtrip": f"""
SELECT team_version_id AS id, nickname AS value, loaded_at_utc FROM {bronze('teams')}
UNION ALL SELECT 'reject', '[{{not json', TIMESTAMP '{LOADED[1]}' UNION ALL SELECT 'reject', '{{not json', TIMESTAMP '{LOADED[2]}'""",
    "landing_damaged": """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS o_custkey, o_orderkey % 97 = 0 AS rejected FROM orders""",
    "landing_forced_load": f"""
SELECT team_id, loaded_at_utc FROM {feed('team_details', 1)},
  (VALUES (TIMESTAMP '2024-03-01 11:00:00'), (TIMESTAMP '2024-03-03 11:00:00')) AS l(loaded_at_utc)""",
    "landing_all_feeds": " UNION ALL ".join(
        f"SELECT '{f}' AS feed, {FEEDS[f].key_name} AS id, loaded_at_utc FROM {bronze_load(f, 1)}" for f in FEEDS),
    "seed_lookup": """
SELECT s_suppkey AS team_id, s_name AS team_name, lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS abbreviation,
  s_nationkey AS nation_id, CASE WHEN s_suppkey % 5 <> 0 THEN r_name END AS conference
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
    "named_datasets": """
SELECT s_suppkey AS team_id, upper(s_name) AS team_name, lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS abbreviation,
  s_nationkey AS nation_id FROM supplier""",
}
