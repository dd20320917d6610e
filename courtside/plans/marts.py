"""Gold marts (M20, M21) over facts and dimensions with the reference's column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.operators.ranking import rank_measures, rank_within
from courtside.operators.star import enrich
from courtside.operators.stats import StatSpec, all_and_season_stats, recent_stats
from courtside.session import materialize

PLAYER_BASIC = ("player_id", "full_name", "birthdate", "country", "height", "weight_lbs", "jersey_number",
                "position", "team_id", "draft_year", "draft_round", "draft_number", "career_from_year",
                "career_to_year", "data_freshness_at")


def player_mart(dim_players: DataFrame, fact: DataFrame, season: str, recent_order: Sequence[Column],
                n: int = 10, basic_cols: Sequence[str] = PLAYER_BASIC, key: str = "player_id",
                active_status: str = "ACTIVE") -> DataFrame:
    """Player basics + all-time, current-season and last-``n`` figures and
    three global ranks on the season averages (NULLs first, as the warehouse)."""
    active = fact.filter(F.col("status") == F.lit(active_status))
    spec = StatSpec(
        avg={"avg_points": "points", "avg_assists": "assists", "avg_total_reb": "total_reb"},
        ratios={"fg_made_pct": ("fg_made", "fg_attempted"), "fg3_made_pct": ("fg3_made", "fg3_attempted")},
        maxes={"last_active_date": "game_date"},
        distinct="game_id")
    periods = all_and_season_stats(active, key, spec, "season", season, "at_", "cs_")
    recent_spec = StatSpec(avg={"avg_points": "points", "avg_assists": "assists", "avg_total_reb": "total_reb"},
                           ratios={"fg_made_pct": ("fg_made", "fg_attempted")})
    recent = recent_stats(active, key, recent_spec, recent_order, n, "rt_")

    stats = periods.join(recent, on=key, how="left").select(
        key,
        F.col("at_total_games").alias("all_time_total_games"),
        F.col("at_avg_points").alias("all_time_avg_points"),
        F.col("at_fg_made_pct").alias("all_time_fg_pct"),
        F.col("at_last_active_date").alias("last_active_date"),
        F.col("cs_total_games").alias("current_season_total_games"),
        F.col("cs_avg_points").alias("current_season_avg_points"),
        F.col("cs_avg_assists").alias("current_season_avg_assists"),
        F.col("cs_avg_total_reb").alias("current_season_avg_reb"),
        F.col("cs_fg_made_pct").alias("current_season_fg_pct"),
        F.col("cs_fg3_made_pct").alias("current_season_fg3_pct"),
        F.col("rt_avg_points").alias("recent_10_avg_points"),
        F.col("rt_avg_assists").alias("recent_10_avg_assists"),
        F.col("rt_avg_total_reb").alias("recent_10_avg_reb"),
        F.col("rt_fg_made_pct").alias("recent_10_fg_pct"))

    base = dim_players.select(*basic_cols)
    # One row per player: materialised once in the shared checkpoint folder, so the ranks
    # read it instead of re-deriving the statistics. All three are taken in one pass over
    # a narrow frame; the wide mart is joined once, by row.
    mart = materialize(base.join(stats, on=key, how="left").withColumn("__row", F.monotonically_increasing_id()))
    values = {"current_season_avg_points": "season_pts_rank", "current_season_avg_assists": "season_ast_rank",
              "current_season_avg_reb": "season_reb_rank"}
    ranks = rank_measures(mart.select("__row", *values), values, "__row")
    stat_cols = [c for c in stats.columns if c != key]
    # Stored, so that the ranks too are taken in tasks of bounded size.
    return materialize(mart.join(ranks.drop(*values), on="__row").select(
        *basic_cols, "season_pts_rank", "season_ast_rank", "season_reb_rank", *stat_cols))


TEAM_BASIC = ("team_id", "team_name", "abbreviation", "nickname", "city", "state", "year_founded", "arena_name",
              "arena_capacity", "head_coach", "general_manager", "owner", "dleague_affiliation",
              "data_freshness_at")


def team_mart(dim_teams: DataFrame, conference_lookup: DataFrame, fact_team_games: DataFrame, season: str,
              recent_order: Sequence[Column], n: int = 10, basic_cols: Sequence[str] = TEAM_BASIC,
              key: str = "team_id") -> DataFrame:
    """DISTINCT team basics + conference (seed), all-time / season / last-``n``
    wins, losses, win %, and the rank inside the conference by season win %."""
    base = enrich(dim_teams.select(*basic_cols), conference_lookup.select(key, "conference"), on=key).distinct()
    win = F.col("wl") == F.lit("W")
    spec = StatSpec(avg={"avg_team_point": "team_total_point"}, flags={"total_wins": win}, distinct="game_id")
    periods = all_and_season_stats(fact_team_games, key, spec, "season", season, "at_", "cs_")
    recent = recent_stats(fact_team_games, key, spec, recent_order, n, "rt_")

    def losses(p: str) -> Column:
        return (F.col(f"{p}total_games") - F.col(f"{p}total_wins")).alias(f"{p}total_losses")

    def win_pct(p: str) -> Column:
        return (F.col(f"{p}total_wins").cast("double") / F.col(f"{p}total_games").cast("double")).alias(f"{p}win_pct")

    stats = periods.join(recent, on=key, how="left").select(
        key,
        F.col("at_total_games").alias("all_time_total_games"),
        F.col("at_total_wins").alias("all_time_wins"),
        losses("at_").alias("all_time_losses"),
        win_pct("at_").alias("all_time_win_pct"),
        F.col("cs_total_games").alias("current_season_total_games"),
        F.col("cs_total_wins").alias("current_season_wins"),
        losses("cs_").alias("current_season_losses"),
        win_pct("cs_").alias("current_season_win_pct"),
        F.col("cs_avg_team_point").alias("current_season_avg_team_point"),
        F.col("rt_total_wins").alias("recent_10_games_wins"),
        losses("rt_").alias("recent_10_games_losses"),
        win_pct("rt_").alias("recent_10_games_win_pct"),
        F.col("rt_avg_team_point").alias("recent_10_games_avg_team_point"))

    mart = materialize(base.join(stats, on=key, how="left"))
    mart = rank_within(mart, ["conference"], "current_season_win_pct", out="conference_rank")
    front = [c for c in stats.columns if c != key]
    i = front.index("current_season_win_pct") + 1
    ordered = front[:i] + ["conference_rank"] + front[i:]
    return mart.select(*basic_cols, "conference", *ordered)
