"""Run the layers in dependency order: landing -> RAW -> bronze -> snapshots ->
silver -> facts/dims -> gold, then the declared quality checks.

Every table is written as a new parquet version (``VersionedTable``) and read
back by the next layer, so each layer starts from a scan (lineage cut, and a
lost executor only recomputes the current layer).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators.quality import Check, count_failures, freshness, observed, run_checks
from courtside.plans import models as M
from courtside.plans.feeds import FEEDS, SNAPSHOTS
from courtside.sources.landing import feed_path, load_files, logical_date, read_seed, rejects
from courtside.sources.tables import BucketedTable, HistoryTable, VersionedTable


@dataclass(frozen=True)
class RunConfig:
    landing_root: str
    warehouse_root: str
    run_ts: str                       # load time stamped on this run's RAW rows
    seed_path: str                    # team -> conference CSV
    date: str | None = None           # yyyymmdd partition to load; None = the day before run_ts
    backfill: bool = False            # load every landed date instead
    current_season: str = "2025-26"
    since: str = "2025-10-21"
    id_prefix: str | None = "002"
    shape: str = "auto"
    force: bool = True                # load files again that an earlier run has loaded, as the producer's schedule does
    tolerant: bool = False
    buckets: int = 8                  # folders of a bronze table, see BucketedTable


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def table(spark: SparkSession, cfg: RunConfig, layer: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{cfg.warehouse_root.rstrip('/')}/{layer}", name)


def raw_path(cfg: RunConfig, feed: str) -> str:
    return f"{cfg.warehouse_root.rstrip('/')}/raw/{feed}"


def load_raw(spark: SparkSession, cfg: RunConfig) -> dict[str, DataFrame]:
    """Append this run's landed files of every feed to its RAW table, with the run's load time.

    A feed, or a date of it, that has not landed adds nothing. Returns every RAW table there is.
    """
    out = {}
    date = None if cfg.backfill else cfg.date or logical_date(cfg.run_ts)
    for name in FEEDS:
        folder = feed_path(cfg.landing_root, name)
        if _exists(spark, folder if date is None else f"{folder}/date={date}"):
            load_files(spark, cfg.landing_root, name, raw_path(cfg, name), f"{cfg.warehouse_root.rstrip('/')}/raw_ledger/{name}",
                       date, cfg.run_ts, cfg.shape, cfg.force)
        if _exists(spark, raw_path(cfg, name)):
            out[name] = spark.read.parquet(raw_path(cfg, name))
    return out


def load_bronze(spark: SparkSession, cfg: RunConfig) -> dict[str, DataFrame]:
    """M1-M6: every bronze table from the RAW rows loaded after its newest load time."""
    out = {}
    for name, raw in load_raw(spark, cfg).items():
        t = BucketedTable(spark, f"{cfg.warehouse_root.rstrip('/')}/bronze", f"bronze_{name}", [FEEDS[name].key_name], cfg.buckets)
        t.upsert(M.bronze_batch(raw.where("raw_json IS NOT NULL"), t.read(), FEEDS[name], cfg.tolerant))
        out[name] = t.read()
    return out


def raw_rejects(spark: SparkSession, cfg: RunConfig) -> DataFrame | None:
    """The texts that did not parse, of all feeds: feed, file_name, inserted_at, bad_text."""
    parts = [rejects(spark.read.parquet(raw_path(cfg, name))).select(F.lit(name).alias("feed"), "file_name", "inserted_at",
                                                                      "bad_text")
             for name in FEEDS if _exists(spark, raw_path(cfg, name))]
    return reduce(DataFrame.unionByName, parts) if parts else None


def run_snapshots(spark: SparkSession, cfg: RunConfig, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    out = {}
    now = F.lit(cfg.run_ts).cast("timestamp_ntz")
    for snap_name, (feed, key, checks, updated_at) in SNAPSHOTS.items():
        t = HistoryTable(spark, f"{cfg.warehouse_root.rstrip('/')}/snapshots", snap_name)
        if feed in bronze:
            t.write_step(M.snapshot(t.read_open(), bronze[feed], key, checks, updated_at, now))
        df = t.read()
        if df is not None:
            out[snap_name] = df
    return out


def _write(spark: SparkSession, cfg: RunConfig, layer: str, name: str, df: DataFrame,
           counted: dict[str, dict[str, int]] | None) -> DataFrame:
    t = table(spark, cfg, layer, name)
    seen = None
    if counted is not None:
        df, seen = observed(df, check_specs({}).get(name, []))
    t.write(df)
    if seen is not None:
        counted[name] = seen.get
    return t.read()


def run_all_layers(spark: SparkSession, cfg: RunConfig,
                   counted: dict[str, dict[str, int]] | None = None) -> dict[str, DataFrame]:
    """One scheduled run. Returns every table of the run (read back from storage).

    Daily and weekly feeds land apart: a table is built as soon as all its inputs exist. A dictionary given as
    ``counted`` is filled with the failing rows of each silver and gold table's row-level checks, counted in the
    write itself, for ``declared_checks``.
    """
    bronze = load_bronze(spark, cfg)
    now = F.lit(cfg.run_ts).cast("timestamp_ntz")
    t: dict[str, DataFrame] = {f"bronze_{k}": v for k, v in bronze.items()}
    t.update(run_snapshots(spark, cfg, bronze))
    t["conference_seed"] = read_seed(spark, cfg.seed_path)
    steps = [
        ("silver", "silver_box_scores", ("bronze_box_scores",), M.silver_box_scores),
        ("silver", "silver_games", ("bronze_games",), M.silver_games),
        ("silver", "silver_teams", ("bronze_teams",), M.silver_teams),
        ("silver", "silver_player_details", ("player_details_snapshot",), M.silver_player_details),
        ("silver", "silver_standings", ("standings_snapshot",), M.silver_standings),
        ("silver", "silver_team_details", ("team_details_snapshot",), M.silver_team_details),
        ("silver", "fact_player_performances", ("silver_box_scores", "silver_games"), M.fact_player_performances),
        ("silver", "fact_team_games", ("silver_games", "silver_teams"),
         lambda g, s: M.fact_team_games(g, s, cfg.since, cfg.id_prefix)),
        ("silver", "dim_players", ("silver_player_details", "fact_player_performances"),
         lambda p, f: M.dim_players(p, f, now)),
        ("silver", "dim_teams", ("silver_teams", "silver_team_details"), M.dim_teams),
        ("gold", "mart_team_analytics", ("dim_teams", "conference_seed", "fact_team_games"),
         lambda d, c, f: M.mart_team_analytics(d, c, f, cfg.current_season)),
        ("gold", "mart_player_analytics", ("dim_players", "fact_player_performances"),
         lambda d, f: M.mart_player_analytics(d, f, cfg.current_season)),
    ]
    for layer, name, needs, job in steps:
        if all(n in t for n in needs):
            t[name] = _write(spark, cfg, layer, name, job(*(t[n] for n in needs)), counted)
    del t["conference_seed"]
    return t


def check_specs(t: dict[str, DataFrame]) -> dict[str, list[Check]]:
    """The checks declared for each table; ``t`` has the parents of the relationships."""
    return {
        "bronze_box_scores": [Check("game_id.not_null", "not_null", "game_id"),
                              Check("player_id.not_null", "not_null", "player_id"),
                              Check("team_id.not_null", "not_null", "team_id"),
                              Check("status.accepted_values", "accepted_values", "status",
                                    values=("ACTIVE", "INACTIVE")),
                              Check("points.accepted_range", "accepted_range", "points", min_value=0)],
        "bronze_games": [Check("game_id.not_null", "not_null", "game_id"),
                         Check("game_date.not_null", "not_null", "game_date"),
                         Check("team_id.not_null", "not_null", "team_id"),
                         Check("pts.accepted_range", "accepted_range", "pts", min_value=0)],
        "bronze_player_details": [Check("player_id.not_null", "not_null", "player_id"),
                                  Check("full_name.not_null", "not_null", "full_name")],
        "bronze_standings": [Check("team_id.not_null", "not_null", "team_id"),
                             Check("conference_rank.not_null", "not_null", "conference_rank")],
        "bronze_team_details": [Check("team_id.not_null", "not_null", "team_id"),
                                Check("abbreviation.not_null", "not_null", "abbreviation")],
        "bronze_teams": [Check("team_id.not_null", "not_null", "team_id"),
                         Check("abbreviation.not_null", "not_null", "abbreviation"),
                         Check("team_name.not_null", "not_null", "team_name")],
        "player_details_snapshot": [Check("player_id.unique_current", "unique", "player_id",
                                          where="valid_to IS NULL")],
        "standings_snapshot": [Check("team_id.unique_current", "unique", "team_id", where="valid_to IS NULL")],
        "team_details_snapshot": [Check("team_id.unique_current", "unique", "team_id", where="valid_to IS NULL")],
        "silver_box_scores": [Check("minutes_played.not_accepted_values", "not_accepted_values", "minutes_played",
                                    values=("",)),
                              Check("box_score_id.unique", "unique", "box_score_id")],
        "silver_games": [Check("game_team_id.unique", "unique", "game_team_id")],
        "silver_player_details": [Check("is_current_record.accepted_values", "accepted_values",
                                        "is_current_record", values=("true",))],
        "silver_standings": [Check("is_current_record.accepted_values", "accepted_values", "is_current_record",
                                   values=("true",))],
        "silver_team_details": [Check("is_current_record.accepted_values", "accepted_values",
                                      "is_current_record", values=("true",))],
        "silver_teams": [Check("team_id.unique", "unique", "team_id"),
                         Check("team_id.relationships", "relationships", "team_id",
                               parent=t.get("silver_games"), field="team_id")],
        "fact_player_performances": [Check("player_id.relationships", "relationships", "player_id",
                                           parent=t.get("dim_players"), field="player_id")],
        "fact_team_games": [Check("team_id.relationships", "relationships", "team_id",
                                  parent=t.get("dim_teams"), field="team_id")],
        "mart_team_analytics": [Check("team_id.unique", "unique", "team_id"),
                                Check("team_id.not_null", "not_null", "team_id"),
                                Check("team_name.unique", "unique", "team_name"),
                                Check("team_name.not_null", "not_null", "team_name"),
                                Check("conference.accepted_values", "accepted_values", "conference",
                                      values=("East", "West")),
                                Check("conference_rank.accepted_range", "accepted_range", "conference_rank",
                                      min_value=1, max_value=15),
                                Check("current_season_win_pct.accepted_range", "accepted_range",
                                      "current_season_win_pct", min_value=0, max_value=1)],
        "mart_player_analytics": [Check("player_id.unique", "unique", "player_id"),
                                  Check("player_id.not_null", "not_null", "player_id"),
                                  Check("season_pts_rank.accepted_range", "accepted_range", "season_pts_rank",
                                        min_value=1),
                                  Check("current_season_fg_pct.accepted_range", "accepted_range",
                                        "current_season_fg_pct", min_value=0, max_value=1)],
    }


def declared_checks(t: dict[str, DataFrame], counted: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """The reference's declared tests (bronze, snapshots, silver, gold and the
    singular assertion) as one DataFrame: table, check_name, failures.

    ``counted``: what ``run_all_layers`` counted while writing; those checks scan nothing.
    """
    parts = []
    for name, checks in check_specs(t).items():
        checks = [c for c in checks if c.kind != "relationships" or c.parent is not None]  # its parent is not built yet
        if name in t and checks:
            parts.append(run_checks(t[name], checks, (counted or {}).get(name)).select(F.lit(name).alias("table"), "*"))
    if "mart_team_analytics" in t:
        m = t["mart_team_analytics"]
        failing = m.filter(F.col("current_season_total_games")
                           != F.col("current_season_wins") + F.col("current_season_losses"))
        parts.append(count_failures("assert_team_stats_total_match", failing)
                     .select(F.lit("mart_team_analytics").alias("table"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_freshness(spark: SparkSession, cfg: RunConfig, now: str) -> DataFrame:
    """Q9 on the RAW tables that exist (box scores, games, standings): warn 25 h, error 49 h."""
    clock = F.lit(now).cast("timestamp_ntz")
    parts = [freshness(spark.read.parquet(raw_path(cfg, n)), "inserted_at", clock, 25, 49, source=n)
             for n in ("box_scores", "games", "standings") if _exists(spark, raw_path(cfg, n))]
    return reduce(DataFrame.unionByName, parts)
