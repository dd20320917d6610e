"""One registered query per table job (M2-M19, M22, M23) and landing normaliser (L1-L9), over the derived feeds."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.keys import NULL_PART, SEPARATOR
from courtside.operators.incremental import upsert
from courtside.operators.star import enrich
from courtside.plans import bindings as B
from courtside.plans import models as M
from courtside.plans import normalise as N
from courtside.plans.feed_bindings import FETCHED, LOADED, bronze_frame, feed_records, raw_rows
from courtside.plans.feeds import FEEDS, SNAPSHOTS
from courtside.session import ensure_checkpoint_dir, materialize
from courtside.plans.layers import RunConfig, load_bronze
from courtside.plans.layers import table as layer_table
from courtside.sources.landing import load_files, read_landing, read_seed, records, write_landing
from courtside.sources.tables import read_table

SINCE, PREFIX = "1996-01-01", "002"
DEAL = "__deal"
Query = Callable[[SparkSession, str], DataFrame]


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bronze_job(feed: str) -> Query:
    """M1-M6 over two RAW loads: the second run reads only what is newer than the first table. Keys are hashed last, as digests
    hardly compress where they are shuffled and stored."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        first = raw_rows(spark, root, feed, 1)
        table = materialize(M.bronze(first, None, FEEDS[feed], digest=False))
        out = M.bronze(first.unionByName(raw_rows(spark, root, feed, 2)), table, FEEDS[feed], digest=False)
        return out.withColumn(FEEDS[feed].key_name, F.md5(FEEDS[feed].key_name))

    return run


def bronze_table(spark: SparkSession, root: str, feed: str, digest: bool = True, dealt: bool = False) -> DataFrame:
    """The bronze table after both loads; ``dealt`` (of key texts) shuffles it by the part before the first separator."""
    key = FEEDS[feed].key_name
    loads = [bronze_frame(spark, root, feed, n, digest) for n in (1, 2)]
    if dealt:
        loads = [t.withColumn(DEAL, F.nullif(F.substring_index(key, SEPARATOR, 1), F.lit(NULL_PART))) for t in loads]
    return upsert(*loads, [key], M.newest_fetched(), [DEAL] if dealt else [])


def snapshot_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """M7-M9 after each of the two loads; without an updated_at column the run time stamps versions."""
    feed, key, checks, updated_at = SNAPSHOTS[name]
    now = {n: F.lit(LOADED[n]).cast("timestamp_ntz") for n in (1, 2)}
    first = materialize(M.snapshot(None, bronze_frame(spark, root, feed, 1), key, checks, updated_at, now[1]))
    return M.snapshot(first, bronze_table(spark, root, feed), key, checks, updated_at, now[2])


def silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    jobs = {"silver_box_scores": ("box_scores", M.silver_box_scores), "silver_games": ("games", M.silver_games),
            "silver_teams": ("teams", M.silver_teams)}
    snaps = {"silver_player_details": ("player_details_snapshot", M.silver_player_details),
             "silver_standings": ("standings_snapshot", M.silver_standings),
             "silver_team_details": ("team_details_snapshot", M.silver_team_details)}
    if name in jobs:
        feed, job = jobs[name]
        key = FEEDS[feed].key_name
        return job(bronze_table(spark, root, feed, digest=False)).withColumn(key, F.md5(key))  # made after the shuffle
    snap, job = snaps[name]
    return job(snapshot_table(spark, root, snap))


def fact_player_performances(spark: SparkSession, root: str) -> DataFrame:
    """M16 with one shuffle a frame: both are dealt by the text before the first separator of their keys.

    Both keys begin with the game id, so that text is made from the key and from the game id alone: it parts
    neither the rows of a key nor those that the join brings together. Without a game id it is NULL, as such rows match none.
    """
    box = M.silver_box_scores(bronze_table(spark, root, "box_scores", digest=False, dealt=True), [DEAL])
    games = M.silver_games(bronze_table(spark, root, "games", digest=False, dealt=True), [DEAL])
    return M.fact_player_performances(box, games, [DEAL])


def fact_team_games(spark: SparkSession, root: str) -> DataFrame:
    return M.fact_team_games(silver(spark, root, "silver_games"), silver(spark, root, "silver_teams"), SINCE, PREFIX)


def dim_players(spark: SparkSession, root: str) -> DataFrame:
    now = F.lit(LOADED[2]).cast("timestamp_ntz")
    return M.dim_players(silver(spark, root, "silver_player_details"), silver(spark, root, "silver_box_scores"), now)


def dim_teams(spark: SparkSession, root: str) -> DataFrame:
    return M.dim_teams(silver(spark, root, "silver_teams"), silver(spark, root, "silver_team_details"))


def adhoc_games_flatten(spark: SparkSession, root: str) -> DataFrame:
    """M22 over all RAW rows, those of both loads."""
    return M.adhoc_games_flatten(raw_rows(spark, root, "games", 1).unionByName(raw_rows(spark, root, "games", 2)))


def adhoc_latest_teams(spark: SparkSession, root: str) -> DataFrame:
    return M.adhoc_latest_teams(bronze_table(spark, root, "teams"))


# ---- landing ---------------------------------------------------------------------


def _as_fetched(frame: DataFrame, rename: dict[str, str], *keep: str) -> DataFrame:
    """A feed frame under the fetched API's column names."""
    return frame.select(*[F.col(c).alias(c) for c in keep], *[F.col(dst).alias(src) for src, dst in rename.items()])


def landing_games(spark: SparkSession, root: str) -> DataFrame:
    """L1."""
    api = _as_fetched(feed_records(spark, root, "games", 1), N.GAMES_RENAME)
    return N.normalise_games(api, "2025-26", FETCHED[1])


def landing_box_scores(spark: SparkSession, root: str) -> DataFrame:
    """Active and inactive players, the latter with zero statistics."""
    rec = feed_records(spark, root, "box_scores", 1)
    active = _as_fetched(rec.where("status = 'ACTIVE'"), N.BOX_ACTIVE_RENAME)
    inactive = _as_fetched(rec.where("status = 'INACTIVE'"), N.BOX_INACTIVE_RENAME, "game_id")
    return N.normalise_box_scores(active, inactive, FETCHED[1])


def landing_standings(spark: SparkSession, root: str) -> DataFrame:
    """L5."""
    return N.normalise_standings(_as_fetched(feed_records(spark, root, "standings", 1), N.STANDINGS_RENAME), FETCHED[1])


def landing_teams(spark: SparkSession, root: str) -> DataFrame:
    """L6."""
    return N.normalise_teams(_as_fetched(feed_records(spark, root, "teams", 1), N.TEAMS_RENAME), FETCHED[1])


def landing_team_details(spark: SparkSession, root: str) -> DataFrame:
    """The first of two background rows of each team."""
    both = [feed_records(spark, root, "team_details", n) for n in (1, 2)]
    api = _as_fetched(both[0].unionByName(both[1]), N.TEAM_DETAILS_RENAME, "team_id")
    return N.normalise_team_details(api, FETCHED[1], [F.col("HEADCOACH").desc(), F.col("GENERALMANAGER").asc_nulls_last()])


def landing_player_details(spark: SparkSession, root: str) -> DataFrame:
    """The first of two info rows of each player."""
    both = [feed_records(spark, root, "player_details", n) for n in (1, 2)]
    api = _as_fetched(both[0].unionByName(both[1]), N.PLAYER_DETAILS_RENAME, "player_id")
    return N.normalise_player_details(api, FETCHED[1], [F.col("HEIGHT").desc()])


def landing_backfill(spark: SparkSession, root: str) -> DataFrame:
    """A season split into date folders, read back and flattened."""
    folder = scratch(spark, "backfill")
    frame = feed_records(spark, root, "games", 1)
    api = _as_fetched(frame.withColumn("game_date", F.col("game_date").cast("timestamp_ntz")), N.GAMES_RENAME)
    N.backfill_games(api, "1995-01", folder)
    raw = read_landing(spark, folder, "games", shape="jsonl", batch_ts=LOADED[1])
    v = F.col("value")
    get = lambda p, t: M.typed_path(v, f"$.{p}", t)
    return records(raw).select(get("game_id", "string").alias("game_id"), get("team_id", "int").alias("team_id"),
                               get("game_date", "timestamp_ntz").alias("game_date"), get("pts", "int").alias("pts"),
                               get("fetched_at", "string").alias("fetched_at"),
                               F.regexp_extract("file_name", "date=([0-9]+)/", 1).alias("folder"))


def landing_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """S8 -> S1-S6 -> RAW -> bronze: two landed days with a bad text each, one date read per run.

    Day one is landed as array files, day two as JSON lines. Columns tell the good
    rows of the bronze table and the rejected texts apart.
    """
    folder, raw_table = scratch(spark, "landing"), scratch(spark, "raw")
    for n, shape in ((1, "array"), (2, "jsonl")):
        date = FETCHED[n][:10].replace("-", "")
        rec = feed_records(spark, root, "teams", n)
        if shape == "array":
            text = rec.groupBy(F.pmod(F.xxhash64("team_id"), F.lit(4)).alias("c")).agg(
                F.to_json(F.collect_list(F.struct(*rec.columns))).alias("value")).select("value")
            bad = spark.range(1).select(F.lit("[{not json").alias("value"))
            text.unionByName(bad).repartition("value").write.text(f"{folder}/source/teams/date={date}")
        else:
            write_landing(rec.withColumn("date", F.lit(date)), folder, "teams")
            spark.range(1).select(F.lit("{not json").alias("value")).write.mode("append").text(f"{folder}/source/teams/date={date}")
        # Several array texts share a file where tasks write them; line by line both shapes read alike.
        read_landing(spark, folder, "teams", date, LOADED[n], "jsonl").write.mode("append").parquet(raw_table)
    raw = spark.read.parquet(raw_table)
    good = raw.where("raw_json IS NOT NULL")
    first = materialize(M.bronze(good.where(F.col("inserted_at") == F.lit(LOADED[1]).cast("timestamp_ntz")), None, FEEDS["teams"]))
    table = M.bronze(good, first, FEEDS["teams"]).select(
        F.col("team_version_id").alias("id"), F.col("nickname").alias("value"), "loaded_at_utc")
    bad = raw.where("raw_json IS NULL").select(F.lit("reject").alias("id"), F.col("bad_text").alias("value"),
                                               F.col("inserted_at").alias("loaded_at_utc"))
    return table.unionByName(bad)


def landing_damaged(spark: SparkSession, root: str) -> DataFrame:
    """Arrays of orders, one record a line or all in one line, every 97th record damaged: the others load."""
    folder = scratch(spark, "damaged")
    o = read_table(spark, root, "orders").select("o_orderkey", "o_orderstatus", F.struct("o_custkey").alias("customer"))
    text = F.to_json(F.struct("o_orderkey", "o_orderstatus", "customer"))
    text = F.when(F.col("o_orderkey") % 97 == 0, F.regexp_replace(text, ":", " ")).otherwise(text)
    file = F.pmod(F.xxhash64("o_orderkey"), F.lit(64))
    arrays = o.groupBy(file.alias("file")).agg(F.collect_list(text).alias("rec"))
    joined = F.when(F.col("file") % 2 == 0, F.concat(F.lit("["), F.array_join("rec", ",\n"), F.lit("]"))).otherwise(
        F.concat(F.lit("["), F.array_join("rec", ","), F.lit("]")))
    arrays.select(joined.alias("value")).write.text(f"{folder}/source/orders/date=20240101")
    raw = materialize(read_landing(spark, folder, "orders", "20240101", LOADED[1]))
    get = lambda p, t: M.typed_path(F.col("value"), f"$.{p}", t)
    good = records(raw.where("raw_json IS NOT NULL")).select(
        get("o_orderkey", "int").alias("o_orderkey"), get("o_orderstatus", "string").alias("o_orderstatus"),
        get("customer.o_custkey", "int").alias("o_custkey"), F.lit(False).alias("rejected"))
    key = F.regexp_extract("bad_text", '"o_orderkey" ([0-9]+)', 1).cast("bigint")
    bad = raw.where("raw_json IS NULL").select(key.alias("o_orderkey"), F.lit(True).alias("rejected"))
    return good.unionByName(bad, allowMissingColumns=True)


def landing_forced_load(spark: SparkSession, root: str) -> DataFrame:
    """One landed day loaded three times: new, again unforced (nothing to do), and forced."""
    folder, raw_table, ledger = (scratch(spark, n) for n in ("forced", "raw", "ledger"))
    write_landing(feed_records(spark, root, "team_details", 1).withColumn("date", F.lit("20240229")), folder, "team_details")
    loads = [("2024-03-01 11:00:00", False), ("2024-03-02 11:00:00", False), ("2024-03-03 11:00:00", True)]
    for at, force in loads:
        load_files(spark, folder, "team_details", raw_table, ledger, "20240229", at, force=force)
    return records(spark.read.parquet(raw_table)).select(
        M.typed_path(F.col("value"), "$.team_id", "int").alias("team_id"), F.col("inserted_at").alias("loaded_at_utc"))


def landing_all_feeds(spark: SparkSession, root: str) -> DataFrame:
    """All six feeds landed as files and loaded by one run into their bronze tables."""
    cfg = RunConfig(scratch(spark, "feeds"), scratch(spark, "warehouse"), LOADED[1], "", date="20240301")
    for feed in FEEDS:
        write_landing(feed_records(spark, root, feed, 1).withColumn("date", F.lit(cfg.date)), cfg.landing_root, feed,
                      compression="gzip")
    parts = [t.select(F.lit(feed).alias("feed"), F.col(FEEDS[feed].key_name).alias("id"), "loaded_at_utc")
             for feed, t in load_bronze(spark, cfg).items()]
    return reduce(DataFrame.unionByName, parts)


def seed_lookup(spark: SparkSession, root: str) -> DataFrame:
    """The conference seed as a CSV file with a header, read with its declared schema and looked up."""
    path = scratch(spark, "seed")
    seed = B.conference_lookup(spark, root).join(B.dim_teams(spark, root).select("team_id", "team_name"), "team_id")
    seed.select("team_id", "team_name", "conference").where("team_id % 5 <> 0").write.option("header", True).csv(path)
    return enrich(B.dim_teams(spark, root), read_seed(spark, path).select("team_id", "conference"), on="team_id")


def named_datasets(spark: SparkSession, root: str) -> DataFrame:
    """A named table written anew three times; readers of its name see the last version whole."""
    cfg = RunConfig("", scratch(spark, "named"), LOADED[1], "")
    name = layer_table(spark, cfg, "silver", "dim_teams")
    teams = B.dim_teams(spark, root)
    for step in (teams, teams.where("team_id % 2 = 0"), teams.withColumn("team_name", F.upper("team_name"))):
        name.write(step)
    return layer_table(spark, cfg, "silver", "dim_teams").read()


REGISTRY: dict[str, Query] = {f"bronze_{f}": bronze_job(f) for f in FEEDS}
REGISTRY["bronze_box_scores_all_columns"] = REGISTRY.pop("bronze_box_scores")
REGISTRY |= {n: (lambda spark, root, n=n: snapshot_table(spark, root, n)) for n in SNAPSHOTS}
REGISTRY |= {n: (lambda spark, root, n=n: silver(spark, root, n)) for n in (
    "silver_box_scores", "silver_games", "silver_teams", "silver_player_details", "silver_standings", "silver_team_details")}
REGISTRY |= {f.__name__: f for f in (
    fact_player_performances, fact_team_games, dim_players, dim_teams, adhoc_games_flatten, adhoc_latest_teams,
    landing_games, landing_box_scores, landing_standings, landing_teams, landing_team_details, landing_player_details,
    landing_backfill, landing_roundtrip, landing_damaged, landing_forced_load, landing_all_feeds, seed_lookup, named_datasets)}
