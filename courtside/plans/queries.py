"""Queries registered with the driver: one per operator family, each over the
whole test tables. Join misses are made by derived keys, never by leaving rows out;
only the operators that filter by nature (watermark, season, upsert batches) do."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators.star import resolve_counterpart
from courtside.plans import bindings as B
from courtside.plans.marts import player_mart, team_mart
from courtside.session import ensure_checkpoint_dir, materialize
from courtside.sources.colocated import CoLocated
from courtside.sources.tables import BucketedTable, HistoryTable


def q_player_mart(spark: SparkSession, root: str) -> DataFrame:
    return player_mart(B.dim_players(spark, root), B.player_facts(spark, root), B.CURRENT_SEASON,
                       B.player_recent_order(), B.RECENT_N, basic_cols=B.PLAYER_COLS)


def team_facts(spark: SparkSession, root: str) -> DataFrame:
    """fact_team_games: team games + opponent (J5), games since the season start."""
    rows = B.team_game_rows(spark, root).filter(F.col("game_date") >= F.lit(B.SEASON_START).cast("timestamp_ntz"))
    codes = B.team_codes(spark, root)
    return resolve_counterpart(rows, codes, "matchup", "own_abbreviation", "abbreviation",
                               {"opponent_team_id": "code_team_id", "opponent_abbreviation": "abbreviation"})


def q_team_mart(spark: SparkSession, root: str) -> DataFrame:
    return team_mart(B.dim_teams(spark, root), B.conference_lookup(spark, root), team_facts(spark, root),
                     B.CURRENT_SEASON, B.team_recent_order(), B.RECENT_N, basic_cols=B.TEAM_COLS)


REGISTRY = {
    "player_mart": q_player_mart,
    "team_mart": q_team_mart,
}


# ---------------------------------------------------------------------------
# Keys, JSON, landing shapes
# ---------------------------------------------------------------------------
from courtside.functions.keys import surrogate_key  # noqa: E402
from courtside.functions.scalars import blank_default, guarded_ratio, status_bucket  # noqa: E402
from courtside.functions.semistruct import extract, flatten, parse_raw  # noqa: E402
from courtside.sources.landing import pack_json_arrays  # noqa: E402
from courtside.sources.tables import read_table  # noqa: E402


def q_surrogate_key(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders")
    prio = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    status = F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.col("o_orderstatus"))
    return o.select("o_orderkey",
                    surrogate_key("o_orderkey", "o_custkey").alias("order_pk"),
                    surrogate_key(F.col("o_custkey"), prio, F.to_date("o_orderdate")).alias("version_pk"),
                    surrogate_key(status, prio).alias("status_pk"))


EVENT_SPEC = [("k", "$.k", "int"), ("k_text", "$.k", "string"), ("k_double", "$.k", "double"),
              ("missing", "$.missing", "int")]


def q_json_extract_typed(spark: SparkSession, root: str) -> DataFrame:
    ev = parse_raw(read_table(spark, root, "events"), "props", "doc")
    return extract(ev, "doc", EVENT_SPEC, keep=["event_id", "user_id"])


def q_json_flatten_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """S8 -> S1 -> V1 -> V3: events packed per landing date into JSON array
    documents of bounded size, parsed back to VARIANT, flattened, typed."""
    ev = read_table(spark, root, "events")
    ev = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id",
                   "event_type", "value", F.parse_json("props").alias("props"),
                   F.date_format("ts", "yyyyMMdd").alias("date"))
    files = pack_json_arrays(ev, "date", "events", max_records=2000)
    raw = parse_raw(files, "raw_text", "raw_json")
    flat = flatten(raw, "raw_json", keep=["file_name", "date"], value="rec")
    spec = [("event_id", "$.event_id", "int"), ("ts", "$.ts", "timestamp_ntz"), ("user_id", "$.user_id", "int"),
            ("event_type", "$.event_type", "string"), ("value", "$.value", "double"), ("k", "$.props.k", "int")]
    out = extract(flat, "rec", spec, keep=["date"])
    return out.select("event_id", "ts", "user_id", "event_type", "value", "k",
                      F.to_date("date", "yyyyMMdd").alias("landing_date"))


def q_landing_union_zero_fill(spark: SparkSession, root: str) -> DataFrame:
    """L2 + L3 + U3: active rows renamed, inactive rows with zero statistics,
    '00:00' minutes and no jersey/position, appended by name."""
    li = read_table(spark, root, "lineitem")
    active = li.filter(F.col("l_returnflag") != "R").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_partkey").alias("player_id"),
        F.col("l_suppkey").alias("team_id"), F.lit("ACTIVE").alias("status"),
        F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":00")).alias("minutes"),
        F.col("l_quantity").cast("bigint").alias("points"), F.col("l_linenumber").cast("bigint").alias("assists"),
        F.col("l_linenumber").cast("string").alias("jersey_number"), F.col("l_linestatus").alias("position"))
    zero = F.lit(0).cast("bigint")
    inactive = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_partkey").alias("player_id"),
        F.col("l_suppkey").alias("team_id"), F.lit("INACTIVE").alias("status"), F.lit("00:00").alias("minutes"),
        zero.alias("points"), zero.alias("assists"))
    return active.unionByName(inactive, allowMissingColumns=True)


def q_distinct_ids(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "lineitem").select(F.col("l_orderkey").alias("game_id")).distinct()


def _raw_minutes() -> F.Column:
    return (F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string"))
             .when(F.col("l_linenumber") == 2, F.lit(""))
             .otherwise(F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":"),
                                 F.lpad((F.col("l_orderkey") % 60).cast("string"), 2, "0"))))


def q_blank_default(spark: SparkSession, root: str) -> DataFrame:
    li = read_table(spark, root, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", blank_default(_raw_minutes()).alias("minutes_played"))


def _career_to_year() -> F.Column:
    return (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
             .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
             .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("abc"))
             .otherwise((F.year("o_orderdate") + 25).cast("string")))


def q_status_bucket(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders")
    y = _career_to_year()
    return o.select("o_orderkey", y.alias("career_to_year"), status_bucket(y, 2024).alias("player_status"))


def q_guarded_ratio(spark: SparkSession, root: str) -> DataFrame:
    li = read_table(spark, root, "lineitem")
    num = F.round(F.col("l_tax") * 100).cast("bigint")
    den = F.when(F.col("l_returnflag") == "N", F.lit(None).cast("bigint")).otherwise(
        F.round(F.col("l_discount") * 100).cast("bigint"))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", guarded_ratio(num, den).alias("fg_pct_calc"))


# ---------------------------------------------------------------------------
# Windows, statistics, ranks
# ---------------------------------------------------------------------------
from courtside.operators.dedup import latest_per_key, recent_n  # noqa: E402,F401
from courtside.operators.ranking import global_rank, rank_within  # noqa: E402
from courtside.operators.stats import StatSpec, all_and_season_stats, period_stats, recent_stats  # noqa: E402


def q_latest_per_key(spark: SparkSession, root: str) -> DataFrame:
    li = read_table(spark, root, "lineitem")
    order = [F.col("l_shipdate").desc_nulls_first(), F.col("l_partkey").asc(), F.col("l_suppkey").asc()]
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], order)


def q_recent_n_stats(spark: SparkSession, root: str) -> DataFrame:
    spec = StatSpec(avg={"avg_points": "points"}, ratios={"fg_pct": ("fg_made", "fg_attempted")},
                    distinct="game_id", distinct_name="games")
    return recent_stats(B.player_facts(spark, root), "player_id", spec, B.player_recent_order(), B.RECENT_N,
                        prefix="recent_")


def q_player_period_stats(spark: SparkSession, root: str) -> DataFrame:
    active = B.player_facts(spark, root).filter(F.col("status") == "ACTIVE")
    spec = StatSpec(avg={"avg_points": "points", "avg_assists": "assists"},
                    ratios={"fg_pct": ("fg_made", "fg_attempted"), "fg3_pct": ("fg3_made", "fg3_attempted")},
                    maxes={"last_date": "game_date"}, distinct="game_id", distinct_name="games")
    recent_spec = StatSpec(avg={"avg_points": "points"}, ratios={"fg_pct": ("fg_made", "fg_attempted")})
    return period_stats(active, "player_id", spec, "season", B.CURRENT_SEASON, B.player_recent_order(),
                        B.RECENT_N, recent_spec)


def _team_rows(spark: SparkSession, root: str) -> DataFrame:
    return B.team_game_rows(spark, root)


def q_team_period_stats(spark: SparkSession, root: str) -> DataFrame:
    rows = _team_rows(spark, root)
    spec = StatSpec(avg={"avg_point": "team_total_point"}, flags={"wins": F.col("wl") == "W"},
                    distinct="game_id", distinct_name="games")
    order = [F.col("game_date").desc_nulls_first(), F.col("game_id").desc(), F.col("part_id").desc(),
             F.col("line_no").desc()]
    st = period_stats(rows, "team_id", spec, "season", B.CURRENT_SEASON, order, B.RECENT_N)
    out = [F.col("team_id")]
    for p in ("all_", "season_", "recent_"):
        out += [F.col(f"{p}games"), F.col(f"{p}wins"),
                (F.col(f"{p}games") - F.col(f"{p}wins")).alias(f"{p}losses"),
                (F.col(f"{p}wins").cast("double") / F.col(f"{p}games").cast("double")).alias(f"{p}win_pct"),
                F.col(f"{p}avg_point")]
    return st.select(*out)


def _season_wins_by_team(spark: SparkSession, root: str) -> DataFrame:
    spec = StatSpec(flags={"wins": F.col("wl") == "W"})
    st = all_and_season_stats(_team_rows(spark, root), "team_id", spec, "season", "2001", "all_", "season_")
    return st.select("team_id", F.col("season_wins"))


def q_rank_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """Supplier rank inside its region by 2001 wins (NULLs first)."""
    teams = B.dim_teams(spark, root).join(B.conference_lookup(spark, root), on="team_id", how="left")
    measured = teams.select("team_id", F.col("conference").alias("region")).join(
        _season_wins_by_team(spark, root), on="team_id", how="left")
    # Three steps of the rank read the measures: one narrow row per team, written once.
    return rank_within(materialize(measured), ["region"], "season_wins", out="region_rank")


def q_rank_global(spark: SparkSession, root: str) -> DataFrame:
    """Every player ranked by season average points over the whole table."""
    spec = StatSpec(avg={"avg_points": "points"})
    st = all_and_season_stats(B.player_facts(spark, root).filter(F.col("status") == "ACTIVE"), "player_id", spec,
                              "season", B.CURRENT_SEASON, "all_", "season_")
    players = B.dim_players(spark, root).select("player_id").join(
        st.select("player_id", F.col("season_avg_points")), on="player_id", how="left")
    return global_rank(materialize(players), "season_avg_points", out="points_rank")


# ---------------------------------------------------------------------------
# Joins, orphans
# ---------------------------------------------------------------------------
from courtside.operators.star import enrich, fill_orphans, orphan_keys, placeholder_defaults  # noqa: E402


def box_and_team_games(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Box scores and team games; the games of other years than 1998 carry another key, so they miss."""
    li = read_table(spark, root, "lineitem")
    o = read_table(spark, root, "orders")
    other = F.when(F.year("o_orderdate") == 1998, F.col("game_id")).otherwise(-1 - F.col("game_id"))
    team_games = (li.groupBy(F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("team_id"))
                    .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("team_pts"))
                    .join(o.select(F.col("o_orderkey").alias("game_id"), F.col("o_orderdate").alias("game_date"),
                                   "o_orderdate"), on="game_id", how="inner")
                    .select(other.alias("game_id"), "team_id", "team_pts", "game_date"))
    box = li.select(F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("team_id"),
                    F.col("l_partkey").alias("player_id"),
                    F.round(F.col("l_tax") * 100).cast("bigint").alias("fg_made"),
                    F.round(F.col("l_discount") * 100).cast("bigint").alias("fg_attempted"))
    return box, team_games


def with_fg_pct(joined: DataFrame) -> DataFrame:
    return joined.select("game_id", "team_id", "player_id", "team_pts", "game_date",
                         guarded_ratio("fg_made", "fg_attempted").alias("fg_pct_calc"))


def q_fact_left_join(spark: SparkSession, root: str) -> DataFrame:
    """J2 + P5: box scores LEFT JOIN team games on (game_id, team_id)."""
    box, team_games = box_and_team_games(spark, root)
    return with_fg_pct(box.join(team_games, on=["game_id", "team_id"], how="left"))


def _colocated(spark: SparkSession, root: str, **tables: DataFrame) -> CoLocated:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/colocated-{uuid.uuid4().hex}"
    return CoLocated(spark, folder, tables, ["game_id", "team_id"], 64)


def q_fact_join_colocated(spark: SparkSession, root: str) -> DataFrame:
    """J2 over tables stored by (game_id, team_id): no shuffle under the join."""
    box, team_games = box_and_team_games(spark, root)
    return with_fg_pct(_colocated(spark, root, box=box, games=team_games).join("box", "games"))


def q_latest_colocated(spark: SparkSession, root: str) -> DataFrame:
    """W1 over a table stored by its key: the team's last line of each game, no shuffle under the window."""
    li = read_table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("team_id"), F.col("l_partkey").alias("player_id"),
        "l_linenumber", "l_shipdate")
    order = [F.col("l_shipdate").desc_nulls_first(), F.col("l_linenumber").desc(), F.col("player_id").desc()]
    return _colocated(spark, root, lines=li).per_key(lambda t: latest_per_key(t, ["game_id", "team_id"], order), "lines")


def q_dim_enrich(spark: SparkSession, root: str) -> DataFrame:
    """J1 + J4: supplier LEFT JOIN nation LEFT JOIN a region lookup in which one region's key misses."""
    s = read_table(spark, root, "supplier")
    n = read_table(spark, root, "nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                                 F.col("n_name").alias("nation_name"), "n_regionkey")
    key = F.when(F.col("r_name") != "MIDDLE EAST", F.col("r_regionkey")).otherwise(-1 - F.col("r_regionkey"))
    r = read_table(spark, root, "region").select(key.alias("n_regionkey"), F.col("r_name").alias("conference"))
    j = enrich(enrich(s, n, on="s_nationkey"), r, on="n_regionkey")
    return j.select(F.col("s_suppkey").alias("team_id"), F.col("s_name").alias("team_name"), "nation_name",
                    "conference")


def q_counterpart_join(spark: SparkSession, root: str) -> DataFrame:
    rows = B.team_game_rows(spark, root)
    out = resolve_counterpart(rows, B.team_codes(spark, root), "matchup", "own_abbreviation", "abbreviation",
                              {"opponent_team_id": "code_team_id", "opponent_abbreviation": "abbreviation"})
    return out.select("game_id", "team_id", "part_id", "line_no", "matchup", "own_abbreviation",
                      "opponent_team_id", "opponent_abbreviation")


def _customers_by_balance(spark: SparkSession, root: str) -> DataFrame:
    """All customers; those in debt carry the negative key, so orders of theirs are orphans."""
    key = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).otherwise(-1 - F.col("c_custkey"))
    return read_table(spark, root, "customer").withColumn("c_custkey", key)


def q_orphan_keys(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders")
    return orphan_keys(o, _customers_by_balance(spark, root), "o_custkey", "c_custkey", out="c_custkey")


def q_orphan_keys_empty_dimension(spark: SparkSession, root: str) -> DataFrame:
    """J6 against a dimension without rows: every key is an orphan, the NULL one too."""
    o = read_table(spark, root, "orders").select(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("k"))
    nobody = read_table(spark, root, "customer").where("c_custkey < 0")
    return orphan_keys(o, nobody, "k", "c_custkey", out="c_custkey")


def q_orphan_fill(spark: SparkSession, root: str) -> DataFrame:
    """Customer dimension plus one placeholder member per orphan key."""
    now = F.lit(B.FIXED_NOW).cast("timestamp_ntz")
    dim = _customers_by_balance(spark, root).select(
        surrogate_key("c_custkey").alias("customer_pk"), "c_custkey", "c_name", "c_mktsegment", "c_nationkey",
        F.lit("Known").alias("customer_status"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
        .alias("data_freshness_at"))
    orphans = orphan_keys(read_table(spark, root, "orders"), dim, "o_custkey", "c_custkey", out="c_custkey")
    defaults = placeholder_defaults("c_custkey", "Unknown Customer (", now, "c_name", ["c_mktsegment"],
                                    status_col="customer_status", freshness_col="data_freshness_at")
    defaults["customer_pk"] = surrogate_key("c_custkey")
    return fill_orphans(dim, orphans, "c_custkey", defaults)


def q_not_in_with_null(spark: SparkSession, root: str) -> DataFrame:
    """J6 with a NULL in the dimension keys: NOT IN semantics give no row."""
    c = read_table(spark, root, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("bigint")).otherwise(F.col("c_custkey")).alias("c_custkey"))
    return orphan_keys(read_table(spark, root, "orders"), c, "o_custkey", "c_custkey", out="c_custkey")


# ---------------------------------------------------------------------------
# Incremental loads
# ---------------------------------------------------------------------------
from courtside.operators.incremental import dedup_batch, new_rows, upsert  # noqa: E402


def _events_loaded(spark: SparkSession, root: str) -> DataFrame:
    ev = read_table(spark, root, "events")
    return ev.select("event_id", "user_id", "event_type", "value", "ts",
                     F.col("ts").alias("inserted_at"))


def q_watermark_filter(spark: SparkSession, root: str) -> DataFrame:
    """F5 + I2: rows strictly newer than the newest load time of a first batch."""
    raw = _events_loaded(spark, root)
    target = raw.filter(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")) \
                .withColumnRenamed("inserted_at", "loaded_at_utc")
    return new_rows(raw, target, "inserted_at", "loaded_at_utc").drop("inserted_at")


def q_incremental_upsert(spark: SparkSession, root: str) -> DataFrame:
    """A target and an overlapping batch that holds two versions of its
    newest keys; the batch is reduced to the newest version per key, then
    replaces matching target rows and adds the rest."""
    ev = read_table(spark, root, "events")
    day = F.expr("INTERVAL 1 DAY")
    target = ev.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).select(
        "event_id", "user_id", "value", F.col("ts").alias("fetched_at"), F.lit("target").alias("origin"))
    b1 = ev.filter(F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).select(
        "event_id", "user_id", (F.col("value") + 1).alias("value"), (F.col("ts") + day).alias("fetched_at"),
        F.lit("batch1").alias("origin"))
    b2 = ev.filter(F.col("ts") >= F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")).select(
        "event_id", "user_id", (F.col("value") + 2).alias("value"), (F.col("ts") + day + day).alias("fetched_at"),
        F.lit("batch2").alias("origin"))
    batch = dedup_batch(b1.unionByName(b2), ["event_id"], [F.col("fetched_at").desc_nulls_first()])
    return upsert(target, batch, ["event_id"])


def q_incremental_upsert_buckets(spark: SparkSession, root: str) -> DataFrame:
    """I3 on a stored table: all orders, then a batch of one customer in a hundred (changed rows and new ones)."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orders-{uuid.uuid4().hex}"
    o = read_table(spark, root, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    table = BucketedTable(spark, folder, "orders", ["o_custkey", "o_orderkey"], 64, bucket_by=["o_custkey"])
    table.upsert(o)
    few = o.where(F.col("o_custkey") % 100 == 7)
    new = few.where(F.col("o_orderkey") % 3 == 0).withColumn("o_orderkey", -F.col("o_orderkey"))
    table.upsert(few.where(F.col("o_orderkey") % 2 == 0).withColumn("o_orderstatus", F.lit("X")).unionByName(new))
    return table.read()


# ---------------------------------------------------------------------------
# Type-2 history
# ---------------------------------------------------------------------------
from courtside.operators.scd2 import asof_lookup, current_versions, history_bulk, snapshot_check  # noqa: E402


def customer_year_rows(spark: SparkSession, root: str) -> DataFrame:
    """One row per customer and order year: the year's latest order, with
    priority '5-LOW' turned into NULL so NULL transitions occur."""
    o = read_table(spark, root, "orders")
    rows = o.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("updated_at"),
                    F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
                    "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("batch_year"))
    return latest_per_key(rows, ["c_custkey", "batch_year"],
                          [F.col("updated_at").desc_nulls_first(), F.col("o_orderkey").desc()])


SNAP_COLS = ["c_custkey", "o_orderpriority", "o_orderkey", "o_totalprice", "valid_from", "valid_to", "version_id",
             "version_updated_at"]


def scd2_batches(spark: SparkSession, root: str) -> DataFrame:
    """D1-D6 applied batch by batch (one batch per order year, oldest first).

    The loop runs on the driver over the batch list only (a handful of years). The rows are stored
    by year, so each step reads its own; it joins them with the open versions and writes these and
    what it closes: the closed history is not touched again.
    """
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/history-{uuid.uuid4().hex}"
    customer_year_rows(spark, root).write.partitionBy("batch_year").parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    history = HistoryTable(spark, folder, "versions")
    for y in sorted(r[0] for r in rows.select("batch_year").distinct().collect()):
        batch = rows.where(F.col("batch_year") == y).drop("batch_year")
        history.write_step(snapshot_check(history.read_open(), batch, "c_custkey", ["o_orderpriority"], updated_at_col="updated_at"))
    return history.read().select(*SNAP_COLS)


def q_scd2_check_history(spark: SparkSession, root: str) -> DataFrame:
    return scd2_batches(spark, root)


def q_scd2_bulk_history(spark: SparkSession, root: str) -> DataFrame:
    rows = materialize(customer_year_rows(spark, root).drop("batch_year"))
    return history_bulk(rows, "c_custkey", ["o_orderpriority"], "updated_at",
                        tie_breakers=[F.col("o_orderkey").desc()]).select(*SNAP_COLS)


def q_scd2_current(spark: SparkSession, root: str) -> DataFrame:
    snap = q_scd2_bulk_history(spark, root)
    cur = current_versions(snap, loaded_col=None)
    return cur.select("c_custkey", "o_orderpriority", "o_orderkey", "record_effective_date", "is_current_record")


def q_scd2_asof(spark: SparkSession, root: str) -> DataFrame:
    snap = materialize(q_scd2_bulk_history(spark, root).withColumnRenamed("o_orderpriority", "version_priority"))
    o = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return asof_lookup(o, snap, "o_custkey", "o_orderdate", snap_key="c_custkey",
                       cols=["version_id", "version_priority"])


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------
from courtside.operators.quality import Check, count_failures, freshness, run_checks  # noqa: E402


def _orders_q(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders")
    return o.withColumn("priority_or_null", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))


def q_quality_not_null(spark: SparkSession, root: str) -> DataFrame:
    return run_checks(_orders_q(spark, root), [
        Check("orders.o_orderkey.not_null", "not_null", "o_orderkey"),
        Check("orders.o_custkey.not_null", "not_null", "o_custkey"),
        Check("orders.priority.not_null", "not_null", "priority_or_null")])


def q_quality_unique(spark: SparkSession, root: str) -> DataFrame:
    o = run_checks(_orders_q(spark, root), [Check("orders.o_orderkey.unique", "unique", "o_orderkey"),
                                            Check("orders.o_custkey.unique", "unique", "o_custkey")])
    li = run_checks(read_table(spark, root, "lineitem"), [Check("lineitem.l_orderkey.unique", "unique", "l_orderkey")])
    return o.unionByName(li)


def q_quality_unique_where(spark: SparkSession, root: str) -> DataFrame:
    snap = materialize(q_scd2_bulk_history(spark, root).select("c_custkey", "valid_to"))
    a = run_checks(snap, [Check("history.c_custkey.unique_open", "unique", "c_custkey", where="valid_to IS NULL"),
                          Check("history.c_custkey.unique_all", "unique", "c_custkey")])
    b = run_checks(_orders_q(spark, root), [Check("orders.o_custkey.unique_finished", "unique", "o_custkey",
                                                  where="o_orderstatus = 'F'")])
    return a.unionByName(b)


def q_quality_accepted_values(spark: SparkSession, root: str) -> DataFrame:
    li = read_table(spark, root, "lineitem")
    box = li.select("l_returnflag", F.when(F.col("l_returnflag") == "R", "INACTIVE").otherwise("ACTIVE").alias("status"),
                    F.when(F.col("l_linestatus") == "O", "W").otherwise("L").alias("wl"))
    return run_checks(box, [
        Check("box.status.accepted", "accepted_values", "status", values=("ACTIVE", "INACTIVE")),
        Check("box.l_returnflag.accepted", "accepted_values", "l_returnflag", values=("A", "N")),
        Check("box.wl.accepted", "accepted_values", "wl", values=("W",))])


def q_quality_not_accepted_values(spark: SparkSession, root: str) -> DataFrame:
    li = read_table(spark, root, "lineitem").select(_raw_minutes().alias("raw_minutes"))
    li = li.withColumn("minutes_played", blank_default("raw_minutes"))
    return run_checks(li, [
        Check("box.minutes_played.not_blank", "not_accepted_values", "minutes_played", values=("",)),
        Check("box.raw_minutes.not_blank", "not_accepted_values", "raw_minutes", values=("",))])


def q_quality_accepted_range(spark: SparkSession, root: str) -> DataFrame:
    li = read_table(spark, root, "lineitem")
    return run_checks(li, [
        Check("lineitem.l_quantity.min0", "accepted_range", "l_quantity", min_value=0),
        Check("lineitem.l_discount.0_005", "accepted_range", "l_discount", min_value=0, max_value=0.05),
        Check("lineitem.l_discount.0_005_excl", "accepted_range", "l_discount", min_value=0, max_value=0.05,
              inclusive=False),
        Check("lineitem.l_tax.max0.06", "accepted_range", "l_tax", max_value=0.06)])


def q_quality_relationships(spark: SparkSession, root: str) -> DataFrame:
    li = read_table(spark, root, "lineitem")
    o = read_table(spark, root, "orders")
    a = run_checks(li, [Check("lineitem.l_partkey.to_part", "relationships", "l_partkey",
                              parent=read_table(spark, root, "part"), field="p_partkey")])
    b = run_checks(o, [Check("orders.o_custkey.to_solvent_customer", "relationships", "o_custkey",
                             parent=_customers_by_balance(spark, root), field="c_custkey")])
    return a.unionByName(b)


def q_quality_assertion(spark: SparkSession, root: str) -> DataFrame:
    """Q8: the team mart's season figures against a plain recount of its facts, as it is and with wins altered."""
    mart = q_team_mart(spark, root).select("team_id", F.coalesce("current_season_wins", F.lit(0)).alias("w"), F.coalesce(
        F.col("current_season_wins") + F.col("current_season_losses"), F.lit(0)).alias("total"))
    recount = team_facts(spark, root).where(F.col("season") == B.CURRENT_SEASON).groupBy("team_id").agg(
        F.sum(F.when(F.col("wl") == "W", 1).otherwise(0)).alias("wins"), F.count_distinct("game_id").alias("games"))
    j = mart.join(recount, on="team_id", how="left").fillna(0, ["wins", "games"])
    altered = j.withColumn("w", F.col("w") + (F.col("team_id") % 7 == 0).cast("int"))
    failing = (F.col("w") != F.col("wins")) | (F.col("total") != F.col("games"))
    name = "team_mart.season_totals_match"
    return count_failures(name, j.where(failing)).unionByName(count_failures(f"{name}.one_win_added", altered.where(failing)))


FRESHNESS_NOW = ("2024-01-31 12:00:00", "2024-02-01 12:00:00", "2024-02-02 12:00:00")


def q_quality_freshness(spark: SparkSession, root: str) -> DataFrame:
    """Q9: newest load time of events against three fixed clocks, and of orders."""
    ev = read_table(spark, root, "events")
    parts = [freshness(ev, "ts", F.lit(now).cast("timestamp_ntz"), source=f"events@{now}") for now in FRESHNESS_NOW]
    parts.append(freshness(read_table(spark, root, "orders"), "o_orderdate",
                           F.lit(FRESHNESS_NOW[0]).cast("timestamp_ntz"), source="orders"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


REGISTRY.update({
    "surrogate_key": q_surrogate_key,
    "json_extract_typed": q_json_extract_typed,
    "json_flatten_roundtrip": q_json_flatten_roundtrip,
    "landing_union_zero_fill": q_landing_union_zero_fill,
    "distinct_ids": q_distinct_ids,
    "blank_default": q_blank_default,
    "status_bucket": q_status_bucket,
    "guarded_ratio": q_guarded_ratio,
    "latest_per_key": q_latest_per_key,
    "recent_n_stats": q_recent_n_stats,
    "player_period_stats": q_player_period_stats,
    "team_period_stats": q_team_period_stats,
    "rank_partitioned": q_rank_partitioned,
    "rank_global": q_rank_global,
    "fact_left_join": q_fact_left_join,
    "fact_join_colocated": q_fact_join_colocated,
    "latest_colocated": q_latest_colocated,
    "dim_enrich": q_dim_enrich,
    "counterpart_join": q_counterpart_join,
    "orphan_keys": q_orphan_keys,
    "orphan_keys_empty_dimension": q_orphan_keys_empty_dimension,
    "orphan_fill": q_orphan_fill,
    "not_in_with_null": q_not_in_with_null,
    "watermark_filter": q_watermark_filter,
    "incremental_upsert": q_incremental_upsert,
    "incremental_upsert_buckets": q_incremental_upsert_buckets,
    "scd2_check_history": q_scd2_check_history,
    "scd2_bulk_history": q_scd2_bulk_history,
    "scd2_current": q_scd2_current,
    "scd2_asof": q_scd2_asof,
    "quality_not_null": q_quality_not_null,
    "quality_unique": q_quality_unique,
    "quality_unique_where": q_quality_unique_where,
    "quality_accepted_values": q_quality_accepted_values,
    "quality_not_accepted_values": q_quality_not_accepted_values,
    "quality_accepted_range": q_quality_accepted_range,
    "quality_relationships": q_quality_relationships,
    "quality_assertion": q_quality_assertion,
    "quality_freshness": q_quality_freshness,
})


# ---------------------------------------------------------------------------
# The reference's bronze model over a feed that Spark derives from lineitem
# ---------------------------------------------------------------------------
from courtside.plans.feeds import BOX_SCORES  # noqa: E402
from courtside.plans.models import bronze  # noqa: E402


def q_bronze_box_scores(spark: SparkSession, root: str) -> DataFrame:
    """M1 twice: load 1 lands every line item shipped before 1998, load 2 those
    shipped from 1997 on (re-fetched, points + 1). RAW rows are JSON array
    documents; the second run reads only rows newer than the bronze watermark,
    flattens, types, keys, keeps the newest row per key and upserts."""
    raws = []
    for lo, hi, loaded, bump in B.FEED_BATCHES:
        recs = B.box_score_feed_records(spark, root, lo, hi, bump)
        files = pack_json_arrays(recs, "date", "box_scores", max_records=5000)
        raws.append(parse_raw(files, "raw_text", "raw_json").select(
            "raw_json", "file_name", F.lit(loaded).cast("timestamp_ntz").alias("inserted_at")))
    raw = raws[0].unionByName(raws[1])
    first = materialize(bronze(raw.filter(F.col("inserted_at") == F.lit(B.FEED_BATCHES[0][2]).cast("timestamp_ntz")),
                               None, BOX_SCORES))
    second = bronze(raw, first, BOX_SCORES)
    return second.select("box_score_id", "game_id", "player_id", "team_id", "status", "minutes_played", "points",
                         "assists", "loaded_at_utc", "api_fetched_at")


REGISTRY["bronze_box_scores"] = q_bronze_box_scores
