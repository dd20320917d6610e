"""What the findings of round 3 asked for: stored steps, one derivation a frame, narrow shuffles."""
import re

from pyspark.sql import functions as F

from courtside.functions.semistruct import typed_fields, typed_path, whole_number
from courtside.operators.dedup import latest_per_key
from courtside.operators.incremental import new_rows, upsert
from courtside.operators.star import resolve_counterpart
from courtside.operators.stats import StatSpec, all_and_season_stats, period_stats
from courtside.plans import bindings as B
from courtside.plans import feed_queries as Q
from courtside.plans import models as M
from courtside.plans.feeds import FEEDS
from courtside.plans.marts import player_mart
from courtside.session import input_bytes, materialize, small_tasks
from courtside.sources.landing import pack_json_arrays, planned, read_landing, write_landing
from tests.conftest import rows


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _executed(df) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_steps_are_parquet_and_whole(spark):
    """F1, F2."""
    df = spark.range(5).selectExpr("id", "IF(id % 2 = 0, NULL, 'x') AS t", "parse_json(concat('[', id, ']')) AS v").repartition(3)
    out = materialize(df)
    assert out.inputFiles() and all(f.endswith(".parquet") for f in out.inputFiles())
    text = lambda d: rows(d.select("id", "t", F.to_json("v")))
    assert text(out) == text(df) and out.dtypes == df.dtypes
    assert materialize(df.where("id < 0")).count() == 0
    assert rows(materialize(spark.range(2).withColumn("n", F.lit(None)))) == [(0, None), (1, None)]  # no Parquet type
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_zipped_landing_reads_back_whole(spark, tmp_path, monkeypatch):
    """F2."""
    monkeypatch.setattr("courtside.sources.landing.ZIPPED_ROWS", 10)
    recs = spark.range(35).selectExpr("id", "'a' AS t", "'20240101' AS date").coalesce(1)
    write_landing(recs, str(tmp_path), "games", compression="gzip")
    files = list((tmp_path / "source/games/date=20240101").glob("*.json.gz"))
    assert len(files) == 4
    raw = read_landing(spark, str(tmp_path), "games", "20240101", "2024-01-02 00:00:00")
    assert raw.where("raw_json IS NOT NULL").count() == 35 and raw.where("bad_text IS NOT NULL").count() == 0


def test_a_landed_line_is_parsed_once(spark, tmp_path):
    """F6."""
    write_landing(spark.range(3).selectExpr("id", "'20240101' AS date"), str(tmp_path), "games")
    plan = _plan(read_landing(spark, str(tmp_path), "games", "20240101", "2024-01-02 00:00:00", "jsonl"))
    assert plan.count("concat([, value") == 1


def test_an_older_load_is_not_planned_again(spark):
    """F7, F8."""
    load = lambda a, b, ts: spark.range(a, b).repartition(2).groupBy("id").count().withColumn(
        "inserted_at", F.lit(ts).cast("timestamp_ntz"))
    target = spark.range(1).select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("loaded_at_utc"))
    new = new_rows(load(0, 5, "2024-01-01 00:00:00").unionByName(load(3, 9, "2024-01-02 00:00:00")), target)
    assert sorted(r.id for r in new.collect()) == [3, 4, 5, 6, 7, 8]
    assert _plan(new).count("Aggregate") == 1
    assert new_rows(load(0, 2, "2024-01-01 00:00:00"), target.where("false")).count() == 2  # the floor


def test_upsert_in_one_pass(spark):
    """F5, F13, F14."""
    order = [F.col("at").desc_nulls_first(), F.col("v").desc_nulls_first()]
    old = spark.createDataFrame([("a", 1, 1), ("a", 1, 1), ("b", 1, 2), (None, 1, 3), (None, 1, 3)], "k string, at int, v int")
    new = spark.createDataFrame([("a", 2, 5), ("a", 2, 6), ("c", 2, 7), (None, 2, 8)], "k string, at int, v int")
    out = upsert(old, new, ["k"], order)
    assert out.columns == old.columns and rows(out) == rows(upsert(old, new, ["k"]))
    latest = latest_per_key(out, ["k"], order)
    assert rows(latest) == [("a", 2, 6), ("b", 1, 2), ("c", 2, 7), (None, 2, 8)]
    assert _executed(latest).count("Exchange hashpartitioning") == 1 and _executed(latest).count("Sort [") == 1


def test_opponents_are_looked_up_without_copies(spark):
    """F3."""
    at = F.lit("2025-01-01").cast("timestamp_ntz")
    games = spark.createDataFrame([("0021", 1, "AAA vs. BBB", 3, "W", "s", 9), ("0022", 4, "CCC @ DDD", 3, "W", "s", 9)],
                                  "game_id string, team_id int, matchup string, plus_minus int, wl string, season string, pts int")
    teams = spark.createDataFrame([(1, "AAA"), (2, "BBB"), (3, "BBB"), (4, None)], "team_id int, abbreviation string")
    out = M.fact_team_games(games.withColumn("game_date", at), teams, "2024-01-01", "002")
    assert rows(out, "game_id", "opponent_team_id") == [("0021", 2), ("0021", 3), ("0022", None)]
    plan = _plan(out)
    assert plan.index("Generate") < plan.index("md5(")  # below it, so before the rows fan out
    facts = spark.createDataFrame([(1, "AAA vs. BBB", "AAA")], "g int, m string, own string")
    hit = resolve_counterpart(facts, teams, "m", "own", "abbreviation", {"opp": "team_id"})
    assert "lambda" not in _plan(hit)


def test_distinct_values_are_counted_without_a_table_of_them(spark):
    """F4, F9-F12."""
    facts = spark.createDataFrame(
        [("p", 1, "s", 2), ("p", 1, "s", 4), ("p", 1, "t", 6), ("p", 2, "t", None), ("p", None, "s", 8), ("q", 3, "t", 1),
         (None, 4, "s", 3), ("r", None, None, None)], "k string, g int, season string, x int")
    out = all_and_season_stats(facts, "k", StatSpec(avg={"x": "x"}, maxes={"m": "x"}, distinct="g", distinct_name="n"), "season", "s")
    assert rows(out, "k", "all_n", "season_n", "all_x", "season_x", "all_m", "season_m") == [
        ("p", 2, 1, 5.0, 14 / 3, 8, 8), ("q", 1, None, 1.0, None, 1, None), ("r", 0, None, None, None, None, None),
        (None, 1, 1, 3.0, 3.0, 3, 3)]
    assert _plan(out).count("Aggregate") == 1


def test_facts_join_the_tables_own_columns(spark, tmp_path):
    """F9-F12."""
    at = F.lit("2000-05-01").cast("timestamp_ntz")
    li = spark.createDataFrame([(1, 2, 3, 1, "R", "O", 5.0, 0.05, 0.02), (9, 2, 3, 2, "N", "F", 7.0, 0.1, 0.0)],
                               "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, "
                               "l_linestatus string, l_quantity double, l_discount double, l_tax double")
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1,)], "o_orderkey long").withColumn("o_orderdate", at).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(3, "N")], "n_nationkey long, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    facts, games = B.player_facts(spark, str(tmp_path)), B.team_game_rows(spark, str(tmp_path))
    assert rows(facts, "game_id", "player_id", "total_reb", "status", "season") == [
        (1, 2, 5, "INACTIVE", "2000"), (9, 2, 10, "ACTIVE", None)]
    assert rows(games, "game_id", "matchup", "season") == [(1, "003 vs. 002", "2000"), (9, "003 vs. 002", None)]
    for df, made in ((facts, "total_reb"), (games, "matchup")):
        plan = _plan(df)
        join = plan[plan.index("Join LeftOuter, (l_orderkey"):]
        assert not re.search(made, join)


def _feed_tables(spark, path):
    """Orders 1-3 and 12 (the last without a row), a NULL order key, repeated rows and a repeated order."""
    at = F.lit("2000-05-01").cast("timestamp_ntz")
    li = [(k, p, s, n, "R" if n == 2 else "N", "O", 5.0 + n, 0.05, 0.02)
          for k in (1, 2, 3, 12, None) for n, (p, s) in enumerate([(7, 3), (7, 4), (8, 3), (None, 3), (9, None)], 1)]
    spark.createDataFrame(li + li[:2], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, "
                          "l_linestatus string, l_quantity double, l_discount double, l_tax double").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "o_orderkey long").withColumn("o_orderdate", at).write.parquet(
        f"{path}/orders.parquet")


def test_facts_are_shuffled_once_a_frame(spark, tmp_path):
    """F5."""
    _feed_tables(spark, tmp_path)
    out = Q.fact_player_performances(spark, str(tmp_path))
    plain = M.fact_player_performances(
        M.silver_box_scores(Q.bronze_table(spark, str(tmp_path), "box_scores")),
        M.silver_games(Q.bronze_table(spark, str(tmp_path), "games")))
    assert out.columns == plain.columns and rows(out) == rows(plain)
    assert out.where("game_date IS NOT NULL").count() > 0 and out.where("game_id IS NULL").count() > 0
    plan = _executed(out)
    assert plan.count("Exchange hashpartitioning(__deal") == 2 and "Exchange hashpartitioning(game_id" not in plan


def test_key_digests_are_made_after_the_shuffle(spark, tmp_path):
    """F5, F13."""
    _feed_tables(spark, tmp_path)
    out = Q.silver(spark, str(tmp_path), "silver_box_scores")
    assert rows(out) == rows(M.silver_box_scores(Q.bronze_table(spark, str(tmp_path), "box_scores")))
    plan = _plan(out)
    assert plan.count("md5(") == 1 and plan.index("md5(") < plan.index("Window")


def test_planned_files_are_looked_up_by_a_join(spark):
    """F6."""
    df = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1), ("b", 1), (None, 2)], "date string, x int")
    out = planned(df, "date", 3)
    assert out.columns == df.columns and rows(out) == rows(df)
    assert "element_at" not in _plan(out) and "Join" in _plan(out)
    assert planned(df.where("false"), "date", 3).count() == 0


def test_stored_steps_are_cut_into_tasks_by_their_input(spark, tmp_path, monkeypatch):
    """F4, F10, F11."""
    spark.range(100).selectExpr("IF(id % 9 = 0, NULL, id % 5) AS k", "id AS g", "'s' AS season", "id AS x").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    size, key = input_bytes(df), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert size == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet")) and input_bytes(spark.range(3)) == 0
    monkeypatch.setattr("courtside.session.FILE_BYTES", size // 20)
    before = spark.conf.get(key, None)
    with small_tasks(df):
        n = int(spark.conf.get(key))
        plan = df.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert n >= 20 and re.search(rf"hashpartitioning\(k#\d+L?, {n}\)", plan) and spark.conf.get(key, None) == before
    assert rows(materialize(df.groupBy("k").count())) == rows(df.groupBy("k").count())
    out = period_stats(df, "k", StatSpec(avg={"x": "x"}, distinct="g"), "season", "s", [F.col("g").desc()], 2)
    assert out.inputFiles() and out.where("k IS NOT NULL").count() == 5


def test_players_without_a_row_are_found_from_stored_keys(spark, tmp_path):
    """F4."""
    now = F.lit("2024-03-02").cast("timestamp_ntz")
    cols = ["full_name", "birthdate", "country", "height", "weight_lbs", "jersey_number", "position", "team_id", "draft_year",
            "draft_round", "draft_number", "career_from_year", "career_to_year"]
    details = spark.range(1, 3).select(F.col("id").alias("player_id"), *[F.lit("1").alias(c) for c in cols], now.alias("last_updated_at"))
    facts = spark.createDataFrame([(1,), (5,), (5,), (None,)], "player_id bigint")
    out = M.dim_players(details, facts, now)
    assert sorted(r.player_id for r in out.select("player_id").collect()) == [1, 2, 5]
    assert any("/table-" in f for f in out.inputFiles())


def test_the_player_mart_is_stored_with_its_ranks(spark):
    """F10."""
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c")], "player_id bigint, full_name string")
    fact = spark.createDataFrame([(1, 7, "ACTIVE", "s", 9), (1, 8, "ACTIVE", "s", 5), (2, 7, "ACTIVE", "s", 4), (2, 9, "INACTIVE", "s", 90)],
                                 "player_id bigint, game_id bigint, status string, season string, points bigint")
    fact = fact.selectExpr("*", "DATE '2024-01-01' AS game_date", *[f"points AS {c}" for c in (
        "assists", "total_reb", "fg_made", "fg_attempted", "fg3_made", "fg3_attempted")])
    out = player_mart(dim, fact, "s", [F.col("game_id").desc()], basic_cols=("player_id", "full_name"))
    assert rows(out, "player_id", "season_pts_rank", "all_time_total_games", "recent_10_avg_points") == [
        (1, 3, 2, 7.0), (2, 4, 1, 4.0), (3, 1, None, None), (3, 1, None, None)]
    assert out.inputFiles() and "Join" not in _plan(out)


def test_fields_of_a_record_are_read_in_one_pass(spark):
    """F7, F8."""
    docs = ['{"a": "x", "b": 7.6, "c": "2024-01-01T00:00:00", "d": 1}', '{"a": 5, "b": "8.4", "c": null}', "[1]", "3", "null", '"t"', "{}",
            '{"a": {"z": 1}, "b": -2.5, "A": "no"}', '{"b": "zz", "c": "nope", "d": true}']
    paths = {"$.a": "string", "$.b": "int", "$.c": "timestamp_ntz", "$.d": "float"}
    v = F.col("v")
    for n, tolerant in ((len(docs), True), (len(docs) - 1, False)):
        df = spark.createDataFrame([(d,) for d in docs[:n]], "t string").select(F.parse_json("t").alias("v"))
        one = df.withColumn("s", typed_fields(v, paths, tolerant))
        one = one.select(*[whole_number(F.col("s")[p[2:]], t).alias(p[2:]) for p, t in paths.items()])
        each = df.select(*[typed_path(v, p, t, tolerant).alias(p[2:]) for p, t in paths.items()])
        assert one.schema == each.schema and rows(one) == rows(each)
    raw = spark.createDataFrame([('[{"game_id": 7, "team_id": 2.0}, 3, {"team_id": null}]',)], "t string").select(
        F.parse_json("t").alias("raw_json"), F.lit("f").alias("file_name"), F.current_timestamp().alias("inserted_at"))
    out = M.bronze_rows(raw, FEEDS["games"])
    assert rows(out, "game_id", "team_id") == [("7", 2), (None, None), (None, None)]
    assert _plan(out).count("variant_get(") <= 3  # object or not, the fields, the team of the key


def test_files_are_packed_without_a_search_through_all_dates(spark):
    """F7, F8."""
    recs = spark.range(60).selectExpr("id", "CASE WHEN id < 50 THEN CAST(id DIV 25 AS STRING) END AS date")
    files = pack_json_arrays(recs, "date", "games", max_records=10)
    assert "map_from_entries" not in _plan(files) and "element_at" not in _plan(files)
    packed = files.select("date", F.explode(F.from_json("raw_text", "array<struct<id: long>>")).alias("r"))
    assert rows(packed.select("date", "r.id")) == rows(recs.select("date", "id"))
    assert files.where("date IS NULL").select("file_name").first()[0].startswith("source/games/date=__HIVE_DEFAULT_PARTITION__/games-")
    executed = _executed(files)
    assert executed.index("collect_list") < executed.index("REPARTITION_BY_COL")  # records meet before any is packed
