"""What the findings of round 4 asked for."""
import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from courtside.operators.incremental import upsert, upsert_stored
from courtside.plans import feed_queries as Q
from courtside.plans import models as M
from courtside.plans.feed_bindings import raw_rows
from courtside.plans.feeds import FEEDS
from courtside.session import discard, materialize
from courtside.sources.landing import append_raw, read_landing
from courtside.sources.tables import BucketedTable
from tests.conftest import rows


def test_a_bucket_is_written_by_many_tasks_and_moved(spark, tmp_path, monkeypatch):
    """F1."""
    table = BucketedTable(spark, str(tmp_path), "t", ["k"], buckets=2)
    batch = spark.range(20_000).repartition(4).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    files = lambda: [len(list((tmp_path / f"t/data/key_bucket={b}").glob("*.parquet"))) for b in (0, 1)]
    assert table.upsert(batch) == [0, 1] and files() == [4, 4]
    monkeypatch.setattr("courtside.sources.tables.FILE_BYTES", 100_000)
    assert table.upsert(batch.where("k % 2 = 0").withColumn("v", F.lower("v"))) == [0, 1]
    assert min(files()) > 1 and not (tmp_path / "t/aside").exists()
    assert rows(table.read().agg(F.count("*"), F.countDistinct("k"))) == [(20_000, 20_000)]
    # what is aside and whole is moved as it is: the files stay the same
    (tmp_path / "t/aside/key_bucket=1").mkdir(parents=True)
    name = next((tmp_path / "t/data/key_bucket=0").glob("*.parquet"))
    (tmp_path / "t/aside/key_bucket=1/part-x.parquet").write_bytes(name.read_bytes())
    (tmp_path / "t/aside/_SUCCESS").write_text("")
    kept = table.read()
    assert [p.name for p in (tmp_path / "t/data/key_bucket=1").iterdir() if p.suffix == ".parquet"] == ["part-x.parquet"]
    assert kept.count() == pq.read_metadata(name).num_rows + sum(
        pq.read_metadata(p).num_rows for p in (tmp_path / "t/data/key_bucket=0").glob("*.parquet"))
    assert not (tmp_path / "t/aside").exists()


def test_raw_rows_are_stored_unshredded(spark, tmp_path):
    """F1."""
    folder = tmp_path / "source/teams/date=20240101"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n".join(json.dumps({"id": i, "x": f"n{i}"}) for i in range(50)))
    append_raw(read_landing(spark, str(tmp_path), "teams", "20240101", "2024-01-02 00:00:00"), f"{tmp_path}/raw")
    schema = [pq.read_schema(p) for p in (tmp_path / "raw").glob("*.parquet")]
    assert schema and all([c.name for c in s.field("raw_json").type] == ["value", "metadata"] for s in schema)
    back = spark.read.parquet(f"{tmp_path}/raw").select(F.to_json("raw_json"))
    assert len(rows(back)) == 50 and ('[{"id":7,"x":"n7"}]',) in rows(back)
    assert spark.conf.get("spark.sql.variant.inferShreddingSchema") == "true"


def test_rows_that_no_key_replaces_are_not_shuffled(spark, monkeypatch):
    """F3."""
    order = [F.col("at").desc_nulls_first(), F.col("v").desc_nulls_first()]
    old = materialize(spark.range(3000).selectExpr("IF(id % 100 = 99, NULL, concat('k', id)) AS k", "1 AS at", "id AS v"))
    new = materialize(spark.range(0, 6000, 7).selectExpr("IF(id % 100 = 98, NULL, concat('k', id)) AS k", "2 AS at", "-id AS v"))
    whole = rows(upsert(old, new, ["k"]))
    assert rows(upsert_stored(old, new, ["k"], order)) == whole and len(whole) == 3000 + new.count() - new.join(old, "k").count()
    monkeypatch.setattr("courtside.operators.incremental.KEY_BITS", 16)  # keys share bits
    assert rows(upsert_stored(old, new, ["k"], order)) == whole
    assert rows(upsert_stored(old, new.limit(0), ["k"], order)) == rows(old)
    monkeypatch.undo()
    plan = upsert_stored(old, new, ["k"], order)._jdf.queryExecution().optimizedPlan().toString()
    kept = plan[:plan.index("Window")]  # the first branch of the union
    assert "Union" in kept and "NOT " in kept and "Join LeftOuter" not in plan[:plan.index("Union")]


def test_documents_are_stored_and_keys_hashed_last(spark, tmp_path):
    """F3."""
    from tests.test_scale_r03 import _feed_tables

    _feed_tables(spark, tmp_path)
    raw = raw_rows(spark, str(tmp_path), "box_scores", 1)
    assert raw.inputFiles() and all("/table-" in f for f in raw.inputFiles())
    out = Q.bronze_job("box_scores")(spark, str(tmp_path))
    plain = [materialize(M.bronze_batch(raw_rows(spark, str(tmp_path), "box_scores", n), None, FEEDS["box_scores"])) for n in (1, 2)]
    assert out.columns == plain[0].columns and rows(out) == rows(upsert(plain[0], plain[1], ["box_score_id"]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" in plan and "md5(" not in plan[plan.index("Window"):]  # none below a shuffle
    kept = materialize(spark.range(3))
    discard(kept)
    assert not kept.sparkSession._jvm.java.io.File(kept.inputFiles()[0].removeprefix("file:")).exists()


def test_codes_are_broadcast_by_their_counted_bytes(spark, monkeypatch):
    """F2."""
    at = F.lit("2025-01-01").cast("timestamp_ntz")
    games = spark.createDataFrame([("0021", 1, "AAA vs. BBB", 3, "W", "s", 9), ("0022", 4, "CCC @ DDD", 3, "W", "s", 9), (None, None, None, 3, "W", "s", 9)],
                                  "game_id string, team_id int, matchup string, plus_minus int, wl string, season string, pts int")
    games = games.withColumn("game_date", at)
    teams = spark.createDataFrame([(1, "AAA"), (2, "BBB"), (3, "BBB"), (4, None), (5, "CCC"), (None, "DDD")], "team_id int, abbreviation string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = M.fact_team_games(games, teams, "2024-01-01", "002")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 3 and "Exchange hashpartitioning" not in plan
        monkeypatch.setattr("courtside.operators.star.LOOKUP_BYTES", 0)
        large = M.fact_team_games(games, teams, "2024-01-01", "002")
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert rows(out, "game_id", "opponent_team_id") == rows(large, "game_id", "opponent_team_id") == [("0021", 2), ("0021", 3), ("0022", None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
