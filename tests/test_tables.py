import os

import pytest
from pyspark.sql import functions as F

from courtside.operators.dedup import latest_per_key
from courtside.sources.colocated import CoLocated
from courtside.sources.tables import VersionedTable
from tests.conftest import rows


def test_versioned_table_marker(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path), "t")
    assert t.read() is None and not t.exists()
    t.write(spark.createDataFrame([(1,)], "a long"))
    first = t.current_path()
    t.write(t.read().unionByName(spark.createDataFrame([(2,)], "a long")))  # built from the current version
    assert rows(t.read()) == [(1,), (2,)] and t.current_path() != first
    assert len(os.listdir(tmp_path / "t" / "_versions")) >= 2  # older markers stay


def test_stop_before_the_marker_changes_nothing(spark, tmp_path):
    """A version folder without its marker, as a stop leaves it, is never read."""
    t = VersionedTable(spark, str(tmp_path), "t")
    t.write(spark.createDataFrame([(1,)], "a long"))
    spark.createDataFrame([(9,)], "a long").write.parquet(f"{t.base}/v=999999999999999-stopped")
    assert rows(t.read()) == [(1,)]

    broken = spark.createDataFrame([(2,)], "a long").selectExpr("assert_true(a < 0)", "a")
    with pytest.raises(Exception):
        t.write(broken)
    assert rows(t.read()) == [(1,)]


def test_highest_number_wins(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path), "t")
    for i in range(12):
        t.write(spark.createDataFrame([(i,)], "a long"))
    assert rows(t.read()) == [(11,)]


def test_upsert_touches_the_buckets_of_its_batch_only(spark, tmp_path):
    from courtside.sources.tables import BucketedTable

    t = BucketedTable(spark, str(tmp_path), "t", ["k"], buckets=32)
    assert t.read() is None
    assert len(t.upsert(spark.range(1000).selectExpr("id AS k", "'a' AS v"))) == 32
    files = lambda: {str(p) for p in (tmp_path / "t/data").rglob("*.parquet")}
    before = files()
    touched = t.upsert(spark.createDataFrame([(3, "b"), (2000, "c")], "k bigint, v string"))
    moved = {p.split("key_bucket=")[1].split("/")[0] for p in before ^ files()}
    assert moved == {str(b) for b in touched} and len(touched) <= 2
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 1001 and got[3] == "b" and got[2000] == "c" and got[4] == "a"
    now = files()
    assert t.upsert(t.read().limit(0)) == [] and files() == now


def test_a_stopped_upsert_is_finished_by_the_next_reader(spark, tmp_path, monkeypatch):
    from courtside.sources.tables import BucketedTable

    t = BucketedTable(spark, str(tmp_path), "t", ["k"], buckets=4)
    t.upsert(spark.range(20).selectExpr("id AS k", "'a' AS v"))
    with monkeypatch.context() as m:
        m.setattr(BucketedTable, "_replace", lambda self: None)  # stopped before the folders are replaced
        touched = t.upsert(spark.createDataFrame([(1, "b")], "k bigint, v string"))
    import shutil
    shutil.rmtree(tmp_path / f"t/data/key_bucket={touched[0]}")  # or in the middle of it
    got = {r.k: r.v for r in BucketedTable(spark, str(tmp_path), "t", ["k"], buckets=4).read().collect()}
    assert len(got) == 20 and got[1] == "b"


def test_history_steps_leave_closed_versions_alone(spark, tmp_path):
    from pyspark.sql import functions as F

    from courtside.operators.scd2 import snapshot_check
    from courtside.sources.tables import HistoryTable

    h = HistoryTable(spark, str(tmp_path), "h")
    assert h.read() is None and h.read_open() is None
    plain, seen = None, set()
    for day, values in enumerate(("aaa", "aba", "abc", "zbc"), 1):
        batch = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k bigint, c string").withColumn(
            "ts", F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp_ntz"))
        h.write_step(snapshot_check(h.read_open(), batch, "k", ["c"], updated_at_col="ts"))
        plain = snapshot_check(plain, batch, "k", ["c"], updated_at_col="ts")
        now = {str(p) for p in (tmp_path / "h/rows").rglob("is_open=false/*.parquet")}
        assert seen <= now
        seen = now
    key = lambda df: sorted((r.k, r.c, str(r.valid_from), str(r.valid_to)) for r in df.collect())
    assert key(h.read()) == key(plain) and len(key(plain)) == 6
    # versions that a stopped step has written, but not made current, are not seen
    plain.limit(1).write.parquet(str(tmp_path / "h/rows/step=99/is_open=false"))
    assert key(h.read()) == key(plain)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_colocated_tables_join_and_window_without_a_shuffle(spark, tmp_path):
    # key 1 holds over half of the rows, NULL a sixth; key 1 and NULL are heavy, key 7 misses
    left = spark.range(600).selectExpr("CASE WHEN id % 6 = 0 THEN NULL WHEN id % 6 < 4 THEN 1 ELSE id END AS k", "id AS x")
    right = spark.range(300).selectExpr("id AS k", "id * 10 AS y").where("k != 7").unionByName(
        spark.createDataFrame([(1, -1), (None, -2)], "k long, y long"))
    both = CoLocated(spark, str(tmp_path), {"l": left, "r": right}, ["k"], 8)
    assert rows(both.heavy) == [(1,), (None,)]
    assert rows(both.heavy_part("l").select("k").distinct()) == [(1,), (None,)]
    for how in ("left", "inner", "full", "left_anti"):
        assert rows(both.join("l", "r", how)) == rows(left.join(right, "k", how))

    newest = [F.col("x").desc()]
    got = both.per_key(lambda t: latest_per_key(t, ["k"], newest), "l")
    assert rows(got) == rows(latest_per_key(left, ["k"], newest))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in _plan(both.light("l").join(both.light("r"), "k", "left"))
        assert "Exchange" not in _plan(latest_per_key(both.light("l"), ["k"], newest))
        assert "Exchange" in _plan(left.join(right, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_colocated_empty_tables(spark, tmp_path):
    left, right = (spark.createDataFrame([], f"k long, {c} long") for c in "xy")
    both = CoLocated(spark, str(tmp_path), {"l": left, "r": right}, ["k"], 4)
    assert both.join("l", "r").count() == 0 and both.heavy.count() == 0
