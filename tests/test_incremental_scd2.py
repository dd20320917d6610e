import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtside.operators.incremental import dedup_batch, new_rows, upsert
from courtside.operators.scd2 import asof_lookup, current_versions, history_bulk, snapshot_check
from tests.conftest import rows

T = dt.datetime


def test_watermark_strictly_newer(spark):
    target = spark.createDataFrame([(1, T(2024, 1, 2))], "k long, loaded_at_utc timestamp_ntz")
    raw = spark.createDataFrame([(1, T(2024, 1, 1)), (2, T(2024, 1, 2)), (3, T(2024, 1, 3))],
                                "k long, inserted_at timestamp_ntz")
    assert rows(new_rows(raw, target), "k") == [(3,)]          # equal time and late row missed
    assert rows(new_rows(raw, None), "k") == [(1,), (2,), (3,)]  # target absent -> full
    empty = target.limit(0)
    assert rows(new_rows(raw, empty), "k") == [(1,), (2,), (3,)]  # empty target -> floor 1900-01-01


def test_upsert_dedup_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    batch = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (3, "c", 1)], "k long, v string, t int")
    batch = dedup_batch(batch, ["k"], [F.col("t").desc()]).drop("t")
    once = upsert(target, batch, ["k"])
    assert rows(once) == [(1, "a"), (2, "b2"), (3, "c"), (None, "n")]
    twice = upsert(once, batch, ["k"])
    assert rows(twice) == rows(once)
    assert rows(upsert(target, batch.limit(0), ["k"])) == rows(target)


SCHEMA = "k long, c string, other string, ts timestamp_ntz"


def _batch(spark, data):
    return spark.createDataFrame(data, SCHEMA)


BATCHES = [
    [(1, "x", "o1", T(2024, 1, 1)), (2, None, "o1", T(2024, 1, 1)), (3, "z", "o1", T(2024, 1, 1))],
    [(1, "x", "o2", T(2024, 1, 2)), (2, "y", "o2", T(2024, 1, 2)), (4, "n", "o2", T(2024, 1, 2))],
    [(1, "w", "o3", T(2024, 1, 3)), (2, None, "o3", T(2024, 1, 3))],
    [(1, "x", "o4", T(2024, 1, 4))],
]


def _apply_all(spark, batches):
    snap = None
    for b in batches:
        snap = snapshot_check(snap, _batch(spark, b), "k", ["c"], updated_at_col="ts")
    return snap


def test_snapshot_check_cases(spark):
    snap = _apply_all(spark, BATCHES)
    got = rows(snap, "k", "c", "other", "valid_from", "valid_to")
    assert got == sorted([
        (1, "x", "o1", T(2024, 1, 1), T(2024, 1, 3)),   # other column change only: no version
        (1, "w", "o3", T(2024, 1, 3), T(2024, 1, 4)),
        (1, "x", "o4", T(2024, 1, 4), None),            # change back to an old value: new version
        (2, None, "o1", T(2024, 1, 1), T(2024, 1, 2)),  # NULL -> value
        (2, "y", "o2", T(2024, 1, 2), T(2024, 1, 3)),
        (2, None, "o3", T(2024, 1, 3), None),           # value -> NULL
        (3, "z", "o1", T(2024, 1, 1), None),            # missing later: stays open
        (4, "n", "o2", T(2024, 1, 2), None),            # new key
    ], key=lambda t: tuple((x is None, str(x)) for x in t))
    again = snapshot_check(snap, _batch(spark, BATCHES[-1]), "k", ["c"], updated_at_col="ts")
    assert rows(again) == rows(snap)                     # same batch twice
    assert current_versions(snap, loaded_col=None).count() == 4


def test_bulk_history_equals_batch_by_batch(spark):
    every = _batch(spark, [r for b in BATCHES for r in b])
    bulk = history_bulk(every, "k", ["c"], "ts")
    cols = ["k", "c", "other", "valid_from", "valid_to", "version_id"]
    assert rows(bulk, *cols) == rows(_apply_all(spark, BATCHES), *cols)


def test_asof_lookup(spark):
    snap = _apply_all(spark, BATCHES)
    facts = spark.createDataFrame([(1, T(2023, 12, 31)), (1, T(2024, 1, 3)), (1, T(2024, 2, 1)),
                                   (1, T(2024, 1, 2, 12))], "k long, at timestamp_ntz")
    out = asof_lookup(facts, snap, "k", "at", cols=["c"])
    assert rows(out, "at", "c") == sorted([(T(2023, 12, 31), None), (T(2024, 1, 2, 12), "x"),
                                           (T(2024, 1, 3), "w"), (T(2024, 2, 1), "x")],
                                          key=lambda t: (str(t[0]),))


def test_snapshot_null_keys_old_rows_and_missing(spark):
    first = snapshot_check(None, _batch(spark, [(None, "x", "o", T(2024, 1, 1)), (1, "x", "o", T(2024, 1, 1)),
                                               (2, "x", "o", T(2024, 1, 1))]), "k", ["c"], updated_at_col="ts")
    # an older row and a row without change leave the open versions alone; the NULL key is a key
    late = _batch(spark, [(1, "w", "o", T(2023, 12, 1)), (2, "x", "o9", T(2024, 2, 1))])
    assert rows(snapshot_check(first, late, "k", ["c"], updated_at_col="ts")) == rows(first)
    nulls = snapshot_check(first, _batch(spark, [(None, "y", "o", T(2024, 3, 1))]), "k", ["c"], updated_at_col="ts")
    assert rows(nulls.where("k IS NULL"), "c", "valid_to") == [("x", T(2024, 3, 1)), ("y", None)]
    assert nulls.count() == 4
    with pytest.raises(ValueError):
        snapshot_check(first, late, "k", ["c"], updated_at_col="ts", close_missing=True)
    now = F.lit("2024-04-01 00:00:00")
    closed = snapshot_check(first, late, "k", ["c"], updated_at_col="ts", now=now, close_missing=True)
    assert rows(closed.where("valid_to IS NOT NULL"), "k", "valid_to") == [(None, T(2024, 4, 1))]


def test_history_and_asof_of_a_hot_key(spark):
    """One key holds half the rows: the same versions as step by step, spread over slices."""
    import random

    rng = random.Random(1)
    data = [((1 if i % 2 else rng.randrange(2, 30)), rng.choice(["x", "y", None]), f"o{i}",
             T(2020, 1, 1) + dt.timedelta(hours=i)) for i in range(900)] + [(None, "n", "o", T(2020, 1, 5))]
    history = history_bulk(_batch(spark, data), "k", ["c"], "ts")
    want, open_at = [], {}
    for k, c, o, t in sorted(data, key=lambda r: r[3]):
        if k not in open_at or open_at[k][1] != c:
            if k in open_at:
                want.append((*open_at[k], t))
            open_at[k] = (k, c, o, t)
    want += [(*v, None) for v in open_at.values()]
    want = [(k, c, o, f, e) for k, c, o, f, e in want]
    got = rows(history, "k", "c", "other", "valid_from", "valid_to")
    assert got == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    facts = [(rng.choice([1, 1, 5, 99, None]), T(2019, 12, 30) + dt.timedelta(minutes=rng.randrange(60 * 24 * 50))) for _ in range(400)]
    facts += [(1, None), (1, data[1][3]), (1, data[1][3])]
    f = spark.createDataFrame(facts, "k long, at timestamp_ntz")
    snap = history.withColumnRenamed("c", "val")
    plain = f.join(snap.withColumnRenamed("k", "sk"), (F.col("k") == F.col("sk")) & (F.col("valid_from") <= F.col("at"))
                   & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))), "left")
    assert rows(asof_lookup(f, snap, "k", "at", cols=["val", "version_id"])) == rows(plain, "k", "at", "val", "version_id")


def test_an_outlier_does_not_gather_a_hot_key(spark):
    """Slices hold about equally many rows wherever the times lie."""
    from courtside.operators.scd2 import _heavy_keys, _sliced

    data = [(1, "x", "o", T(1900, 1, 1))] + [(1, "xy"[i % 2], "o", T(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(10_000)]
    data += [(2, "x", "o", T(2024, 1, 1)), (None, "x", "o", T(2024, 1, 1))]
    df = _batch(spark, data)
    heavy = _heavy_keys(df.select("k"))
    assert heavy == [(1, 10_001)]
    sizes = [r["count"] for r in _sliced(df.where("k = 1"), "k", "ts", heavy).groupBy("__s").count().collect()]
    assert len(sizes) > 50 and max(sizes) < 1_000 and sum(sizes) == 10_001
    assert history_bulk(df, "k", ["c"], "ts").count() == 10_001 + 2 - 1  # 1900's x goes on into 2024


def test_asof_keeps_facts_without_key_or_version(spark):
    snap = _apply_all(spark, BATCHES)
    facts = spark.createDataFrame([(None, T(2024, 1, 2)), (None, None), (77, T(2024, 1, 2)), (1, None)], "k long, at timestamp_ntz")
    assert rows(asof_lookup(facts, snap, "k", "at", cols=["c"]), "c") == [(None,)] * 4
