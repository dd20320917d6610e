import random

from pyspark.sql import functions as F

from courtside.operators.dedup import latest_per_key, recent_n
from courtside.operators.ranking import global_rank, plain_rank, rank_measures, rank_within
from tests.conftest import rows


def test_latest_per_key_ties_nulls_and_duplicates(spark):
    df = spark.createDataFrame([
        ("a", None, 1), ("a", 5, 2), ("a", 5, 3),      # NULL time first (warehouse DESC), then tie-breaker
        ("b", 1, 1),                                   # one row
        ("c", 2, 9), ("c", 2, 9),                      # same row twice
    ], "k string, t int, tie int")
    out = latest_per_key(df, ["k"], [F.col("t").desc_nulls_first(), F.col("tie").desc()])
    assert rows(out) == [("a", None, 1), ("b", 1, 1), ("c", 2, 9)]


def test_recent_n_fewer_exact_more(spark):
    data = [("few", i) for i in range(3)] + [("exact", i) for i in range(10)] + [("more", i) for i in range(15)]
    df = spark.createDataFrame(data, "k string, t int")
    out = recent_n(df, ["k"], [F.col("t").desc()], 10)
    counts = dict((r[0], r[1]) for r in out.groupBy("k").count().collect())
    assert counts == {"few": 3, "exact": 10, "more": 10}
    assert min(r.t for r in out.filter("k = 'more'").collect()) == 5


def _random_frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = [(i, rnd.choice(["x", "y", "z", None]),
             None if rnd.random() < 0.05 else float(rnd.randint(0, 40)) / 4) for i in range(n)]
    return spark.createDataFrame(data, "id long, p string, v double")


def test_global_rank_matches_rank(spark):
    df = _random_frame(spark)
    for desc in (True, False):
        for nf in (True, False):
            a = global_rank(df, "v", descending=desc, nulls_first=nf, out="r", buckets=8)
            b = plain_rank(df, "v", descending=desc, nulls_first=nf, out="r")
            assert rows(a, "id", "r") == rows(b, "id", "r")


def test_rank_within_matches_rank_with_null_partition(spark):
    df = _random_frame(spark, seed=11)
    a = rank_within(df, ["p"], "v", out="r", buckets=4)
    b = plain_rank(df, "v", ["p"], out="r")
    assert rows(a, "id", "r") == rows(b, "id", "r")


def test_rank_all_equal_and_more_rows_than_buckets(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(500)], "id long, v double")
    assert {r.r for r in global_rank(df, "v", out="r", buckets=16).collect()} == {1}


def test_several_measures_ranked_at_once(spark):
    df = _random_frame(spark, seed=3).withColumn("w", F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("v") * -1000)) \
        .withColumn("none", F.lit(None).cast("double"))
    names = {"v": "r_v", "w": "r_w", "none": "r_none"}
    for desc, first in ((True, True), (True, False), (False, True)):
        got = rank_measures(df, names, "id", descending=desc, nulls_first=first, buckets=8)
        want = df
        for value, name in names.items():
            want = plain_rank(want, value, descending=desc, nulls_first=first, out=name)
        assert got.columns == [*df.columns, *names.values()]
        assert rows(got) == rows(want)
    assert rank_measures(df.limit(0), names, "id").count() == 0
