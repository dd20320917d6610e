from pyspark.sql import functions as F

from courtside.operators.star import fill_orphans, orphan_keys, placeholder_defaults, resolve_counterpart
from tests.conftest import rows

DIM = [(1, "AAA"), (2, "BBB"), (3, "CCC"), (4, "BBB")]  # BBB twice: two matches


def _facts(spark):
    return spark.createDataFrame([
        ("g1", "AAA vs. CCC", "AAA"),   # own code first -> CCC
        ("g2", "CCC @ AAA", "AAA"),     # own code last -> CCC
        ("g3", "AAA vs. CCC", "DDD"),   # own code absent -> AAA and CCC
        ("g4", "AAA vs. CCC", None),    # own code NULL -> no match
        ("g5", "AAA vs. ZZZ", "AAA"),   # unknown other code -> no match
        ("g6", "AAA vs. AAA", "CCC"),   # both codes equal -> AAA once
        ("g7", "BBB vs. AAA", "AAA"),   # duplicated dimension code -> two rows
    ], "gid string, matchup string, own string")


EXPECTED = sorted([("g1", 3), ("g2", 3), ("g3", 1), ("g3", 3), ("g4", None), ("g5", None), ("g6", 1),
                   ("g7", 2), ("g7", 4)], key=lambda t: (t[0], t[1] is None, t[1]))


def _run(spark):
    dim = spark.createDataFrame(DIM, "tid long, code string")
    out = resolve_counterpart(_facts(spark), dim, "matchup", "own", "code", {"opp_id": "tid", "opp_code": "code"})
    return sorted(((r.gid, r.opp_id) for r in out.collect()), key=lambda t: (t[0], t[1] is None, t[1]))


def test_counterpart(spark):
    assert _run(spark) == EXPECTED


def test_counterpart_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _run(spark) == EXPECTED
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counterpart_keeps_repeated_and_keyless_facts(spark):
    facts = spark.createDataFrame([(None, "AAA vs. BBB", "AAA")] * 3 + [(1, "AAA vs. ZZZ", "AAA")] * 2,
                                  "gid long, matchup string, own string")
    dim = spark.createDataFrame([(1, "AAA"), (2, "BBB")], "tid long, code string")
    out = resolve_counterpart(facts, dim, "matchup", "own", "code", {"opp": "tid"})
    assert out.columns == ["gid", "matchup", "own", "opp"]
    assert sorted((r.gid or 0, r.opp) for r in out.collect() if r.opp) == [(0, 2)] * 3
    assert out.where("opp IS NULL").count() == 2


def test_orphans_null_aware(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k long")
    dim = spark.createDataFrame([(1,), (5,)], "k long")
    assert rows(orphan_keys(fact, dim, "k")) == [(2,), (3,)]
    dim_null = spark.createDataFrame([(1,), (None,)], "k long")
    assert orphan_keys(fact, dim_null, "k").count() == 0
    empty = spark.createDataFrame([], "k long")
    assert rows(orphan_keys(fact, empty, "k")) == rows(fact.distinct())  # NOT IN () holds for NULL too


def test_fill_orphans(spark):
    dim = spark.createDataFrame([(1, "Ann", "US", "Active", None)],
                                "player_id long, full_name string, country string, player_status string, "
                                "data_freshness_at timestamp_ntz")
    orphans = spark.createDataFrame([(9,)], "player_id long")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    d = placeholder_defaults("player_id", "Unknown Player (", now, "full_name", ["country"],
                             status_col="player_status", freshness_col="data_freshness_at")
    out = {r.player_id: r for r in fill_orphans(dim, orphans, "player_id", d).collect()}
    assert out[9].full_name == "Unknown Player (9)" and out[9].country == "N/A"
    assert out[9].player_status == "Unknown" and out[9].data_freshness_at is not None
