import datetime as dt

from pyspark.sql import functions as F

from courtside.operators.quality import Check, accepted_values, freshness, observed, run_checks
from courtside.operators.stats import StatSpec, all_and_season_stats, period_stats
from tests.conftest import rows

FACT = [
    # player, game, season, points, made, att, status
    (1, "g1", "S1", 10, 1, 2), (1, "g2", "S1", 20, 0, 0), (1, "g2", "S1", 5, 1, 1),   # duplicate game id
    (2, "g1", "S0", 7, 1, 3),                                                          # no current-season rows
    (3, None, "S1", None, None, None),                                                 # all-NULL group
]


def _fact(spark):
    return spark.createDataFrame(FACT, "p long, g string, season string, pts long, made long, att long") \
                .withColumn("d", F.lit("2024-01-01").cast("date"))


def test_fused_stats_match_join_form(spark):
    df = _fact(spark)
    spec = StatSpec(avg={"avg_pts": "pts"}, ratios={"pct": ("made", "att")}, flags={"big": F.col("pts") > 8},
                    distinct="g", distinct_name="games")
    fused = all_and_season_stats(df, "p", spec, "season", "S1", "a_", "s_")
    df.createOrReplaceTempView("fact_t")
    join_form = df.sparkSession.sql("""
      WITH a AS (SELECT p, COUNT(DISTINCT g) games, AVG(pts) avg_pts,
                        CAST(SUM(made) AS DOUBLE) / NULLIF(SUM(att), 0) pct,
                        SUM(CASE WHEN pts > 8 THEN 1 ELSE 0 END) big FROM fact_t GROUP BY p),
           s AS (SELECT p, COUNT(DISTINCT g) games, AVG(pts) avg_pts,
                        CAST(SUM(made) AS DOUBLE) / NULLIF(SUM(att), 0) pct,
                        SUM(CASE WHEN pts > 8 THEN 1 ELSE 0 END) big FROM fact_t WHERE season = 'S1' GROUP BY p)
      SELECT a.p, a.games a_games, a.avg_pts a_avg_pts, a.pct a_pct, a.big a_big,
             s.games s_games, s.avg_pts s_avg_pts, s.pct s_pct, s.big s_big
      FROM a LEFT JOIN s ON a.p = s.p""")
    cols = ["p", "a_games", "a_avg_pts", "a_pct", "a_big", "s_games", "s_avg_pts", "s_pct", "s_big"]
    assert rows(fused, *cols) == rows(join_form, *cols)
    p2 = fused.filter("p = 2").first()
    assert p2.s_games is None and p2.s_big is None          # absent period -> NULL, not 0


def test_period_stats_recent(spark):
    out = period_stats(_fact(spark), "p", StatSpec(avg={"avg_pts": "pts"}), "season", "S1",
                       [F.col("pts").desc_nulls_first()], 2)
    assert {r.p: r.recent_avg_pts for r in out.collect()} == {1: 15.0, 2: 7.0, 3: None}


def test_run_checks_counts(spark):
    df = spark.createDataFrame([(1, "A", 5), (1, "B", -1), (None, "X", None), (3, "X", 100), (4, None, 3)],
                               "id long, s string, n long")
    parent = spark.createDataFrame([(1,)], "id long")
    got = dict((r.check_name, r.failures) for r in run_checks(df, [
        Check("nn", "not_null", "id"),
        Check("uniq", "unique", "id"),
        Check("acc", "accepted_values", "s", values=("A", "B")),        # one distinct failing value (X)
        Check("nacc", "not_accepted_values", "s", values=("X",)),       # two rows
        Check("rng", "accepted_range", "n", min_value=0, max_value=10),  # -1 and 100; NULL passes
        Check("rel", "relationships", "id", parent=parent, field="id"),  # 3 and 4
        Check("uniq_where", "unique", "id", where="s = 'A'"),
    ]).collect())
    assert got == {"nn": 1, "uniq": 1, "acc": 1, "nacc": 2, "rng": 2, "rel": 2, "uniq_where": 0}
    assert accepted_values(df, "s", ("A", "B")).count() == 1


def test_freshness_thresholds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    for hours, status in ((24, "pass"), (30, "warn"), (50, "error")):
        now = F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)).cast("timestamp_ntz")
        assert freshness(df, "t", now).first().status == status


def test_checks_counted_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5.0), (None, "b", -1.0), (3, "b", None), (4, "c", 9.0)],
                               "id long, kind string, v double").repartition(3)
    checks = [Check("id.not_null", "not_null", "id"), Check("kind.known", "accepted_values", "kind", values=("a",)),
              Check("kind.any", "accepted_values", "kind", values=("a", "b", "c")),
              Check("v.range", "accepted_range", "v", min_value=0, max_value=8),
              Check("v.where", "accepted_range", "v", min_value=0, where="kind = 'a'"), Check("kind.unique", "unique", "kind")]
    out, seen = observed(df, checks)
    out.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"id.not_null": 1, "kind.known": 3, "kind.any": 0, "v.range": 2, "v.where": 0}
    stored = spark.read.parquet(str(tmp_path / "t"))
    want = {r.check_name: r.failures for r in run_checks(stored, checks).collect()}
    assert {r.check_name: r.failures for r in run_checks(stored, checks, seen.get).collect()} == want
    assert want["kind.known"] == 2 and want["kind.unique"] == 1
    plan = run_checks(stored, [c for c in checks if c.name in ("id.not_null", "v.range")], seen.get)
    assert "FileScan" not in plan._jdf.queryExecution().executedPlan().toString()
    assert observed(df, [checks[-1]]) == (df, None)

    empty, seen = observed(df.limit(0), checks)
    empty.write.parquet(str(tmp_path / "none"))
    again = spark.read.parquet(str(tmp_path / "none"))
    assert {r.failures for r in run_checks(again, checks, seen.get).collect()} == {0}
