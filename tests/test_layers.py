import json
import os

from pyspark.sql import functions as F

from courtside.plans.layers import RunConfig, declared_checks, run_all_layers
from courtside.sources.landing import pack_json_arrays, read_landing, write_landing
from tests import feed_fixtures as fx
from tests.conftest import rows


def _land(spark, root, feed, date, recs):
    df = spark.createDataFrame([(json.dumps(r), date) for r in recs], "j string, date string")
    # records as JSON lines (Spark's JSON writer), one folder per date
    parsed = df.select(F.parse_json("j").alias("j"), "date")
    keys = sorted({k for r in recs for k in r})
    cols = [F.try_variant_get("j", f"$.{k}", "string").alias(k) for k in keys]
    typed = parsed.select(*cols, "date")
    write_landing(typed, root, feed)


def _day(spark, root, date, fetched, pairs, standings_rec, coach_suffix="", jersey="7", updated="2026-01-01T00:00:00"):
    g = fx.games(date, fetched, pairs)
    _land(spark, root, "games", date, g)
    _land(spark, root, "box_scores", date, fx.box_scores(g, fetched))
    _land(spark, root, "standings", date, fx.standings(fetched, standings_rec))
    _land(spark, root, "teams", date, fx.teams(fetched))
    _land(spark, root, "team_details", date, fx.team_details(fetched, coach_suffix))
    _land(spark, root, "player_details", date, fx.player_details(fetched, updated, jersey))


def test_two_batches_to_gold(spark, tmp_path):
    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    seed = tmp_path / "seed.csv"
    seed.write_text(fx.CONFERENCE_SEED)
    _day(spark, landing, "20251101", "2025-11-02T08:00:00.123456", [(101, 102, 110, 100), (103, 104, 90, 95)],
         [(1, 0), (0, 1), (0, 1), (1, 0)])
    cfg1 = RunConfig(landing, wh, "2025-11-02 09:00:00", str(seed), date="20251101")
    t1 = run_all_layers(spark, cfg1)
    assert t1["bronze_games"].count() == 4
    assert t1["mart_team_analytics"].count() == 4

    _day(spark, landing, "20251102", "2025-11-03T08:00:00", [(102, 101, 99, 101), (104, 103, 80, 70)],
         [(2, 0), (0, 2), (0, 2), (2, 0)], coach_suffix=" II", jersey="8", updated="2026-01-02T00:00:00")
    cfg2 = RunConfig(landing, wh, "2025-11-03 09:00:00", str(seed), date="20251102")
    t2 = run_all_layers(spark, cfg2)

    assert t2["bronze_games"].count() == 8
    assert t2["fact_team_games"].filter("opponent_team_id IS NULL").count() == 0
    # standings: conference_rank changed for every team -> two versions each, one open
    snap = t2["standings_snapshot"]
    assert snap.count() == 8 and snap.filter("valid_to IS NULL").count() == 4
    # team details: only team 101's coach changed -> 5 versions
    assert t2["team_details_snapshot"].count() == 5
    # player 1010's jersey changed -> a second version; 1031 is a placeholder member
    dim = {r.player_id: r for r in t2["dim_players"].collect()}
    assert dim[1031].full_name == "Unknown Player (1031)" and dim[1031].player_status == "Unknown"
    assert dim[1011].player_status == "Retired" and dim[1010].jersey_number == "8"

    mart = {r.team_id: r for r in t2["mart_team_analytics"].collect()}
    assert mart[101].all_time_total_games == 2 and mart[101].all_time_wins == 2
    assert mart[102].current_season_wins == 0 and mart[102].conference_rank == 2
    assert mart[101].conference_rank == 1
    pm = {r.player_id: r for r in t2["mart_player_analytics"].collect()}
    assert pm[1011].all_time_total_games is None          # inactive-only player: no statistics
    assert pm[1011].season_pts_rank == 1                   # NULL season average ranks first
    checks = {(r.table, r.check_name): r.failures for r in declared_checks(t2).collect()}
    failing = {k: v for k, v in checks.items() if v}
    assert failing == {}, failing

    # re-running the second batch changes nothing in bronze (watermark)
    counted = {}
    t3 = run_all_layers(spark, cfg2, counted)
    # the checks counted while writing say the same as those that scan, whether they fail or not
    assert counted["mart_player_analytics"]["player_id.not_null"] == 0 and "silver_box_scores" in counted
    assert rows(declared_checks(t3, counted)) == rows(declared_checks(t3))
    assert t3["bronze_games"].count() == 8


def test_array_shaped_landing_roundtrip(spark, tmp_path):
    root = str(tmp_path)
    recs = spark.createDataFrame([(i, f"n{i}", "20240101" if i < 5 else "20240102") for i in range(12)],
                                 "id long, name string, date string")
    files = pack_json_arrays(recs, "date", "teams", max_records=4)
    for r in files.collect():
        path = os.path.join(root, "source", "teams", f"date={r.date}")
        os.makedirs(path, exist_ok=True)
        with open(os.path.join(path, os.path.basename(r.file_name)), "w") as f:
            f.write(r.raw_text)
    with open(os.path.join(root, "source", "teams", "date=20240102", "bad.json"), "w") as f:
        f.write("{not json")
    raw = read_landing(spark, root, "teams", shape="array", batch_ts="2024-01-03 00:00:00")
    assert raw.filter("raw_json IS NULL").count() == 1
    from courtside.sources.landing import records
    flat = records(raw)
    assert flat.count() == 12
    one_day = read_landing(spark, root, "teams", date="20240101", shape="array")
    assert records(one_day).count() == 5


def test_reference_shape_is_the_default(spark, tmp_path):
    """A one-line array file of five games gives five bronze rows, a bad file is a reject, the date is the day before."""
    from courtside.plans.layers import load_bronze, raw_rejects, source_freshness

    folder = tmp_path / "landing/source/games/date=20251101"
    folder.mkdir(parents=True)
    games = fx.games("20251101", "2025-11-02T08:00:00", [(101, 102, 110, 100), (103, 104, 90, 95)])
    (folder / "games.json").write_text(json.dumps([*games, {**games[0], "game_id": "0029999999"}]))
    (folder / "bad.json").write_text("{broken")
    cfg = RunConfig(str(tmp_path / "landing"), str(tmp_path / "wh"), "2025-11-02 09:00:00", "")
    bronze = load_bronze(spark, cfg)
    assert list(bronze) == ["games"] and bronze["games"].count() == 5
    assert bronze["games"].where("game_id IS NULL").count() == 0
    assert [(r.feed, r.bad_text) for r in raw_rejects(spark, cfg).collect()] == [("games", "{broken")]
    # two days later: nothing landed for the day before, the table stays, and the source is late
    later = RunConfig(cfg.landing_root, cfg.warehouse_root, "2025-11-04 09:00:00", "")
    assert load_bronze(spark, later)["games"].count() == 5
    assert [(r.source, r.status) for r in source_freshness(spark, later, "2025-11-03 12:00:00").collect()] == [("games", "warn")]
    # a backfill reads every date
    everything = RunConfig(cfg.landing_root, str(tmp_path / "wh2"), "2025-12-04 09:00:00", "", backfill=True)
    assert load_bronze(spark, everything)["games"].count() == 5


def test_daily_run_before_the_weekly_feeds(spark, tmp_path):
    landing, seed = str(tmp_path / "landing"), tmp_path / "seed.csv"
    seed.write_text(fx.CONFERENCE_SEED)
    g = fx.games("20251101", "2025-11-02T08:00:00", [(101, 102, 110, 100)])
    _land(spark, landing, "games", "20251101", g)
    _land(spark, landing, "box_scores", "20251101", fx.box_scores(g, "2025-11-02T08:00:00"))
    t = run_all_layers(spark, RunConfig(landing, str(tmp_path / "wh"), "2025-11-02 09:00:00", str(seed)))
    assert "fact_player_performances" in t and "dim_teams" not in t and "mart_team_analytics" not in t
    assert t["silver_games"].count() == 2
    assert declared_checks(t).where("failures > 0").count() == 0


def test_lines_of_arrays_and_objects(spark, tmp_path):
    folder = tmp_path / "source/teams/date=20240101"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('[{"id": 1}, {"id": 2}]\n{"id": 3}\n\n{bad\n')
    from courtside.sources.landing import records, rejects
    raw = read_landing(spark, str(tmp_path), "teams", shape="jsonl")
    assert records(raw).count() == 3
    assert [r.bad_text for r in rejects(raw).collect()] == ["{bad"]
    whole = read_landing(spark, str(tmp_path), "teams", shape="array")
    assert records(whole).count() == 0 and rejects(whole).count() == 1
    auto = read_landing(spark, str(tmp_path), "teams")
    assert records(auto).count() == 3 and [r.bad_text for r in rejects(auto).collect()] == ["{bad"]
    (folder / "b.json").write_text('[\n  {\n    "id": 4\n  },\n  {\n    "id": 5\n  }\n]\n')
    (folder / "c.json").write_text('[\n  {"id": 6},\n  7\n')
    (folder / "d.json").write_text('[{"id": 8}, {"id": 9 9}, {"id": 10, "x": {"y": [{"id": 0}]}}, {"id": 11, "x": {"id": 12}, "z')
    mixed = read_landing(spark, str(tmp_path), "teams")
    got = [r[0] for r in records(mixed).select(F.try_variant_get("value", "$.id", "int")).collect()]
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 8, 10]  # the cut-off files keep their good records
    assert sorted(r.bad_text for r in rejects(mixed).collect()) == sorted(
        ["  7", "{bad", '{"id": 9 9}', '{"id": 11, "x": {"id": 12}, "z'])


def test_files_are_loaded_once_unless_forced(spark, tmp_path):
    from courtside.sources.landing import load_files

    folder = tmp_path / "l/source/teams/date=20240101"
    folder.mkdir(parents=True)
    (folder / "a b.json").write_text('[{"id": 1}]')
    args = (spark, str(tmp_path / "l"), "teams", str(tmp_path / "raw"), str(tmp_path / "ledger"), "20240101", "2024-01-02 00:00:00")
    assert [load_files(*args), load_files(*args)] == [1, 0]
    (folder / "c.json").write_text('[{"id": 2}]')
    (folder / "a b.json").write_text('[{"id": 1}, {"id": 3}]')  # another length: another file
    assert [load_files(*args), load_files(*args), load_files(*args, force=True)] == [2, 0, 2]
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 1 + 2 + 2


def test_arrays_keep_null_dates_and_plan_no_cross_join(spark):
    recs = spark.createDataFrame([(1, "20240101"), (2, None), (3, None)], "id long, date string")
    files = pack_json_arrays(recs, "date", "teams")
    got = {r.date: (r.file_name, len(json.loads(r.raw_text))) for r in files.collect()}
    assert got == {"20240101": ("source/teams/date=20240101/teams-0.json", 1),
                   None: ("source/teams/date=__HIVE_DEFAULT_PARTITION__/teams-0.json", 2)}
    constant = pack_json_arrays(recs.withColumn("date", F.lit("20240101")), "date", "teams", max_records=1)
    plan = constant._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert sum(len(json.loads(r.raw_text)) for r in constant.collect()) == 3


def test_files_are_planned_by_size(spark, tmp_path):
    hot = [(i, "20240101") for i in range(4000)] + [(i, f"202402{i % 20 + 1:02d}") for i in range(200)] + [(1, None)]
    write_landing(spark.createDataFrame(hot, "id long, date string").repartition(8), str(tmp_path), "teams", file_rows=500)
    base = tmp_path / "source/teams"
    count = {d.name: len(list(d.glob("*.json"))) for d in base.iterdir() if d.is_dir()}
    assert count["date=20240101"] == 8  # many tasks for the hot date
    assert all(n == 1 for d, n in count.items() if d != "date=20240101") and len(count) == 22
    assert spark.read.json(str(base)).count() == len(hot)
