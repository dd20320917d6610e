import json

from pyspark.sql import functions as F

from courtside.plans.feeds import GAMES
from courtside.sources.landing import write_landing
from courtside.sources.tables import BucketedTable
from courtside.streaming import start_bronze_stream
from tests import feed_fixtures as fx


def _land_games(spark, root, day, fetched, pairs):
    recs = fx.games(day, fetched, pairs)
    df = spark.createDataFrame([(json.dumps(r), day) for r in recs], "j string, date string")
    keys = sorted({k for r in recs for k in r})
    typed = df.select(*[F.get_json_object("j", f"$.{k}").alias(k) for k in keys], "date")
    write_landing(typed, root, "games")


def test_available_now_stream_upserts_new_files_only(spark, tmp_path):
    landing, wh, ckpt = str(tmp_path / "landing"), str(tmp_path / "wh"), str(tmp_path / "ckpt")
    _land_games(spark, landing, "20251101", "2025-11-02T08:00:00", [(101, 102, 110, 100)])
    q = start_bronze_stream(spark, landing, wh, GAMES, ckpt)
    q.awaitTermination(120)
    table = BucketedTable(spark, f"{wh}/bronze", "bronze_games", [GAMES.key_name])
    assert table.read().count() == 2

    # a new day plus a corrected re-fetch of the first game (same key, later fetch)
    _land_games(spark, landing, "20251102", "2025-11-03T08:00:00", [(103, 104, 90, 95)])
    _land_games(spark, landing, "20251101", "2025-11-04T08:00:00", [(101, 102, 111, 100)])
    q = start_bronze_stream(spark, landing, wh, GAMES, ckpt)
    q.awaitTermination(120)
    out = {(r.game_id, r.team_id): r.pts for r in table.read().collect()}
    assert len(out) == 4
    assert out[("0022511010", 101)] == 111
