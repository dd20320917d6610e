"""The six feeds derived from the given tables, in SQL that Spark and DuckDB both read.

Team = ``supplier``, player = ``part`` (every tenth with a negated key, so that its
facts are orphans), game = ``orders`` x suppliers of its line items, box score =
line items by order and part. Two loads: the first holds everything, the second
re-fetches some keys with altered values. Columns carry the feeds' JSON names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.keys import key_text
from courtside.plans.feeds import FEEDS, FeedSpec
from courtside.session import discard, materialize
from courtside.sources.landing import pack_json_arrays
from courtside.sources.tables import read_table

TABLES = ("supplier", "nation", "part", "orders", "lineitem")
LOADED = {1: "2024-03-01 10:00:00", 2: "2024-03-02 10:00:00"}
FETCHED = {1: "2024-03-01T08:00:00", 2: "2024-03-02T08:00:00"}
UPDATED = {1: "2024-01-15T00:00:00", 2: "2024-02-15T00:00:00"}


def _text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _code(x: str) -> str:
    return f"lpad({_text(f'({x}) % 1000')}, 3, '0')"


GAME_ID = f"CASE WHEN l_orderkey % 10 = 0 THEN '001' ELSE '002' END || lpad({_text('l_orderkey')}, 9, '0')"

FEED_SQL = {
    "teams": f"""
SELECT s_suppkey AS team_id, s_name AS team_name, {_code('s_suppkey')} AS abbreviation,
  CASE WHEN {{n}} = 2 AND s_suppkey % 2 = 0 THEN lower(s_name) ELSE s_name END AS nickname,
  'City ' || {_text('s_nationkey')} AS city,
  CASE WHEN s_nationkey % 2 = 0 THEN 'State ' || {_text('s_nationkey')} END AS state,
  CAST(1900 + s_nationkey AS BIGINT) AS year_founded
FROM {{supplier}} WHERE {{n}} = 1 OR s_suppkey % 3 <> 0""",
    "team_details": f"""
SELECT s_suppkey AS team_id, {_code('s_suppkey')} AS abbreviation, s_name AS nickname,
  'City ' || {_text('s_nationkey')} AS city, 'Arena ' || {_text('s_suppkey')} AS arena,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE {_text('10000 + s_suppkey')} END AS arena_capacity,
  'Coach ' || {_text('CASE WHEN {n} = 2 AND s_suppkey % 5 = 0 THEN s_suppkey + 1 ELSE s_suppkey END')} AS head_coach,
  CASE WHEN {{n}} = 2 AND s_suppkey % 7 = 0 THEN NULL ELSE 'Manager' END AS general_manager,
  'Owner ' || {_text('s_nationkey')} AS owner, CASE WHEN s_suppkey % 2 = 0 THEN 'Affiliate' END AS dleague_affiliation,
  CAST(1900 + s_nationkey AS BIGINT) AS year_founded
FROM {{supplier}} WHERE {{n}} = 1 OR s_suppkey % 3 <> 0""",
    "standings": f"""
SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'East' ELSE 'West' END AS conference,
  {_text('CASE WHEN s_suppkey % 3 = 1 THEN 1 ELSE {n} END')} || '-' || {_text('s_suppkey % 9')} AS conference_rank,
  n_name AS division, '10-' || {_text('s_suppkey % 9')} AS home_record, '5-5' AS last_10,
  CAST({{n}} * 3 AS BIGINT) AS losses, '8-8' AS road_record, CAST(s_suppkey % 7 - 3 AS BIGINT) AS streak,
  s_suppkey AS team_id, s_name AS team_name,
  CAST({{n}} * 10 + s_suppkey % 5 AS DOUBLE) / CAST({{n}} * 13 + s_suppkey % 5 AS DOUBLE) AS win_pct,
  CAST({{n}} * 10 + s_suppkey % 5 AS BIGINT) AS wins
FROM {{supplier}} LEFT JOIN {{nation}} ON s_nationkey = n_nationkey WHERE {{n}} = 1 OR s_suppkey % 4 <> 0""",
    "player_details": f"""
SELECT CASE WHEN p_partkey % 10 = 3 THEN -p_partkey ELSE p_partkey END AS player_id, p_name AS full_name,
  '1990-01-01T00:00:00' AS birthdate, CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_brand END AS country,
  {_text('p_size')} || '-' || {_text('{n}')} AS height, {_text('180 + p_size')} AS weight,
  {_text('CASE WHEN p_partkey % 2 = 0 THEN {n} ELSE 0 END')} AS jersey_number, p_type AS position,
  p_partkey % 50 + 1 AS team_id, 'Team' AS team_name, {_code('p_partkey % 50 + 1')} AS team_abbreviation,
  '2010' AS draft_year, '1' AS draft_round, {_text('p_size')} AS draft_number, '2010' AS from_year,
  CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 7 = 0 THEN NULL ELSE {_text('1990 + p_size')} END AS to_year,
  '{{updated}}' AS updated_at
FROM {{part}} WHERE {{n}} = 1 OR p_partkey % 4 <> 1""",
    "games": f"""
SELECT {GAME_ID} AS game_id, {_text('CAST(max(o_orderdate) AS DATE)')} AS game_date,
  {_code('l_suppkey')} || CASE WHEN l_orderkey % 2 = 0 THEN ' vs. ' ELSE ' @ ' END || {_code('l_orderkey % 110 + 1')} AS matchup,
  {_text('year(max(o_orderdate))')} AS season, l_suppkey AS team_id,
  CAST(sum(l_linenumber) AS BIGINT) - 4 AS plus_minus, CAST(sum(l_quantity) AS BIGINT) + {{n}} - 1 AS pts,
  CASE WHEN min(l_linestatus) = 'O' THEN 'W' ELSE 'L' END AS wl
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
WHERE {{n}} = 1 OR l_orderkey % 3 = 0 GROUP BY l_orderkey, l_suppkey""",
    "box_scores": f"""
SELECT {GAME_ID} AS game_id, l_partkey AS player_id, min(l_suppkey) AS team_id, 'First' AS first_name,
  'Last ' || {_text('l_partkey')} AS family_name, {_text('max(l_linenumber)')} AS jersey_number,
  CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'G' END AS position,
  CASE WHEN min(l_returnflag) = 'R' THEN 'INACTIVE' ELSE 'ACTIVE' END AS status, 'City' AS team_city,
  'Name' AS team_name, {_code('min(l_suppkey)')} AS team_abbreviation,
  CASE WHEN l_partkey % 5 = 0 THEN '' WHEN l_partkey % 7 = 0 THEN NULL ELSE '12:34' END AS minutes,
  CAST(max(l_quantity) AS BIGINT) + {{n}} - 1 AS points, CAST(max(l_linenumber) AS BIGINT) AS assists,
  CAST(l_partkey % 4 AS BIGINT) AS steals, CAST(l_partkey % 3 AS BIGINT) AS blocks,
  CAST(l_orderkey % 5 AS BIGINT) AS turnovers, CAST(l_orderkey % 6 AS BIGINT) AS fouls,
  CAST(l_orderkey % 21 AS BIGINT) - 10 AS plus_minus, CAST(l_partkey % 6 AS BIGINT) AS rebounds_offensive,
  CAST(l_partkey % 8 AS BIGINT) AS rebounds_defensive, CAST(l_partkey % 6 + l_partkey % 8 AS BIGINT) AS rebounds_total,
  CAST(l_partkey % 9 AS BIGINT) AS fg_made, CAST(l_partkey % 9 + l_orderkey % 7 AS BIGINT) AS fg_attempted,
  max(l_discount) AS fg_pct, CAST(l_partkey % 2 AS BIGINT) AS fg3_made, CAST(l_partkey % 2 + 1 AS BIGINT) AS fg3_attempted,
  max(l_tax) AS fg3_pct, CAST(l_orderkey % 3 AS BIGINT) AS ft_made, CAST(l_orderkey % 3 + 2 AS BIGINT) AS ft_attempted,
  0.5 + max(l_tax) AS ft_pct
FROM {{lineitem}} WHERE {{n}} = 1 OR l_orderkey % 4 = 0 GROUP BY l_orderkey, l_partkey""",
}


def feed_sql(feed: str, load: int, **tables: str) -> str:
    """The feed's SQL for one load, with its fetch time; ``tables`` names the given tables."""
    return (f"SELECT *, '{FETCHED[load]}' AS fetched_at FROM ("
            + FEED_SQL[feed].format(n=load, updated=UPDATED[load], **tables) + ") AS feed")


def feed_records(spark: SparkSession, root: str, feed: str, load: int) -> DataFrame:
    """Landing records of one load, as the producer writes them."""
    names = [t for t in TABLES if "{" + t + "}" in FEED_SQL[feed]]
    sql = feed_sql(feed, load, **{t: "{" + t + "}" for t in names})
    return spark.sql(sql, **{t: read_table(spark, root, t) for t in names})


def source_file(feed: str, load: int) -> str:
    return f"source/{feed}/date={FETCHED[load][:10].replace('-', '')}/{feed}.json"


def raw_rows(spark: SparkSession, root: str, feed: str, load: int) -> DataFrame:
    """RAW rows of one load: JSON array documents parsed to VARIANT. The documents are stored, the records they are packed from are not kept."""
    recs = materialize(feed_records(spark, root, feed, load).withColumn("date", F.lit(FETCHED[load][:10])))
    files = materialize(pack_json_arrays(recs, "date", feed, max_records=5000).select("raw_text"))
    discard(recs)
    return files.select(F.try_parse_json("raw_text").alias("raw_json"), F.lit(source_file(feed, load)).alias("file_name"),
                        F.lit(LOADED[load]).cast("timestamp_ntz").alias("inserted_at"))


def bronze_frame(spark: SparkSession, root: str, feed: str, load: int, digest: bool = True) -> DataFrame:
    """Bronze-shaped rows of one load without the way through JSON, for the jobs above bronze.

    Without ``digest`` the key stays the text that its digest is made from.
    """
    spec: FeedSpec = FEEDS[feed]
    kinds = {"int": "bigint", "float": "double", "string": "string", "timestamp_ntz": "timestamp_ntz"}
    rec = feed_records(spark, root, feed, load)
    field = lambda path: path.removeprefix("$.")
    parts = [F.to_date(F.col(field(p)).cast("timestamp_ntz")) if k == "date" else F.col(field(p)) for p, k in spec.key_parts]
    cols = [(F.col(field(p)) if field(p) in rec.columns else F.lit(None)).cast(kinds[t]).alias(c) for c, p, t in spec.columns]
    key = F.md5(key_text(*parts)) if digest else key_text(*parts)
    return rec.select(key.alias(spec.key_name), *cols, F.lit(source_file(feed, load)).alias("source_file"),
                      F.lit(LOADED[load]).cast("timestamp_ntz").alias("loaded_at_utc"),
                      F.col("fetched_at").cast("timestamp_ntz").alias("api_fetched_at"))
