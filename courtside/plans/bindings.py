"""Role binding of the driver's tables to the reference's data model.

game = ``orders`` (game_id = o_orderkey, game_date = o_orderdate, season =
year as text); box score = ``lineitem`` (player = l_partkey, team =
l_suppkey); player = ``part``; team = ``supplier``; team code = 3-digit nation
key of ``nation``; conference = ``region`` through ``nation``; JSON feed =
``events.props``. Measures are integer functions of line-item columns so that
both engines compute identical bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.sources.tables import read_table

CURRENT_SEASON = "2000"
SEASON_START = "1996-01-01"
RECENT_N = 10
RETIRED_BEFORE = 2024
# Fixed "now" for placeholder members and freshness, so results are reproducible.
FIXED_NOW = "2024-02-01 00:00:00"


def _pct(c: str) -> Column:
    return F.round(F.col(c) * F.lit(100)).cast("bigint")


def box_scores(spark: SparkSession, root: str) -> DataFrame:
    """lineitem as player x game rows with the reference's statistic names."""
    return _box_score_columns(read_table(spark, root, "lineitem"))


def _box_score_columns(li: DataFrame, *more: str) -> DataFrame:
    return li.select(
        F.col("l_partkey").alias("player_id"),
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("team_id"),
        F.col("l_linenumber").cast("bigint").alias("line_no"),
        F.when(F.col("l_returnflag") == "R", F.lit("INACTIVE")).otherwise(F.lit("ACTIVE")).alias("status"),
        F.col("l_quantity").cast("bigint").alias("points"),
        F.col("l_linenumber").cast("bigint").alias("assists"),
        _pct("l_discount").alias("total_reb"),
        _pct("l_tax").alias("fg_made"),
        (_pct("l_tax") + _pct("l_discount")).alias("fg_attempted"),
        (F.col("l_linenumber").cast("bigint") - 1).alias("fg3_made"),
        (F.col("l_linenumber").cast("bigint") + _pct("l_discount")).alias("fg3_attempted"),
        F.when(F.col("l_linestatus") == "O", F.lit("W")).otherwise(F.lit("L")).alias("wl"),
        *more)


def games(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders")
    return o.select(F.col("o_orderkey").alias("game_id"), F.col("o_orderdate").alias("game_date"),
                    F.year("o_orderdate").cast("string").alias("season"))


def player_facts(spark: SparkSession, root: str) -> DataFrame:
    """fact_player_performances: box scores LEFT JOIN games.

    The tables' own columns are joined and the measures made from them afterwards: fewer bytes are shuffled and sorted.
    """
    li = read_table(spark, root, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag",
                                                    "l_quantity", "l_discount", "l_tax", "l_linestatus")
    o = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate")
    facts = _box_score_columns(li.join(o, li["l_orderkey"] == o["o_orderkey"], "left"), "o_orderdate")
    facts = facts.withColumn("game_date", F.col("o_orderdate")).withColumn("season", F.year("o_orderdate").cast("string"))
    return facts.select("game_id", *[c for c in facts.columns if c not in ("game_id", "o_orderdate")])


def player_recent_order() -> list[Column]:
    return [F.col("game_date").desc_nulls_first(), F.col("game_id").desc(), F.col("line_no").desc(),
            F.col("team_id").desc()]


def dim_players(spark: SparkSession, root: str) -> DataFrame:
    p = read_table(spark, root, "part")
    year = (F.lit(1975) + F.col("p_size")).cast("string")
    return p.select(
        F.col("p_partkey").alias("player_id"),
        F.col("p_name").alias("full_name"),
        F.col("p_brand").alias("country"),
        F.col("p_type").alias("position"),
        F.col("p_size").cast("string").alias("weight_lbs"),
        year.alias("career_to_year"),
        F.when(year.try_cast("int") < F.lit(RETIRED_BEFORE), F.lit("Retired")).otherwise(F.lit("Active"))
         .alias("player_status"))


PLAYER_COLS = ("player_id", "full_name", "country", "position", "weight_lbs", "career_to_year", "player_status")


def code_of(c: Column) -> Column:
    """Three-digit team code from an integer key (the 'abbreviation')."""
    return F.lpad(c.cast("string"), 3, "0")


def team_codes(spark: SparkSession, root: str) -> DataFrame:
    n = read_table(spark, root, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("code_team_id"),
                    code_of(F.col("n_nationkey")).alias("abbreviation"))


def team_game_rows(spark: SparkSession, root: str) -> DataFrame:
    """Team x game rows with a matchup text and the team's own code (for J5).

    matchup = code(suppkey % 25) || ' vs. ' || code(partkey % 27): codes 025 and
    026 exist in no dimension row. Own team = nation (suppkey + linenumber % 2)
    % 26, where 25 has no row, so the own code is then NULL.
    """
    li = read_table(spark, root, "lineitem")
    o = read_table(spark, root, "orders")
    codes = team_codes(spark, root)
    li = li.select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_linestatus", "l_quantity")
    o = o.select("o_orderkey", "o_orderdate")
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left").select(  # texts are made after the shuffle
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("team_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_linenumber").cast("bigint").alias("line_no"),
        F.concat(code_of(F.col("l_suppkey") % 25), F.lit(" vs. "), code_of(F.col("l_partkey") % 27)).alias("matchup"),
        ((F.col("l_suppkey") + F.col("l_linenumber") % 2) % 26).alias("own_team_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("W")).otherwise(F.lit("L")).alias("wl"),
        F.col("l_quantity").cast("bigint").alias("team_total_point"),
        F.col("o_orderdate").alias("game_date"), F.year("o_orderdate").cast("string").alias("season"))
    own = codes.select(F.col("code_team_id").alias("own_team_id"), F.col("abbreviation").alias("own_abbreviation"))
    return rows.join(own, on="own_team_id", how="left")


def team_recent_order() -> list[Column]:
    return [F.col("game_date").desc_nulls_first(), F.col("game_id").desc(), F.col("part_id").desc(),
            F.col("line_no").desc(), F.col("opponent_team_id").asc_nulls_first()]


def dim_teams(spark: SparkSession, root: str) -> DataFrame:
    s = read_table(spark, root, "supplier")
    return s.select(F.col("s_suppkey").alias("team_id"), F.col("s_name").alias("team_name"),
                    code_of(F.col("s_nationkey")).alias("abbreviation"),
                    F.col("s_nationkey").alias("nation_id"))


def conference_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Seed stand-in: team -> conference (region name through nation)."""
    s = read_table(spark, root, "supplier")
    n = read_table(spark, root, "nation")
    r = read_table(spark, root, "region")
    nr = n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select("n_nationkey", "r_name")
    return s.join(nr, s["s_nationkey"] == nr["n_nationkey"], "left").select(
        F.col("s_suppkey").alias("team_id"), F.col("r_name").alias("conference"))


TEAM_COLS = ("team_id", "team_name", "abbreviation")


# Box-score feed derived from lineitem: two load batches that overlap in ship year.
FEED_BATCHES = (("1900-01-01", "1998-01-01", "2024-03-01 10:00:00", 0),
                ("1997-01-01", "9999-12-31", "2024-03-02 10:00:00", 1))


def box_score_feed_records(spark: SparkSession, root: str, lo: str, hi: str, bump: int) -> DataFrame:
    """Landing records (as the producer writes them) for line items shipped in [lo, hi).

    game_id is the order key as ten-digit text; the fetch time is the ship date
    plus the supplier key in seconds; ``bump`` is added to the points of a later
    re-fetch so replaced rows are visible.
    """
    li = read_table(spark, root, "lineitem").filter(
        (F.col("l_shipdate") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit(hi).cast("timestamp_ntz")))
    fetched = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("l_suppkey").cast("decimal(18,6)"))
    return li.select(
        F.lpad(F.col("l_orderkey").cast("string"), 10, "0").alias("game_id"),
        F.col("l_partkey").alias("player_id"), F.col("l_suppkey").alias("team_id"),
        F.when(F.col("l_returnflag") == "R", F.lit("INACTIVE")).otherwise(F.lit("ACTIVE")).alias("status"),
        F.when(F.col("l_linenumber") == 2, F.lit("")).otherwise(F.lit("12:00")).alias("minutes"),
        (F.col("l_quantity").cast("bigint") + F.lit(bump)).alias("points"),
        F.col("l_linenumber").alias("assists"),
        F.date_format(fetched, "yyyy-MM-dd'T'HH:mm:ss").alias("fetched_at"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("date"))
