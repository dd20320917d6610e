"""Landing zone: feed files by date.

Layout ``{root}/source/{feed}/date={yyyymmdd}/...``. A file is

* one JSON array of objects, as the feeds' producer writes them, or
* lines of one object or array each, as Spark's JSON writer produces.

The default shape ``auto`` reads lines, so a large file is split over tasks, and reads
a file whole only if some line of it can't stand alone (a pretty-printed record);
``jsonl`` reads lines only, ``array`` whole files only, which must be one value each. A
single object counts as an array of one.

A damaged text (cut off, or with a bad record) is taken element by element: its good
records load, whether it is one line or one record a line, and only what is bad is kept
as a reject. ``array`` rejects a damaged file as a whole.

Writers never gather a whole date into one task: ``write_landing`` lets every
task write its own file, and ``pack_json_arrays`` cuts a date into arrays of
about ``max_records`` objects.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.functions.semistruct import flatten
from courtside.session import materialize, shuffles_dropped, unshredded

TASK_DATES = 50
ZIPPED_ROWS = 200_000
NULL_DATE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a NULL partition value


def feed_path(root: str, feed: str) -> str:
    return f"{root.rstrip('/')}/source/{feed}"


def logical_date(run_ts: str) -> str:
    """The folder a run loads, the day before its own date, as yyyymmdd."""
    return (dt.datetime.fromisoformat(run_ts).date() - dt.timedelta(days=1)).strftime("%Y%m%d")


def pack_json_arrays(df: DataFrame, date_col: str, feed: str, max_records: int = 10_000) -> DataFrame:
    """S8 in memory: one JSON array text per (date, chunk) of ~max_records objects.

    Each date gets as many chunks as its own row count asks for, and rows are spread over
    them by a hash, so small dates stay one array and no group grows with the data when one
    date is hot. A NULL date is a date of its own, in the folder Spark's writer gives it. ``df`` is
    read for the counts and for the texts: store it first if it is costly to derive.
    """
    payload = [c for c in df.columns if c != date_col]
    # A NULL date finds its row too; with nothing of another column added, a constant one is still joined as a key, not crossed.
    nothing = F.left(F.coalesce(F.col(payload[0]).cast("string"), F.lit("")), F.lit(0))
    day = F.concat(F.coalesce(F.col(date_col).cast("string"), F.lit(NULL_DATE)), nothing)
    counts = df.groupBy(day.alias("__day")).agg(F.ceil(F.count("*") / max_records).alias("__chunks"))
    # Joined, as a map of all dates would be searched from its start for every row.
    dealt = df.join(F.broadcast(counts), day == F.col("__day"))
    chunk = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in payload]), F.col("__chunks"))
    dealt = dealt.select(*df.columns, chunk.alias("__chunk")).repartition(date_col, "__chunk")  # else each task sorts and packs parts of all
    grouped = dealt.groupBy(date_col, "__chunk").agg(F.to_json(F.collect_list(F.struct(*payload))).alias("raw_text"))
    name = F.concat(F.lit(f"source/{feed}/date="), F.coalesce(F.col(date_col).cast("string"), F.lit(NULL_DATE)),
                    F.lit(f"/{feed}-"), F.col("__chunk").cast("string"), F.lit(".json"))
    return grouped.select(F.col(date_col), name.alias("file_name"), "raw_text")


def write_landing(df: DataFrame, root: str, feed: str, date_col: str = "date", file_rows: int = 0,
                  compression: str = "none") -> None:
    """Write records as JSON lines partitioned by date.

    Dynamic partition overwrite: a re-run of a date replaces only that date;
    an empty frame writes nothing. With ``file_rows`` the files are planned first: see ``planned``; ``df`` is
    stored for that, as it is read for the counts and for the rows. Files with a ``compression`` are read whole by a
    task, so they hold at most ZIPPED_ROWS rows each.
    """
    out = planned(materialize(df), date_col, file_rows) if file_rows else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression)
    if compression != "none":
        writer = writer.option("maxRecordsPerFile", ZIPPED_ROWS)
    with shuffles_dropped(df.sparkSession):
        writer.partitionBy(date_col).json(feed_path(root, feed))


def planned(df: DataFrame, date_col: str, file_rows: int) -> DataFrame:
    """Rows dealt to tasks so that each writes about ``file_rows`` rows.

    Dates are laid end to end by their counted rows: a hot date is cut over many tasks by a
    hash of its rows, small dates share a task (at most TASK_DATES, as each opens a file), and a
    date gets no more files than its rows ask for.
    """
    day = F.coalesce(F.col(date_col).cast("string"), F.lit(NULL_DATE))
    counts = df.groupBy(day.alias("d")).count().orderBy("d").collect()  # one row per date
    starts, tasks, filled, dates = {}, 0, 0, 0
    for r in counts:
        parts = max(1, round(r["count"] / file_rows))
        if parts > 1 or filled + r["count"] > file_rows or dates == TASK_DATES:
            tasks, filled, dates = tasks + (filled > 0), 0, 0
        starts[r["d"]] = (tasks, parts)
        if parts > 1:
            tasks += parts
        else:
            filled, dates = filled + r["count"], dates + 1
    if not starts:
        return df
    # Joined, as a map of all dates would be searched from its start for every row.
    places = F.create_map(*[x for d, (at, n) in starts.items() for x in (F.lit(d), F.struct(F.lit(at).alias("at"), F.lit(n).alias("n")))])
    plan = df.sparkSession.range(1).select(F.explode(places).alias("__day", "__place"))
    spread = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in df.columns]), F.col("__place.n"))
    dealt = df.join(F.broadcast(plan), day == F.col("__day")).withColumn("__task", (F.col("__place.at") + spread).cast("int"))
    return dealt.repartitionById(tasks + 1, F.col("__task")).select(*df.columns)


def parse_outer(text: Column) -> Column:
    """The text parsed inside brackets, so that anything after the first value shows."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def parse_array(text: Column, outer: Column | None = None) -> Column:
    """VARIANT array of a JSON array's elements, or of one object; NULL for anything else.

    ``outer``: a column that holds ``parse_outer(text)``, so that it is parsed once a row.
    """
    start = F.substring(F.ltrim(text, F.lit(" \t\n\x0b\f\r")), 1, 1)
    outer = parse_outer(text) if outer is None else outer
    alone = F.try_variant_get(outer, "$[1]", "variant").isNull()
    return F.when((start == "{") & alone, outer).when((start == "[") & alone, F.try_variant_get(outer, "$[0]", "variant"))


# An object with up to three levels inside, strings skipped; or, from a brace that never closes, all the rest.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_OBJECT = r"\{(?:[^{}\"]++|" + _STRING + r")*+\}"
for _ in range(3):
    _OBJECT = r"\{(?:[^{}\"]++|" + _STRING + "|" + _OBJECT + r")*+\}"
ELEMENT = f"(?s:{_OBJECT}|\\{{.*+)"
# A line that can't stand alone: it goes on with a field, closes a record, or opens one and ends.
_PART = r'^\s*(?:["}]|[\[,]?\s*\{\s*$)'


def salvage(text: Column, whole: Column | None = None) -> Column:
    """array<struct<raw_json, bad_text>> of a text: its records as one VARIANT array, and each bad part by itself.

    Objects are cut out by balanced braces; what is left over but brackets and commas is a bad part
    too. A text without any good record is one bad part. ``whole``: a column that holds ``parse_array(text)``.
    """
    good = lambda e: F.try_parse_json(e).isNotNull()
    ok = lambda v: F.struct(v.alias("raw_json"), F.lit(None).cast("string").alias("bad_text"))
    bad = lambda t: F.struct(F.try_parse_json(F.lit(None).cast("string")).alias("raw_json"), t.alias("bad_text"))
    found = F.regexp_extract_all(text, F.lit(ELEMENT), F.lit(0))
    kept, lost = F.filter(found, good), F.filter(found, lambda e: ~good(e))
    rest = F.trim(F.regexp_replace(F.regexp_replace(text, ELEMENT, ""), "[\\s,\\[\\]]+", " "))
    parts = F.concat(F.array(ok(F.try_parse_json(F.concat(F.lit("["), F.concat_ws(",", kept), F.lit("]"))))),
                     F.transform(lost, bad), F.when(rest != "", F.array(bad(rest))).otherwise(F.array().cast(
                         "array<struct<raw_json:variant,bad_text:string>>")))
    whole = parse_array(text) if whole is None else whole
    brackets = F.regexp_replace(text, "[\\s,\\[\\]]+", "") == ""  # the lines around one record a line
    return (F.when(whole.isNotNull(), F.array(ok(whole))).when(brackets, F.array(ok(F.parse_json(F.lit("[]")))))
             .when(F.size(kept) > 0, parts).otherwise(F.array(bad(text))))


def read_landing(spark: SparkSession, root: str, feed: str, date: str | None = None,
                 batch_ts: Column | str | None = None, shape: str = "auto", files: list[str] | None = None) -> DataFrame:
    """RAW rows (raw_json VARIANT, file_name, inserted_at, date, bad_text).

    ``date`` opens one date folder (the others are not even listed), ``files`` only the files named;
    ``batch_ts`` is the load time stamped on every row; a text that does not parse has a NULL
    ``raw_json`` and is kept in ``bad_text`` (see ``rejects``). Blank lines are skipped.
    """
    if shape not in ("auto", "array", "jsonl"):
        raise ValueError(f"unknown landing shape {shape}")
    base = feed_path(root, feed)
    path = f"{base}/date={date}" if date is not None else base
    file = F.col("_metadata.file_path")

    def texts(paths: str | list[str], whole: bool) -> DataFrame:
        raw = spark.read.option("basePath", base).text(paths, wholetext=whole)
        return raw.select("value", F.col("date").cast("string").alias("date"), file.alias("file_name"))

    raw = texts([unquote(f) for f in files] if files is not None else path, shape == "array")
    if shape == "auto":
        # Names of files, which the driver lists for the scan in any case.
        odd = [r[0] for r in raw.where(F.col("value").rlike(_PART)).select("file_name").distinct().collect()]
        if odd:
            names = spark.createDataFrame([(f,) for f in odd], "file_name string")
            raw = raw.join(F.broadcast(names), "file_name", "left_anti").unionByName(
                texts([unquote(f) for f in odd], True))
    raw = raw.where(F.trim("value") != "")
    ts = batch_ts if isinstance(batch_ts, Column) else (
        F.lit(batch_ts).cast("timestamp_ntz") if batch_ts else F.localtimestamp())
    if shape == "array":
        parsed = parse_array(F.col("value"))
        raw = raw.select(parsed.alias("raw_json"), "file_name", "date", F.when(parsed.isNull(), F.col("value")).alias("bad_text"))
    else:
        raw = raw.withColumn("__outer", parse_outer(F.col("value")))  # columns of their own: parsed once a row
        raw = raw.withColumn("__whole", parse_array(F.col("value"), F.col("__outer")))
        raw = raw.select("file_name", "date", F.inline(salvage(F.col("value"), F.col("__whole"))))
    return raw.select("raw_json", "file_name", ts.alias("inserted_at"), "date", "bad_text")


def rejects(raw: DataFrame) -> DataFrame:
    """Rows whose text did not parse (kept aside; the load continues)."""
    return raw.filter(F.col("raw_json").isNull())


def append_raw(raw: DataFrame, path: str) -> None:
    """A (forced) load appends its rows to the RAW table; duplicates are removed downstream."""
    with shuffles_dropped(raw.sparkSession), unshredded(raw.sparkSession):
        raw.write.mode("append").parquet(path)


LEDGER = "file_name string, length bigint, modified timestamp, inserted_at timestamp_ntz"


def landed_files(spark: SparkSession, root: str, feed: str, date: str | None = None) -> DataFrame:
    """The landed files of a feed (file_name, length, modified), listed without reading them."""
    base = feed_path(root, feed)
    files = spark.read.format("binaryFile").option("basePath", base).load(f"{base}/date={date}" if date is not None else base)
    return files.select(F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_size").alias("length"),
                        F.col("_metadata.file_modification_time").alias("modified"))


def load_files(spark: SparkSession, root: str, feed: str, raw_table: str, ledger: str, date: str | None = None,
               batch_ts: str | None = None, shape: str = "auto", force: bool = False) -> int:
    """Append landed files to the RAW table and to the ledger of loaded files; returns their number.

    Unforced, a file that the ledger holds with the same length and modification time is
    passed over; ``force`` loads every file again. The ledger is written after the rows: a stop between
    them loads the files once more, and duplicates are removed downstream.
    """
    found = landed_files(spark, root, feed, date)
    done = spark.read.schema(LEDGER).parquet(ledger) if _exists(spark, ledger) else spark.createDataFrame([], LEDGER)
    if not force:
        found = found.join(done, ["file_name", "length", "modified"], "left_anti")
    ts = F.lit(batch_ts).cast("timestamp_ntz") if batch_ts else F.localtimestamp()
    rows = found.orderBy("file_name").collect()  # as many as the files that the scan lists on the driver anyway
    if rows:
        append_raw(read_landing(spark, root, feed, date, batch_ts, shape, [r["file_name"] for r in rows]), raw_table)
        new = spark.createDataFrame([tuple(r) for r in rows], "file_name string, length bigint, modified timestamp")
        new.withColumn("inserted_at", ts).coalesce(1).write.mode("append").parquet(ledger)
    return len(rows)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def records(raw: DataFrame, value: str = "value") -> DataFrame:
    """V1 over RAW rows: one row per landed object with the file columns kept."""
    return flatten(raw, "raw_json", keep=["file_name", "inserted_at"], value=value)


SEED_CONFERENCE_SCHEMA = T.StructType([
    T.StructField("team_id", T.LongType()),
    T.StructField("team_name", T.StringType()),
    T.StructField("conference", T.StringType()),
])


def read_seed(spark: SparkSession, path: str, schema: T.StructType = SEED_CONFERENCE_SCHEMA) -> DataFrame:
    """Static lookup CSV with a declared schema (no inference)."""
    return spark.read.schema(schema).option("header", "true").csv(path)
