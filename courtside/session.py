"""SparkSession settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock for timestamp_ntz <-> date casts,
# ANSI casts (strict numeric parsing unless a try_* form is asked for) and AQE
# for runtime re-planning (partition coalescing, skew-join splits, broadcast
# conversion once real sizes are known).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "courtside", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the base settings.

    On a cluster ``master`` stays None so spark-submit decides; the shuffle
    partition count should then be sized so one partition holds ~128-256 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins (Spark applies it at start-up). Only a
    local-mode session (tests, bench) without one gets a private scratch
    folder; a cluster session without the setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="courtside-ckpt-", dir=os.environ.get("COURTSIDE_SCRATCH")))
    return sc.getCheckpointDir()


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes inside have their shuffle files removed as soon as they end: what is written is read from then on."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def unshredded(spark: SparkSession):
    """Writes inside keep a VARIANT as one value: cutting it into columns and putting it together again is wasted where it is read whole."""
    key = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


TASK_BYTES = 16 << 20  # of shuffled rows; sorting them takes up to forty times as much, where they compress well
FILE_BYTES = 4 << 20  # of input files for one shuffle partition: they hold rows encoded, several times smaller than shuffled
SPLIT_BYTES = 8 << 20  # of input files for one task


def input_bytes(df) -> int:
    """Bytes of the files that ``df`` is read from; files that are gone or can't be asked count nothing."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for f in df.inputFiles():
        try:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
            total += path.getFileSystem(conf).getFileStatus(path).getLen()
        except Py4JJavaError:
            continue
    return total


@contextmanager
def small_tasks(df, task_bytes: int = TASK_BYTES):
    """Writes of ``df`` inside are cut into tasks of bounded size, however large its input is.

    The session's number of shuffle partitions is fixed, so the memory of a task would grow with the input. Shuffles begin
    with a partition for every FILE_BYTES of input, and adaptive execution joins those that turn out small.
    """
    conf = df.sparkSession.conf
    begin = max(int(conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // FILE_BYTES))
    wanted = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": begin,
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": task_bytes,
              "spark.sql.files.maxPartitionBytes": SPLIT_BYTES}
    before = {k: conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def materialize(df):
    """Store ``df`` in the shared checkpoint folder and read it back (cuts lineage).

    As Parquet: encoded and compressed columns take a fraction of a checkpoint's raw rows, and what
    follows reads only the columns it needs. Columns that Parquet can't hold take a reliable checkpoint.
    """
    folder = ensure_checkpoint_dir(df.sparkSession)
    names = [c.lower() for c in df.columns]
    if not names or len(set(names)) < len(names) or re.search(r"\b(void|interval)\b", df.schema.simpleString()):
        return df.checkpoint(eager=True)
    path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession), small_tasks(df):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Remove the files of a frame that ``materialize`` returned, when all that was made of it is stored."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        if path.getName().startswith("table-"):
            path.getFileSystem(conf).delete(path, True)
