"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.session import ensure_checkpoint_dir, shuffles_dropped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BATCH_ROWS = 1000


def text_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of at most BATCH_ROWS.

    Rows here carry whole texts: Spark's default of 10,000 rows would hold a whole
    partition of long texts several times over, in the JVM and in the worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def tidied(run: Callable) -> Callable:
    """``run`` over Arrow batches, with freed memory given back to the system at the end.

    Worker processes outlive their tasks, and what their allocators keep adds to the executor's memory.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage: what follows survives the loss of any executor without
    recomputing what came before, and reads only the columns it needs. Its shuffle files go as soon as it is written.
    """
    spark = df.sparkSession
    text_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    atexit.register(_discard, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table when the application ends."""
    try:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    except (Py4JError, Py4JNetworkError, AttributeError):  # the session is gone; the folder's retention takes it
        pass


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """64-bit key of (id, text): with the id it tells apart rows that share an id."""
    return F.xxhash64(df[id_col], df[text_col])


def texts(batch: pa.RecordBatch, i: int) -> Iterator[str]:
    """The column's texts, NULL as the empty text, one Python string at a time."""
    return (x.as_py() or "" for x in batch.column(i))


def utf8(batch: pa.RecordBatch, i: int) -> Iterator[bytes]:
    """The column's texts as UTF-8 bytes (NULL: empty), sliced from the Arrow buffer."""
    col = batch.column(i)
    col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())  # shares the buffer
    return (x.as_py() or b"" for x in col)


def rebatched(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows (tuples in schema order) as record batches of at most ``size`` rows."""
    buf: list[tuple] = []
    for row in rows:
        buf.append(row)
        if len(buf) >= size:
            yield _batch(buf, schema)
            buf = []
    if buf:
        yield _batch(buf, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (NULL id: the empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit words (wraps)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
