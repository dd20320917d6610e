"""Landing -> bronze as a Structured Streaming job.

The file source remembers which landing files it has processed in its
checkpoint (this replaces the MAX(load time) watermark of the batch form);
``trigger(availableNow=True)`` processes everything new and stops, so the job
can run on the same daily schedule. Each micro-batch runs the same
flatten -> type -> dedup -> upsert as the batch model and writes a new
table version. A replayed micro-batch is harmless: the upsert is idempotent
by key.

Unlike the watermark form, a file that lands late with an old load time is
still picked up (the source tracks files, not times).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courtside.plans.feeds import FeedSpec
from courtside.plans.models import bronze_batch
from courtside.sources.landing import feed_path, parse_array
from courtside.sources.tables import BucketedTable


def landing_stream(spark: SparkSession, landing_root: str, feed: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """RAW rows of newly landed JSON-lines files (one object or array per line)."""
    src = (spark.readStream.format("text")
                .option("maxFilesPerTrigger", max_files_per_trigger)
                .option("recursiveFileLookup", "true")
                .load(feed_path(landing_root, feed)))
    return src.select(parse_array(F.col("value")).alias("raw_json"),
                      F.col("_metadata.file_path").alias("file_name"))


def start_bronze_stream(spark: SparkSession, landing_root: str, warehouse_root: str, spec: FeedSpec,
                        checkpoint_location: str, available_now: bool = True,
                        processing_time: str | None = None) -> StreamingQuery:
    table = BucketedTable(spark, f"{warehouse_root.rstrip('/')}/bronze", f"bronze_{spec.name}", [spec.key_name], buckets=8)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("inserted_at", F.localtimestamp()).where("raw_json IS NOT NULL").persist()
        try:  # the stream hands over only new files: no watermark filter here
            table.upsert(bronze_batch(stamped, None, spec))
        finally:
            stamped.unpersist()

    writer = (landing_stream(spark, landing_root, spec.name).writeStream
              .foreachBatch(each_batch).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()

