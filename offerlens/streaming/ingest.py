"""Incremental offer ingest with Structured Streaming.

* ``ingest_first_seen`` - the collector's progressive save with first-seen
  dedup across batches, exactly: each micro-batch is reduced to its first
  card per id (hash aggregate with ``min_by``), then anti-joined with the ids
  already in the sink, and appended.  The sink lies in folders by the hash of
  the id and, below, by ``batch_id``: a batch opens only the folders its ids
  fall into (partition pruning), so a small batch never reads a long-lived
  sink as a whole.  The write overwrites only the batch's own partitions, so
  a retried batch (lost executor, restarted query) is idempotent.
* ``stream_dedup`` - the built-in stateful dedup on the id.  With a watermark
  an id is forgotten once its time of expiry has passed, and the state store
  stays as small as the ids of that span; without one it holds every id.

Both read a file source (new files as they arrive) and keep progress in a
checkpoint folder; ``availableNow`` processes what has arrived and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from offerlens.operators.cards import first_seen


#: Folders of ids in a sink, fixed when it is made.
BUCKETS = 64


def _sink_schema(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add("id_bucket", "integer").add("batch_id", "long")


def id_bucket(key: str, buckets: int = BUCKETS):
    """Folder of an id."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def seen_ids(sink: DataFrame, key: str, opened: list[int], batch_id: int) -> DataFrame:
    """Ids of earlier batches in the folders ``opened``."""
    return sink.where(F.col("id_bucket").isin(opened) & (F.col("batch_id") < batch_id)).select("id_bucket", key)


def _merge_batch(sink: str, schema: StructType, key: str, order: list[str], title: str, buckets: int = BUCKETS):
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.where(F.col(title).isNotNull() & (F.col(title) != F.lit("")))
        firsts = first_seen(kept, key, order).withColumn("id_bucket", id_bucket(key, buckets))
        opened = sorted(r[0] for r in firsts.select("id_bucket").distinct().collect())     # at most ``buckets`` numbers
        stored = spark.read.schema(_sink_schema(schema)).parquet(sink)
        # A semi join whose build side is the batch's keys: Spark can broadcast
        # them (its own size check, sort-merge beyond it) and streams the
        # folders' ids through the hash table instead of shuffling them.
        hits = seen_ids(stored, key, opened, batch_id).join(firsts.select("id_bucket", key), ["id_bucket", key], "left_semi")
        new = firsts.join(hits, ["id_bucket", key], "left_anti").withColumn("batch_id", F.lit(batch_id).cast("long"))
        (new.select(*schema.names, "id_bucket", "batch_id").repartition("id_bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("id_bucket", "batch_id").parquet(sink))
    return merge


def ingest_first_seen(spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str,
                      key: str = "job_id", order: tuple[str, ...] = ("scraped_at", "offer_id"),
                      title: str = "title", max_files_per_trigger: int | None = None, buckets: int = BUCKETS) -> None:
    """Process every file that has arrived in ``source`` (then stop)."""
    spark.createDataFrame([], _sink_schema(schema)).write.mode("ignore").partitionBy(
        "id_bucket", "batch_id").parquet(sink)
    rd = spark.readStream.schema(schema)
    if max_files_per_trigger:
        rd = rd.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (rd.parquet(source).writeStream
         .foreachBatch(_merge_batch(sink, schema, key, list(order), title, buckets))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_dedup(spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str,
                 key: str = "job_id", watermark: tuple[str, str] | None = None) -> dict:
    """Stateful dedup on ``key`` into a Parquet sink (append mode).  ``watermark`` (event time column, span): an id
    counts as seen until its first row's time plus the span has passed, rows older than the watermark are dropped.
    Returns the last micro-batch's state figures."""
    s = spark.readStream.schema(schema).parquet(source)
    if watermark:
        s = s.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    else:
        s = s.dropDuplicates([key])
    q = (s.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    last = q.lastProgress
    states = last["stateOperators"] if last else []
    return {"rows": sum(x["numRowsTotal"] for x in states), "removed": sum(x["numRowsRemoved"] for x in states)}
