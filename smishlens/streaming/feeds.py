"""Streaming analysis history, block list and feedback (inventory L1-L3).

The reference's README describes these (history of analyses, blocked numbers,
user feedback) without code or field lists; the contracts below are ours.

* L1 ``score_stream``: incoming messages with their text -> each id scored
  once, the first time it arrives -> per micro-batch (``foreachBatch``): text cleaning with the URL
  join, naive Bayes scoring, verdict -> the history table. Repeats within the
  watermark on the time of arrival are dropped by streaming state, which holds no older ids; older repeats by an
  anti join with the history's ids, of which only the batch's buckets are read. With many
  ids per watermark, set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
* L2 ``drop_blocked``: stream-static left-anti join with the block list.
* L3 ``merge_feedback``: the latest user label per message (``max_by`` on
  event time, then event id) replaces the training label; ``upsert_labels`` keeps such labels in a
  table of id buckets and rewrites only the buckets that a batch changes.

Streams read files with ``availableNow`` so a run processes what is there and
stops. The caller names the folder of state and output: a run on the same
folder resumes where the last one ended. Every micro-batch writes its own
``epoch=<id>`` folder with overwrite, so a repeated batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from smishlens.functions.scores import verdict
from smishlens.operators.naive_bayes import NaiveBayesModel
from smishlens.operators.preprocess import preprocess
from smishlens.operators.tfidf import ENTRIES, with_entries
from smishlens.session import drop_table, path_exists, scratch_folder, shared_table


def read_file_stream(spark: SparkSession, folder: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """A parquet file stream over ``folder`` (or a file pattern), ``max_files`` per micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def with_event_time(stream: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Parquet ``TIMESTAMP_NTZ`` cannot carry a watermark: cast to TIMESTAMP (UTC session)."""
    return stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def drop_blocked(stream: DataFrame, blocked: DataFrame, sender_col: str = "user_id") -> DataFrame:
    """L2: messages from listed senders are dropped (stream-static anti join)."""
    listed = blocked.select(F.col("sender").alias(sender_col)).distinct()
    return stream.join(listed, sender_col, "left_anti")


def merge_feedback(train: DataFrame, feedback: DataFrame, id_col: str = "msg_id") -> DataFrame:
    """L3: ``(id, label, source)`` with the latest feedback label where one exists."""
    latest = feedback.groupBy(id_col).agg(
        F.max_by("label", F.struct("ts", "event_id")).alias("_fb"))
    joined = train.join(latest, id_col, "left")
    return joined.select(id_col, F.coalesce("_fb", "label").alias("label"),
                         F.when(F.col("_fb").isNotNull(), "feedback").otherwise("original").alias("source"))


def run_to_table(stream: DataFrame, spark: SparkSession, name: str, batch_fn=None,
                 path: str | None = None, epoch_fn=None) -> DataFrame:
    """Run a stream with ``availableNow`` into the parquet table ``{path}/data``,
    state in ``{path}/_state``, and return the table as a batch DataFrame.
    Without ``path`` a new folder in the shared checkpoint folder is used. A batch is written as ``batch_fn(batch)`` or
    ``epoch_fn(batch, number)`` returns it."""
    out = path or scratch_folder(spark, name)
    writer = stream.writeStream.option("checkpointLocation", out + "/_state").trigger(availableNow=True)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        result = epoch_fn(batch, epoch_id) if epoch_fn else batch_fn(batch) if batch_fn else batch
        result.write.mode("overwrite").parquet(f"{out}/data/epoch={epoch_id}")

    writer.foreachBatch(sink).start().awaitTermination()
    return spark.read.parquet(out + "/data").drop("epoch")


def id_bucket(id_col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def score_stream(spark: SparkSession, messages: DataFrame, threats: DataFrame | None, model: NaiveBayesModel,
                 cuts: tuple[float, float] = (0.3, 0.7), path: str | None = None, delay: str = "10 minutes",
                 buckets: int = 16) -> DataFrame:
    """L1: score each message of the stream ``(msg_id, message, label)`` once by
    id, whatever the files and batches it arrives in; returns the written history.

    The history's ids lie in ``{path}/ids``, by batch and bucket of the id."""
    out = path or scratch_folder(spark, "history")
    # no message is late by the time of its arrival, so the watermark drops ids from the state and never a message
    arrived = messages.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    first = arrived.dropDuplicatesWithinWatermark(["msg_id"]).drop("_arrived")
    written: list[DataFrame] = []

    def unseen(batch: DataFrame, epoch_id: int) -> DataFrame:
        if not path_exists(spark, f"{out}/ids"):
            return batch
        own = [r[0] for r in batch.select(id_bucket("msg_id", buckets)).distinct().collect()]  # ``buckets`` at most
        known = spark.read.schema("msg_id long, epoch long, bucket int").parquet(f"{out}/ids") \
            .filter((F.col("epoch") < epoch_id) & F.col("bucket").isin(own)).select(F.col("msg_id").alias("_known"))
        return batch.join(known, F.col("msg_id").eqNullSafe(F.col("_known")), "left_anti")

    def score(batch: DataFrame, epoch_id: int) -> DataFrame:
        while written:  # of the batch before, which is done
            drop_table(written.pop())
        rows = shared_table(unseen(batch.select("msg_id", "message", "label"), epoch_id), "stream_batch")
        written.append(rows)
        rows.select("msg_id", id_bucket("msg_id", buckets).alias("bucket")).write.mode("overwrite") \
            .partitionBy("bucket").parquet(f"{out}/ids/epoch={epoch_id}")
        written.append(with_entries(preprocess(rows, threats).drop(ENTRIES)))
        scored = model.predict(written[-1], keep=["label"])
        return scored.withColumn("verdict", verdict(F.col("p"), *cuts))

    return run_to_table(first, spark, "history", path=out, epoch_fn=score)


def upsert_labels(spark: SparkSession, path: str, updates: DataFrame, id_col: str = "msg_id", buckets: int = 64) -> DataFrame:
    """L3 as a table ``(id, label, ts, event_id, bucket)`` at ``path``, in buckets of the id: of each id the label with the
    latest ``(ts, event_id)`` stays. Only buckets in which ``updates`` (id, label, ts, event_id) bring
    something newer are written again, so a repeated batch changes nothing. Rows without an id are left out.

    The buckets are replaced when the batch is complete (staged in the shared folder first); a run that ends in
    between leaves some new and some old, and the same batch mends it."""
    newest = F.struct("ts", "event_id")
    rows = updates.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max_by(F.struct("label", "ts", "event_id"), newest).alias("_u")) \
        .select(id_col, "_u.*").withColumn("bucket", id_bucket(id_col, buckets))
    rows = shared_table(rows, "label_updates")
    schema = rows.schema
    there = path_exists(spark, path)
    current = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
    old = current.select(F.col(id_col).alias("_id"), F.struct("ts", "event_id").alias("_old"))
    changed = rows.join(old, rows[id_col] == old["_id"], "left").filter(F.col("_old").isNull() | (newest > F.col("_old"))).drop("_id", "_old")
    changed = shared_table(changed, "label_changes")
    touched = [r[0] for r in changed.select("bucket").distinct().collect()]  # ``buckets`` at most
    if touched:
        kept = current.filter(F.col("bucket").isin(touched)).join(changed.select(id_col), id_col, "left_anti")
        staged = shared_table(kept.unionByName(changed), "label_buckets")
        staged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    elif not there:
        rows.write.partitionBy("bucket").parquet(path)
    return spark.read.schema(schema).parquet(path)
