"""Streaming state that stays bounded, and labels that are upserted bucket by bucket."""

import glob
import json
import os

from pyspark.sql import functions as F

from smishlens.operators.naive_bayes import fit_naive_bayes
from smishlens.operators.tfidf import fit_tfidf
from smishlens.streaming import feeds as ST


def test_each_id_once_with_bounded_state(spark, tmp_path):
    """Many batches; repeats in a batch, in the next one, and long after the watermark has passed."""
    train = spark.createDataFrame([(1, "alpha beta", 0), (2, "gamma delta", 1)], "msg_id long, message string, label int")
    model = fit_naive_bayes(fit_tfidf(train), train)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "msg_id long, message string, label string"
    want = {}
    for k in range(6):
        ids = [*range(10 * k, 10 * k + 10), 10 * k, 0, 3, max(0, 10 * k - 7)]
        for i in ids:
            want.setdefault(i, "spam" if i % 2 else "ham")
        rows = [(i, "alpha" if i % 2 else "gamma", "spam" if i % 2 else "ham") for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        # a run per file; the state keeps nothing that is older than a millisecond
        stream = ST.read_file_stream(spark, source, spark.read.parquet(source).schema)
        got = ST.score_stream(spark, stream, None, model, path=out, delay="1 millisecond", buckets=4)
    seen = [(r["msg_id"], r["label"]) for r in got.collect()]
    assert sorted(i for i, _ in seen) == sorted(want) and len(seen) == len({i for i, _ in seen})
    assert got.filter(F.col("verdict").isNull()).count() == 0
    rows_in_state = [p for p in glob.glob(f"{out}/_state/state/0/*/*.delta")]
    assert rows_in_state  # there is state
    known = spark.read.parquet(f"{out}/ids").groupBy("bucket").count().count()
    assert known <= 4
    last = sorted(glob.glob(f"{out}/_state/offsets/[0-9]*"), key=lambda p: int(os.path.basename(p)))[-1]
    meta = json.loads(open(last).read().splitlines()[1])
    assert meta["batchWatermarkMs"] > 0  # the watermark moves, so older ids leave the state


def test_the_state_forgets_old_ids(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    totals = []
    for k in range(4):
        spark.range(100 * k, 100 * k + 100).select(F.col("id").alias("msg_id")).coalesce(1).write.mode("append").parquet(source)
        stream = ST.read_file_stream(spark, source, spark.read.parquet(source).schema)
        kept = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", "1 millisecond").dropDuplicatesWithinWatermark(["msg_id"])
        query = kept.writeStream.option("checkpointLocation", f"{out}/state").trigger(availableNow=True) \
            .foreachBatch(lambda batch, epoch: batch.write.mode("append").parquet(f"{out}/data")).start()
        query.awaitTermination()
        totals.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]))
    assert spark.read.parquet(f"{out}/data").count() == 400 and max(totals) <= 200


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/bucket=*/part-*")}


def test_only_changed_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "labels")

    def update(rows):
        return ST.upsert_labels(spark, path, spark.createDataFrame(rows, "msg_id long, label int, ts timestamp, event_id long"), buckets=8)

    from datetime import datetime
    day = [datetime(2024, 1, k) for k in range(1, 9)]
    assert update([]).count() == 0
    update([(i, 0, day[0], i) for i in range(40)] + [(None, 1, day[0], 99)])
    before = files(path)
    assert len({os.path.dirname(f) for f in before}) == 8
    out = update([(7, 1, day[2], 50), (7, 0, day[1], 60), (7, 1, day[2], 49)])
    after = files(path)
    changed = {os.path.dirname(f) for f in set(before) ^ set(after)}
    assert len(changed) == 1 and {r["msg_id"]: r["label"] for r in out.collect()} == {i: int(i == 7) for i in range(40)}
    # again, older, and equal: nothing is written
    update([(7, 1, day[2], 50)])
    update([(7, 0, day[1], 10), (8, 1, None, 0)])
    assert files(path) == after
    out = update([(100, 1, day[3], 1), (100, 0, day[3], 2), (7, None, day[4], 3)])
    got = {r["msg_id"]: r["label"] for r in out.collect()}
    assert got[100] == 0 and got[7] is None and len(got) == 41
