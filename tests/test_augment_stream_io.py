import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF0001
from smishlens.operators import augment as G
from smishlens.sources import messages as SRC
from smishlens.sources import testdata as D
from smishlens.streaming import feeds as ST

TR = [("es", "en", "hola", "hello"), ("en", "es", "hello", "hola!"), ("en", "es", "hi", "hola"),
      ("en", "es", "hey", "hola")]


def _frames(spark):
    tr = spark.createDataFrame(TR, "src_lang string, tgt_lang string, text_in string, text_out string")
    es = spark.createDataFrame([(1, "hola", "ham"), (2, "nada", "spam")], "msg_id long, message string, label string")
    en = spark.createDataFrame([(3, "hi", "ham"), (4, "hey", "ham"), (5, "hi", "ham")],
                               "msg_id long, message string, label string")
    return tr, es, en


def test_back_translation_copies_and_failures(spark):
    tr, es, _ = _frames(spark)
    assert sorted(r["message"] for r in G.back_translate(es, tr, 3).collect()) == ["hola!"] * 3
    assert G.back_translate(es, tr, 0).count() == 0


def test_translate_distinct_per_row_only(spark):
    tr, _, en = _frames(spark)
    out = G.translate_distinct(en, tr, 2).collect()
    assert sorted((r["msg_id"], r["message"]) for r in out) == [(3, "hola"), (4, "hola"), (5, "hola")]


def test_augment_union_and_counts(spark):
    tr, es, en = _frames(spark)
    parts = G.augment(es, en, tr, 1, 1)
    rows = parts["union"].collect()
    assert sum(1 for r in rows if r["aug_type"] == "original_es") == 2
    assert sum(1 for r in rows if r["aug_type"] is None) == 4
    counts = {r["kind"]: r["n"] for r in G.augment_counts(parts).collect()}
    assert counts == {"originals": 2, "bt": 1, "en2es": 3}


def test_stream_equals_batch(spark):
    blocked = D.blocked_senders(spark, SF001)
    stream = ST.drop_blocked(D.events_stream(spark, SF001), blocked).select("event_id")
    got = sorted(r[0] for r in ST.run_to_table(stream, spark, "t").collect())
    batch = ST.drop_blocked(D.table(spark, SF001, "events"), blocked).select("event_id")
    assert got == sorted(r[0] for r in batch.collect())


def test_csv_null_markers_and_multiline(spark):
    d = tempfile.mkdtemp(prefix="smishlens-csv-")
    path = os.path.join(d, "m.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('label,message\nspam,"line one\nline ""two"""\nham,NA\n,hello\nham,ok\n')
    df = SRC.read_messages(spark, path).collect()
    assert sorted(r["message"] for r in df) == ['line one\nline "two"', "ok"]
    assert len({r["msg_id"] for r in df}) == 2
    with pytest.raises(ValueError):
        SRC.require_columns(SRC.read_csv_plain(spark, path), "message", "text")


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["msg_id", "label", "p", "prediction"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
