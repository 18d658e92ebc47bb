"""Text cleaning: goldens, edge cases, and the fused pass against a plain
Python version of the same rules."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smishlens.functions import text as T
from smishlens.operators.preprocess import clean_text, drop_blank, preprocess

THREATS = [("http://phish.link", "MALWARE"), ("http://ok.example", "UNWANTED_SOFTWARE")]

# (input, expected) from FIXTURES.md section 3
GOLDEN = [
    ("Estimado cliente, su pedido no llegó. Consulte aquí: http://mistracking.es/123",
     "estimado cliente  su pedido no llego  consulte aqui   url_trusted"),
    ("Hola, ¿qué tal? Este es un mensaje de prueba sin spam.",
     "hola   que tal  este es un mensaje de prueba sin spam"),
    ("Dear customer, your package couldn't be delivered. Click http://phish.link",
     "dear customer  your package couldn t be delivered  click  url_suspicious"),
    ("Hey, just checking in with you!", "hey  just checking in with you"),
    ("Has ganado un premio, reclama aquí https://bit/ly.com", "has ganado un premio  reclama aqui  url_trusted"),
    ("llama 600123456789, ya", "llama  phone_num   ya"),
]


def _clean(spark, texts):
    df = spark.createDataFrame([(i, t, "ham") for i, t in enumerate(texts)], "msg_id long, message string, label string")
    threats = spark.createDataFrame(THREATS, "url string, threat_type string")
    out = clean_text(df, threats).orderBy("msg_id").collect()
    return [r["message"] for r in out]


def test_goldens(spark):
    got = _clean(spark, [g[0] for g in GOLDEN])
    assert got == [g[1] for g in GOLDEN]


def test_edge_cases(spark):
    got = _clean(spark, ["HTTP://x.com", "see http://a.b/c, now", "_1234567890 and 123456789",
                         "\tpadded\n", "go http://phish.link now", "win\U0001F389now ¿ok?"])
    assert got[0] == "http   x com"
    assert got[1] == "see  url_trusted  now"          # the comma belongs to the URL
    assert got[2] == "_1234567890 and 123456789"       # no word boundary / only 9 digits
    assert got[3] == "padded"
    assert got[4] == "go  url_suspicious  now"        # NBSP ends the URL
    assert got[5] == "winnow  ok"


def test_url_extraction(spark):
    df = spark.createDataFrame([("a http://x.y/z, b www.q.r end http://k",)], "t string")
    assert df.select(T.extract_urls(F.col("t"))).first()[0] == ["http://x.y/z,", "www.q.r", "http://k"]


def test_blank_messages_dropped(spark):
    df = spark.createDataFrame([(1, "!!! ???", "spam"), (2, "ok", "ham")], "msg_id long, message string, label string")
    out = preprocess(df, None).collect()
    assert [(r["msg_id"], r["message"], r["label"]) for r in out] == [(2, "ok", 0)]


def test_drop_blank_keeps_columns(spark):
    df = spark.createDataFrame([(1, " ", 0), (2, "x", 1)], "msg_id long, message string, label int")
    assert drop_blank(df).columns == ["msg_id", "message", "label"]
    assert drop_blank(df).count() == 1


FOLDED = [
    ("don´t", "don't"), ("ＡＢ１", "AB1"), ("Москва щука", "Moskva shchuka"), ("раураl", "raural"), ("Ψυχή ΑΘΗΝΑ", "Psukhe AThENA"),
    ("a•b™ ¨x¨ ¬", 'a*bTM "x" !'), ("…–—„ok”", '...---,,ok"'), ("漢字 ok", "xx ok"), ("½ ② x²", " 1/2 x x2"), ("ﬀ ĳ", "x ij"),
]


@pytest.mark.parametrize("text,want", FOLDED)
def test_fold_goldens(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(T.fold_accents(F.col("t"))).first()[0] == want


def test_no_script_vanishes(spark):
    """A message wholly in another script is not blank after cleaning."""
    texts = ["ПРИВЕТ", "γειά", "שלום", "مرحبا", "こんにちは", "안녕", "ＷＩＮ"]
    df = spark.createDataFrame([(i, t, "ham") for i, t in enumerate(texts)], "msg_id long, message string, label string")
    assert preprocess(df, None).count() == len(texts)


# A plain Python statement of C3-C6 with the same fold table (brute force).
_TABLE = T.default_fold_table()


def py_clean(s: str) -> str:
    wide = any(ord(ch) > 0x017F for ch in s)
    s = "".join(_TABLE.get(ch, T.FOLD_UNKNOWN if wide and ord(ch) > 127 and unicodedata.category(ch)[0] in "LN" else ch) for ch in s)
    s = "".join(ch for ch in s if ord(ch) < 128)
    s = re.sub(r"\b\d{10,}\b", " PHONE_NUM ", s)
    s = re.sub(r"[^A-Za-z0-9_\t\n\x0b\x0c\r\x1c-\x1f ]", " ", s)
    return s.lower().strip("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ")


ALPHABET = st.sampled_from(list("aZ09_ .,!?¿¡-'\"\t\néñüßæœ½²€—…😀´¨жΩ漢Ａ•") + ["1234567890", "98765432101", " "])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), min_size=1, max_size=8))
def test_fused_clean_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(T.clean_after_urls(F.col("t")).alias("a"),
                     T.lower_strip(T.strip_punct(T.mask_numbers(T.fold_accents(F.col("t"))))).alias("b")).collect()
    for t, r in zip(texts, rows):
        assert r["a"] == r["b"] == py_clean(t), t


def test_clean_is_idempotent(spark):
    texts = [g[0] for g in GOLDEN]
    once = _clean(spark, texts)
    assert _clean(spark, once) == once


@pytest.mark.parametrize("text,tokens", [("hola   que  tal a", ["hola", "que", "tal", "a"]), ("", [])])
def test_whitespace_tokens(spark, text, tokens):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(T.whitespace_tokens(F.col("t"))).first()[0] == tokens
