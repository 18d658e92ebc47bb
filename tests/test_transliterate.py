"""Hangul and kana by rule: goldens, and every syllable against its Unicode name."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from smishlens.functions import text as T
from smishlens.functions.transliterate import hangul, kana


@pytest.mark.parametrize("text,want", [
    ("안녕하세요", "annyeonghaseyo"), ("한국 123 abc", "hangug 123 abc"), ("값", "gabs"), ("", ""), ("plain", "plain"), ("漢가", "漢ga"),
    ("きょうは", "kyouha"), ("トウキョウ", "toukyou"), ("がっこう", "gakkou"), ("マッチャ", "matcha"), ("しゃしん", "shashin"), ("ジュース", "jusu"),
    ("コーヒー", "kohi"), ("あっ", "a"), ("ゃ", "ya"), ("いや", "iya"), ("ちょっと", "chotto"), ("ヴ", "vu"), ("ー", "ー"), ("さくらx", "sakurax"), ("キ", "ki"), ("きゃきや", "kyakiya"),
])
def test_goldens(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(kana(hangul(F.col("t"))).alias("x")).first()
    assert row["x"] == want


def test_every_hangul_syllable(spark):
    chars = [chr(cp) for cp in range(0xAC00, 0xD7A4)]
    rows = spark.createDataFrame([(c,) for c in chars], "c string").select("c", hangul(F.col("c")).alias("x")).collect()
    for r in rows:
        name = unicodedata.name(r["c"]).removeprefix("HANGUL SYLLABLE ").lower()
        assert r["x"] == name
    assert len(rows) == 11172


def test_every_kana(spark):
    chars = [chr(cp) for cp in [*range(0x3041, 0x3095), *range(0x30A1, 0x30F5)]]
    rows = spark.createDataFrame([(c,) for c in chars], "c string").select("c", kana(F.col("c")).alias("x")).collect()
    plain = {"si": "shi", "zi": "ji", "ti": "chi", "di": "ji", "tu": "tsu", "du": "zu", "hu": "fu"}
    for r in rows:
        name = re.sub("^(HIRAGANA|KATAKANA) LETTER ", "", unicodedata.name(r["c"])).lower()
        if name == "small tu":
            assert r["x"] == ""
        else:
            name = name.removeprefix("small ")
            assert r["x"] == plain.get(name, name)


def test_cleaned_texts_keep_their_words(spark):
    df = spark.createDataFrame([("무료 선물! 지금",), ("プレゼント、無料",), ("नमस्ते",)], "t string")
    out = [r[0] for r in df.select(T.clean_after_urls(F.col("t"))).collect()]
    assert out[0] == "muryo seonmul  jigeum" and out[1].startswith("purezento") and "purezento" in out[1] and "xx" in out[1] and "x" in out[2]
    folded = df.select(T.fold_accents(F.col("t")).alias("x")).first()["x"]
    assert folded == "muryo seonmul! jigeum"
