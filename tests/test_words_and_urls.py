"""Lemma rules and URL reputation by expressions against plain Python and published examples."""

import pytest
from pyspark.sql import functions as F

from smishlens.operators.lemmas import NOUN_ENDINGS, lemma_table
from smishlens.operators.reputation import expressions, listed_urls, with_parts
from smishlens.operators.urls import tokenise_urls


def plain_lemma(word, lexicon, exceptions):
    def rules(forms):
        return [f[:-len(old)] + new for f in forms for old, new in NOUN_ENDINGS if f.endswith(old)]

    if word in exceptions:
        found = [f for f in [word, *sorted(exceptions[word])] if f in lexicon]
        return min(found, key=len) if found else None
    forms = rules([word])
    found = [f for f in [word, *forms] if f in lexicon]
    while not found and forms:
        forms = rules(forms)
        found = [f for f in forms if f in lexicon]
    return min(found, key=len) if found else None


def test_lemmas_by_rules(spark):
    words = ["dogs", "buses", "wolves", "boxes", "quizzes", "churches", "wishes", "firemen", "ponies", "glasses", "bus", "geese", "mice",
             "oxen", "lens", "nosuchwords", "messes", "asses", "s", "es", "men", "axes", "classses", "knives", "", None, "dogs", "oases", "yes"]
    lexicon = ["dog", "bus", "wolf", "box", "quiz", "quizz", "church", "wish", "fireman", "pony", "glass", "goose", "mouse", "ox", "lens", "mess", "ass",
               "as", "man", "axis", "ax", "axe", "clas", "knife", "knive", None, "oxe", "o", "ye", "dog"]
    exceptions = {"geese": {"goose"}, "mice": {"mouse", "ox"}, "oxen": {"ox"}, "axes": {"axis", "axe"}, "knives": {"unknown"}}
    out = lemma_table(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(w,) for w in lexicon], "word string"),
                      spark.createDataFrame([(w, f) for w, forms in exceptions.items() for f in forms], "word string, lemma string"))
    want = {w: plain_lemma(w, set(lexicon) - {None}, exceptions) for w in set(words) - {None}}
    assert {r["word"]: r["lemma"] for r in out.collect()} == {w: f for w, f in want.items() if f is not None} and out.count() == len(
        {w for w, f in want.items() if f is not None})
    assert want["oxen"] == "ox" and want["nosuchwords"] is None and want["wolves"] == "wolf" and want["classses"] is not None
    assert lemma_table(spark.createDataFrame([], "word string"), spark.createDataFrame([("a",)], "word string")).count() == 0


# published canonical forms
CANONICAL = [
    ("http://host/%25%32%35", "host/%25"), ("http://host/%2525252525252525", "host/%25"), ("http://host/%%%25%32%35asd%%", "host/%25%25%25asd%25%25"),
    ("http://%31%36%38%2e%31%38%38%2e%39%39%2e%32%36/%2E%73%65%63%75%72%65/%77%77%77%2E%65%62%61%79%2E%63%6F%6D/", "168.188.99.26/.secure/www.ebay.com/"),
    ("http://host%23.com/%257Ea%2521b%2540c%2523d%2524e%25f%255E00%252611%252A22%252833%252944_55%252B", "host%23.com/~a!b@c%23d$e%25f^00&11*22(33)44_55+"),
    ("http://3279880203/blah", "195.127.0.11/blah"), ("http://www.google.com/blah/..", "www.google.com/"), ("www.google.com", "www.google.com/"),
    ("http://www.GOOgle.com/", "www.google.com/"), ("http://www.google.com.../", "www.google.com/"), ("http://www.google.com/q?r?s", "www.google.com/q?r?s"),
    ("http://www.google.com/foo\tbar\rbaz\n2", "www.google.com/foobarbaz2"), ("http://evil.com/foo#bar#baz", "evil.com/foo"), ("http://www.gotaport.com:1234/", "www.gotaport.com/"),
    ("  http://www.google.com/  ", "www.google.com/"), ("http://\x01\x80.com/", "%01%C2%80.com/"), ("%20leadingspace.com/", "%20leadingspace.com/"),
    ("http://host.com//twoslashes?more//slashes", "host.com/twoslashes?more//slashes"), ("http://0x12.0x43.44.1:80/x/./y/", "18.67.44.1/x/y/"),
    ("http://u:p@h.com/?", "h.com/?"), ("http://1.2.65535/", "1.2.255.255/"), ("http://999.1.1.1/", "999.1.1.1/"), ("", "/"),
]


def test_canonical_forms(spark):
    df = spark.createDataFrame(CANONICAL, "url string, want string")
    out = with_parts(df).select("url", "want", F.concat("_host", "_path", F.coalesce(F.concat(F.lit("?"), "_query"), F.lit(""))).alias("got")).collect()
    assert [(r["url"], r["got"]) for r in out] == CANONICAL


@pytest.mark.parametrize("url,want", [
    ("http://a.b.c/1/2.html?param=1", "a.b.c/1/2.html?param=1 a.b.c/1/2.html a.b.c/ a.b.c/1/ b.c/1/2.html?param=1 b.c/1/2.html b.c/ b.c/1/"),
    ("http://a.b.c.d.e.f.g/1.html", "a.b.c.d.e.f.g/1.html a.b.c.d.e.f.g/ c.d.e.f.g/1.html c.d.e.f.g/ d.e.f.g/1.html d.e.f.g/ e.f.g/1.html e.f.g/ f.g/1.html f.g/"),
    ("http://1.2.3.4/1/", "1.2.3.4/1/ 1.2.3.4/"), ("http://ex.com/a/b/c/d/e", "ex.com/a/b/c/d/e ex.com/ ex.com/a/ ex.com/a/b/ ex.com/a/b/c/"),
])
def test_expressions(spark, url, want):
    row = with_parts(spark.createDataFrame([(url,)], "url string")).select(expressions(F.col("_host"), F.col("_path"), F.col("_query")).alias("e")).first()
    assert sorted(row["e"]) == sorted(want.split())


def test_listed_hosts_and_folders(spark):
    urls = spark.createDataFrame([("HTTP://User@Shop.Bad.example:80/x?y#z",), ("http://fine.example/ok",), ("http://fine.example/%62ad/page",),
                                  ("http://notbad.example/",), (None,), ("http://fine.example/ok",)], "url string")
    listed = spark.createDataFrame([("bad.example/", "MALWARE"), ("fine.example/bad/", "SOCIAL_ENGINEERING"), ("bad.example/", "MALWARE"),
                                    ("fine.example/ok", "UNWANTED_SOFTWARE"), (None, "MALWARE")], "expression string, threat_type string")
    got = sorted(map(tuple, listed_urls(urls, listed).collect()))
    assert got == [("HTTP://User@Shop.Bad.example:80/x?y#z", "MALWARE"), ("http://fine.example/%62ad/page", "SOCIAL_ENGINEERING"),
                   ("http://fine.example/ok", "UNWANTED_SOFTWARE")]
    text = spark.createDataFrame([(1, "see http://shop.bad.example/a and http://fine.example/ok"), (2, "no link")], "msg_id long, message string")
    out = {r["msg_id"]: r["message"] for r in tokenise_urls(text, listed).collect()}
    assert out == {1: "see  URL_SUSPICIOUS  and  URL_TRUSTED ", 2: "no link"}
