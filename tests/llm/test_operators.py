"""The operators' own interfaces: real outputs, laws and edge cases."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smishlens.llm import (
    chat, decontaminate, html_text, langid, packing, ppm, quality, sharding, simhash, token_files, tokens)
from smishlens.llm.arrow_text import chunks, split_words
from smishlens.llm.ranking import with_rank

TEXTS = st.text(alphabet=st.sampled_from(list("ab cd\t\n\x0b\x0c\r\x1c\x85\xa0éÉ漢.,<|\\>")), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXTS), max_size=6))
def test_words_are_runs_of_other_than_ascii_white_space(texts):
    import re

    counts, words = split_words(pa.array(texts, pa.string()))
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert counts.tolist() == [len(w) for w in want] and words.to_pylist() == [x for w in want for x in w]


def test_chunks_hold_whole_rows():
    texts = pa.array(["a" * n for n in (3, 0, 50, 4, 4)])
    assert [(at, len(part)) for at, part in chunks(texts, 8)] == [(0, 2), (2, 1), (3, 2)]
    assert list(chunks(pa.array([], pa.string()), 8)) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=30), min_size=1, max_size=4))
def test_longest_repeats_match_brute_force(docs):
    got = quality.longest_repeats(np.array([w for d in docs for w in d], np.int64), np.array([len(d) for d in docs]))
    want = []
    for d in docs:
        for i in range(len(d)):
            best = 0
            for j in range(len(d)):
                k = 0
                while i != j and max(i, j) + k < len(d) and d[i + k] == d[j + k]:
                    k += 1
                best = max(best, k)
            want.append(best)
    assert got.tolist() == want


def test_verdict_limits(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rest = " ".join(f"w{i}" for i in range(400))
    rows = [(1, rest), (2, f"{passage} {rest} {passage}"), (3, f"{passage} {passage} {passage}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["repetition"] for r in quality.quality_rules(df).collect()}
    assert [out[k]["kept"] for k in (1, 2, 3)] == [True, True, False]
    assert (out[2]["longest_repeat"], out[2]["n_repeats"], out[2]["n_repeat_words"]) == (20, 2, 40)
    strict = {r["doc_id"]: r["repetition"]["kept"] for r in quality.quality_rules(df, max_longest=19).collect()}
    assert strict == {1: True, 2: False, 3: False}
    assert quality.keep_good(df).columns == ["doc_id", "text"] and quality.keep_good(df).count() == 2


def test_language_rejection_and_calibration(spark):
    random.seed(3)
    words = {"xx": ["zor", "zar", "zim", "zul"], "yy": ["bek", "bok", "bik", "buk"]}
    rows = [(i, " ".join(random.choices(words[la], k=30)), la) for i, la in enumerate(["xx", "yy"] * 60)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), buckets=1 << 10)
    assert model.langs == ["xx", "yy"] and 0 < model.reject_below < 1 and 0 < model.unfamiliar_below <= 1
    test = spark.createDataFrame([("zor zul zar",), ("buk BEK",), ("123 !?",), (None,)], "text string")
    out = [tuple(r["p"]) for r in test.select(langid.predict(F.col("text"), model).alias("p")).collect()]
    assert [o[0] for o in out] == ["xx", "yy", "und", "und"] and [o[2] for o in out] == [False, False, True, True]
    none = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert none.langs == [] and langid.keep_known(test.withColumn("lang", F.lit(None).cast("string"))).count() == 4


@settings(max_examples=20, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=8))
def test_escape_is_reversible_and_hides_control_strings(spark, texts):
    df = spark.createDataFrame([(t + "<|im_end|>\n" + t,) for t in texts], "t string")
    rows = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    assert all("<|" not in r["e"] and r["u"] == r["t"] for r in rows)


def test_every_reply_is_one_example_with_its_context(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"),
            (1, 4, "assistant", "a2"), (1, 5, "user", "u3")]
    out = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")) \
        .orderBy("example").collect()
    assert [(r["example"], r["complete"], r["loss_start"] is None) for r in out] == [(2, False, False), (4, False, False), (5, True, True)]
    assert [r["formatted"][r["loss_start"]:r["loss_end"]] for r in out[:2]] == ["a1", "a2"]
    assert out[1]["formatted"].startswith(out[0]["formatted"])


def test_ppm_probabilities_sum_to_one_and_match_a_plain_model():
    texts = pa.array(["abracadabra", "abra", "", "banana é"])
    order = 3
    keys, counts = ppm.count_grams(texts, order)
    levels = []
    for k in range(order + 1):
        total = Counter()
        for key, n in zip(keys.tolist(), counts.tolist()):
            total[(key >> 9) & ((1 << 9 * k) - 1), key & 511] += n
        levels.append(tuple(np.array(x) for x in zip(*[(c, s, n) for (c, s), n in total.items()])))
    trie = ppm.build(levels, order)
    missing = ppm.SYMBOLS - (trie.logs.shape[1] - 1)
    sums = (10 ** trie.logs[:, :-1].astype(float)).sum(axis=1) + missing * 10 ** trie.logs[:, -1].astype(float)
    assert sums == pytest.approx(np.ones(len(sums)), rel=1e-4)

    tables = [{} for _ in range(order + 1)]
    for k, (contexts, symbols, n) in enumerate(levels):
        for c, s, x in zip(contexts.tolist(), symbols.tolist(), n.tolist()):
            tables[k].setdefault(c, {})[s] = x

    def plain(text):
        data = text.encode()
        total = 0.0
        for i in range(len(data) + 1):
            symbol = data[i] if i < len(data) else ppm.END
            context = [data[i - j] + 1 if i - j >= 0 else 0 for j in range(1, order + 1)]
            p, seen = 1.0, set()
            for k in range(order, -1, -1):
                own = tables[k].get(sum(c << 9 * j for j, c in enumerate(context[:k])), {})
                own = {s: n for s, n in own.items() if s not in seen}
                if not own:
                    continue
                whole = sum(own.values()) + len(own)
                if symbol in own:
                    p *= own[symbol] / whole
                    break
                p *= len(own) / whole
                seen |= set(own)
            else:
                p /= ppm.SYMBOLS - len(seen)
            total += np.log10(p)
        return total

    probes = ["abra", "zebra", "", "banana é", "éé", "cadabrab"]
    assert trie.score(pa.array(probes)).tolist() == pytest.approx([plain(t) for t in probes], rel=1e-4)


def test_ppm_scores_do_not_depend_on_which_contexts_are_broadcast(spark):
    order = 3
    training = ["abracadabra", "abra", "", "banana é", "the cadabra band", "a banana band ran"] * 2
    docs = training + ["zebra", "band é band", "漢", "ran abracad", None]
    keys, counts = ppm.count_grams(pa.array(training), order)
    levels = []
    for k in range(order + 1):
        total = Counter()
        for key, n in zip(keys.tolist(), counts.tolist()):
            total[(key >> 9) & ((1 << 9 * k) - 1), key & 511] += n
        levels.append(tuple(np.array(x) for x in zip(*[(c, s, n) for (c, s), n in total.items()])))
    want = ppm.build(levels, order).score(pa.array(docs, pa.string()))
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    train = spark.createDataFrame([(i, t) for i, t in enumerate(training)], "doc_id long, text string")
    for contexts in (1, 20, 1 << 17):
        out = ppm.score(docs, train, order=order, contexts=contexts).orderBy("doc_id").collect()
        assert [r["score"] for r in out] == pytest.approx(want.tolist(), rel=1e-4)


def test_ppm_without_training(spark):
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    r = ppm.score(docs, docs.limit(0)).first()
    assert r["score"] == pytest.approx(3 * np.log10(1 / 257), rel=1e-5)
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (2, 0, 0, 0.0)


def test_html_keeps_the_whole_article_around_its_best_element():
    prose = "".join(f"<p>Paragraph {i}, with words, commas, and some length to it, {'so that it scores ' * 12}.</p>" for i in range(12))
    for tag, attributes in (("article", ""), ("main", ""), ("div", ' class="post"'), ("div", "")):
        page = (f"<body><nav><a href=x>Home</a></nav><{tag}{attributes}><h1>Title</h1><div class=body>{prose}</div><h2>Notes</h2>"
                f"<ul><li>first</li><li>second</li></ul><p>The end.</p></{tag}><footer>imprint</footer></body>")
        text = html_text.extract(page).split("\n\n")
        assert text[0] == "Title" and text[-4:] == ["Notes", "first", "second", "The end."] and len(text) == 17
        page = (f"<body><{tag}{attributes}><h1>Title</h1><section>{prose}</section><section><h2>Short</h2><p>One sentence here.</p></section>"
                f"<aside>More</aside></{tag}><div class=footer>imprint</div></body>")
        text = html_text.extract(page).split("\n\n")
        assert text[0] == "Title" and text[-2:] == ["Short", "One sentence here."] and len(text) == 15
    page = f"<body><h1>Title</h1><div>{prose}</div><p>imprint</p><div class=sidebar><h2>Links</h2></div></body>"
    assert html_text.extract(page).startswith("Title\n\nParagraph 0") and "imprint" not in html_text.extract(page)


@pytest.mark.parametrize("left_out", [None, "de", "fr"])
def test_a_language_that_was_not_learned_is_rejected(spark, left_out):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter(r"lang is not null and text rlike '\\p{L}'") \
        .select("doc_id", "text", "lang").repartition(8)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.fit(docs.filter(~held & (F.col("lang") != F.lit(left_out or "-"))))
    assert (left_out or "-") not in model.langs and 0.05 < model.temperature < 20
    found = docs.filter(held).select("lang", langid.predict(F.col("text"), model).alias("p"))
    out = {r["foreign"]: r for r in found.groupBy((F.col("lang") == F.lit(left_out or "-")).alias("foreign")).agg(
        F.mean(F.col("p.rejected").cast("int")).alias("rejected"), F.mean((F.col("p.lang_pred") == F.col("lang")).cast("int")).alias("right")).collect()}
    assert out[False]["rejected"] <= 0.01 and out[False]["right"] >= 0.99
    assert left_out is None or out[True]["rejected"] >= 0.9
    kept = langid.keep_known(docs.filter(~held & (F.col("lang") != F.lit(left_out or "-"))))
    assert kept.count() >= 0.99 * docs.filter(~held & (F.col("lang") != F.lit(left_out or "-"))).count()


def test_counts_are_packed_exactly():
    rng = np.random.default_rng(2)
    for size in (0, 1, 1000):
        rows = rng.integers(0, 1 << 18, size)
        index, counts = langid.unpacked_counts(langid.packed_counts(rows))
        assert (index.tolist(), counts.tolist()) == tuple(x.tolist() for x in np.unique(rows, return_counts=True))


def test_language_sample_counts_copies_once(spark):
    rows = [("en", f"english text {i}") for i in range(900)] + [("de", "ein kopierter Text")] * 3000 \
        + [("de", f"deutscher Text {i}") for i in range(40)] + [("no", str(i)) for i in range(500)] + [("no", "norsk tekst")]
    docs = spark.createDataFrame([(t, v) for v, t in rows], "text string, lang string").repartition(5)
    for per_lang, limit, want in ((100, 4000, {"en": 100, "de": 41, "no": 1}), (100, 90, {"en": 30, "de": 30, "no": 1})):
        bags = langid.sample(docs, "text", "lang", per_lang, limit, 1 << 12)
        assert Counter(value for value, _, _ in bags) == want
    again = langid.sample(docs.repartition(3), "text", "lang", 100, 90, 1 << 12)
    assert again == bags


def test_hypergeometric_sampler_beyond_numpy(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 0)
    draws = np.array([sharding.hypergeometric(rng, 300, 700, 50) for _ in range(20_000)])
    p = 0.3
    assert draws.mean() == pytest.approx(50 * p, abs=0.1)
    assert draws.var() == pytest.approx(50 * p * (1 - p) * 950 / 999, rel=0.05)
    monkeypatch.undo()
    assert 100 < sharding.hypergeometric(rng, 10**12, 39 * 10**12, 8192) < 320


def test_matrix_margins():
    m = sharding.communication_matrix([10, 0, 7, 30, 1], 7, 3)
    assert m.sum(axis=1).tolist() == [10, 0, 7, 30, 1]
    assert sorted(m.sum(axis=0).tolist()) == [6, 7, 7, 7, 7, 7, 7]


def test_shards_keep_rows_and_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("shard"), F.lit("x").alias("text"))
    a = sharding.uniform_shards(df, 8, ["id"], block_rows=100)
    b = sharding.uniform_shards(df.repartition(13), 8, ["id"], block_rows=100)
    assert a.columns == ["id", "text", "shard", "slot"]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    other = sharding.uniform_shards(df, 8, ["id"], seed=6, block_rows=100)
    assert sorted(map(tuple, a.collect())) != sorted(map(tuple, other.collect()))


def test_ranks_are_gapless_in_a_hot_group(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") < 5000, 0).otherwise(F.col("id") % 5).alias("g"),
                                    F.xxhash64("id").alias("h"))
    out = with_rank(rows, ["g"], "h", ["id"], 5200).collect()
    by = {}
    for r in out:
        by.setdefault(r["g"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and sum(map(len, by.values())) == 6000


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 300), min_size=1, max_size=12))
def test_patterns_take_the_demand_exactly(demand):
    sizes = np.array(sorted(demand))
    want = np.array([demand[s] for s in sizes])
    solution = packing.solve(sizes, want, 40)
    assert (sum(c * p for c, p in solution) == want).all()
    assert all((p * sizes).sum() <= 40 for _, p in solution)
    bound = -(-int((sizes * want).sum()) // 40)
    assert sum(c for c, _ in solution) <= 2 * bound + 1


def test_sequences_hold_the_pieces(spark):
    docs = spark.createDataFrame([(i, "word " * (37 * i % 211)) for i in range(60)], "doc_id long, text string")
    cut = packing.pieces(docs, tokens.vocabulary_path(), 2, capacity=64)
    plan = packing.pack(cut.drop("ids"), capacity=64, unit=4)
    out = packing.sequences(cut, plan).collect()
    ids = {r["piece"]: bytes(r["ids"]) for r in cut.collect()}
    places = sorted((r["sequence_id"], r["offset"], r["piece"]) for r in plan.collect())
    for r in out:
        assert bytes(r["ids"]) == b"".join(ids[p] for s, _, p in places if s == r["sequence_id"])
        assert r["n_tokens"] == len(r["ids"]) // 4 <= 64


@pytest.mark.parametrize("lengths", [[9], [1], [17], list(range(3, 40)), [9, 300], [33, 70, 130, 300]])
def test_little_padding_for_short_pieces(spark, lengths):
    n = 60_000 // max(sum(lengths) // len(lengths), 1)
    rows = [(i, lengths[i % len(lengths)]) for i in range(n)]
    out = packing.pack(spark.createDataFrame(rows, "piece long, length long")).collect()
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    total = sum(length for _, length in rows)
    assert len(out) == n and len(by) <= -(-total // packing.CAPACITY) * 1.03 + 2


def test_the_unit_follows_the_lengths():
    assert packing.choose_unit(np.array([2000, 9]), np.array([100, 3]), 4096) == 8
    assert packing.choose_unit(np.array([9]), np.array([100]), 4096) == 1
    for unit in (1, 2, 4, 8):
        lengths = np.arange(1, 4097)
        sizes = packing.rounded(lengths, unit, 4096)
        assert (sizes * unit >= lengths).all() and sizes.max() == 4096 // unit and len(np.unique(sizes)) <= 608
    with pytest.warns(UserWarning, match="1 rounds"):
        packing.solve(np.array([3, 5, 7, 11]), np.array([40, 30, 20, 50]), 29, max_rounds=1)


def test_repeats_of_a_long_text_in_bounded_memory():
    import tracemalloc

    n = 1_000_000
    for words in (np.zeros(n, np.int64), np.tile(np.arange(1000), n // 1000), np.arange(n)):
        tracemalloc.start()
        got = quality.longest_repeats(words, np.array([n]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 150 * n  # bytes
        assert got[0] == (n - 1 if not words.any() else n - 1000 if words[1000] == 0 else 0)


def test_random_access_to_sequences(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"alpha beta {i} " * (i % 9)) for i in range(50)], "doc_id long, text string")
    manifest = token_files.write(docs, str(tmp_path / "t"), tokens.vocabulary_path(), 1, length=16, batch=4, part_bytes=1500)
    parts = manifest.orderBy("part").collect()
    assert len(parts) > 1 and sum(r["n_docs"] for r in parts) == 50
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokens.vocabulary_path())
    want = [i for k in range(50) for i in [*tokenizer.encode(f"alpha beta {k} " * (k % 9), add_special_tokens=False).ids, 1]]
    got, ends = [], 0
    for r in parts:
        f = token_files.SequenceFile(f"{r['path']}.seq.arrow")
        assert len(f) == r["n_sequences"]
        for i in range(len(f)):
            ids, mask, last = f[i]
            assert len(ids) == len(mask) == len(last) == 16 and (i == len(f) - 1 or mask.all())
            got += ids[mask].tolist()
            ends += int(last.sum())
        with pytest.raises(IndexError):
            f[len(f)]
    assert got == want and ends == 50
    with pytest.raises(ValueError):
        token_files.SequenceWriter(pa.BufferOutputStream(), 4, 2, 1 << 16).write(np.array([1 << 17]), np.array([0]))


@pytest.mark.parametrize("page,want", [
    ("<body><header>Site</header><main><h1>T</h1><p>Some long text, with commas, that goes on.</p></main></body>",
     "T\n\nSome long text, with commas, that goes on."),
    ("<div id=content><p>First paragraph is long, and it has commas, too.</p><div class='share-box'>Share</div>"
     "<form>Mail <input></form><p>Second&nbsp;one &lt;b&gt;</p></div><div class=comments><p>Nice, one, really, great!</p></div>",
     "First paragraph is long, and it has commas, too.\n\nSecond one <b>"),
    ("<article><p>x<p>y<ul><li><a href=/a>a link</a><li><a href=/b>other</a></ul></article>", "x\n\ny"),
    ("<script>var a='</p>'</script><style>p{}</style><!-- <p>no</p> --><p>only this</p><textarea><p>no</textarea>", "only this"),
    ("<p>open <a href='x>y", "open y"), ("<<p>a < b && c", "<\n\na < b && c"), ("<aside role=x><p>hid</p></aside>", ""),
])
def test_main_text_of_small_pages(page, want):
    assert html_text.extract(page) == want


ARTICLE = "<p>The article is short, but it is the article, and it has commas.</p>"
REMARK = "<p>A remark by a reader, with many, many words, and commas, and so on, and on, and on, which goes on for long.</p>" * 4


@pytest.mark.parametrize("page", [
    "<body><article><h1>T</h1>{a}</article><div id=comments class=comments-area><li class=comment><article class=comment-body>{r}</article></li></div></body>",
    "<body><main><article><h1>T</h1>{a}</article><article class=comment>{r}</article></main></body>",
    "<body><article><h1>T</h1>{a}<div class=comment-text>{r}</div><div class=newsletter-body>{r}</div><div class=cookie-content>{r}</div></article></body>",
    "<body><div class=page-with-comments><article><h1>T</h1>{a}</article><section class=post-comments>{r}</section></div></body>",
    "<body><article class='post tag-ads category-cookies'><h1>T</h1>{a}</article><div class=related><article>{r}</article></div></body>",
    "<body><div class=post><h1>T</h1>{a}</div><div id=comments><article>{r}</article></div></body>",
    "<body><div class=main-nav>{r}</div><article><header class=entry-header><h1>T</h1></header>{a}</article></body>",
    "<body><div id=sidebar-layout><article><h1>T</h1>{a}</article></div><div class=sponsored-story>{r}</div></body>",
])
def test_what_readers_and_advertisers_say_is_not_the_article(page):
    want = "T\n\nThe article is short, but it is the article, and it has commas."
    assert html_text.extract(page.format(a=ARTICLE, r=REMARK)) == want


def test_a_broken_page_takes_time_in_proportion():
    import time

    began = time.process_time()
    text = html_text.extract("<body><article>" + "<font>" * 80_000 + "<h2>x" * 80_000 + "<div class=ad></div>" * 10_000)
    assert time.process_time() - began < 6 and text.count("x") == 80_000


def test_many_broken_tags_stay_cheap():
    assert html_text.extract("<p>" + "<a href=\"x " * 20000 + "</p>tail text") is not None
    assert len(html_text.extract("<div>" * 5000 + "deep text, deep" + "</div>" * 5000)) == 15


def test_spans_are_cut_and_the_rest_is_kept(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, "tiny item")],
                                  "item_id long, text string")
    leak = "ONE two, three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"Before: {leak}! After."), (2, "clean text"), (3, None), (4, "a Tiny ITEM b"),
                                  (5, leak), (5, leak)], "doc_id long, text string").withColumn("window", F.lit(0))
    cut = decontaminate.decontaminate(docs, bench, "spans")
    out = sorted((r["doc_id"], r["text"]) for r in cut.collect())
    assert cut.columns == docs.columns
    assert out == [(1, "Before:  ,        ! After."), (2, "clean text"), (3, None), (4, "a   b"),
                   (5, " ,        "), (5, " ,        ")]
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()) == [2, 3]
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == 6
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, bench, "other")


@pytest.mark.parametrize("most", [1, 3, 10])
def test_a_larger_benchmark_takes_several_passes(spark, monkeypatch, most):
    passage = [f"w{i % 17}" for i in range(40)]
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, " ".join(passage)), (3, "tiny item"), (None, "a b c d e f g h i j"), (4, None)],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c d e f g h i j k y"), (2, "a b"), (3, " ".join(passage[5:30])), (3, " ".join(passage[5:30])), (4, "A Tiny item"),
                                  (5, None), (6, "")], "doc_id long, text string")

    def found():
        out = decontaminate.scan(docs, bench, ["doc_id"]).withColumn("hits", F.array_sort("hits"))
        return sorted(map(str, out.collect()))

    before = found()
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", most)
    assert found() == before and len(before) == 6


@pytest.mark.parametrize("max_bits", [2, 4, 6])
def test_links_connect_what_all_pairs_connect(spark, max_bits):
    rng = random.Random(max_bits)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for center in prints[:3]:  # dense balls, chains and strays
        ball = [center]
        for _ in range(60):
            p = rng.choice(ball)
            for b in rng.sample(range(64), rng.randint(1, max_bits)):
                p ^= 1 << b
            ball.append(p)
        prints += ball
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p, 1 + i % 3) for i, p in enumerate(signed)], "fp long, n long")
    links = {(r["a"], r["b"]) for r in simhash.links(df, max_bits).collect()}
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= max_bits for a, b in links)
    root = {p: p for p in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[i + 1:]:
            if ((a ^ b) & mask).bit_count() <= max_bits:
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = {p: find(p) for p in signed}
    label = {r["node"]: r["label"] for r in simhash.components(simhash.links(df, max_bits)).collect()}
    assert {p: label.get(p, p) for p in signed} == want


def test_one_row_of_a_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(7, text, "b"), (3, text, "z"), (3, text, "a"), (3, text, "a"), (9, "another text of its own kind", None), (None, None, "n")]
    out = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, fp string"))
    kept = out.collect()
    assert out.columns == ["doc_id", "text", "fp"] and len(kept) == 3
    assert sorted(str(r["doc_id"]) for r in kept) == ["3", "9", "None"]
