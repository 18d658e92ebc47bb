"""Every query on tables with odd rows, against brute force in plain Python, and on empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from llm_tables import empty_dir, odd_dir, odd_docs  # noqa: F401
from smishlens.llm import catalog
from smishlens.llm.tokens import vocabulary_path

WHITE = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def remainder(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def held_out(doc_id, n):
    return remainder(doc_id, n) == 2


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    out = catalog.QUERIES[name](spark, empty_dir)
    assert out.count() == (1 if name.startswith("op2") else 0)  # conversation -1


def test_op1(spark, odd_dir, odd_docs):
    out = catalog.op1_language_id(spark, odd_dir).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(d for d, _, _ in odd_docs)
    langs = {la for d, _, la in odd_docs if la and not held_out(d, 4)}
    by_id = {r["doc_id"]: r for r in out}
    for doc_id, text, lang in odd_docs:
        r = by_id[doc_id]
        letter = any(c.isalpha() for c in text or "")
        assert r["held_out"] == held_out(doc_id, 4)
        assert (r["lang_pred"] in langs) if letter else (r["lang_pred"] == "und" and r["score"] == 0 and r["rejected"])
        assert 0 <= r["score"] <= 1
    plain = [(by_id[d], la) for d, t, la in odd_docs if d is not None and 0 <= d < 900000 and held_out(d, 4)]
    assert sum(r["lang_pred"] == la for r, la in plain) >= 0.95 * len(plain)


def test_op2(spark, odd_dir):
    talks = defaultdict(list)
    for r in spark.read.parquet(f"{odd_dir}/conversations.parquet").collect():
        talks[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    talks[-1] = [(True, k, role, "<|im_end|><|im_start|>assistant ok") for k, role in enumerate(("user", "assistant"))]
    want = {}
    for conv, turns in talks.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        want[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    out = catalog.op2_chat_formatting(spark, odd_dir).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in out} == want and len(out) == len(want)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in out)


def test_op3(spark, odd_dir, odd_docs):
    words = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for i, (_, t, _) in enumerate(odd_docs)}
    train = [i for i, (d, _, _) in enumerate(odd_docs) if not held_out(d, 7)]
    counts = Counter(w for i in train for w in words[i])
    n, whole = sum(counts.values()) + len(train), sum(counts.values()) + len(train) + len(counts) + 2
    want = sorted((str(d), held_out(d, 7), len(words[i]) + 1, sum(counts[w] > 0 for w in words[i]) + 1, n)
                  for i, (d, _, _) in enumerate(odd_docs))
    out = catalog.op3_lm_scoring(spark, odd_dir).collect()
    assert sorted((str(r["doc_id"]), *tuple(r)[1:5]) for r in out) == want
    base = {str(d): sum(math.log10((counts[w] + 1) / whole) for w in words[i]) + math.log10((len(train) + 1) / whole)
            for i, (d, _, _) in enumerate(odd_docs)}
    for r in out:
        assert r["base_score"] == pytest.approx(base[str(r["doc_id"])], rel=1e-9)
        assert r["score"] < 0


def test_op4(spark, odd_dir, odd_docs):
    out = catalog.op4_sharding(spark, odd_dir).collect()
    want = sorted((str(d), len((t or "").encode()) + 16, None if t is None else zlib.crc32(t.encode())) for d, t, _ in odd_docs)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == sorted(want, key=lambda x: x)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(40)]
    assert max(sizes) - min(sizes) <= 1


def encoded(docs, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    return [[*e.ids, end] for e in tokenizer.encode_batch([t or "" for _, t, _ in docs], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op5(spark, odd_dir, odd_docs):
    out = catalog.op5_packing(spark, odd_dir).collect()
    want = Counter()
    for (d, _, _), ids in zip(odd_docs, encoded(odd_docs, 2)):
        for at in range(0, len(ids), 4096):
            part = ids[at:at + 4096]
            want[(d, at, len(part), crc(part), len(ids))] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out) == want
    packed = defaultdict(list)
    for r in out:
        packed[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in packed.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    tokens = sum(r["length"] for r in out)
    assert len(packed) <= math.ceil(tokens / 4096) * 1.05 + 1


def test_op6(spark, odd_dir, odd_docs):
    out = sorted(catalog.op6_token_files(spark, odd_dir).collect(), key=lambda r: r["start"])
    ids = defaultdict(list)
    for (d, _, _), e in zip(odd_docs, encoded(odd_docs, 1)):
        ids[d].append((len(e), crc(e)))
    assert [r["doc_id"] for r in out] == sorted((d for d, _, _ in odd_docs), key=lambda d: (d is not None, d or 0))
    start, got = 0, defaultdict(list)
    for r in out:
        assert r["start"] == start
        start += r["n_tokens"]
        got[r["doc_id"]].append((r["n_tokens"], r["ids_crc32"]))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in ids.items()}


def test_op7(spark, odd_dir):
    out = catalog.op7_html_extraction(spark, odd_dir).collect()
    assert len(out) == spark.read.parquet(f"{odd_dir}/pages.parquet").count()
    by_id = {r["page_id"]: r for r in out}
    assert (by_id[9001]["text"], by_id[9002]["text"], by_id[9001]["n_chars"]) == ("", "", 0)
    assert by_id[9003]["text"] == "plain words, no markup"
    assert by_id[None]["text"] == "unclosed bold\n\nsecond & last © A"
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_op8(spark, odd_dir, odd_docs):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(text):
        return word.findall((text or "").translate(UPPER))

    grams = defaultdict(set)
    for r in spark.read.parquet(f"{odd_dir}/benchmark.parquet").collect():
        w = words(r["text"])
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            grams[tuple(w[i:i + size])].add("" if r["item_id"] is None else str(r["item_id"]))
    sizes = {len(g) for g in grams}
    want = []
    for d, text, _ in odd_docs:
        w, hit, items = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in grams:
                    hit.update(range(i, i + size))
                    items |= grams[tuple(w[i:i + size])]
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        want.append((d, len(w), len(hit), len(items), digest, bool(hit)))
    assert rows(catalog.op8_benchmark_decontamination(spark, odd_dir)) == sorted(want, key=str)


def brute_simhash(text):
    w = [x.translate(UPPER) for x in WHITE.findall(text or "")]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_op9(spark, odd_dir, odd_docs):
    prints = [brute_simhash(t) for _, t, _ in odd_docs]
    root = brute_components(prints)
    least = {}
    for (d, _, _), p in zip(odd_docs, prints):
        least[root[p]] = min((x for x in (least.get(root[p]), d) if x is not None), default=None)
    want = sorted(((d, f"{p:016x}", least[root[p]]) for (d, _, _), p in zip(odd_docs, prints)), key=str)
    assert rows(catalog.op9_simhash_near_dedup(spark, odd_dir)) == want


def brute_quality(text):
    text = text or ""
    w = WHITE.findall(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WHITE.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def test_op10(spark, odd_dir, odd_docs):
    out = catalog.op10_quality_rules(spark, odd_dir).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = rows(out.drop("kept"))
    assert got == sorted(((d, *brute_quality(t)) for d, t, _ in odd_docs), key=str)
    assert not any(r["base_failed"] and r["kept"] for r in out.collect())


def test_pipeline_against_brute_force(spark, odd_dir, odd_docs):
    """Each stage's decisions, taken anew from its own input in plain Python."""
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    columns, kept = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        path = f"{odd_dir}/stage-{name}"
        stage(spark, docs, odd_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        assert docs.columns == columns
        kept = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
        if name == "quality_rules":
            assert kept == sorted((x for x in before if not brute_quality(x[1])[5]), key=str)
        elif name == "language_id":
            assert len(kept) >= 0.99 * len(before)
        elif name == "simhash_near_dedup":
            prints = {x: brute_simhash(x[1]) for x in before}
            root = brute_components(prints.values())
            groups = defaultdict(set)
            for x, p in prints.items():
                groups[root[p]].add(x)
            assert len(kept) == len(groups)
            assert {x[0] for x in kept} == {min((x[0] for x in g if x[0] is not None), default=None) for g in groups.values()}
        else:
            hit = {r["doc_id"] for r in catalog.op8_benchmark_decontamination(spark, odd_dir).collect() if r["contaminated"]}
            assert kept == sorted((x for x in before if x[0] not in hit), key=str)
    packed = corpus_pipeline.run(spark, odd_dir).collect()
    ids = dict(zip((d for d, _ in kept), encoded([(d, t, None) for d, t in kept], 2)))
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == Counter(d for d, _ in kept)
    assert all(r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]) for r in packed)


def test_pipeline_on_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
