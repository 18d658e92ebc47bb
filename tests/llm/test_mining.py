"""Collocations, secret scan and prefix trie against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_tables import empty_dir, odd_dir, odd_docs  # noqa: F401
from smishlens.llm import catalog, collocations, prefix_trie, secrets

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(docs, least=10, top=2000, cover=50, longest=3):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, own in f.items():
        candidates = [p for p, a in own.items() if len(p) > 1 and a >= least]
        longer = Counter()
        for p in candidates:
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        longer[p[i:j]] = max(longer[p[i:j]], own[p])
        rows = []
        for p in candidates:
            a = own[p]
            if longer[p] and 100 * longer[p] >= cover * a:
                continue
            score, _, left, right = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_bytes,longest,top", [(32 << 20, 3, 2000), (300, 3, 20), (300, 4, 2000), (300, 2, 2000)])
def test_collocations_of_any_length_and_layout(spark, monkeypatch, block_bytes, longest, top):
    random.seed(1)
    words = ["The", "the", "a", "b", "é", "x\x85y", "cat", "dog"]
    gaps = [" ", "  ", "\t", ", ", ". ", "\n", " ", " ", " "]
    docs = [("".join(random.choice(words) + random.choice(gaps) for _ in range(random.randint(0, 60))), random.choice(["en", "de", None, "und"]))
            for _ in range(300)] + [(None, "en"), ("", None), (",;.", "fr"), (" ", "fr")]
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", min(block_bytes, 2 << 20))
    df = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    got = collocations.collocations(df, max_words=longest, top=top)
    assert sorted(map(tuple, got.collect())) == plain_collocations(docs, longest=longest, top=top)


def test_scores_beyond_64_bits(spark):
    big = 9_999_999_999_999_999
    rows = [("en", "a b", big - 7), ("en", "c d", 3)]
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big - 1), ("en", "c", 7), ("en", "d", big)], "lang string, phrase string, a long")
    out = collocations.scored([words, spark.createDataFrame(rows, "lang string, phrase string, a long")]).collect()
    assert {r["phrase"]: r["score"] for r in out} == {"a b": 10**6 * (big - 7)**2 // (big * (big - 1)), "c d": 0}


def test_op11(spark, odd_dir, odd_docs):
    got = sorted(map(tuple, catalog.op11_phrase_collocations(spark, odd_dir).collect()))
    assert got == plain_collocations([(t, la) for _, t, la in odd_docs])


def plain_spans(text, scope=200):
    text = text or ""
    found = []
    for k, kind in enumerate(secrets.KINDS):
        for m in re.finditer(kind.pattern, text):
            value = m.group(kind.group)
            if len(value) >= kind.least and (kind.name != "secret" or all(re.search(x, value) for x in ("[a-z]", "[A-Z]", "[0-9]"))):
                found.append((m.start(), k, m.end()))
    strong = [s for s in found if s[1] < 3]
    parts = strong + [w for w in found if w[1] >= 3 and not any(s[0] < w[2] and w[0] < s[2] for s in strong)]
    blank = [m.end() for m in re.finditer("\n[\x20\x09\x0D]*\n", text)]
    told = set()
    for s in parts:
        for o in parts:
            if secrets.KINDS[s[1]].part == "secret" != secrets.KINDS[o[1]].part and s[0] - scope <= o[0] < s[2] + scope \
                    and sum(b <= s[0] for b in blank) == sum(b <= o[0] for b in blank):
                told |= {x for x in (s, o) if x[1] >= 3}
    return sorted(strong + list(told))


BITS = ["password: hunter22", 'token = "abcdefgh"', "secret=token:abcdefgh", "AKIA" + "X" * 16, "AKIAAKIA", "AKIA" + "Z9" * 12, "deadbeef" * 3,
        "0123456789abcdef" * 2, "bob@mail.example.com", "user_name: alice99", "account=ab", "https://s3.example.com/x?y", "aB3" * 12, "aB3" * 12 + "==",
        "x", "Ünï", "漢字", "\n\n", "\n \t\n", "\n", "the quick brown fox " * 8, " ", "=", "token=ab", 'TOKEN="Zz9/x+_.-=="', "API_KEY : q1w2e3r4",
        "ſecret=abcdefgh", "toKen:abcdefg", "😀 passwd:😀abcdefg", "http://a", "key@", "db://h:1/" + "deadbeef" * 3]


def test_linked_secrets(spark):
    random.seed(5)
    texts = ["".join(random.choice(BITS) + random.choice([" ", "", ", ", "\n"]) for _ in range(random.randint(0, 14))) for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:50])], "doc_id long, text string")
    out = {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["found"]] for r in secrets.scan(df, ["doc_id"]).collect()}
    assert out == {i: plain_spans(t) for i, t in enumerate(texts + texts[:50])}
    assert sum(s[1] >= 3 for spans in out.values() for s in spans) > 100


def test_weak_parts_alone_are_not_told(spark):
    rows = [(1, "write to bob@mail.example.com or see https://example.com/help"), (2, "aB3" * 12), (3, "mail bob@mail.example.com, token: abcdefgh"),
            (4, "mail bob@mail.example.com\n\ntoken: abcdefgh"), (5, "bob@mail.example.com" + " x" * 300 + " token: abcdefgh")]
    out = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    names = {r["doc_id"]: [s["name"] for s in r["found"]] for r in out}
    assert names == {1: [], 2: [], 3: ["identifier", "assign"], 4: ["assign"], 5: ["assign"]}


def test_many_matches_of_one_text(spark):
    text = "\n".join(hashlib.sha256(str(i).encode()).hexdigest() + " user: someone" for i in range(3000))
    found = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"]).first()["found"]
    assert [(s["start"], s["kind"], s["end"]) for s in found][::2] == [(79 * i, 2, 79 * i + 64) for i in range(3000)] and len(found) == 6000


def test_op12(spark, odd_dir, odd_docs):
    def told(spans):
        return ",".join(f"{secrets.KINDS[k].name}:{a}:{b}" for a, k, b in spans)

    want = []
    for doc_id, text, _ in odd_docs:
        spans = plain_spans(text)
        strong = [s for s in spans if s[1] < 3]
        want.append((doc_id, *[sum(s[1] == k for s in strong) for k in range(3)], hashlib.sha256(told(strong).encode()).hexdigest(), told(spans)))
    got = catalog.op12_secret_scan(spark, odd_dir)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def plain_trie(conversations):
    """The nodes of {conv_id: [(role, text)]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for key, own in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(own) - 1) * (len(key[-1][1].encode()) if key else 0)
    return sorted((min(own), len(key), min(members[key[:-1]]) if key else None, len(own), children[key], leaves[key], saved[key],
                   hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest()) for key, own in members.items())


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]


@pytest.mark.parametrize("seed,words,shard_bytes", [(1, 2, 400), (2, 3, 1500), (3, 1, 300), (4, 30, 16 << 20)])
def test_trie_over_many_shards(spark, seed, words, shard_bytes):
    rng = random.Random(seed)
    talks = {c: [(rng.choice("ua"), "w" * rng.randint(1, words)) for _ in range(rng.choice([0, 1, 2, 5, 12]))] for c in range(-5, 250)}
    talks |= {1000 + i: talks[3] for i in range(60)}  # copies
    rows = [(c, d, role, text) for c, turns in talks.items() for d, (role, text) in enumerate(turns)]
    found = prefix_trie.paths(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    empty = spark.createDataFrame([(c, b"", []) for c, turns in talks.items() if not turns], "conv_id long, path binary, sizes array<int>")
    got = rows_of(prefix_trie.nodes(found.unionByName(empty), shard_bytes))
    assert sorted(got, key=str) == sorted(plain_trie(talks), key=str)


def test_close_of_every_parenthesis():
    rng = np.random.default_rng(4)
    for n in (1, 5, 70, 5000):
        for share in (0.2, 0.5, 0.9):  # shallow and deep
            bits, height, left = [1], 1, n - 1
            while height:
                up = left and (rng.random() < share or height == 1)
                bits.append(int(up))
                height += 1 if up else -1
                left -= bool(up)
            bits = np.array(bits, np.uint8)
            stack, want = [], {}
            for i, b in enumerate(bits):
                if b:
                    stack.append(i)
                else:
                    want[stack.pop()] = i
            opens = np.flatnonzero(bits)
            assert prefix_trie.Parentheses(bits).find_close(opens).tolist() == [want[i] for i in opens.tolist()]


def test_a_very_long_conversation(spark):
    rows = [(c, d, "user", f"turn {d}") for c in (1, 2) for d in range(3000)] + [(2, 3000, "user", "more")]
    got = rows_of(prefix_trie.nodes(prefix_trie.paths(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    assert len(got) == 3002 and max(r[1] for r in got) == 3001 and all(r[5] == 1 for r in got)


def test_op13(spark, odd_dir):
    own = defaultdict(list)
    for r in spark.read.parquet(f"{odd_dir}/conversations.parquet").collect():
        if r["conv_id"] is not None:
            own[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    talks = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        talks[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    got = rows_of(catalog.op13_conversation_prefix_trie(spark, odd_dir))
    assert sorted(got, key=str) == sorted(plain_trie(talks), key=str)
