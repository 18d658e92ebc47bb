"""Porter stems on every corpus word (sf0.01) against a plain-Python stemmer.

The Python version below follows the library variant rule by rule (first
listed suffix that matches wins, recursion for ``alli``), one word at a time,
so it shares no code with the Column expressions it checks.
"""

from conftest import SF001

from smishlens.operators.porter import porter_stems
from smishlens.sources import testdata as D

# Irregular words of the library variant.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}


def is_cons(w, i):
    if w[i] in "aeiou":
        return False
    if w[i] == "y":
        return i == 0 or not is_cons(w, i - 1)
    return True


def measure(s):
    return "".join("c" if is_cons(s, i) else "v" for i in range(len(s))).count("vc")


def has_vowel(s):
    return any(not is_cons(s, i) for i in range(len(s)))


def double_c(w):
    return len(w) >= 2 and w[-1] == w[-2] and is_cons(w, len(w) - 1)


def cvc(w):
    if (len(w) >= 3 and is_cons(w, len(w) - 3) and not is_cons(w, len(w) - 2)
            and is_cons(w, len(w) - 1) and w[-1] not in "wxy"):
        return True
    return len(w) == 2 and not is_cons(w, 0) and is_cons(w, 1)


def first_rule(w, rules):
    for suf, rep, cond in rules:
        if w.endswith(suf):
            stem = w[:len(w) - len(suf)]
            return stem + rep if cond(stem) else w
    return w


def m_gt(k):
    return lambda s: measure(s) > k


def step2(w):
    if w.endswith("alli") and measure(w[:-4]) > 0:
        return step2(w[:-4] + "al")
    pos = m_gt(0)
    rules = [("ational", "ate", pos), ("tional", "tion", pos), ("enci", "ence", pos), ("anci", "ance", pos),
             ("izer", "ize", pos), ("bli", "ble", pos), ("alli", "al", pos), ("entli", "ent", pos),
             ("eli", "e", pos), ("ousli", "ous", pos), ("ization", "ize", pos), ("ation", "ate", pos),
             ("ator", "ate", pos), ("alism", "al", pos), ("iveness", "ive", pos), ("fulness", "ful", pos),
             ("ousness", "ous", pos), ("aliti", "al", pos), ("iviti", "ive", pos), ("biliti", "ble", pos),
             ("fulli", "ful", pos), ("logi", "log", lambda s: measure(w[:-3]) > 0)]
    return first_rule(w, rules)


def py_stem(w):
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    # 1a
    if w.endswith("ies") and len(w) == 4:
        w = w[:-3] + "ie"
    else:
        always = lambda s: True
        w = first_rule(w, [("sses", "ss", always), ("ies", "i", always), ("ss", "ss", always), ("s", "", always)])
    # 1b
    if w.endswith("ied"):
        w = w[:-3] + ("ie" if len(w) == 4 else "i")
    elif w.endswith("eed"):
        if measure(w[:-3]) > 0:
            w = w[:-3] + "ee"
    else:
        cut = None
        for suf in ("ed", "ing"):
            if w.endswith(suf) and has_vowel(w[:-len(suf)]):
                cut = w[:-len(suf)]
                break
        if cut is not None:
            w = cut
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif double_c(w):
                if w[-1] not in "lsz":
                    w = w[:-1]
            elif measure(w) == 1 and cvc(w):
                w += "e"
    # 1c
    if w.endswith("y") and len(w) > 2 and is_cons(w, len(w) - 2):
        w = w[:-1] + "i"
    w = step2(w)
    pos = m_gt(0)
    w = first_rule(w, [("icate", "ic", pos), ("ative", "", pos), ("alize", "al", pos), ("iciti", "ic", pos),
                       ("ical", "ic", pos), ("ful", "", pos), ("ness", "", pos)])
    big = m_gt(1)
    rules4 = [(s, "", big) for s in ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent")]
    rules4.append(("ion", "", lambda s: measure(s) > 1 and s[-1:] in ("s", "t")))
    rules4 += [(s, "", big) for s in ("ou", "ism", "ate", "iti", "ous", "ive", "ize")]
    w = first_rule(w, rules4)
    if w.endswith("e"):
        s = w[:-1]
        if measure(s) > 1 or (measure(s) == 1 and not cvc(s)):
            w = s
    if w.endswith("ll") and measure(w[:-1]) > 1:
        w = w[:-1]
    return w


def test_corpus_words_match_python(spark):
    rows = porter_stems(D.corpus_words(spark, SF001)).collect()
    assert len(rows) > 10_000
    wrong = {r["word"]: (r["stem"], py_stem(r["word"])) for r in rows if r["stem"] != py_stem(r["word"])}
    assert not dict(list(wrong.items())[:20]), f"{len(wrong)} of {len(rows)} differ"


def test_python_reference_on_hand_examples():
    cases = {"ties": "tie", "spied": "spi", "possibly": "possibl", "geology": "geolog", "say": "say",
             "controlling": "control", "radically": "radic", "ayyy": "ayyy", "yyy": "yyy", "flyy": "flyy"}
    assert {w: py_stem(w) for w in cases} == cases


def test_runs_of_y(spark):
    """y after a consonant y is a vowel, so runs of y alternate."""
    words = ["ayyy", "yyy", "flyy", "yyying", "sayy", "yayy", "buyyers", "toyyed", "xyyy", "xyyyyy", "yyyyy",
             "ayyyyying", "byyyyed", "syyyyyyyyyyyyy",
             "b" + "y" * 103 + "ed", "b" + "y" * 104 + "ed", "y" * 301 + "ing", "a" + "y" * 250 + "s"]
    got = {r["word"]: r["stem"] for r in porter_stems(spark.createDataFrame([(w,) for w in words], "word string"))
           .collect()}
    assert got == {w: py_stem(w) for w in words}
