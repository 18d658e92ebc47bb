"""DuckDB twins of the Spark queries (the correctness gate).

Each query is written a second time as plain SQL over the same parquet views
(``documents``, ``labels``, ``pages``, ``events`` ...). Shared steps are named
CTEs; ``with_ctes`` pulls in a CTE and everything it depends on, in order.
Doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

# The twins state all values themselves: they import nothing of the code they check.
# RE2 spellings of the patterns (no (?U); the oracle data is ASCII-blank only).
URL_RE = r"https?://\S+|www\.\S+"
PHONE_RE = r"\b\d{10,}\b"
BLANKS = r"\t\n\x0B\f\r\x1C-\x1F "
PUNCT_RE = rf"[^A-Za-z0-9_{BLANKS}]"
STRIP_RE = rf"^[{BLANKS}]+|[{BLANKS}]+$"
SPLIT_RE = rf"[{BLANKS}]+"
TOKEN_RE = r"\b\w\w+\b"
PHONE_TOKEN, URL_SUSPICIOUS_TOKEN, URL_TRUSTED_TOKEN = " PHONE_NUM ", " URL_SUSPICIOUS ", " URL_TRUSTED "
POSITIVE_LABELS, NEGATIVE_LABELS = ("spam", "1"), ("ham", "0")
SUSPICIOUS_TYPES = ("MALWARE", "SOCIAL_ENGINEERING")

# Suffix rules of the published stemming algorithm (steps 2 to 4) and
# the irregular words of its library variant.
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
         ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
         ("iviti", "ive"), ("biliti", "ble"), ("alli", "al"), ("bli", "ble"), ("fulli", "ful"), ("logi", "log")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
         "iti", "ous", "ive", "ize"]
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}


# Foldings of the accent folder that strip_accents does not give,
# stated here once more so that the twin does not depend on the code it checks.
FOLD_TWIN = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Þ": "Th", "þ": "th", "Ð": "D", "ð": "d",
    "¿": "?", "¡": "!", "«": "<<", "»": ">>", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", "…": "...",
    "€": "EUR", "£": "PS", "©": "(c)", "®": "(r)", "°": "deg", "·": "*", "ª": "a", "º": "o", "´": "'", "•": "*",
}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fold_sql(expr: str) -> str:
    out = expr
    for k, v in FOLD_TWIN.items():
        out = f"replace({out}, {q(k)}, {q(v)})"
    out = f"strip_accents({out})"
    return f"regexp_replace({out}, '[^\\x00-\\x7F]', '', 'g')"


def mask_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {q(PHONE_RE)}, {q(PHONE_TOKEN)}, 'g')"


def punct_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {q(PUNCT_RE)}, ' ', 'g')"


def lower_strip_sql(expr: str) -> str:
    return f"regexp_replace(lower({expr}), {q(STRIP_RE)}, '', 'g')"


def clean_after_urls_sql(expr: str) -> str:
    return lower_strip_sql(punct_sql(mask_sql(fold_sql(expr))))


def tokens_sql(expr: str) -> str:
    """Whitespace tokens without empties."""
    return f"list_filter(string_split_regex({expr}, {q(SPLIT_RE)}), lambda t: t <> '')"


def label_sql(expr: str, mode: str = "strict") -> str:
    t = f"regexp_replace(lower(CAST({expr} AS VARCHAR)), '^\\s+|\\s+$', '', 'g')"
    pos = ", ".join(q(x) for x in POSITIVE_LABELS)
    neg = ", ".join(q(x) for x in NEGATIVE_LABELS)
    base = f"CASE WHEN {t} IN ({pos}) THEN 1 WHEN {t} IN ({neg}) THEN 0"
    if mode == "lenient":
        return f"CAST({base} END AS INTEGER)"
    return f"CAST({base} ELSE error('unknown label') END AS INTEGER)"


SUSP_TYPES = ", ".join(q(x) for x in SUSPICIOUS_TYPES)

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (body, deps)


def with_ctes(final: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final
    parts = [f"{n} AS ({CTES[n][0]})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + final


# ---- adapters --------------------------------------------------------------
cte("messages", """
SELECT d.doc_id AS msg_id, d.text AS message,
       CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
cte("messages_es", """
SELECT doc_id AS msg_id, text AS message,
       CASE WHEN lang = 'es' THEN 'spam' ELSE 'ham' END AS label
FROM documents""")
cte("url_messages", """
SELECT page_id AS msg_id, 'Win ' || url || ', now: www.x.y ok ' || upper(url) AS message,
       CASE WHEN starts_with(url, 'http://') THEN 'spam' ELSE 'ham' END AS label
FROM pages""")
cte("threats", """
SELECT url, 'MALWARE' AS threat_type FROM pages
  WHERE starts_with(url, 'http://') AND contains(url, '/fr/')
UNION ALL SELECT url, 'SOCIAL_ENGINEERING' FROM pages
  WHERE contains(url, '/fr/') OR contains(url, '/de/')
UNION ALL SELECT url, 'UNWANTED_SOFTWARE' FROM pages WHERE contains(url, '/es/')""")
cte("bad_urls", f"SELECT DISTINCT url FROM threats WHERE threat_type IN ({SUSP_TYPES})", ("threats",))


def _spelt_sql(valid_only: bool) -> str:
    spelt = ("CASE WHEN d.lang = 'en' THEN (CASE WHEN l.toxic = 1 THEN ' SPAM ' ELSE 'Ham' END) "
             "WHEN d.lang = 'es' THEN (CASE WHEN l.toxic = 1 THEN '1' ELSE '0' END) "
             "WHEN d.lang = 'fr' THEN (CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END) "
             "ELSE (CASE WHEN l.toxic = 1 THEN chr(9) || '1 ' ELSE ' 0' END) END")
    if valid_only:
        return spelt
    return f"CASE WHEN d.lang = 'de' AND l.quality = 0 THEN 'unsure' ELSE {spelt} END"


cte("labels_spelt", f"""
SELECT l.doc_id AS msg_id, {_spelt_sql(True)} AS label
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
cte("labels_mixed", f"""
SELECT l.doc_id AS msg_id, {_spelt_sql(False)} AS label
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
cte("translations", """
SELECT DISTINCT * FROM (
  SELECT 'es' AS src_lang, 'en' AS tgt_lang, text AS text_in, reverse(text) AS text_out
    FROM documents WHERE lang = 'es'
  UNION ALL SELECT 'en', 'es', reverse(text), lower(text) FROM documents WHERE lang = 'es'
  UNION ALL SELECT 'en', 'es', reverse(text), upper(text) FROM documents WHERE lang = 'es'
  UNION ALL SELECT 'en', 'es', text, reverse(text) FROM documents WHERE lang = 'en'
  UNION ALL SELECT 'en', 'es', text, text FROM documents WHERE lang = 'en')
WHERE text_in IS NOT NULL""")
cte("options", """
SELECT src_lang, tgt_lang, text_in, list_sort(list(text_out)) AS options FROM translations GROUP BY ALL""", ("translations",))


def url_tokens_cte(name: str, src: str) -> None:
    """C2 twin: pieces between URLs and URL tokens interleaved, re-joined in order."""
    cte(f"{name}_pieces", f"""
SELECT m.msg_id, 2 * t.i - 1 AS k, t.piece
FROM {src} m, unnest(string_split_regex(m.message, {q(URL_RE)})) WITH ORDINALITY AS t(piece, i)
UNION ALL
SELECT u.msg_id, 2 * u.i AS k,
       CASE WHEN b.url IS NULL THEN {q(URL_TRUSTED_TOKEN)} ELSE {q(URL_SUSPICIOUS_TOKEN)} END
FROM (SELECT m.msg_id, t.url, t.i
      FROM {src} m, unnest(regexp_extract_all(m.message, {q(URL_RE)})) WITH ORDINALITY AS t(url, i)) u
LEFT JOIN bad_urls b ON b.url = u.url""", (src, "bad_urls"))
    cte(name, f"""
SELECT m.msg_id, p.message, m.label
FROM {src} m JOIN (SELECT msg_id, string_agg(piece, '' ORDER BY k) AS message
                   FROM {name}_pieces GROUP BY msg_id) p ON m.msg_id = p.msg_id""", (f"{name}_pieces",))


def preprocess_cte(name: str, src: str, label_mode: str = "strict") -> None:
    """B8 twin: label map -> clean text -> drop blank."""
    url_tokens_cte(f"{name}_urls", src)
    cte(name, f"""
SELECT msg_id, message, label FROM (
  SELECT msg_id, {clean_after_urls_sql('message')} AS message, {label_sql('label', label_mode)} AS label
  FROM {name}_urls)
WHERE length(regexp_replace(message, {q(STRIP_RE)}, '', 'g')) > 0""", (f"{name}_urls",))


preprocess_cte("prep", "messages")
preprocess_cte("prep_es", "messages_es")
url_tokens_cte("url_tok", "url_messages")

ORACLE: dict[str, str] = {}

ORACLE["load_normalise"] = with_ctes("""
SELECT d.doc_id AS msg_id, d.text AS message, s.label
FROM documents d LEFT JOIN labels_spelt s ON d.doc_id = s.msg_id
WHERE d.text IS NOT NULL AND s.label IS NOT NULL""", "labels_spelt")
ORACLE["map_label_strict"] = with_ctes(
    f"SELECT msg_id, CAST({label_sql('label')} AS BIGINT) AS label FROM labels_spelt", "labels_spelt")
ORACLE["map_label_lenient"] = with_ctes(
    f"SELECT msg_id, CAST({label_sql('label', 'lenient')} AS BIGINT) AS label FROM labels_mixed",
    "labels_mixed")
ORACLE["map_label_numeric"] = """
SELECT doc_id AS msg_id,
       CAST(CASE WHEN trunc(CAST(toxic AS DOUBLE) + quality * 0.5) IN (0, 1)
                 THEN trunc(CAST(toxic AS DOUBLE) + quality * 0.5)
                 ELSE error('unknown label') END AS BIGINT) AS label
FROM labels"""
ORACLE["extract_urls"] = with_ctes(f"""
SELECT m.msg_id, CAST(t.i - 1 AS BIGINT) AS pos, t.url
FROM url_messages m, unnest(regexp_extract_all(m.message, {q(URL_RE)})) WITH ORDINALITY AS t(url, i)""",
                                   "url_messages")
ORACLE["url_tokens"] = with_ctes("SELECT msg_id, message FROM url_tok", "url_tok")
ORACLE["fold_accents"] = f"SELECT doc_id AS msg_id, {fold_sql('text')} AS message FROM documents"
ORACLE["mask_numbers"] = f"SELECT doc_id AS msg_id, {mask_sql(fold_sql('text'))} AS message FROM documents"
ORACLE["strip_punct"] = (f"SELECT doc_id AS msg_id, {punct_sql(mask_sql(fold_sql('text')))} AS message "
                         "FROM documents")
ORACLE["clean_text"] = with_ctes(
    f"SELECT msg_id, {clean_after_urls_sql('message')} AS message FROM url_tok", "url_tok")
ORACLE["preprocess"] = with_ctes("SELECT msg_id, message, CAST(label AS BIGINT) AS label FROM prep", "prep")
ORACLE["tokenise"] = with_ctes(f"""
SELECT msg_id, array_to_string({tokens_sql('message')}, ' ') AS message,
       CAST(len({tokens_sql('message')}) AS BIGINT) AS n_tokens
FROM prep_es""", "prep_es")


# ---- C9-C11 ---------------------------------------------------------------------
cte("corpus_words", f"""
SELECT DISTINCT w AS word FROM (
  SELECT unnest(regexp_extract_all(lower({clean_after_urls_sql(f"regexp_replace(text, {q(URL_RE)}, {q(URL_TRUSTED_TOKEN)}, 'g')")}),
                                   {q(TOKEN_RE)})) AS w
  FROM documents)""")
cte("lemmas", """
SELECT word, rtrim(word, 's') AS lemma FROM corpus_words
WHERE ends_with(word, 's') AND length(word) > 3""", ("corpus_words",))
cte("stems", """
SELECT word, regexp_replace(word, '(ing|ed)$', '') AS stem FROM corpus_words
WHERE regexp_matches(word, '(ing|ed)$') AND length(word) > 5""", ("corpus_words",))


# ---- C10: Porter stems (library variant) in plain SQL ------------------------------
# Written step by step as CASE expressions over nested selects. The
# consonant/vowel form is a fold over the letters (list_reduce), so a y takes
# its class from the letter before it for runs of any length.

def _p_m(c: str) -> str:
    return f"((length({c}) - length(replace({c}, 'VC', ''))) // 2)"


def _p_cvc(s: str, c: str) -> str:
    return f"((ends_with({c}, 'CVC') AND right({s}, 1) NOT IN ('w', 'x', 'y')) OR {c} = 'VC')"


def _p_dbl(s: str, c: str) -> str:
    return f"(length({s}) >= 2 AND right({s}, 1) = substr({s}, length({s}) - 1, 1) AND ends_with({c}, 'C'))"


def _p_form(text: str) -> str:
    return "".join("V" if ch in "aeiou" else "C" for ch in text)


def _p_rules(src: str, rules, cond: str, special: dict | None = None) -> str:
    """One suffix step over ``src(word, w, c)``; ``cond`` uses ``stem``/``cvp``."""
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    hit = "CASE " + " ".join(f"WHEN ends_with(w, {q(sfx)}) THEN {q(sfx)}" for sfx, _ in ordered) + " END"
    rep = "CASE hit " + " ".join(f"WHEN {q(sfx)} THEN {q(r)}" for sfx, r in ordered) + " END"
    form = "CASE hit " + " ".join(f"WHEN {q(sfx)} THEN {q(_p_form(r))}" for sfx, r in ordered) + " END"
    ok = cond
    for sfx, extra in (special or {}).items():
        ok = f"CASE WHEN hit = {q(sfx)} THEN ({extra}) ELSE ({ok}) END"
    return f"""SELECT word,
  CASE WHEN hit IS NOT NULL AND ({ok}) THEN stem || {rep} ELSE w END AS w,
  CASE WHEN hit IS NOT NULL AND ({ok}) THEN cvp || {form} ELSE c END AS c
FROM (SELECT *, left(w, length(w) - length(coalesce(hit, ''))) AS stem,
             left(c, length(c) - length(coalesce(hit, ''))) AS cvp
      FROM (SELECT word, w, c, {hit} AS hit FROM ({src})))"""


def porter_sql(src: str) -> str:
    """``(word, stem)`` for the distinct ``word`` values of ``src``."""
    cv = ("list_reduce(list_prepend('', string_split(word, '')), lambda acc, ch: acc || "
          "CASE WHEN ch IN ('a', 'e', 'i', 'o', 'u') THEN 'V' "
          "WHEN ch = 'y' THEN (CASE WHEN acc = '' OR right(acc, 1) = 'V' THEN 'C' ELSE 'V' END) "
          "ELSE 'C' END)")
    cur = f"SELECT word, word AS w, {cv} AS c FROM (SELECT DISTINCT word FROM {src} WHERE word IS NOT NULL)"
    # 1a
    cur = _p_rules(cur, [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")], "TRUE")
    four = "(ends_with(word, 'ies') AND length(word) = 4)"  # 1a reads the word itself
    cur = f"""SELECT word,
  CASE WHEN {four} THEN left(word, 1) || 'ie' ELSE w END AS w,
  CASE WHEN {four} THEN left(c, 1) || 'VV' ELSE c END AS c
FROM ({cur})"""
    # 1b
    ed_ok = "(ends_with(w, 'ed') AND contains(left(c, length(c) - 2), 'V'))"
    ing_ok = "(ends_with(w, 'ing') AND contains(left(c, length(c) - 3), 'V'))"
    eed_fire = f"({_p_m('left(c, length(c) - 3)')} > 0)"
    cur = f"""SELECT word,
  CASE WHEN ends_with(w, 'ied') THEN left(w, length(w) - 3) || (CASE WHEN length(w) = 4 THEN 'ie' ELSE 'i' END)
       WHEN ends_with(w, 'eed') THEN (CASE WHEN {eed_fire} THEN left(w, length(w) - 1) ELSE w END)
       WHEN {ed_ok} THEN left(w, length(w) - 2)
       WHEN {ing_ok} THEN left(w, length(w) - 3)
       ELSE w END AS w,
  CASE WHEN ends_with(w, 'ied') THEN left(c, length(c) - 3) || (CASE WHEN length(w) = 4 THEN 'VV' ELSE 'V' END)
       WHEN ends_with(w, 'eed') THEN (CASE WHEN {eed_fire} THEN left(c, length(c) - 1) ELSE c END)
       WHEN {ed_ok} THEN left(c, length(c) - 2)
       WHEN {ing_ok} THEN left(c, length(c) - 3)
       ELSE c END AS c,
  (NOT ends_with(w, 'ied') AND NOT ends_with(w, 'eed') AND ({ed_ok} OR {ing_ok})) AS f
FROM ({cur})"""
    add_e0 = "(ends_with(w, 'at') OR ends_with(w, 'bl') OR ends_with(w, 'iz'))"
    undouble = f"(NOT {add_e0} AND {_p_dbl('w', 'c')} AND right(w, 1) NOT IN ('l', 's', 'z'))"
    add_e = f"({add_e0} OR (NOT {_p_dbl('w', 'c')} AND {_p_m('c')} = 1 AND {_p_cvc('w', 'c')}))"
    cur = f"""SELECT word,
  CASE WHEN f AND {add_e} THEN w || 'e' WHEN f AND {undouble} THEN left(w, length(w) - 1) ELSE w END AS w,
  CASE WHEN f AND {add_e} THEN c || 'V' WHEN f AND {undouble} THEN left(c, length(c) - 1) ELSE c END AS c
FROM ({cur})"""
    # 1c
    cur = _p_rules(cur, [("y", "i")], "length(stem) > 1 AND ends_with(cvp, 'C')")
    # 2: alli first, then the rule list
    alli = f"(ends_with(w, 'alli') AND {_p_m('left(c, length(c) - 4)')} > 0)"
    cur = f"""SELECT word,
  CASE WHEN {alli} THEN left(w, length(w) - 4) || 'al' ELSE w END AS w,
  CASE WHEN {alli} THEN left(c, length(c) - 4) || 'VC' ELSE c END AS c
FROM ({cur})"""
    cur = _p_rules(cur, STEP2, f"{_p_m('cvp')} > 0", {"logi": f"{_p_m("(cvp || 'C')")} > 0"})
    # 3, 4
    cur = _p_rules(cur, STEP3, f"{_p_m('cvp')} > 0")
    cur = _p_rules(cur, [(x, "") for x in STEP4], f"{_p_m('cvp')} > 1",
                   {"ion": f"{_p_m('cvp')} > 1 AND (ends_with(stem, 's') OR ends_with(stem, 't'))"})
    # 5a, 5b
    e_stem, e_cvp = "left(w, length(w) - 1)", "left(c, length(c) - 1)"
    drop_e = (f"(ends_with(w, 'e') AND ({_p_m(e_cvp)} > 1 OR ({_p_m(e_cvp)} = 1 AND NOT {_p_cvc(e_stem, e_cvp)})))")
    cur = f"""SELECT word, CASE WHEN {drop_e} THEN {e_stem} ELSE w END AS w,
  CASE WHEN {drop_e} THEN {e_cvp} ELSE c END AS c FROM ({cur})"""
    single_l = f"({_p_m('c')} > 1 AND {_p_dbl('w', 'c')} AND ends_with(w, 'l'))"
    cur = f"SELECT word, CASE WHEN {single_l} THEN left(w, length(w) - 1) ELSE w END AS w FROM ({cur})"
    irregular = "CASE word " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in IRREGULAR.items()) + " END"
    return f"""SELECT word, coalesce({irregular}, CASE WHEN length(word) <= 2 THEN word ELSE w END) AS stem
FROM ({cur})"""


def lookup_sql(src: str, lemma: bool, stem: bool, extra_cols: str = "",
               stem_table: str = "stems") -> tuple[str, tuple[str, ...]]:
    steps = f"""
toks AS (SELECT p.msg_id, t.i AS pos, t.tok FROM {src} p,
         unnest({tokens_sql('p.message')}) WITH ORDINALITY AS t(tok, i))"""
    cur = "toks"
    deps = [src]
    if lemma:
        steps += f""",
t_lem AS (SELECT x.msg_id, x.pos, coalesce(l.lemma, x.tok) AS tok FROM {cur} x
          LEFT JOIN (SELECT word, lemma FROM lemmas WHERE word <> lemma) l ON x.tok = l.word)"""
        cur = "t_lem"
        deps.append("lemmas")
    if stem:
        steps += f""",
t_stem AS (SELECT x.msg_id, x.pos, coalesce(s.stem, x.tok) AS tok FROM {cur} x
           LEFT JOIN (SELECT word, stem FROM {stem_table} WHERE word <> stem) s ON x.tok = s.word)"""
        cur = "t_stem"
        deps.append(stem_table)
    final = f""",
agg AS (SELECT msg_id, string_agg(tok, ' ' ORDER BY pos) AS message FROM {cur} GROUP BY msg_id)
SELECT p.msg_id, coalesce(a.message, '') AS message{extra_cols} FROM {src} p LEFT JOIN agg a ON p.msg_id = a.msg_id"""
    return steps + final, tuple(deps)


def _with_steps(steps_final: str, deps: tuple[str, ...]) -> str:
    base = with_ctes("SELECT 1", *deps)
    head = base[: base.rfind("\nSELECT 1")]
    return head + "," + steps_final


ORACLE["lemma_lookup"] = _with_steps(*lookup_sql("prep_es", True, False))
ORACLE["stem_lookup"] = _with_steps(*lookup_sql("prep_es", False, True))
ORACLE["text_preprocessor"] = _with_steps(*lookup_sql("prep", True, True, ", CAST(p.label AS BIGINT) AS label"))

_LEMMA_RULES = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"))


def _detached_sql(form: str, order: str) -> str:
    rows = [f"CASE WHEN ends_with({form}, '{old}') THEN {{'o': {order} || '{k:02d}', 'f': left({form}, length({form}) - {len(old)}) || '{new}'}} END"
            for k, (old, new) in enumerate(_LEMMA_RULES, 1)]
    return "list_filter([" + ", ".join(rows) + "], lambda x: x IS NOT NULL)"


# every chain of rules with its length; the first length that has a known form counts
ORACLE["lemma_rules"] = with_ctes(rf"""
, bare AS (SELECT word, regexp_replace(word, '(ses|ves|xes|zes|ches|shes|men|ies|ss|s)$', '') AS b FROM corpus_words),
lexicon AS (
  SELECT DISTINCT w FROM (SELECT unnest([word, b, b || 'y', b || 'man']) AS w FROM bare) WHERE length(w) > 1 AND left(md5(w), 1) < '8'),
odd AS (SELECT word, unnest([left(word, 2), left(word, length(word) - 2)]) AS form FROM corpus_words WHERE ends_with(word, 'en') AND length(word) % 2 = 1),
listed AS (SELECT word, 1 AS stage, '' AS o, word AS form FROM odd UNION SELECT word, 1, form, form FROM odd),
plain AS (SELECT word FROM corpus_words WHERE NOT (ends_with(word, 'en') AND length(word) % 2 = 1)),
chain AS (
  SELECT word, 1 AS stage, m.o AS o, m.f AS form FROM (SELECT word, unnest({_detached_sql("word", "''")}) AS m FROM plain)
  UNION ALL
  SELECT word, stage + 1, m.o, m.f FROM (SELECT word, stage, unnest({_detached_sql("form", "o")}) AS m FROM chain)),
candidates AS (SELECT word, 1 AS stage, '' AS o, word AS form FROM plain UNION ALL SELECT * FROM chain UNION ALL SELECT * FROM listed)
SELECT word, form AS lemma FROM candidates SEMI JOIN lexicon ON form = w
QUALIFY row_number() OVER (PARTITION BY word ORDER BY stage, length(form), o) = 1""", "corpus_words").replace("\n\n, bare AS", ", bare AS").replace("WITH ", "WITH RECURSIVE ", 1)

ORACLE["porter"] = with_ctes(porter_sql("corpus_words"), "corpus_words")
cte("porter_es", porter_sql(f"(SELECT unnest({tokens_sql('message')}) AS word FROM prep_es)"), ("prep_es",))
ORACLE["stem_porter"] = _with_steps(*lookup_sql("prep_es", False, True, stem_table="porter_es"))


# ---- D: splits ----------------------------------------------------------------------
def split_ctes(prefix: str, src: str, test_size: float, seed: int, groups: tuple[str, ...] = (),
               label: str = "label", id_col: str = "msg_id") -> str:
    """CTE text (no leading WITH) ending in ``{prefix}_split`` = src + split column."""
    g = ", ".join(groups)
    gp = f"PARTITION BY {g}" if groups else ""
    gsel = (g + ", ") if groups else ""
    join_on = " AND ".join([f"b.{c} = q.{c}" for c in (*groups, label)])
    return f"""
{prefix}_base AS (SELECT *, md5(concat_ws(':', {seed}, {id_col})) AS _key FROM {src}),
{prefix}_cls AS (SELECT {gsel}{label}, count(*) AS n_c FROM {prefix}_base GROUP BY {gsel}{label}),
{prefix}_q1 AS (SELECT *, sum(n_c) OVER ({gp}) AS _n,
                CAST(ceil(CAST({test_size!r} AS DOUBLE) * sum(n_c) OVER ({gp})) AS BIGINT) AS _n_test
                FROM {prefix}_cls),
{prefix}_q2 AS (SELECT *, (_n - _n_test) * n_c / _n AS _cont, _n - _n_test AS _n_train FROM {prefix}_q1),
{prefix}_q3 AS (SELECT *, CAST(floor(_cont) AS BIGINT) AS _floor, _cont - floor(_cont) AS _rem FROM {prefix}_q2),
{prefix}_q4 AS (SELECT *, _n_train - sum(_floor) OVER ({gp}) AS _need,
                row_number() OVER ({gp} ORDER BY _rem DESC, {label}) AS _rk FROM {prefix}_q3),
{prefix}_quota AS (SELECT {gsel}{label}, n_c - (_floor + CASE WHEN _rk <= _need THEN 1 ELSE 0 END) AS n_test_c
                   FROM {prefix}_q4),
{prefix}_ranked AS (SELECT b.*, row_number() OVER (PARTITION BY {gsel}b.{label} ORDER BY _key, {id_col}) AS _rn
                    FROM {prefix}_base b),
{prefix}_split AS (SELECT b.* EXCLUDE (_key, _rn),
                   CASE WHEN b._rn <= q.n_test_c THEN 'test' ELSE 'train' END AS split
                   FROM {prefix}_ranked b JOIN {prefix}_quota q ON {join_on})"""


def sql_with_split(deps: tuple[str, ...], split_text: str, final: str) -> str:
    base = with_ctes("SELECT 1", *deps) if deps else "WITH SELECT 1"
    head = base[: base.rfind("\nSELECT 1")]
    sep = "," if deps else ""
    return head + sep + split_text + "\n" + final


cte("msg_labels", "SELECT msg_id, label FROM messages", ("messages",))
cte("es_ids", "SELECT msg_id, 1 AS _one FROM messages_es", ("messages_es",))
cte("lang_msgs", """
SELECT d.lang AS source, d.doc_id AS msg_id, CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
ORACLE["split_stratified"] = sql_with_split(
    ("msg_labels",), split_ctes("s", "msg_labels", 0.2, 42),
    "SELECT msg_id, label, split FROM s_split")
ORACLE["split_random"] = sql_with_split(
    ("es_ids",), split_ctes("s", "es_ids", 0.1, 42, label="_one"),
    "SELECT msg_id, split FROM s_split")
ORACLE["split_by_source"] = sql_with_split(
    ("lang_msgs",), split_ctes("s", "lang_msgs", 0.2, 42, groups=("source",)),
    "SELECT source, msg_id, label, split FROM s_split")


# ---- F, H1: TF-IDF and naive Bayes ---------------------------------------------
def tf_sql(src: str, extra: str = "") -> str:
    """Per-message term counts over vectoriser tokens."""
    return f"""SELECT msg_id{extra}, term, count(*) AS tf FROM (
  SELECT msg_id{extra}, unnest(regexp_extract_all(lower(message), {q(TOKEN_RE)})) AS term FROM {src})
GROUP BY ALL"""


cte("es_tf", tf_sql("prep_es"), ("prep_es",))
cte("es_stats", "SELECT term, sum(tf) AS total, count(*) AS df FROM es_tf GROUP BY term", ("es_tf",))
cte("es_vocab", "SELECT * FROM es_stats ORDER BY total DESC, term LIMIT 10000", ("es_stats",))
cte("es_idf", """
SELECT v.term, v.df, ln((1.0 + n.n) / (1.0 + v.df)) + 1.0 AS idf
FROM es_vocab v, (SELECT count(*) AS n FROM prep_es) n""", ("es_vocab", "prep_es"))


def tfidf_long_sql(tf: str, idf: str, extra: str = "") -> str:
    return f"""
SELECT w.msg_id{extra.replace(', ', ', w.')}, w.term, w.w / sqrt(n.s2) AS tfidf FROM
  (SELECT t.msg_id{extra.replace(', ', ', t.')}, t.term, t.tf * i.idf AS w FROM {tf} t JOIN {idf} i ON t.term = i.term) w
JOIN (SELECT t.msg_id, sum((t.tf * i.idf) * (t.tf * i.idf)) AS s2 FROM {tf} t JOIN {idf} i ON t.term = i.term
      GROUP BY t.msg_id) n ON w.msg_id = n.msg_id"""


ORACLE["term_counts"] = with_ctes("SELECT msg_id, term, CAST(tf AS BIGINT) AS tf FROM es_tf", "es_tf")
ORACLE["vocab_topk"] = with_ctes(
    "SELECT term, CAST(total AS BIGINT) AS total, CAST(df AS BIGINT) AS df FROM es_vocab", "es_vocab")
ORACLE["idf"] = with_ctes("SELECT term, CAST(df AS BIGINT) AS df, round(idf, 6) AS idf FROM es_idf", "es_idf")
ORACLE["tfidf"] = with_ctes(
    f"SELECT msg_id, term, round(tfidf, 6) AS tfidf FROM ({tfidf_long_sql('es_tf', 'es_idf')})",
    "es_tf", "es_idf")


def classic_ctes(p: str, prep: str, test_size: float = 0.3, seed: int = 42) -> str:
    """CTE text for split -> TF-IDF (train) -> naive Bayes -> test predictions.

    Produces ``{p}_split, {p}_idf, {p}_lp, {p}_pred(msg_id, label, p, prediction)``."""
    return split_ctes(p, prep, test_size, seed) + f""",
{p}_train AS (SELECT * FROM {p}_split WHERE split = 'train'),
{p}_test AS (SELECT * FROM {p}_split WHERE split = 'test'),
{p}_tf AS ({tf_sql(f'{p}_train', ', label')}),
{p}_vocab AS (SELECT term, sum(tf) AS total, count(*) AS df FROM {p}_tf GROUP BY term
              ORDER BY total DESC, term LIMIT 10000),
{p}_idf AS (SELECT v.term, v.df, ln((1.0 + n.n) / (1.0 + v.df)) + 1.0 AS idf
            FROM {p}_vocab v, (SELECT count(*) AS n FROM {p}_train) n),
{p}_x AS ({tfidf_long_sql(f'{p}_tf', f'{p}_idf', ', label')}),
{p}_fc AS (SELECT i.term, coalesce(sum(CASE WHEN x.label = 0 THEN x.tfidf END), 0) AS fc0,
                  coalesce(sum(CASE WHEN x.label = 1 THEN x.tfidf END), 0) AS fc1
           FROM {p}_idf i LEFT JOIN {p}_x x ON i.term = x.term GROUP BY i.term),
{p}_lp AS (SELECT f.term, i.idf, ln((f.fc0 + 1.0) / (t.t0 + t.v)) AS lp0, ln((f.fc1 + 1.0) / (t.t1 + t.v)) AS lp1
           FROM {p}_fc f JOIN {p}_idf i ON f.term = i.term,
                (SELECT sum(fc0) AS t0, sum(fc1) AS t1, count(*) AS v FROM {p}_fc) t),
{p}_prior AS (SELECT ln(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) / count(*)) AS pr0,
                     ln(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) / count(*)) AS pr1 FROM {p}_train),
{p}_ttf AS ({tf_sql(f'{p}_test')}),
{p}_s AS (SELECT t.msg_id, sum((t.tf * l.idf) * (t.tf * l.idf)) AS s2,
                 sum(t.tf * l.idf * l.lp0) AS s0, sum(t.tf * l.idf * l.lp1) AS s1
          FROM {p}_ttf t JOIN {p}_lp l ON t.term = l.term GROUP BY t.msg_id),
{p}_jll AS (SELECT t.msg_id, t.label, pr.pr0 + coalesce(s.s0 / sqrt(s.s2), 0.0) AS jll0,
                   pr.pr1 + coalesce(s.s1 / sqrt(s.s2), 0.0) AS jll1
            FROM {p}_test t LEFT JOIN {p}_s s ON t.msg_id = s.msg_id, {p}_prior pr),
{p}_pred AS (SELECT msg_id, label, 1.0 / (1.0 + exp(jll0 - jll1)) AS p,
                    CASE WHEN jll1 > jll0 THEN 1 ELSE 0 END AS prediction FROM {p}_jll)"""


ORACLE["tfidf_transform"] = sql_with_split(("prep_es",), classic_ctes("c", "prep_es"), """
SELECT t.msg_id, x.term, round(x.tfidf, 6) AS tfidf
FROM c_test t LEFT JOIN (""" + tfidf_long_sql("c_ttf", "c_idf") + """) x ON t.msg_id = x.msg_id""")
ORACLE["nb_fit"] = sql_with_split(("prep_es",), classic_ctes("c", "prep_es"), """
SELECT CAST(0 AS BIGINT) AS label, term, round(lp0, 6) AS log_prob FROM c_lp
UNION ALL SELECT CAST(1 AS BIGINT), term, round(lp1, 6) FROM c_lp""")
ORACLE["nb_predict"] = sql_with_split(("prep_es",), classic_ctes("c", "prep_es"), """
SELECT msg_id, CAST(label AS BIGINT) AS label, round(p, 6) AS p, CAST(prediction AS BIGINT) AS prediction
FROM c_pred""")


# ---- I, H8, H10, H12, H13, L4 ----------------------------------------------------------
TOXIC_THRESHOLD = 0.05
VERDICT_CUTS = (0.03, 0.05)



def _lookup_subquery(src: str) -> str:
    """prep -> lemma -> stem as one subquery (msg_id, message, label)."""
    return f"""
SELECT p.msg_id, coalesce(a.message, '') AS message, p.label FROM {src} p LEFT JOIN (
  SELECT msg_id, string_agg(tok, ' ' ORDER BY pos) AS message FROM (
    SELECT x.msg_id, x.pos, coalesce(s.stem, x.tok) AS tok FROM (
      SELECT t.msg_id, t.pos, coalesce(l.lemma, t.tok) AS tok FROM (
        SELECT p2.msg_id, u.i AS pos, u.tok FROM {src} p2,
               unnest({tokens_sql('p2.message')}) WITH ORDINALITY AS u(tok, i)) t
      LEFT JOIN (SELECT word, lemma FROM lemmas WHERE word <> lemma) l ON t.tok = l.word) x
    LEFT JOIN (SELECT word, stem FROM stems WHERE word <> stem) s ON x.tok = s.word)
  GROUP BY msg_id) a ON p.msg_id = a.msg_id"""


cte("prep_es_ls", _lookup_subquery("prep_es"), ("prep_es", "lemmas", "stems"))



def _pipeline_sql(final: str, *, toxic: bool = False, es: bool = False, es_ls: bool = False) -> str:
    deps = []
    parts = []
    if toxic:
        deps.append("prep")
        parts.append(classic_ctes("t", "prep"))
    if es:
        deps.append("prep_es")
        parts.append(classic_ctes("c", "prep_es"))
    if es_ls:
        deps.append("prep_es_ls")
        parts.append(classic_ctes("l", "prep_es_ls"))
    base = with_ctes("SELECT 1", *deps)
    head = base[: base.rfind("\nSELECT 1")]
    extra = ""
    if toxic:
        extra += f""",
tox_preds AS (SELECT msg_id, label, round(p, 12) AS p,
                     CASE WHEN round(p, 12) >= {TOXIC_THRESHOLD} THEN 1 ELSE 0 END AS prediction FROM t_pred)"""
    return head + "," + ",".join(parts) + extra + "\n" + final


def _counts_sql(src: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""SELECT {g}
  sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn
FROM {src} {gb}"""


def _sd(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / ({den}) END)"


PRF = (f"round({_sd('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy, round({_sd('tp', 'tp + fp')}, 6) AS precision, "
       f"round({_sd('tp', 'tp + fn')}, 6) AS recall, round({_sd('2 * tp', '2 * tp + fp + fn')}, 6) AS f1, "
       "CAST(tp + fp + fn + tn AS BIGINT) AS n")


def _ranks_sql(src: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_lt,
       coalesce(sum(pos) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_lt,
       sum(pos) OVER ({part}) AS P, sum(neg) OVER ({part}) AS N
FROM (SELECT {g}p AS score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg FROM {src} WHERE label IN (0, 1) GROUP BY {g}p)"""


def _auc_sql(src: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""SELECT {g}CASE WHEN max(P) = 0 OR max(N) = 0 THEN NULL
       ELSE sum(pos * (neg_lt + neg * 0.5)) / (CAST(max(P) AS DOUBLE) * max(N)) END AS auc
FROM ({_ranks_sql(src, group)}) {gb}"""


ORACLE["threshold"] = _pipeline_sql(
    "SELECT msg_id, CAST(label AS BIGINT) AS label, round(p, 6) AS p, CAST(prediction AS BIGINT) AS prediction "
    "FROM tox_preds", toxic=True)
ORACLE["confusion"] = _pipeline_sql(f"""
SELECT CAST(l AS BIGINT) AS label, CAST(pr AS BIGINT) AS prediction, CAST(n AS BIGINT) AS n FROM (
  SELECT 0 AS l, 0 AS pr, tn AS n FROM c UNION ALL SELECT 0, 1, fp FROM c
  UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c)""".replace(
    "FROM c", f"FROM ({_counts_sql('tox_preds')})"), toxic=True)
ORACLE["accuracy_prf"] = _pipeline_sql(f"SELECT {PRF} FROM ({_counts_sql('tox_preds')})", toxic=True)
ORACLE["class_report"] = _pipeline_sql(f"""
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM (
  SELECT '0' AS class, {_sd('tn', 'tn + fn')} AS precision, {_sd('tn', 'tn + fp')} AS recall,
         {_sd('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM k
  UNION ALL SELECT '1', {_sd('tp', 'tp + fp')}, {_sd('tp', 'tp + fn')}, {_sd('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM k
  UNION ALL SELECT 'accuracy', NULL, NULL, {_sd('tp + tn', 'tp + fp + fn + tn')}, tp + fp + fn + tn FROM k
  UNION ALL SELECT 'macro avg', ({_sd('tn', 'tn + fn')} + {_sd('tp', 'tp + fp')}) / 2,
         ({_sd('tn', 'tn + fp')} + {_sd('tp', 'tp + fn')}) / 2,
         ({_sd('2 * tn', '2 * tn + fn + fp')} + {_sd('2 * tp', '2 * tp + fp + fn')}) / 2, tp + fp + fn + tn FROM k
  UNION ALL SELECT 'weighted avg',
         {_sd(f"{_sd('tn', 'tn + fn')} * (tn + fp) + {_sd('tp', 'tp + fp')} * (tp + fn)", 'tp + fp + fn + tn')},
         {_sd(f"{_sd('tn', 'tn + fp')} * (tn + fp) + {_sd('tp', 'tp + fn')} * (tp + fn)", 'tp + fp + fn + tn')},
         {_sd(f"{_sd('2 * tn', '2 * tn + fn + fp')} * (tn + fp) + {_sd('2 * tp', '2 * tp + fp + fn')} * (tp + fn)", 'tp + fp + fn + tn')},
         tp + fp + fn + tn FROM k)""".replace("FROM k", f"FROM ({_counts_sql('tox_preds')})"), toxic=True)
ORACLE["roc_auc"] = _pipeline_sql(f"SELECT round(auc, 6) AS auc FROM ({_auc_sql('tox_preds')})", toxic=True)
ORACLE["roc_points"] = _pipeline_sql(f"""
SELECT round(score, 6) AS threshold, round({_sd('N - neg_lt', 'N')}, 6) AS fpr, round({_sd('P - pos_lt', 'P')}, 6) AS tpr
FROM ({_ranks_sql('tox_preds')})
UNION ALL SELECT CAST(NULL AS DOUBLE), 0.0, 0.0""", toxic=True)

_CMP = """
all_preds AS (SELECT 'naive_bayes' AS model, msg_id, label, round(p, 12) AS p, prediction FROM c_pred
              UNION ALL SELECT 'naive_bayes_lemma_stem', msg_id, label, round(p, 12), prediction FROM l_pred),
cmp AS (SELECT k.model, k.tp, k.fp, k.fn, k.tn, a.auc FROM ({counts}) k JOIN ({auc}) a ON k.model = a.model)"""
_CMP = _CMP.format(counts=_counts_sql("all_preds", "model"), auc=_auc_sql("all_preds", "model"))
_CMP_COLS = f"model, {PRF.replace(', CAST(tp + fp + fn + tn AS BIGINT) AS n', '')}, round(auc, 6) AS auc, CAST(tp + fp + fn + tn AS BIGINT) AS n"
ORACLE["compare_models"] = _pipeline_sql(f"SELECT {_CMP_COLS} FROM cmp", es=True, es_ls=True).replace(
    "\nSELECT " + _CMP_COLS, "," + _CMP + "\nSELECT " + _CMP_COLS)
ORACLE["best_model"] = _pipeline_sql(f"""SELECT {_CMP_COLS} FROM cmp
ORDER BY {_sd('tp + tn', 'tp + fp + fn + tn')} DESC, CASE model WHEN 'naive_bayes' THEN 0 ELSE 1 END LIMIT 1""",
                                     es=True, es_ls=True).replace("\nSELECT " + _CMP_COLS, "," + _CMP + "\nSELECT " + _CMP_COLS)
ORACLE["softmax"] = _pipeline_sql("SELECT msg_id, round(1.0 / (1.0 + exp(jll0 - jll1)), 6) AS p FROM c_jll", es=True)
ORACLE["argmax"] = _pipeline_sql(
    "SELECT msg_id, CAST(CASE WHEN jll1 > jll0 THEN 1 ELSE 0 END AS BIGINT) AS prediction FROM c_jll", es=True)
ORACLE["logit_metrics"] = _pipeline_sql(f"""SELECT {PRF} FROM ({_counts_sql(
    "(SELECT label, CASE WHEN jll1 > jll0 THEN 1 ELSE 0 END AS prediction FROM c_jll)")})""", es=True)
ORACLE["verdict"] = _pipeline_sql(f"""
SELECT msg_id, CASE WHEN p >= {VERDICT_CUTS[1]} THEN 'fraud' WHEN p >= {VERDICT_CUTS[0]} THEN 'possible_spam'
                    ELSE 'legit' END AS verdict FROM tox_preds""", toxic=True)


# ---- G: augmentation --------------------------------------------------------------------
cte("es_msgs", """
SELECT d.doc_id AS msg_id, d.text AS message, CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang = 'es'""")
cte("en_msgs", """
SELECT d.doc_id AS msg_id, d.text AS message, CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang = 'en'""")
# ``attempts``: G1 and G2 take candidate j modulo the number of candidates in attempt j.
def bt_cte(name: str, attempts: int) -> None:
    cte(name, f"""
SELECT e.msg_id, t2.options[(r.j % len(t2.options)) + 1] AS message, e.label
FROM es_msgs e CROSS JOIN (SELECT unnest(range({attempts})) AS j) r
JOIN options t1 ON t1.src_lang = 'es' AND t1.tgt_lang = 'en' AND t1.text_in = e.message
JOIN options t2 ON t2.src_lang = 'en' AND t2.tgt_lang = 'es' AND t2.text_in = t1.options[(r.j % len(t1.options)) + 1]""",
        ("es_msgs", "options"))


def en2es_cte(name: str, attempts: int) -> None:
    cte(name, f"""
SELECT msg_id, message, label FROM (
  SELECT e.msg_id, e.label, unnest(list_distinct(list_transform(range({attempts}),
    lambda j: t.options[(j % len(t.options)) + 1]))) AS message
  FROM en_msgs e JOIN options t ON t.src_lang = 'en' AND t.tgt_lang = 'es' AND t.text_in = e.message)""",
        ("en_msgs", "options"))


bt_cte("bt1", 1)
bt_cte("bt2", 2)
en2es_cte("en2es", 1)
en2es_cte("en2es_3", 3)
ORACLE["backtranslate"] = with_ctes("SELECT msg_id, message, label FROM bt2", "bt2")
ORACLE["translate_distinct"] = with_ctes("SELECT msg_id, message, label FROM en2es_3", "en2es_3")
ORACLE["augment_union"] = with_ctes("""
SELECT message, label, 'original_es' AS aug_type FROM es_msgs
UNION ALL SELECT message, label, CAST(NULL AS VARCHAR) FROM bt1
UNION ALL SELECT message, label, CAST(NULL AS VARCHAR) FROM en2es""", "es_msgs", "bt1", "en2es")
ORACLE["augment_counts"] = with_ctes("""
SELECT 'originals' AS kind, CAST(count(*) AS BIGINT) AS n FROM es_msgs
UNION ALL SELECT 'bt', count(*) FROM bt1
UNION ALL SELECT 'en2es', count(*) FROM en2es""", "es_msgs", "bt1", "en2es")

ORACLE["soft_vote"] = _pipeline_sql("""
SELECT msg_id, CAST(label AS BIGINT) AS label, round(avg(p), 6) AS p,
       CAST(CASE WHEN avg(p) > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction
FROM (SELECT msg_id, label, round(p, 12) AS p FROM c_pred UNION ALL SELECT msg_id, label, round(p, 12) FROM l_pred)
GROUP BY msg_id, label""", es=True, es_ls=True)
ORACLE["text_preprocessor_ml"] = f"""
SELECT doc_id AS msg_id, array_to_string({tokens_sql(clean_after_urls_sql(f"regexp_replace(text, {q(URL_RE)}, {q(URL_TRUSTED_TOKEN)}, 'g')"))}, ' ') AS message
FROM documents"""
cte("ml_clean", ORACLE["text_preprocessor_ml"])
cte("porter_ml", porter_sql(f"(SELECT unnest({tokens_sql('message')}) AS word FROM ml_clean)"), ("ml_clean",))
ORACLE["text_preprocessor_ml_stem"] = _with_steps(*lookup_sql("ml_clean", False, True, stem_table="porter_ml"))


# ---- H11, L1-L3 ---------------------------------------------------------------------------
ORACLE["batch_score"] = with_ctes("""
SELECT msg_id, round(1.0 / (1.0 + exp(-(0.01 * length(message) - 2.0))), 6) AS p,
       CAST(CASE WHEN 1.0 / (1.0 + exp(-(0.01 * length(message) - 2.0))) >= 0.5 THEN 1 ELSE 0 END AS BIGINT)
         AS prediction
FROM prep_es""", "prep_es")
ORACLE["stream_blocklist"] = """
SELECT event_id, user_id, event_type FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value >= 300)"""
ORACLE["feedback_merge"] = """
SELECT l.doc_id AS msg_id, CAST(coalesce(f.label, l.toxic) AS BIGINT) AS label,
       CASE WHEN f.label IS NOT NULL THEN 'feedback' ELSE 'original' END AS source
FROM labels l LEFT JOIN (
  SELECT msg_id, label FROM (
    SELECT user_id AS msg_id, CASE WHEN value > 100 THEN 1 ELSE 0 END AS label,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE event_type = 'click') WHERE rn = 1) f ON l.doc_id = f.msg_id"""
ORACLE["feedback_upsert"] = """
SELECT user_id AS msg_id, CAST(CASE WHEN value > 100 THEN 1 ELSE 0 END AS BIGINT) AS label
FROM events WHERE event_type = 'click' AND user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
STREAM_CUTS = (0.3, 0.7)
# L1: every document id once, scored by the model fitted on the train part.
ORACLE["stream_score"] = _pipeline_sql(f"""
SELECT j.msg_id, CAST(j.label AS BIGINT) AS label, round(1.0 / (1.0 + exp(j.jll0 - j.jll1)), 6) AS p,
       CAST(CASE WHEN j.jll1 > j.jll0 THEN 1 ELSE 0 END AS BIGINT) AS prediction,
       CASE WHEN 1.0 / (1.0 + exp(j.jll0 - j.jll1)) >= {STREAM_CUTS[1]} THEN 'fraud'
            WHEN 1.0 / (1.0 + exp(j.jll0 - j.jll1)) >= {STREAM_CUTS[0]} THEN 'possible_spam' ELSE 'legit' END AS verdict
FROM (SELECT t.msg_id, t.label, pr.pr0 + coalesce(s.s0 / sqrt(s.s2), 0.0) AS jll0,
             pr.pr1 + coalesce(s.s1 / sqrt(s.s2), 0.0) AS jll1
      FROM prep_es t LEFT JOIN sc_s s ON t.msg_id = s.msg_id, c_prior pr) j""", es=True).replace(
    "\nSELECT j.msg_id", f""",
sc_tf AS ({tf_sql('prep_es')}),
sc_s AS (SELECT t.msg_id, sum((t.tf * l.idf) * (t.tf * l.idf)) AS s2, sum(t.tf * l.idf * l.lp0) AS s0,
                sum(t.tf * l.idf * l.lp1) AS s1 FROM sc_tf t JOIN c_lp l ON t.term = l.term GROUP BY t.msg_id)
SELECT j.msg_id""", 1)


# ---- H2-H9: solvers. Their numbers have no closed form: the queries compare each result
# with an independent statement (see solver_checks), which must hold for every test row.
_AGREES = "SELECT msg_id, CAST(label AS BIGINT) AS label, TRUE AS agrees FROM c_test"
for _name in ("lr_fit", "svm_platt", "forest", "ensemble_fit"):
    ORACLE[_name] = _pipeline_sql(_AGREES, es=True)
ORACLE["compare_ml"] = _pipeline_sql("""
SELECT m.model, (SELECT count(*) FROM c_test) AS n, TRUE AS agrees
FROM (SELECT unnest(['random_forest', 'logistic_regression', 'naive_bayes', 'svm']) AS model) m""", es=True)
ORACLE["best_of_four"] = _pipeline_sql("""
SELECT CAST(4 AS BIGINT) AS n_models, count(*) AS n, TRUE AS is_best, TRUE AS is_saved, TRUE AS scores_again FROM c_test""",
                                       es=True)
# The refit learns from all rows and scores them: the closed form with train = test = all.
cte("all_es", "SELECT *, 'train' AS split FROM prep_es UNION ALL SELECT *, 'test' FROM prep_es", ("prep_es",))
ORACLE["production_refit"] = sql_with_split(
    ("all_es",), classic_ctes("c", "prep_es").replace(split_ctes("c", "prep_es", 0.3, 42) + ",\n", "\n")
    .replace("c_split", "all_es"), """
SELECT msg_id, CAST(label AS BIGINT) AS label, round(p, 6) AS p, CAST(prediction AS BIGINT) AS prediction,
       CAST(0.429 AS DOUBLE) AS threshold FROM c_pred""")
ORACLE["production_refit_svm"] = with_ctes("""
SELECT msg_id, CAST(label AS BIGINT) AS label, TRUE AS agrees, CAST(0.429 AS DOUBLE) AS threshold FROM prep_es""", "prep_es")
ORACLE["evaluate_saved"] = (_pipeline_sql("SELECT 1 AS one", es=True)[:-len("\nSELECT 1 AS one")] + ",\n"
                            + "tox_preds AS (SELECT label, prediction FROM c_pred)\n"
                            + ORACLE["class_report"][ORACLE["class_report"].rindex("\nSELECT class"):])
ORACLE["text_preprocessor_ml_urls"] = with_ctes(f"""
SELECT msg_id, array_to_string({tokens_sql(clean_after_urls_sql('message'))}, ' ') AS message FROM url_tok""", "url_tok")

ORACLE["csv_roundtrip"] = with_ctes("""
SELECT msg_id, message, label FROM messages
WHERE message NOT IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND',
                      '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')""", "messages")


# ---- E1 by expressions: canonical forms of the spelt URLs, joined on the expressions themselves.
ORACLE["url_reputation_prefix"] = r"""
WITH parts AS (SELECT *, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
    regexp_extract(url, '^https?://[^/]+(/.*)$', 1) AS rest, regexp_extract(url, '^https?://[^/]+/([^/]*)/', 1) AS folder,
    regexp_extract(url, '^https?://[^/]+/[^/]*/(.*)$', 1) AS tail
  FROM pages),
spelt AS (
  SELECT DISTINCT CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN upper(scheme || '://' || host) || rest
    WHEN 2 THEN scheme || '://user:pass@' || host || '.:8080/' || folder || '/' || tail
    WHEN 3 THEN scheme || '://' || host || '/%2e/x/../%25%33%37%2F..%2f' || folder || '/' || tail
    ELSE scheme || '://' || host || '//' || folder || '//' || tail || '#frag#ment' END AS url
  FROM parts),
bare AS (SELECT url, regexp_replace(url_decode(url_decode(regexp_replace(url, '#.*$', ''))), '^[a-zA-Z]+://', '') AS u FROM spelt),
cut AS (
  SELECT url, trim(lower(regexp_replace(regexp_replace(regexp_extract(u, '^([^/?]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '.') AS host,
    string_split(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/') AS segments, regexp_extract(u, '^[^?]*(\?.*)$', 1) AS query
  FROM bare),
walked AS (
  SELECT *, string_split(host, '.') AS labels, list_reduce(list_prepend([]::VARCHAR[], list_transform(segments, lambda s: [s])), lambda acc, s:
    CASE WHEN s[1] IN ('', '.') THEN acc WHEN s[1] = '..' THEN acc[1:len(acc) - 1] ELSE list_concat(acc, s) END) AS names
  FROM cut),
canonical AS (
  SELECT *, '/' || array_to_string(names, '/') || CASE WHEN segments[-1] IN ('', '.', '..') AND len(names) > 0 THEN '/' ELSE '' END AS path FROM walked),
folders AS (SELECT *, list_filter(string_split(regexp_replace(path, '[^/]*$', ''), '/'), lambda s: s <> '') AS inner_names FROM canonical),
hosts AS (
  SELECT *, unnest(list_concat([host], list_transform(range(greatest(2, len(labels) - 4), least(greatest(2, len(labels) - 4) + 4, len(labels))),
    lambda k: array_to_string(labels[k:], '.')))) AS h
  FROM folders),
expressions AS (
  SELECT DISTINCT url, h || unnest(list_concat([path, path || query], list_transform(range(0, least(3, len(inner_names)) + 1),
    lambda k: '/' || array_to_string(list_transform(inner_names[1:k], lambda s: s || '/'), '')))) AS expression
  FROM hosts),
listed AS (
  SELECT host || '/' || folder || '/' AS expression, 'MALWARE' AS threat_type FROM parts WHERE page_id % 13 = 0
  UNION SELECT CASE WHEN len(string_split(host, '.')) > 3 THEN regexp_replace(host, '^[^.]+\.', '') ELSE host END || '/', 'SOCIAL_ENGINEERING'
  FROM parts WHERE page_id % 17 = 0
  UNION SELECT host || regexp_replace(rest, '#.*$', ''), 'UNWANTED_SOFTWARE' FROM parts WHERE page_id % 3 = 0)
SELECT DISTINCT url, threat_type FROM expressions JOIN listed USING (expression)"""
