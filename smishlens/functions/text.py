"""Column functions for message text (inventory C1, C3-C6, C8, C12).

Everything here is a built-in Spark expression (regexp, translate, replace,
higher-order array functions), so it stays inside whole-stage codegen and runs
on the executors; no Python UDF is involved.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from smishlens.functions.transliterate import syllables

# Patterns of the reference's text cleaning.
#   URL     https?://\S+|www\.\S+   (case-sensitive; \S is Unicode-aware in Python,
#                                    hence the (?U) flag for Java)
#   PHONE   \b\d{10,}\b             -> ' PHONE_NUM '
#   PUNCT   [^\w\s]                 -> ' '
#   TOKEN   \b\w\w+\b               (vectoriser tokens)
URL_PATTERN = r"(?U)https?://\S+|www\.\S+"
PHONE_PATTERN = r"\b\d{10,}\b"
PHONE_TOKEN = " PHONE_NUM "
URL_SUSPICIOUS_TOKEN = " URL_SUSPICIOUS "
URL_TRUSTED_TOKEN = " URL_TRUSTED "
# Tokens are read from cleaned text, which is ASCII, so the ASCII classes are
# exact (and faster than the Unicode ones).
TOKEN_PATTERN = r"\b\w\w+\b"

# After folding the text is ASCII. Python's ASCII whitespace set is
# [\t\n\x0B\f\r\x1C-\x1F ]; Java's \s lacks \x1C-\x1F, so the class is spelt out.
WS_CLASS = r"\t\n\x0B\f\r\x1C-\x1F "
PUNCT_PATTERN = r"[^A-Za-z0-9_" + WS_CLASS + r"]"
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
STRIP_PATTERN = r"^[" + WS_CLASS + r"]+|[" + WS_CLASS + r"]+$"
SPLIT_PATTERN = r"[" + WS_CLASS + r"]+"
NON_ASCII_PATTERN = r"[^\x00-\x7F]"

# Transliterations of the accent folder for characters that the
# decomposition rule below does not give (a symbol that becomes N punctuation
# characters later becomes N blanks, so the lengths matter).
FOLD_LATIN = {
    "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "¦": "|", "§": "SS", "¨": '"', "©": "(c)",
    "ª": "a", "«": "<<", "¬": "!", "®": "(r)", "¯": "-", "°": "deg", "±": "+-", "²": "2", "³": "3",
    "´": "'", "µ": "u", "¶": "P", "·": "*", "¸": ",", "¹": "1", "º": "o", "»": ">>", "¼": " 1/4",
    "½": " 1/2", "¾": " 3/4", "¿": "?", "×": "x", "÷": "/",
    "Æ": "AE", "æ": "ae", "Ð": "D", "ð": "d", "Ø": "O", "ø": "o", "Þ": "Th", "þ": "th", "ß": "ss",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "q", "Ł": "L", "ł": "l", "Ŋ": "NG", "ŋ": "ng",
    "Œ": "OE", "œ": "oe", "Ŧ": "T", "ŧ": "t", "ſ": "s",
}
FOLD_PUNCTUATION = {
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "‖": "||", "‗": "_", "‘": "'", "’": "'",
    "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "‟": '"', "†": "+", "‡": "++", "•": "*", "‣": "*>",
    "․": ".", "‥": "..", "…": "...", "‧": ".", "‰": "%0", "′": "'", "″": "''", "‵": "`", "‹": "<", "›": ">",
    "※": "*", "‼": "!!", "⁄": "/", "€": "EUR", "−": "-",
}
FOLD_GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k",
    "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t",
    "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
FOLD_CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "io", "ж": "zh", "з": "z", "и": "i",
    "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t",
    "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": '"', "ы": "y",
    "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "ђ": "dj", "ѓ": "gj", "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j", "љ": "lj", "њ": "nj",
    "ћ": "tsh", "ќ": "kj", "ў": "u", "џ": "dzh", "ґ": "g'",
}
# Not in the reference: a letter or digit of a script without a table keeps its
# place as this letter, so a message in such letters is not blank.
FOLD_UNKNOWN = "x"


def _letters() -> dict[str, str]:
    """The letter tables with their upper case (first letter of the value upper-cased)."""
    table = {**FOLD_LATIN, **FOLD_PUNCTUATION}
    for lower in (FOLD_GREEK, FOLD_CYRILLIC):
        table.update(lower)
        table.update({k.upper(): v[0].upper() + v[1:] for k, v in lower.items() if k != "ς"})
    return table


def default_fold_table() -> dict[str, str]:
    """Character -> ASCII. The tables above, and by rule for Latin, Greek and
    Cyrillic letters, punctuation, letterlike and width forms: the parts of the
    compatibility decomposition, each folded; space separators are blanks."""
    table = _letters()
    for first, last in ((0x00A0, 0x0600), (0x1E00, 0x2400), (0x3000, 0x3001), (0xFF00, 0xFFF0)):
        for cp in range(first, last):
            ch = chr(cp)
            if ch in table:
                continue
            if unicodedata.category(ch) == "Zs":
                table[ch] = " "
                continue
            parts = unicodedata.normalize("NFKD", ch)
            folded = "".join(c if ord(c) < 128 else table.get(c, "") for c in parts)
            if folded and parts != ch:
                table[ch] = folded
    table["\u2028"] = "\n"
    table["\u2029"] = "\n"
    return table


def _fold(col: Column, table: dict[str, str], ascii_map: dict[str, str]) -> Column:
    """The fold of a text with non-ASCII characters: one ``translate`` for 1:1 pairs
    (and for ``ascii_map``), then ``replace`` for 1:n. Texts within Latin-1 and Latin
    Extended-A take a short chain. In the others, Hangul and kana are spelt by rule
    (:mod:`transliterate`), and letters and digits without an entry become ``FOLD_UNKNOWN``; what is left beyond ASCII (marks, pictographs)
    is removed. Each text runs through one of the two branches."""
    def chain(part: dict[str, str], col: Column = col) -> Column:
        one = {k: v for k, v in part.items() if len(v) == 1} | ascii_map
        many = {k: v for k, v in part.items() if len(v) != 1}
        out = whole = F.translate(col, "".join(one.keys()), "".join(one.values()))
        for k, v in sorted(many.items()):
            whole = F.replace(whole, F.lit(k), F.lit(v))
        # each replace reads the whole text: only texts with such a character, or one that becomes one, run through them
        starts = {k[0] for k in many if k} | {k for k, v in one.items() if any(m.startswith(v) for m in many)}
        return F.when(col.rlike("[" + "".join(f"\\x{{{ord(k):X}}}" for k in sorted(starts)) + "]"), whole).otherwise(out) if starts else out

    latin = chain({k: v for k, v in table.items() if ord(k) < 0x0180})
    full = F.regexp_replace(chain(table, syllables(col)), r"[\p{L}\p{N}&&[^\x00-\x7F]]", FOLD_UNKNOWN)
    return F.regexp_replace(F.when(col.rlike(r"[^\x00-\u017F]"), full).otherwise(latin), NON_ASCII_PATTERN, "")


def fold_accents(col: Column, table: dict[str, str] | None = None) -> Column:
    """Fold to ASCII; ASCII text is left as it is."""
    table = default_fold_table() if table is None else table
    return F.when(col.rlike(NON_ASCII_PATTERN), _fold(col, table, {})).otherwise(col)


def may_have_url(col: Column) -> Column:
    """A substring test that every text with a URL passes."""
    return col.contains("http://") | col.contains("https://") | col.contains("www.")


def extract_urls(col: Column) -> Column:
    """Array of URLs in order of appearance (trailing punctuation included)."""
    return F.regexp_extract_all(col, F.lit(URL_PATTERN), 0)


def split_on_urls(col: Column) -> Column:
    """Text pieces between URL matches; always ``size(urls) + 1`` pieces."""
    return F.split(col, URL_PATTERN, -1)


def mask_numbers(col: Column) -> Column:
    """C4: runs of >= 10 digits at word boundaries become ' PHONE_NUM '."""
    return F.regexp_replace(col, PHONE_PATTERN, PHONE_TOKEN)


def strip_punct(col: Column) -> Column:
    """Every character that is neither a word character nor blank -> ' '."""
    return F.regexp_replace(col, PUNCT_PATTERN, " ")


def lower_strip(col: Column) -> Column:
    """Lower case, strip outer whitespace (inner runs are kept)."""
    return F.regexp_replace(F.lower(col), STRIP_PATTERN, "")


# ASCII characters that C5 turns into a blank: neither word characters nor
# whitespace (printable punctuation and the remaining control characters).
ASCII_PUNCT = "".join(ch for ch in map(chr, range(128))
                      if not (ch.isalnum() or ch == "_" or ch in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "))


def _blank_punct(s: str) -> str:
    return "".join(" " if ch in ASCII_PUNCT else ch for ch in s)


def clean_after_urls(col: Column, fold_table: dict[str, str] | None = None) -> Column:
    """C3 -> C4 -> C5 -> C6, the part of ``clean_text`` after URL tokens.

    Same result as ``lower_strip(strip_punct(mask_numbers(fold_accents(x))))``
    in fewer passes: the accent table is composed with C5 (a folded character
    that is punctuation becomes a blank directly) and ASCII punctuation joins
    the same ``translate``. C5 may run before C4 because blanks and
    punctuation are both non-word characters for ``\\b`` and the number
    token holds no punctuation; C3's digits (e.g. superscripts) still come
    before C4."""
    table = default_fold_table() if fold_table is None else fold_table
    blanked = {k: _blank_punct(v) for k, v in table.items()}
    blanks = {ch: " " for ch in ASCII_PUNCT}
    plain = F.translate(col, "".join(blanks), " " * len(blanks))
    ascii_text = F.when(col.rlike(NON_ASCII_PATTERN), _fold(col, blanked, blanks)).otherwise(plain)
    # ASCII by now, so the ends can be trimmed without a regular expression over the text
    return F.btrim(F.lower(mask_numbers(ascii_text)), F.lit(WS_CHARS))


def is_blank(col: Column) -> Column:
    """B3 predicate: empty once outer whitespace is stripped."""
    return ~col.rlike(r"[^" + WS_CLASS + r"]")


def whitespace_tokens(col: Column) -> Column:
    """Whitespace tokenisation (runs collapse, no empty tokens)."""
    return F.filter(F.split(col, SPLIT_PATTERN, -1), lambda t: t != "")


def join_tokens(col: Column) -> Column:
    """Tokens joined with exactly one blank."""
    return F.array_join(col, " ")


def vectorizer_tokens(col: Column) -> Column:
    """Tokens of the TF-IDF vectoriser: lower-cased, >= 2 word characters."""
    return F.regexp_extract_all(F.lower(col), F.lit(TOKEN_PATTERN), 0)
