"""Transliteration by rule of scripts that are written in syllables (inventory C3).

Hangul syllables are numbers: (lead * 21 + vowel) * 28 + tail, so three short tables and a
division give every one of them. Kana are syllables of a regular table; a sign and the small
ya, yu or yo after it are one syllable, a small tsu doubles the consonant that follows,
and a length mark repeats nothing. The characters of a text are looked at with their
neighbours, so the longest match wins. Only texts with such characters are taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short names of the Hangul letters, in the order of their code points.
HANGUL_LEADS = "g gg n d dd r m b bb s ss - j jj c k t p h".replace("-", "").split(" ")
HANGUL_VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split(" ")
HANGUL_TAILS = " g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split(" ")
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3

# The kana from U+3041 (hiragana; katakana lie 0x60 above) in the order of their code points.
KANA = ("a a i i u u e e o o ka ga ki gi ku gu ke ge ko go sa za shi ji su zu se ze so zo ta da chi ji tsu tsu zu te de to do "
        "na ni nu ne no ha ba pa hi bi pi fu bu pu he be pe ho bo po ma mi mu me mo ya ya yu yu yo yo ra ri ru re ro wa wa wi we wo n vu").split(" ")
KANA_FIRST, KATAKANA_FIRST = 0x3041, 0x30A1
SMALL_TSU, LENGTH_MARK = 0x3063 - KANA_FIRST, "ー"
#: Small ya, yu, yo, and the vowel that they put in the place of an i.
GLIDES = {0x3083 - KANA_FIRST: "a", 0x3085 - KANA_FIRST: "u", 0x3087 - KANA_FIRST: "o"}

_HANGUL = "[가-힣]"
_KANA = "[ぁ-ゔァ-ヴ]"


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def hangul(text: Column) -> Column:
    """Hangul syllables as their letters' short names; all else as it is."""
    def one(c: Column) -> Column:
        k = F.ascii(c) - HANGUL_FIRST
        name = F.concat(F.get(_strings(HANGUL_LEADS), F.floor(k / 588).cast("int")),
                        F.get(_strings(HANGUL_VOWELS), F.floor(F.pmod(k, F.lit(588)) / 28).cast("int")),
                        F.get(_strings(HANGUL_TAILS), F.pmod(k, F.lit(28)).cast("int")))
        return F.when(k.between(0, HANGUL_LAST - HANGUL_FIRST), name).otherwise(c)

    return F.when(text.rlike(_HANGUL), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


def kana(text: Column) -> Column:
    """Kana in Hepburn spelling; all else as it is."""
    chars = F.split(F.regexp_replace(text, f"(?<={_KANA}){LENGTH_MARK}+", ""), "")

    def place(c: Column) -> Column:
        """The number of a sign in the table; null for what is no kana."""
        k = F.ascii(c)
        k = F.when(k >= KATAKANA_FIRST, k - KATAKANA_FIRST).otherwise(k - KANA_FIRST)
        return F.when(c.rlike(_KANA), k.cast("int"))

    def glides(k: Column) -> Column:
        return F.coalesce(k.isin(list(GLIDES)), F.lit(False))

    # signs that end in i, without it: "ky" but "sh"
    stems = [None if not s.endswith("i") or s in ("i", "wi") else s[:-1] + ("" if s[:-1] in ("sh", "ch", "j") else "y") for s in KANA]
    vowels = [GLIDES.get(k) for k in range(len(KANA))]

    def one(c: Column, i: Column) -> Column:
        k, after, before = place(c), place(F.get(chars, i + 1)), place(F.when(i > 0, F.get(chars, i - 1)))
        plain, stem = F.get(_strings(KANA), k), F.get(_strings(stems), k)
        joined = F.get(_strings(stems), before).isNotNull()
        next_name = F.get(_strings(KANA), after)
        doubled = F.when(next_name.startswith("ch"), "t").when(next_name.rlike("^[^aeioun]"), F.substring(next_name, 1, 1)).otherwise("")
        return F.when(k.isNull(), c).when(k == SMALL_TSU, F.coalesce(doubled, F.lit(""))) \
            .when(glides(k) & joined, F.get(_strings(vowels), k)).when(glides(after) & stem.isNotNull(), stem).otherwise(plain)

    return F.when(text.rlike(_KANA), F.array_join(F.transform(chars, one), "")).otherwise(text)


def syllables(text: Column) -> Column:
    """Hangul and kana by rule."""
    return kana(hangul(text))
