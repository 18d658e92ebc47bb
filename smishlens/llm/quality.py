"""Quality rules from within-text repetition, found with suffix arrays.

The words of many texts are sorted as suffixes in one array by prefix doubling:
a suffix ends with its text, and words of different texts never compare equal,
so every repeat found lies within one text. Ranks of every third doubling round are
kept, and the longest common prefix (LCP) of neighbours in the suffix array is
read off them. The largest LCP at a suffix is the LCP interval it belongs to,
i.e. the longest substring that starts there and occurs again; those that no
repeat starting one word earlier contains are the maximal repeated substrings.
Their spans are united; a text fails when they cover too large a share of its
bytes, or when one of them is too long.

Defined cases: a null or blank text has no words, every count is 0, the base
rule (too few words) rejects it. Rows are judged one by one, so ties, repeated
rows, empty tables and further columns have no influence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smishlens.llm.arrow_text import as_array, chunks, release, row_sums, split_words, text_bytes

#: A repeat counts from this many words on.
MIN_REPEAT_WORDS = 8
#: Base rule: fewest words, and largest percentage of repeated words.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: The method's verdict: largest share of a text's word bytes inside maximal
#: repeats, and longest single repeat in words.
MAX_COVERED = 0.3
MAX_LONGEST = 200

SYMBOLS = "#*$%&|<>"
#: Of the rounds of prefix doubling, the ranks of one in so many are kept for the common prefixes.
KEPT_ROUNDS = 3
CHUNK_BYTES = 4 << 20

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_repeats long, longest_repeat long, covered_share double, base_failed boolean, kept boolean")


def longest_repeats(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For every position the length in words of the longest substring that
    starts there and occurs at another position of the same text (0: none).

    ``words``: word numbers of all texts one after the other; ``counts``: words
    per text. Repeats may overlap. Ranks are 32-bit numbers, and of the doubling rounds every
    ``KEPT_ROUNDS``-th is kept, so memory is some 100 bytes per word."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int32)
    left = np.repeat(np.cumsum(counts), counts).astype(np.int32) - np.arange(n, dtype=np.int32)  # words up to the text's end
    key = np.repeat(np.arange(len(counts)) * (int(words.max()) + 1), counts)
    key += words
    suffixes = np.argsort(key, kind="stable").astype(np.int32)  # the suffix array, sorted by the first 2**k words so far
    key = key[suffixes]
    head = np.ones(n, bool)
    head[1:] = key[1:] != key[:-1]
    del key
    # the first word of neighbours is the same where no new group starts
    same_word = np.flatnonzero(~head).astype(np.int32)
    rank = np.empty(n, np.int32)
    rank[suffixes] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), 0))
    kept = [rank.copy()]
    step = rounds = 1
    while True:
        # places of the array whose neighbours still tie
        tied = ~head
        tied[:-1] |= ~head[1:]
        place = np.flatnonzero(tied).astype(np.int32)
        del tied
        if len(place) == 0:
            break
        at = suffixes[place]
        group = rank[at].astype(np.int64) * (n + 1)
        group += np.where(left[at] > step, rank[np.minimum(at + np.int32(step), n - 1)] + 1, 0)
        sort = np.argsort(group, kind="stable")
        at, group = at[sort], group[sort]
        del sort
        suffixes[place] = at
        first = np.ones(len(at), bool)
        first[1:] = group[1:] != group[:-1]
        del group
        rank[at] = np.maximum.accumulate(np.where(first, place, 0))
        head[place] = first
        step *= 2
        if rounds % KEPT_ROUNDS == 0:
            kept.append(rank.copy())
        rounds += 1
    del rank, head
    # LCP of neighbours: by the lengths of the kept rounds from the largest down, as often as the ranks agree
    a, b = suffixes[same_word - 1], suffixes[same_word]
    del suffixes, same_word
    lcp = np.zeros(len(a), np.int32)
    while kept:
        ranks, length = kept.pop(), 1 << (KEPT_ROUNDS * len(kept))
        here = np.arange(len(a), dtype=np.int32)
        while len(here):
            x, y = a[here] + lcp[here], b[here] + lcp[here]
            inside = (lcp[here] < left[a[here]]) & (lcp[here] < left[b[here]])
            here = here[inside & (ranks[np.minimum(x, n - 1)] == ranks[np.minimum(y, n - 1)])]
            lcp[here] += length
    out = np.zeros(n, np.int32)
    np.maximum.at(out, a, lcp)
    np.maximum.at(out, b, lcp)
    return out


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in one of the spans."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def _duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(" \t\n\v\f\r"):
            seen.add(line)
    return n


def judge(texts: pa.Array, min_repeat: int, max_covered: float, max_longest: int) -> pa.StructArray:
    counts, words = split_words(texts)
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    repeat = longest_repeats(numbers, counts)
    repeat[repeat < min_repeat] = 0
    # maximal: not the tail of a repeat that starts one word earlier (in the same text)
    earlier = np.concatenate(([0], repeat[:-1]))
    earlier[bounds[:-1][counts > 0]] = 0
    spans = np.flatnonzero((repeat > 0) & (earlier <= repeat))
    inside = covered(spans, repeat[spans], len(numbers))
    n_inside = row_sums(inside, bounds).astype(np.int64)
    of_bytes = row_sums(size * inside, bounds) / np.maximum(row_sums(size, bounds), 1)
    maximal = np.zeros(len(numbers), bool)
    maximal[spans] = True
    longest = np.zeros(len(counts), np.int64)
    full = np.flatnonzero(counts)
    if len(full):
        longest[full] = np.maximum.reduceat(repeat, bounds[full])

    data, ends = text_bytes(texts)
    lut = np.zeros(256, np.uint8)
    lut[[ord(c) for c in SYMBOLS]] = 1
    symbols = row_sums(lut[data], ends).astype(np.int64)
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    # code points in words: bytes that start a code point and are no white space
    letters = row_sums(((data & 0xC0) != 0x80) & ~white[data], ends).astype(np.int64)
    dup = np.array([_duplicate_lines(t) if t else 0 for t in texts.to_pylist()], np.int64)

    base_failed = (counts < MIN_WORDS) | (100 * n_inside > MAX_REPEAT_PERCENT * counts)
    kept = ~base_failed & (of_bytes <= max_covered) & (longest <= max_longest)
    columns = [counts, letters, symbols, dup, n_inside, row_sums(maximal, bounds).astype(np.int64),
               longest, of_bytes, base_failed, kept]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in RESULT.split(", ")])


def repetition(text: Column, min_repeat: int = MIN_REPEAT_WORDS, max_covered: float = MAX_COVERED,
               max_longest: int = MAX_LONGEST) -> Column:
    """A struct column with the counts and the verdict of every text.

    With ``min_repeat`` 8, ``n_repeat_words`` (words inside repeats) is the number of
    words in 8-word windows that occur twice or more."""
    def apply(column: pa.Array) -> pa.Array:
        texts = as_array(column)
        parts = [judge(part, min_repeat, max_covered, max_longest) for _, part in chunks(texts, CHUNK_BYTES)]
        release()
        return pa.concat_arrays(parts) if parts else judge(texts, min_repeat, max_covered, max_longest)

    apply.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, RESULT).asNondeterministic()(text)


def quality_rules(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """``docs`` with a column ``repetition`` that replaces any of that name."""
    return docs.withColumn("repetition", repetition(F.col(text), **limits))


def keep_good(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns only."""
    verdict = "__repetition"
    return (docs.withColumn(verdict, repetition(F.col(text), **limits))
            .filter(F.col(f"{verdict}.kept")).drop(verdict))
