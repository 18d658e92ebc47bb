"""Phrase collocations by SETM relational mining.

Texts are cut into pieces at punctuation and line ends, pieces into words. The
relation R1 has a row (place, word) per occurrence, sorted by place: pieces lie one
after the other with a gap between them, so place and place + 1 are the same piece at
adjacent positions. The relation of a length is the merge-join of the one before
with R1 on piece and adjacent position; its groups are counted, and it is semi-joined with the
frequent groups before the next length extends it. A group of length k + 1 is the
id of its frequent first k words and the id of its last word.

Relations are persisted block by block (``BLOCK_BYTES`` of text, whole texts): a
block's rows are in one place, so the merge-join needs no shuffle. What is shuffled
are the distinct groups of each block with their counts. A window per group adds them
up and names the group after its first (block, code); the blocks of frequent groups
get these names back, and that is the semi-join. A group has one row per
block at most, whatever its occurrences, so a frequent word or line is no hot key.

Scores and limits are exact: products are decimals of 38 digits.

Defined cases: a null or empty text has no words; a null language is ``und``; a null id
or repeated rows make no difference (every row counts); an empty table gives no
rows; further columns are ignored; ties are broken by the phrase in byte order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from smishlens.llm.arrow_text import chunks, pack_numbers, release, text_bytes, unpack_numbers
from smishlens.session import drop_table, shared_table

#: Text of a block, text that is split at a time, groups in an Arrow batch.
BLOCK_BYTES = 16 << 20
CHUNK_BYTES = 2 << 20
ROWS = 100_000
#: Parts of a language's phrases that are ranked apart before all are.
PARTS = 64
#: A block's number is the task's, shifted by this, and the block's in the task.
TASK_BITS = 11

UNKNOWN = "und"

_SPACE, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _BREAK


def split_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, the text of each, its place) of all texts, A-Z in lower case. Places ascend by one within a
    piece, and by two from one piece to the next."""
    data, bounds = text_bytes(pc.ascii_lower(texts))
    kind = _KIND[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = kind == 0
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    starts_text = bounds[:-1][np.diff(bounds) > 0]
    first[starts_text] = inside[starts_text]
    start = np.flatnonzero(first)
    text = np.searchsorted(bounds, start, side="right") - 1
    kept = inside[:-1]
    ends = np.append(np.searchsorted(np.flatnonzero(kept), start), kept.sum()).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[kept])])
    breaks = np.cumsum(kind == _BREAK, dtype=np.int32)[start]
    new = np.ones(len(start), np.int32)
    new[1:] += (np.diff(breaks) > 0) | (np.diff(text) > 0)
    return words.cast(pa.large_string()), text, np.cumsum(new, dtype=np.int32)


def _distinct(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, n) of the distinct pairs in ascending order, and the number of each row's pair."""
    width = int(right.max()) + 1 if len(right) else 1
    pair, code, n = np.unique(left * width + right, return_inverse=True, return_counts=True)
    return pair // width, pair % width, n, code


# a row is a block's relations, or the numbers of a group in a block (``block`` null there)
_PLACES = "block long, n long, place binary, item binary"
_WORDS = f"{_PLACES}, lang string, word string, at long, times long"
# R1, and from two words on the relation of the words before the last
_GROUPS = f"{_PLACES}, ids array<long>, n_before long, place_before binary, item_before binary, left long, right long, at long, times long"


def _layout(columns: str) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(columns))


def _batch(layout: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in layout], schema=layout)


def occurrences(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """The relation R1 of every block, and per block the distinct (lang, word) with their counts."""
    layout = _layout(_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        words: list[pa.Array] = []
        langs: list[pa.Array] = []
        places: list[np.ndarray] = []
        size = 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            task = TaskContext.get().partitionId()
            if number >> TASK_BITS or task >> (31 - TASK_BITS):
                raise ValueError("too many blocks or tasks: raise spark.sql.files.maxPartitionBytes, or BLOCK_BYTES")
            own = (task << TASK_BITS) + number
            word = pa.chunked_array(words).unify_dictionaries().combine_chunks()
            language = pa.chunked_array(langs).unify_dictionaries().combine_chunks()
            words.clear(), langs.clear()
            n_words = max(len(word.dictionary), 1)
            pair = language.indices.to_numpy() * np.int64(n_words)
            pair += word.indices.to_numpy()
            word, language = word.dictionary, language.dictionary
            coded = pa.array(pair).dictionary_encode()
            code, pair = coded.indices.to_numpy(), coded.dictionary.to_numpy()
            times = np.bincount(code, minlength=len(pair))
            # adjacent chunks are two pieces
            place = np.concatenate(places)
            places.clear()
            yield _batch(layout, 1, block=[own], n=[len(place)], place=[pack_numbers(np.diff(place, prepend=0))], item=[pack_numbers(code)])
            del place, code, coded
            for at in range(0, len(pair), ROWS):
                part = pair[at:at + ROWS]
                yield _batch(layout, len(part), lang=language.take(pa.array(part // n_words)).cast(pa.string()),
                             word=word.take(pa.array(part % n_words)).cast(pa.string()),
                             at=(own << 32) + at + np.arange(len(part)), times=times[at:at + ROWS])
            number, size = number + 1, 0
            release()

        for batch in batches:
            of = pc.fill_null(batch.column(1), UNKNOWN).cast(pa.large_string()).dictionary_encode()
            for at, texts in chunks(batch.column(0), CHUNK_BYTES):
                found, row, place = split_pieces(texts)
                length = int(pc.sum(pc.binary_length(texts)).as_py() or 0)
                if size and size + length > BLOCK_BYTES:
                    yield from block()
                size += length
                if len(found):
                    words.append(found.dictionary_encode())
                    langs.append(of.take(pa.array(at + row)))
                    places.append(place + (places[-1][-1] + 1 if places else 0))
        if words:
            yield from block()

    return shared_table(docs.select(text, lang).mapInArrow(run, _WORDS), "occurrences")


def frequent(asked: DataFrame, key: list[str], least: int) -> DataFrame:
    """(key, at, id, total) of the groups with ``least`` occurrences in all, a row for each block that has
    one. The id is the smallest ``at`` (block and code), so the row where both are equal is the group's own."""
    same = Window.partitionBy(*key)
    counted = asked.select(*key, "at", F.sum("times").over(same).alias("total"), F.min("at").over(same).alias("id"))
    return shared_table(counted.filter(F.col("total") >= least), "frequent")


def _answers(groups: DataFrame) -> DataFrame:
    return groups.select(F.shiftright("at", 32).alias("of_block"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).alias("code"), "id")


def _semi_join(place: np.ndarray, code: np.ndarray, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows whose group is frequent, with codes anew: 0 .. in ascending order of the old ones; the ids by code."""
    known = answers["code"].to_numpy()
    by = np.argsort(known)
    known, ids = known[by], answers["id"].to_numpy()[by]
    if not len(known):
        return place[:0], code[:0], ids
    found = np.minimum(np.searchsorted(known, code), len(known) - 1)
    here = known[found] == code
    return place[here], found[here], ids


def _merge_join(place: np.ndarray, item: np.ndarray, word_place: np.ndarray, word: np.ndarray, length: int):
    """(place, left, right): occurrences of ``length`` words, and the word that follows in the piece."""
    at = np.searchsorted(word_place, place + length)
    found = at < len(word_place)
    found[found] = word_place[at[found]] == place[found] + length
    return place[found], item[found], word[at[found]]


def extend(before: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    """The relation of ``length`` + 1 words of every block: the one of ``length`` words, semi-joined with its frequent
    groups, merge-joined with R1. With it come the block's distinct groups (left id, right id) and counts.

    ``before`` has R1 with its words' codes (length 1), or what this function returned."""
    layout = _layout(_GROUPS)

    def run(blocks: pa.Table, found: pa.Table) -> Iterator[pa.RecordBatch]:
        for row in blocks.to_pylist():
            own, more = row["block"], {}
            place, item = np.cumsum(unpack_numbers(row["place"], row["n"])), unpack_numbers(row["item"], row["n"])
            if length == 1:
                place, item, ids = _semi_join(place, item, found)
                before, before_item, before_ids = place, item, ids
            else:
                ids = np.array(row["ids"], np.int64)
                if length == 2:
                    before, before_item = place, item
                else:
                    before = np.cumsum(unpack_numbers(row["place_before"], row["n_before"]))
                    before_item = unpack_numbers(row["item_before"], row["n_before"])
                # the groups of this length have the numbers that the pairs got when they were counted
                before, left, right = _merge_join(before, before_item, place, item, length - 1)
                before, before_item, before_ids = _semi_join(before, _distinct(left, right)[3], found)
                more = {"n_before": [len(before)], "place_before": [pack_numbers(np.diff(before, prepend=0))],
                        "item_before": [pack_numbers(before_item)]}
            _, left, right = _merge_join(before, before_item, place, item, length)
            left, right, times, _ = _distinct(left, right)
            yield _batch(layout, 1, block=[own], n=[len(place)], place=[pack_numbers(np.diff(place, prepend=0))], item=[pack_numbers(item)],
                         ids=[ids], **more)
            for at in range(0, len(left), ROWS):
                part = slice(at, at + ROWS)
                yield _batch(layout, len(left[part]), left=before_ids[left[part]], right=ids[right[part]],
                             at=(own << 32) + at + np.arange(len(left[part])), times=times[part])
        release()

    def one(blocks: pa.Table, found: pa.Table) -> pa.Table:
        return pa.Table.from_batches(run(blocks, found), layout)

    relations = before.filter("block is not null").drop("lang", "word", "left", "right", "at", "times")
    return shared_table(relations.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(one, _GROUPS), "relation")


def _score(a: str, first: str, rest: str) -> Column:
    """floor(1000000 * a * a / (first * rest)), exactly, of counts of 16 digits at most."""
    def whole(name: str) -> Column:
        return F.col(name).cast("decimal(16,0)")

    square = (whole(a) * whole(a) * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)")
    of = whole(first) * whole(rest)
    return ((square - square % of) / of).cast("long")


def _words_of(first: int, last: int) -> Column:
    """The words of ``phrase`` from one number to another, from 1."""
    return F.array_join(F.slice(F.split("phrase", " "), first, last - first + 1), " ")


def scored(phrases: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more, by the cut with the lowest score. ``phrases``:
    (lang, phrase, a) of 1, 2, .. words."""
    counts = reduce(DataFrame.unionByName, [p.select("lang", "phrase", "a") for p in phrases])
    cuts = [p.select("lang", "phrase", "a", F.lit(k).alias("cut"), _words_of(1, k).alias("first"), _words_of(k + 1, size).alias("rest"))
            for size, p in enumerate(phrases, 1) for k in range(1, size)]
    cuts = reduce(DataFrame.unionByName, cuts)
    for name, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(count)), ["lang", name])
    cuts = cuts.withColumn("score", _score("a", "l", "r"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def covered(phrases: list[DataFrame]) -> DataFrame:
    """(lang, phrase, longer): the most occurrences of a phrase one word longer that holds the phrase. Phrases that are
    longer still occur no more often."""
    inner = [p.select("lang", part.alias("phrase"), F.col("a").alias("longer"))
             for size, p in enumerate(phrases[2:], 3) for part in (_words_of(1, size - 1), _words_of(2, size))]
    if not inner:
        return phrases[0].select("lang", "phrase", F.col("a").alias("longer")).limit(0)
    return reduce(DataFrame.unionByName, inner).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 3, least: int = 10,
                 cover_percent: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``max_words`` words of every language.

    Phrases that occur fewer than ``least`` times are out, and those of whose occurrences one longer
    phrase accounts for ``cover_percent`` or more."""
    relation = occurrences(docs, text, lang)
    asked = relation.filter("at is not null")
    sizes = asked.groupBy("lang").agg(F.sum("times").alias("n"))
    groups = frequent(asked, ["lang", "word"], least)
    phrases = [groups.filter("at = id").select("id", "lang", F.col("word").alias("phrase"), F.col("total").alias("a"))]
    words = phrases[0].select(F.col("id").alias("right"), F.col("phrase").alias("last"))
    for length in range(1, max_words):
        before, relation = relation, extend(relation, _answers(groups), length)
        if length > 1:  # the words' own table also has the sizes of the languages
            drop_table(before)
        groups = frequent(relation.filter("at is not null"), ["left", "right"], least)
        before = phrases[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("start"))
        longer = groups.filter("at = id").select("id", "left", "right", F.col("total").alias("a"))
        longer = longer.join(before, "left").join(words, "right")
        phrases.append(shared_table(longer.select("id", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "a"), "phrases"))
    found = scored(phrases).join(covered(phrases), ["lang", "phrase"], "left") \
        .filter(F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("a")))
    # the first of each language are among the first of its parts, so the last window has PARTS * top rows at most
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    parts = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    parts = parts.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    first = parts.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return first.join(sizes, "lang") \
        .select("lang", "rank", "phrase", "a", "l", "r", F.col("n").cast("long").alias("n"), "score")
