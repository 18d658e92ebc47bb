"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts, the last byte first, pretrained on all
training texts. A symbol is a byte or the end of the text; the symbol's probability
starts in the longest known context: a symbol seen there n times of N, beside d distinct ones,
has n / (N + d), and d / (N + d) escapes to the next shorter context
(method C), in which symbols seen in longer ones are excluded; what escapes
the empty context is shared evenly by the symbols left. Contexts do not cross the
start of a text, which is a context symbol of its own.

Every (context, symbol) of the whole training corpus is counted by Spark, and every
context counts. Those that hold at least one in ``CONTEXTS`` of all symbols,
so ``CONTEXTS`` of each order at most, are in a broadcast trie with probabilities
worked out once on the driver. Its size is known from counts before any of it is
collected; where it would pass ``TRIE_BYTES``, the share that a context must hold is
doubled until it does not. A symbol after any other context is looked up exactly: the
distinct (context, symbol) of all documents are joined with the counts, order by order
until the symbol is found, and then with the batches of documents that ask for them.
A context outside the trie is rare, so it is no hot key.

The base score is a unigram model over words (A-Z lower-cased, an end token per
text) with add-one smoothing over all training tokens. Words that hold at least
one in ``HEAVY`` of all tokens, so ``HEAVY`` words at most, are broadcast with
their counts; all other words of a text are looked up by one join on the
word, in which, being rare, no word is a hot key.

Defined cases: a null or blank text has its end only; a row with no id is in
training; with no training text every symbol has 1/257 and every token is
unknown; repeated rows are scored one by one; further columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from smishlens.llm.arrow_text import as_array, chunks, release, row_sums, split_words, text_bytes
from smishlens.session import _drop_folder, shared_table

#: Longest context in bytes, contexts per order, words in the broadcast table.
ORDER = 5
CONTEXTS = 1 << 17
#: Bytes of the broadcast trie at most.
TRIE_BYTES = 64 << 20
HEAVY = 1 << 21

SYMBOLS = 257  # bytes and the end of the text
END = 256
BITS = 9  # a context symbol: 0 for the start of the text, else byte + 1
#: Text counted at a time; grams and words that a task gathers before it adds them up, and keeps after that.
COUNT_BYTES = 1 << 20
MERGE_GRAMS, MERGE_WORDS = 600_000, 300_000
KEEP_GRAMS, KEEP_WORDS = 1_000_000, 500_000
SCORE_BYTES = 1 << 18
#: Text of the documents that ask for a (context, symbol) together, and (context, symbol) per row.
BATCH_BYTES = 32 << 20
LISTED = 100_000
WORD_BYTES = 2 << 20


def padded(data: np.ndarray, bounds: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other, each with ``order`` start marks before and the
    end symbol after it: (context symbols, symbols to predict with -1 at the
    marks, bounds in this layout)."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    new = np.concatenate(([0], np.cumsum(size + order + 1)))
    context = np.zeros(new[-1], np.int16)
    symbol = np.full(new[-1], -1, np.int16)
    place = np.arange(len(data)) + np.repeat(np.arange(n) * (order + 1) + order, size)
    context[place] = data + np.int16(1)
    symbol[place] = data
    symbol[new[1:] - 1] = END
    return context, symbol, new


def gram_keys(context: np.ndarray, symbol: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The (context, symbol) keys at some places of a :func:`padded` layout."""
    key = symbol[at].astype(np.int64)
    for j in range(1, order + 1):
        key |= context[at - j].astype(np.int64) << (BITS * j)
    return key


def packed(data: np.ndarray) -> bytes:
    # these bytes are written twice, with the scored rows and in the exchange that brings them to their answers
    return pa.Codec("zstd", compression_level=7).compress(data.tobytes(), asbytes=True) if len(data) else b""


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd"), np.uint8) if size else np.zeros(0, np.uint8)


def count_grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, symbol) keys of the texts and their counts. A key is the symbol
    with the context symbols above it, the last byte lowest."""
    context, symbol, _ = padded(*text_bytes(texts), order)
    key = symbol.astype(np.int64)
    for j in range(1, order + 1):
        key[j:] |= context[:-j].astype(np.int64) << (BITS * j)
    key = key[symbol >= 0]
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[:len(key)])
    return key[first], np.diff(np.append(first, len(key)))


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of distinct keys over all parts, by key."""
    key, n = (np.concatenate(x) for x in zip(*parts))
    by = np.argsort(key)
    key, n = key[by], n[by]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[:len(key)])
    return key[first], np.add.reduceat(n, first) if len(first) else n


def merge_words(parts: list[pa.Table]) -> pa.Table:
    """(word, n) of distinct words over all parts."""
    total = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return total.select(["word", "n_sum"]).rename_columns(["word", "n"]).combine_chunks()


def corpus_counts(docs: DataFrame, text: str, order: int) -> tuple[DataFrame, DataFrame, str]:
    """(word, n) and (gram, n) over all texts, and the folder that the second is read from. Both come from one pass; a task adds
    up its own grams, as long as they are few, before it sends them on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grams(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.nulls(len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                                              ["word", "gram", "n"])

        def words(table: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([as_array(table["word"]), pa.nulls(len(table), pa.int64()), as_array(table["n"])],
                                              ["word", "gram", "n"])

        own: list[tuple[np.ndarray, np.ndarray]] = []
        own_words: list[pa.Table] = []
        gathered = gathered_words = 0  # grams and words since they were last added up
        for batch in batches:
            for _, texts in chunks(batch.column(0), COUNT_BYTES):
                found = pc.value_counts(split_words(texts, lower=True)[1])
                own_words.append(pa.table({"word": found.field("values").cast(pa.string()), "n": found.field("counts")}))
                gathered_words += len(found)
                if gathered_words > MERGE_WORDS:
                    own_words, gathered_words = [merge_words(own_words)], 0
                    if len(own_words[0]) > KEEP_WORDS:
                        yield words(own_words.pop())
                own.append(count_grams(texts, order))
                gathered += len(own[-1][0])
                if gathered > MERGE_GRAMS:
                    own, gathered = [merge_counts(own)], 0
                    if len(own[0][0]) > KEEP_GRAMS:
                        yield grams(*own.pop())
                release()
        if own_words:
            yield words(merge_words(own_words))
        if own:
            yield grams(*merge_counts(own))

    # the partial counts are written once: words and grams are then added up apart
    partial = shared_table(docs.select(text).mapInArrow(run, "word string, gram long, n long"), "partial_counts")
    files = partial.inputFiles()
    words, grams = partial.filter("word is not null"), partial.filter("gram is not null")
    return (shared_table(words.groupBy("word").agg(F.sum("n").alias("n")), "word_counts"),
            grams.groupBy("gram").agg(F.sum("n").alias("n")), os.path.dirname(files[0]) if files else "")


@dataclass
class ByteTrie:
    """Lookup arrays of a fitted model (see :func:`build`)."""

    order: int
    context_class: np.ndarray  # context symbol -> column of the child tables
    symbol_class: np.ndarray  # symbol -> column of ``logs``
    children: list[np.ndarray]  # per level: (node of the level before + 1, class) -> node + 1
    bases: list[int]  # first row of ``logs`` of each level
    logs: np.ndarray  # log10 probability per (context, symbol class), float32

    def score(self, texts: pa.Array) -> np.ndarray:
        """log10 probability of every text, its end included."""
        return self.score_known(texts)[0]

    def score_known(self, texts: pa.Array, known_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of every text; the (context, symbol) keys of the symbols whose longest context is
        not in the trie, and a mark for each symbol of the texts that has one (``known_only``: these add nothing)."""
        context, symbol, bounds = padded(*text_bytes(texts), self.order)
        code = self.context_class[context]
        state = np.zeros(len(symbol), np.int32)
        node = np.ones(len(symbol), np.int32)
        for level, table in enumerate(self.children, 1):
            shifted = np.concatenate((np.zeros(level, code.dtype), code[:-level]))
            node = table.ravel()[node * table.shape[1] + shifted]
            state = np.maximum(state, np.where(node > 0, node + np.int32(self.bases[level] - 1), 0))
        width = self.logs.shape[1]
        value = self.logs.ravel()[state.astype(np.int64) * width + self.symbol_class[symbol]]
        value[symbol < 0] = 0
        open_ = (node == 0) & (symbol >= 0)
        if known_only:
            value[open_] = 0
        return row_sums(value, bounds), gram_keys(context, symbol, np.flatnonzero(open_), self.order), open_[symbol >= 0]


def build(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], order: int) -> ByteTrie:
    """The trie from ``levels[k]``: parallel arrays of context key, symbol and count of order k."""
    keys = [np.unique(context) for context, _, _ in levels]
    seen = np.unique(levels[0][1])
    symbol_class = np.full(SYMBOLS + 1, len(seen), np.int64)  # the last entry answers for -1
    symbol_class[seen] = np.arange(len(seen))
    if not len(keys[0]):
        keys[0] = np.zeros(1, np.int64)
    counts = []
    for own, (context, symbol, n) in zip(keys, levels):
        dense = np.zeros((len(own), len(seen)))
        dense[np.searchsorted(own, context), symbol_class[symbol]] = n
        counts.append(dense)

    used = np.unique(np.concatenate([keys[k] >> (BITS * (k - 1)) for k in range(1, order + 1)]))
    context_class = np.zeros(SYMBOLS, np.int32)
    context_class[used] = np.arange(1, len(used) + 1)
    children, bases, logs = [], [0], []
    for k in range(order + 1):
        # row of every shorter context at its level; a shorter context holds no less, so it is there
        above = [np.searchsorted(keys[j], keys[k] & ((1 << (BITS * j)) - 1)) for j in range(k)] + [np.arange(len(keys[k]))]
        for first in range(0, len(keys[k]), 2048):
            part = slice(first, first + 2048)
            logs.append(_logs([counts[j][above[j][part]] for j in range(k, -1, -1)]))
        if k:
            table = np.zeros((len(keys[k - 1]) + 1, len(used) + 1), np.int32)
            table[above[k - 1] + 1, context_class[keys[k] >> (BITS * (k - 1))]] = np.arange(1, len(keys[k]) + 1)
            children.append(table)
            bases.append(bases[-1] + len(keys[k - 1]))
    return ByteTrie(order, context_class, symbol_class, children, bases, np.concatenate(logs).astype(np.float32))


def _logs(counts: list[np.ndarray]) -> np.ndarray:
    """log10 probabilities from the counts in a context and in its shorter ones,
    longest first; the last column is any symbol seen nowhere."""
    n, width = counts[0].shape
    p, seen, escape = np.zeros((n, width)), np.zeros((n, width), bool), np.ones(n)
    for level in counts:
        own = np.where(seen, 0, level)
        seen |= own > 0
        total, distinct = own.sum(axis=1), (own > 0).sum(axis=1)
        distinct = np.where(seen.sum(axis=1) == SYMBOLS, 0, distinct)  # nothing is left to escape to
        whole = np.maximum(total + distinct, 1)
        p += (escape / whole)[:, None] * own
        escape = np.where(total > 0, escape * distinct / whole, escape)
    rest = escape / np.maximum(SYMBOLS - seen.sum(axis=1), 1)
    p = np.concatenate((np.where(seen, p, rest[:, None]), rest[:, None]), axis=1)
    return np.log10(np.maximum(p, 1e-300))


def contexts_that_fit(tables: list[DataFrame], n_symbols: int, contexts: int, trie_bytes: int) -> int:
    """``contexts``, or the largest of its halves, quarters .. with which the trie has ``trie_bytes`` at most."""
    choices = [contexts >> i for i in range(contexts.bit_length())]
    kept = [F.sum((F.col("total") >= -(-n_symbols // c)).cast("long")).alias(f"n{c}") for c in choices]
    sizes = reduce(DataFrame.unionByName, [t.select("total") for t in tables]).agg(*kept).first()
    seen = tables[0].select(F.explode("pairs.symbol").alias("symbol")).distinct().count()
    row = 4 * (2 * seen + 3)  # its probabilities, and its children
    return next((c for c in choices if (sizes[f"n{c}"] or 0) * row <= trie_bytes), choices[-1])


def fit_trie(grams: DataFrame, order: int, contexts: int, trie_bytes: int = TRIE_BYTES) -> tuple[ByteTrie, int, list[DataFrame]]:
    """The trie from the counted grams, the number of training texts, and per order the
    counts of the contexts that lookups need: (context, total, pairs of symbol and n)."""
    tables: list[DataFrame] = []
    # from the longest contexts down: each order's table is added up from the one before
    for k in range(order, -1, -1):
        if k < order:
            mask = (1 << (BITS * (k + 1))) - 1
            grams = tables[-1].select("context", F.explode("pairs").alias("of")).select(
                F.shiftleft("context", BITS).bitwiseOR(F.col("of.symbol")).bitwiseAND(F.lit(mask).cast("long")).alias("gram"),
                F.col("of.n").alias("n")).groupBy("gram").agg(F.sum("n").alias("n"))
        pairs = grams.select(F.shiftright("gram", BITS).alias("context"), F.col("gram").bitwiseAND(F.lit(511)).alias("symbol"), "n")
        # a context has 257 symbols at most
        tables.append(shared_table(pairs.groupBy("context").agg(
            F.sum("n").alias("total"), F.collect_list(F.struct("symbol", "n")).alias("pairs")), f"contexts_{k}"))
    tables.reverse()
    n_symbols = tables[0].agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    least = -(-n_symbols // contexts_that_fit(tables, n_symbols, contexts, trie_bytes))
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for table in tables:
        known = table.filter(F.col("total") >= least).select("context", F.explode("pairs").alias("of")) \
            .select("context", F.col("of.symbol").alias("symbol"), F.col("of.n").alias("n")).toArrow()
        levels.append(tuple(known[c].to_numpy() for c in ("context", "symbol", "n")))
    tables[-1] = tables[-1].filter(F.col("total") < least)
    ends = levels[0][1] == END
    n_texts = int(levels[0][2][ends].sum())
    return build(levels, order), n_texts, tables


def look_up(asked: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``asked`` (asking batch, gram) with ``score``: the log10 probability of every gram, whose
    contexts of the highest order are not in the trie. Each gram is looked up once, whoever asks."""
    rest = asked.select("gram").distinct().withColumns({"score": F.lit(0.0), "seen": F.array().cast("array<long>")})
    answers = []
    for k in range(len(tables) - 1, -1, -1):
        mask = (1 << (BITS * (k + 1))) - 1
        # 257 contexts at most of order 1
        table = F.broadcast(tables[k]) if k < 2 else tables[k]
        rest = rest.withColumn("context", F.shiftright(F.col("gram").bitwiseAND(F.lit(mask).cast("long")), BITS)) \
            .join(table, "context", "left")
        # what longer contexts have seen is left out; ``seen`` is a part of this context's symbols
        rest = rest.withColumns({
            "n": F.expr("get(filter(pairs, x -> x.symbol = (gram & 511)), 0).n"),
            "own": F.expr("if(size(seen) = 0, total, aggregate(pairs, 0L, (a, x) -> a + if(array_contains(seen, x.symbol), 0L, x.n)))"),
            "left": F.expr(f"if(size(pairs) = {SYMBOLS}, 0, size(pairs) - size(seen))")})
        rest = rest.select(
            "gram", F.col("n").isNotNull().alias("found"),
            F.expr("score + case when n is not null then log10(n / (own + left)) "
                   "when own > 0 then log10(left / (own + left)) else 0 end").alias("score"),
            F.expr("case when n is null then coalesce(pairs.symbol, seen) end").alias("seen"))
        rest = shared_table(rest, f"asked_{k}")
        answers.append(rest.filter("found").select("gram", "score"))
        rest = rest.filter("not found").drop("found")
    # a symbol seen nowhere
    answers.append(rest.select("gram", (F.col("score") - F.log10(F.lit(float(SYMBOLS)) - F.size("seen"))).alias("score")))
    return asked.join(reduce(DataFrame.unionByName, answers), "gram").select("asking", "gram", F.col("score").cast("float"))


def add_answers(texts: pa.Table, found: pa.Table, order: int) -> pa.Table:
    """(row, looked_up): what the looked-up grams of one batch add to the score of every text."""
    grams, values = found["gram"].to_numpy(), found["score"].to_numpy()
    del found
    by = np.argsort(grams)
    grams, values = grams[by], values[by]
    del by
    release()
    rows, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
    for first, part in zip(texts["row"].to_pylist(), texts["part"]):
        size = part["sizes"].values.to_numpy()
        ends = np.concatenate(([0], np.cumsum(size)))
        n_symbols = int(ends[-1]) + len(size)
        context, symbol, bounds = padded(unpacked(part["text"].as_py(), int(ends[-1])), ends, order)
        open_ = np.unpackbits(unpacked(part["marks"].as_py(), (n_symbols + 7) // 8), count=n_symbols) > 0
        places = np.flatnonzero(symbol >= 0)[open_]
        coded = pa.array(gram_keys(context, symbol, places, order)).dictionary_encode()
        value = np.zeros(len(symbol))
        if len(places):
            value[places] = values[np.searchsorted(grams, coded.dictionary.to_numpy())][coded.indices.to_numpy()]
        rows.append(first + np.arange(len(size)))
        sums.append(row_sums(value, bounds))
    release()
    return pa.table({"row": np.concatenate(rows), "looked_up": np.concatenate(sums)})


def score(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text: str = "text", order: int = ORDER,
          contexts: int = CONTEXTS, heavy: int = HEAVY) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""
    spark = docs.sparkSession
    words, grams, folder = corpus_counts(training, text, order)
    trie, n_texts, tables = fit_trie(grams, order, contexts)
    if folder:  # added up by now
        _drop_folder(folder)
    n_words, n_distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_train = n_words + n_texts
    whole = n_train + n_distinct + (1 if n_texts else 0) + 1
    frequent = words.filter(F.col("n") * heavy >= n_train).toArrow()
    model = spark.sparkContext.broadcast((trie, frequent["word"].combine_chunks(), frequent["n"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_trie, heavy_words, heavy_counts = model.value
        heavy_words = heavy_words.cast(pa.string())
        row = group = TaskContext.get().partitionId() << 40
        size, asked = 0, []

        def ask() -> Iterator[pa.RecordBatch]:
            grams = asked[0] if asked else np.zeros(0, np.int64)
            for first in range(0, len(grams), LISTED):
                yield table_rows(1, batch=[group], grams=[grams[first:first + LISTED]])
            asked.clear()

        def table_rows(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in layout], schema=layout)

        for batch in batches:
            for at, texts in chunks(batch.column(1), WORD_BYTES):
                n = len(texts)
                sizes, found = split_words(texts, lower=True)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                coded = found.cast(pa.string()).dictionary_encode()
                code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                place = pc.index_in(coded.dictionary, value_set=heavy_words)
                is_heavy = pc.is_valid(place).to_numpy(zero_copy_only=False)
                count = np.append(heavy_counts, 0)[pc.fill_null(place, 0).to_numpy(zero_copy_only=False)]
                base = np.where(is_heavy, np.log10((count + 1) / whole), 0.0)
                known = is_heavy[code]
                # the other words of each text, with how often they occur in it
                rare = np.flatnonzero(~known)
                owner = np.repeat(np.arange(n), sizes)[rare]
                pair, times = np.unique(owner * max(len(base), 1) + code[rare], return_counts=True)
                owner, rare_code = np.divmod(pair, max(len(base), 1))
                ends = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
                listed = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(rare_code)), pa.array(times)], ["word", "times"])
                text_size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                if size and size + text_size.sum() > BATCH_BYTES:
                    yield from ask()
                    group, size = group + 1, 0
                size += int(text_size.sum())
                parts = [model_trie.score_known(part, known_only=True) for _, part in chunks(texts, SCORE_BYTES)]
                asked[:] = [np.unique(np.concatenate([*asked, *(grams for _, grams, _ in parts)]))]
                marks = np.concatenate([x for _, _, x in parts])
                part = {"sizes": text_size, "text": packed(text_bytes(texts)[0]), "marks": packed(np.packbits(marks))}
                yield table_rows(1, batch=[group], row=[row], part=[part])
                yield table_rows(
                    n, row=row + np.arange(n), id=batch.column(0).slice(at, n), n_tokens=sizes + 1,
                    known=row_sums(known, bounds).astype(np.int64), base=row_sums(base[code], bounds),
                    score=np.concatenate([x for x, _, _ in parts]), rare=pa.ListArray.from_arrays(pa.array(ends), listed))
                row += n
                del parts, part, marks, coded, code, found, texts
                release()
        yield from ask()
        release()

    # a row holds a document's numbers, a chunk of texts (compressed, with the marks of what is looked up), or grams
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = dict(docs.dtypes)[id_col]
    columns = (f"batch long, row long, id {kind}, n_tokens long, known long, base double, score double, "
               "rare array<struct<word: string, times: long>>, part struct<sizes: array<long>, text: binary, marks: binary>, grams array<long>")
    layout = to_arrow_schema(_parse_datatype_string(columns))
    scored = shared_table(rows.mapInArrow(run, columns), "scored")
    found = look_up(scored.select(F.col("batch").alias("asking"), F.explode("grams").alias("gram")), tables)
    # batches are of like size, each of a bounded text and its distinct grams
    looked_up = scored.filter("part is not null").select("batch", "row", "part").groupBy("batch").cogroup(found.groupBy("asking")) \
        .applyInArrow(lambda texts, answers: add_answers(texts, answers, order), "row long, looked_up double")
    scored = scored.filter("n_tokens is not null").drop("batch", "part", "grams")
    # ``row`` is in the written table, so both readings of it agree
    rare = scored.select("row", F.explode("rare").alias("of")).select("row", "of.word", "of.times")
    rare = rare.join(words, "word", "left").select(
        "row", (F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(whole)))).alias("base"),
        F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("known"))
    rare = rare.groupBy("row").agg(F.sum("base").alias("rare_base"), F.sum("known").alias("rare_known"))
    end = float(np.log10((n_texts + 1) / whole))
    return scored.drop("rare").join(rare, "row", "left").join(looked_up, "row").select(
        F.col("id").alias(id_col), "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + (1 if n_texts else 0)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + end).alias("base_score"),
        (F.col("score") + F.col("looked_up")).alias("score"))
