"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its subwords, followed by a linear
softmax over the languages. Subwords are the byte n-grams (2 to 5 bytes) of the
ASCII-lowered text in which every ASCII character that is no letter is a space;
they are hashed into a fixed number of rows of the embedding table. Embeddings and
softmax are trained by stochastic gradient descent in numpy on the driver, on a
bounded sample of labelled rows that reaches it as sparse counts. The softmax
is linear, so for prediction embeddings and weights are multiplied once
into one table (subword row x language): a text's logits are the mean of its
subwords' rows.

Calibration: a part of the sample is kept from training. On it a temperature is fitted so
that the mean score is the (smoothed) share of right predictions.

Rejection: a softmax is sure of texts in languages it never saw, so rejection looks at the
text's share of familiar n-grams: those of ``FAMILIAR_BYTES`` bytes that occur in
the training texts of the predicted language (a bitmap per language). Of the shares and of the
scores of the kept-back, rightly predicted texts, the ``REJECT_SHARE`` quantile is taken, and the limit
lies below it by ``SLACK`` times its distance from their median. A text below either limit is
rejected, and so is one without a language.

Defined cases: a null text or one without any letter is ``und`` with score 0
and rejected; so is every text when there is no labelled row. Labelled rows with null
text or no letter are not learned from. Whole texts are used. Repeated rows are
predicted alike; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smishlens.llm.arrow_text import (
    as_array, chunks, pack_numbers, release, row_sums, text_bytes, unpack_numbers)
from smishlens.session import shared_table

#: Rows of the embedding table, its width, and the n-gram sizes in bytes.
BUCKETS = 1 << 16
WIDTH = 16
SIZES = (2, 3, 4, 5)
#: Bounds of the labelled sample: rows per language, and rows in all.
SAMPLE_PER_LANG = 500
SAMPLE_ROWS = 4000
EPOCHS = 6
RATE = 0.5
#: Of the sample, one in so many rows is for calibration.
CALIBRATE_ONE_IN = 5
#: Quantile of the rightly predicted calibration texts from which the rejection limits are drawn.
REJECT_SHARE = 0.005
SLACK = 2
#: Length of the n-grams that are familiar or not, and bits of a language's bitmap of them.
FAMILIAR_BYTES = 4
FAMILIAR_BITS = 1 << 18

UNKNOWN = "und"
CHUNK_BYTES = 1 << 20

_FOLD = np.full(256, 32, np.uint8)
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)


def subwords(data: np.ndarray, bounds: np.ndarray, buckets: int, sizes: tuple[int, ...] = SIZES):
    """For each n-gram size the table row of the n-gram at every byte; n-grams
    that would cross the end of their text get row ``buckets`` (all zero)."""
    folded = _FOLD[data].astype(np.uint64)
    n = len(folded)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    key = folded.copy()
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    for size in range(2, max(sizes) + 1):
        key[:max(n - size + 1, 0)] |= folded[size - 1:] << np.uint64(8 * (size - 1))
        if size in sizes:
            row = ((key + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int32)
            row[left < size] = buckets
            yield row


def n_subwords(bounds: np.ndarray) -> np.ndarray:
    """Number of n-grams of each text."""
    size = np.diff(bounds)
    return sum(np.maximum(size - n + 1, 0) for n in SIZES)


def has_letter(texts: pa.Array) -> np.ndarray:
    found = pc.match_substring_regex(pc.fill_null(texts, ""), r"\p{L}")
    return found.to_numpy(zero_copy_only=False)


@dataclass
class LanguageModel:
    """``table``: embeddings times softmax weights, one row per subword and a
    last one of zeros; ``bias`` per language; ``familiar``: the bitmaps, a byte per n-gram and a last one of zero."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    familiar: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    unfamiliar_below: float = 0.0

    def probabilities(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        logits = np.zeros((len(bounds) - 1, len(self.langs)))
        for row in subwords(data, bounds, len(self.table) - 1):
            for k in range(len(self.langs)):
                logits[:, k] += row_sums(self.table[:, k][row], bounds)
        logits /= np.maximum(n_subwords(bounds), 1)[:, None]
        return softmax((logits + self.bias) / self.temperature)

    def familiar_share(self, data: np.ndarray, bounds: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The share of each text's n-grams that language number ``of`` knows; 1 where there is none."""
        width = self.familiar.shape[1]
        row = next(subwords(data, bounds, width - 1, (FAMILIAR_BYTES,)))
        n = np.maximum(np.diff(bounds) - FAMILIAR_BYTES + 1, 0)
        hit = self.familiar.ravel()[np.repeat(of * width, np.diff(bounds)) + row]
        return np.where(n > 0, row_sums(hit, bounds) / np.maximum(n, 1), 1.0)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def packed_counts(rows: np.ndarray) -> bytes:
    """How often each number occurs: the distinct ones as steps, then their counts, compressed."""
    rows, counts = np.unique(rows, return_counts=True)
    return len(rows).to_bytes(4, "little") + pack_numbers(np.concatenate((np.diff(rows, prepend=0), counts)))


def unpacked_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    both = unpack_numbers(data[4:], 2 * n)
    return np.cumsum(both[:n]), both[n:]


def _bags(docs: DataFrame, text: str, lang: str, buckets: int) -> DataFrame:
    """(lang, bag, grams): the packed counts of the subwords and of the n-grams for familiarity of every text with a letter."""
    def count(batches):
        for batch in batches:
            texts = batch.column(0)
            letters = has_letter(texts)
            for i in np.flatnonzero(letters):
                data, bounds = text_bytes(texts.slice(i, 1))
                rows = np.concatenate(list(subwords(data, bounds, buckets)))
                grams = next(subwords(data, bounds, FAMILIAR_BITS, (FAMILIAR_BYTES,)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(i, 1), pa.array([packed_counts(rows[rows < buckets])], pa.binary()),
                     pa.array([packed_counts(grams[grams < FAMILIAR_BITS])], pa.binary())], ["lang", "bag", "grams"])

    return docs.select(text, lang).mapInArrow(count, "lang string, bag binary, grams binary")


def sample(docs: DataFrame, text: str, lang: str, per_lang: int, rows: int, buckets: int) -> list[tuple]:
    """A bounded sample of labelled rows as (lang, packed subwords, packed n-grams): of each language
    the first ``per_lang`` distinct texts by hash, fewer when there are many languages so that
    it is ``rows`` at most in all (one of each at least)."""
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")) \
        .filter("lang is not null and text is not null").filter(F.col("text").rlike(r"\p{L}")) \
        .withColumn("hash", F.xxhash64("text", "lang"))
    # copies of a text count once
    hashes = shared_table(labelled.select("lang", "hash").distinct(), "text_hashes")
    sizes = {r["lang"]: r["n"] for r in hashes.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return []
    per_lang = min(per_lang, max(1, rows // len(sizes)))

    def up_to(table: DataFrame, limits: dict[str, int]) -> DataFrame:
        """The rows whose hash is not above the limit of their language."""
        limit = docs.sparkSession.createDataFrame(list(limits.items()), "lang string, upto long")
        return table.join(F.broadcast(limit), "lang").filter("hash <= upto").drop("upto")

    # so many hashes as are sure to hold the first ``per_lang``, then the last of these
    enough = 3 * per_lang // 2 + 50
    near = up_to(hashes, {value: min((1 << 63) - 1, (enough << 64) // n - (1 << 63)) for value, n in sizes.items()}).toArrow()
    first: dict[str, list[int]] = {}
    for value, h in sorted(zip(near["lang"].to_pylist(), near["hash"].to_pylist())):
        first.setdefault(value, []).append(h)
    chosen = up_to(labelled, {value: h[:per_lang][-1] for value, h in first.items()}).select("text", "lang").distinct()
    found = _bags(chosen, "text", "lang", buckets).toArrow()
    return sorted(bag for bag in zip(*(found[c].to_pylist() for c in ("lang", "bag", "grams"))) if len(bag[1]) > 4)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS, width: int = WIDTH,
        epochs: int = EPOCHS, rate: float = RATE, per_lang: int = SAMPLE_PER_LANG, rows: int = SAMPLE_ROWS,
        seed: int = 7) -> LanguageModel:
    """Train and calibrate on a bounded sample of the labelled rows of ``docs``."""
    bags = sample(docs, text, lang, per_lang, rows, buckets)
    langs = sorted({value for value, _, _ in bags})
    if not langs:
        return LanguageModel([], np.zeros((buckets + 1, 0), np.float32), np.zeros(0), np.zeros((0, FAMILIAR_BITS + 1), bool))
    number = {value: k for k, value in enumerate(langs)}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(bags))
    held = {int(i) for i in order[::CALIBRATE_ONE_IN]} if len(bags) >= 10 * len(langs) else set()
    train = [int(i) for i in order if int(i) not in held]
    # every language weighs the same, however its sample turned out
    size = np.bincount([number[bags[i][0]] for i in train], minlength=len(langs))
    weight = len(train) / (len(langs) * np.maximum(size, 1))
    embeddings = rng.normal(0, 1 / width, (buckets, width))
    out = np.zeros((width, len(langs)))
    bias = np.zeros(len(langs))
    steps, step = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            index, counts = unpacked_counts(bags[i][1])
            share = counts / counts.sum()
            mean = share @ embeddings[index]
            error = softmax(mean @ out + bias)
            of = number[bags[i][0]]
            error[of] -= 1
            error *= rate * (1 - step / steps) * min(weight[of], 10.0)
            back = out @ error
            out -= np.outer(mean, error)
            bias -= error
            # one step per subword of the average, scaled so that rare ones move as well
            embeddings[index] -= np.outer(share * np.sqrt(len(index)), back)
            step += 1
    table = np.vstack([embeddings @ out, np.zeros((1, len(langs)))]).astype(np.float32)
    familiar = np.zeros((len(langs), FAMILIAR_BITS + 1), bool)
    for i in train:
        familiar[number[bags[i][0]], unpacked_counts(bags[i][2])[0]] = True
    model = LanguageModel(langs, table, bias, familiar)
    if held:
        calibrate(model, [bags[i] for i in sorted(held)], number)
    del bags, embeddings  # the sample is some MB of the driver's memory
    release()
    return model


def calibrate(model: LanguageModel, bags: list[tuple], number: dict[str, int]) -> None:
    """Sets the temperature and the rejection limits from texts that were kept from training."""
    counted = [unpacked_counts(bag) for _, bag, _ in bags]
    logits = np.array([(c / c.sum()) @ model.table[r].astype(np.float64) for r, c in counted]) + model.bias
    truth = np.array([number[value] for value, _, _ in bags])
    best = logits.argmax(axis=1)
    right = best == truth
    if not right.any():
        return
    grid = np.geomspace(0.001, 1000, 601)
    sure = np.array([softmax(logits / t).max(axis=1).mean() for t in grid])
    model.temperature = float(grid[int(np.argmin(np.abs(sure - (right.sum() + 1) / (len(right) + 2))))])

    def limit(values: np.ndarray) -> float:
        low = float(np.quantile(values, REJECT_SHARE))
        return max(0.0, low - SLACK * (float(np.median(values)) - low))

    model.reject_below = limit(softmax(logits / model.temperature).max(axis=1)[right])
    grams = [unpacked_counts(found) for _, _, found in bags]
    model.unfamiliar_below = limit(np.array([(c * model.familiar[k, r]).sum() / c.sum() if len(c) else 1.0
                                             for (r, c), k in zip(grams, best)])[right])


def predict(text: Column, model: LanguageModel) -> Column:
    """A struct (lang_pred, score, rejected) for every whole text."""
    def apply(column: pa.Array) -> pa.Array:
        texts = as_array(column)
        n = len(model.langs)
        best, top, strange = np.full(len(texts), n), np.zeros(len(texts)), np.zeros(len(texts), bool)
        for at, part in chunks(texts, CHUNK_BYTES):
            known = has_letter(part) if n else np.zeros(len(part), bool)
            if known.any():
                data, bounds = text_bytes(part)
                p = model.probabilities(data, bounds)
                own = slice(at, at + len(part))
                share = model.familiar_share(data, bounds, p.argmax(axis=1))
                best[own], top[own] = np.where(known, p.argmax(axis=1), n), np.where(known, p.max(axis=1), 0.0)
                strange[own] = share < model.unfamiliar_below
        release()
        lang = pa.array(np.array([*model.langs, UNKNOWN], object)[best], pa.string())
        rejected = (top < model.reject_below) | strange | (best == n)
        return pa.StructArray.from_arrays([lang, pa.array(top), pa.array(rejected)], ["lang_pred", "score", "rejected"])

    apply.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "lang_pred string, score double, rejected boolean").asNondeterministic()(text)


def keep_known(docs: DataFrame, text: str = "text", lang: str = "lang", **params) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns, by a
    model trained on their labelled rows."""
    model = fit(docs, text, lang, **params)
    if not model.langs:  # nothing to learn from: no text can be told to be foreign
        return docs
    verdict = "__language"
    return docs.withColumn(verdict, predict(F.col(text), model)).filter(~F.col(f"{verdict}.rejected")).drop(verdict)
