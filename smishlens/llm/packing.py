"""Sequence packing as a cutting-stock problem, by column generation.

A document longer than a sequence is cut into full sequences and a remainder;
nothing else is cut. Pieces are counted by length, rounded up to a size: to the token
for short pieces, to eight tokens for long ones, so the histogram is of bounded size. The unit in which
sizes are counted is the largest that costs no more than ``ROUNDING`` of all tokens, so tables of
short texts are packed by exact lengths. The linear program "use
as few sequences as possible" has one variable per pattern (how many pieces of
each length one sequence takes); it starts with one pattern per length, and
a knapsack dynamic program over the dual prices finds the pattern that improves
it most, until the gap to the proven bound is under ``GAP`` (a warning tells when ``MAX_ROUNDS`` end it before). Pattern counts are
rounded down; what is left over is packed first-fit, longest first.

Each pattern's copies take a range of ranks in each of its lengths. Pieces are
ranked within their length by a hash (see :mod:`ranking`), and a search over
the ranges gives a piece its sequence. Only the histogram reaches the driver.

Defined cases: a null or blank text is its end id alone; an empty table gives no
piece; equal ids and repeated rows are pieces of their own; further columns
are ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smishlens.llm.arrow_text import as_array, chunks
from smishlens.llm.ranking import with_rank
from smishlens.llm.tokens import CHUNK_BYTES, worker_tokenizer
from smishlens.session import scratch_folder

#: Tokens in a sequence, and the largest unit of the histogram; smaller ones are its halves.
CAPACITY = 4096
UNIT = 8
#: Pieces up to so many tokens are rounded up to that many.
STEPS = ((64, 1), (128, 2), (256, 4))
#: Share of the tokens that rounding up may cost.
ROUNDING = 0.01
#: The linear program ends when its value is within this share of the bound.
GAP = 0.001
MAX_ROUNDS = 20_000

PIECES = "piece long, id long, start long, length long, doc_tokens long, ids binary"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """All documents' tokens, cut to at most ``capacity``: (piece, id, start, length,
    doc_tokens, ids as little-endian unsigned 32-bit integers), written once into the
    shared folder, so that ``piece`` numbers them for good."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, piece = None, TaskContext.get().partitionId() << 40
        for rows in batches:
            for at, texts in chunks(rows.column(1), CHUNK_BYTES):
                tokenizer = tokenizer or worker_tokenizer(vocabulary)
                sizes, ids = tokenizer.encode(texts, end_id)
                n = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * capacity
                length = np.minimum(sizes[row] - start, capacity)
                # the pieces follow each other in ids, so their ends are running sums
                ends = np.concatenate(([0], np.cumsum(length) * 4))
                binary = pa.Array.from_buffers(pa.large_binary(), len(row), [
                    None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece + np.arange(len(row))), rows.column(0).slice(at, len(texts)).take(pa.array(row)),
                     pa.array(start), pa.array(length), pa.array(sizes[row]), binary.cast(pa.binary())],
                    ["piece", "id", "start", "length", "doc_tokens", "ids"])
                piece += len(row)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    path = scratch_folder(docs.sparkSession, "pieces")
    rows.mapInArrow(run, PIECES).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(PIECES).parquet(path)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of largest total price that fits."""
    value, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if fits[room]:
            offer = prices[:fits[room]] + value[room - sizes[:fits[room]]]
            k = int(offer.argmax())
            if offer[k] > value[room] + 1e-12:
                value[room], taken[room] = offer[k], sizes[k]
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if taken[room]:
            pattern[np.searchsorted(sizes, taken[room])] += 1
            room -= int(taken[room])
        else:
            room -= 1
    return float(value[capacity]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP,
          max_rounds: int = MAX_ROUNDS) -> list[tuple[int, np.ndarray]]:
    """(copies, pattern) list that takes exactly ``demand`` pieces of each of
    the ascending ``sizes``; a pattern holds pieces per size."""
    if len(sizes) == 0:
        return []
    fill = capacity // sizes
    patterns = np.diag(fill).astype(float)  # columns: the basis
    inverse = np.diag(1.0 / fill)
    x = demand / fill
    value = np.inf
    for _ in range(max_rounds):
        value, pattern = best_pattern(inverse.sum(axis=0), sizes, capacity)
        if 1 - 1 / value <= gap:  # total / value is a lower bound of the optimum
            break
        move = inverse @ pattern
        up = move > 1e-9
        steps = np.where(up, x / np.where(up, move, 1), np.inf)
        leave = int(steps.argmin())
        x = np.maximum(x - steps[leave] * move, 0)
        x[leave] = steps[leave]
        patterns[:, leave] = pattern
        row = inverse[leave] / move[leave]
        inverse -= np.outer(move, row)
        inverse[leave] = row
    else:
        warnings.warn(f"packing: {max_rounds} rounds, {1 - 1 / value:.2%} from the bound", stacklevel=2)
    return round_down(patterns, x, sizes, demand, capacity)


def round_down(patterns: np.ndarray, x: np.ndarray, sizes: np.ndarray, demand: np.ndarray,
               capacity: int) -> list[tuple[int, np.ndarray]]:
    copies = np.floor(x + 1e-6).astype(np.int64)
    rest = demand - (patterns.astype(np.int64) @ copies)
    while (rest < 0).any():  # by rounding errors of the inverse only
        short = int(rest.argmin())
        k = int(np.argmax((patterns[short] > 0) * copies))
        copies[k] -= 1
        rest = demand - (patterns.astype(np.int64) @ copies)
    out = [(int(c), patterns[:, k].astype(np.int64)) for k, c in enumerate(copies) if c]
    # what is left: first fit, longest first; equal sequences are filled at once
    while rest.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for k in range(len(sizes) - 1, -1, -1):
            take = min(int(rest[k]), room // int(sizes[k]))
            pattern[k], room = take, room - take * int(sizes[k])
        times = int((rest[pattern > 0] // pattern[pattern > 0]).min())
        out.append((times, pattern))
        rest = rest - times * pattern
    return out


def slots(solution: list[tuple[int, np.ndarray]], sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Parallel arrays sorted by (size, first rank): size, first rank, first
    sequence, pieces of that size in each copy of the pattern."""
    used, first, rows = {int(s): 0 for s in sizes}, 0, []
    for copies, pattern in solution:
        for k in np.flatnonzero(pattern):
            size, n = int(sizes[k]), int(pattern[k])
            rows.append((size, used[size], first, n))
            used[size] += n * copies
        first += copies
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return tuple(table[:, k].copy() for k in range(4))


def rounded(lengths: np.ndarray, unit: int, capacity: int) -> np.ndarray:
    """The sizes of pieces, in units; a sequence's size is ``capacity // unit``."""
    step = np.full(len(lengths), UNIT)
    for most, of in reversed(STEPS):
        step[lengths <= most] = of
    step = np.maximum(step, unit)
    return np.minimum(-(-lengths // step) * step // unit, capacity // unit)


def choose_unit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """The largest unit with which rounding up costs ``ROUNDING`` of the tokens at most."""
    unit = UNIT
    while unit > 1 and (counts * (rounded(lengths, unit, capacity) * unit - lengths)).sum() > ROUNDING * (counts * lengths).sum():
        unit //= 2
    return unit


def pack(cut: DataFrame, capacity: int = CAPACITY, unit: int | None = None, seed: int = 11) -> DataFrame:
    """The narrow columns of :func:`pieces` with ``sequence_id`` and ``offset``. ``unit``: chosen by the
    lengths where it is not given."""
    found = cut.groupBy("length").count().orderBy("length").collect()  # at most capacity rows
    lengths, counts = (np.array([r[c] for r in found], np.int64) for c in ("length", "count"))
    unit = unit or choose_unit(lengths, counts, capacity)
    sizes, place = np.unique(rounded(lengths, unit, capacity), return_inverse=True)
    demand = np.bincount(place, counts, len(sizes)).astype(np.int64)
    step = F.lit(UNIT)
    for most, of in reversed(STEPS):
        step = F.when(F.col("length") <= most, F.lit(of)).otherwise(step)
    step = F.greatest(step, F.lit(unit))
    size = F.least(F.ceil(F.col("length") / step) * step / unit, F.lit(capacity // unit)).cast("long")
    rows = cut.withColumn("size", size).withColumn("order", F.xxhash64("piece", F.lit(seed)))
    size_of, first_rank, first_sequence, per_copy = slots(solve(sizes, demand, capacity // unit), sizes)

    def find(size: pa.Array, rank: pa.Array) -> pa.Array:
        s, r = (as_array(c).to_numpy(zero_copy_only=False) for c in (size, rank))
        key = (size_of << 48) + first_rank
        k = np.searchsorted(key, (s << 48) + r, side="right") - 1
        return pa.array(first_sequence[k] + (r - first_rank[k]) // per_copy[k])

    find.__annotations__ = {"size": pa.Array, "rank": pa.Array, "return": pa.Array}
    ranked = with_rank(rows, ["size"], "order", ["piece"], int(demand.max()) if len(demand) else 0)
    placed = ranked.withColumn("sequence_id", F.arrow_udf(find, "long")(F.col("size"), F.col("rank")))
    # at most ``capacity`` pieces share a sequence
    before = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))) \
        .drop("size", "order", "rank")


def sequences(cut: DataFrame, plan: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, n_tokens, ids) with the ids of all pieces in order."""
    rows = plan.select("piece", "sequence_id", "offset").join(cut.select("piece", "length", "ids"), "piece")
    found = rows.groupBy("sequence_id").agg(
        F.count("*").alias("n_pieces"), F.sum("length").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return found.select("sequence_id", "n_pieces", "n_tokens", ids.alias("ids"))
