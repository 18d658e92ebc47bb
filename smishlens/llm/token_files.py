"""Token ids as Arrow stream files of equal-length sequences.

Documents are put in ascending id order by range, and every range becomes two
files in a shared folder. ``part-N.seq.arrow`` is an Arrow IPC stream whose
record batches hold fixed-size lists: ``ids`` (unsigned integers as narrow as
the vocabulary allows), ``mask`` (true for a token, false for the padding of
the last sequence) and ``last`` (true for a document's last token). All batches
but a part's last have the same number of sequences and nothing is compressed, so sequence i
lies in batch i // n, row i % n, and a memory map gives it without a copy.
``part-N.docs.arrow`` is a stream with the ids and token counts of the part's
documents. A file is written under a name of its task attempt and then renamed, so
a repeated task replaces it by the same bytes.

Files are opened through ``pyarrow.fs``, so the folder can be any store that
pyarrow and Spark both reach; a local folder is memory-mapped.

Defined cases: a null or blank text has its end id only; a null document id
comes first; rows of equal id are ordered by text hash and all kept; an empty
table gives no file and no row; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smishlens.llm.arrow_text import chunks
from smishlens.llm.tokens import CHUNK_BYTES, worker_tokenizer
from smishlens.session import scratch_folder, shared_table

#: Tokens in a sequence, sequences in a record batch, bytes of text in a part.
SEQUENCE = 2048
BATCH = 128
PART_BYTES = 32 << 20

MANIFEST = "part int, path string, n_docs long, n_tokens long, n_sequences long"


def open_store(uri: str):
    """(filesystem, path) of a folder or file given as a URI or a plain path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):  # Hadoop writes file:/x, pyarrow wants a path
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def sequence_schema(length: int, n_ids: int) -> pa.Schema:
    ids = pa.uint16() if n_ids <= 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length)),
                      ("last", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Cuts a flow of documents' ids into sequences and writes full batches."""

    def __init__(self, sink, length: int, batch: int, n_ids: int):
        self._schema = sequence_schema(length, n_ids)
        self._type = self._schema.field("ids").type.value_type.to_pandas_dtype()
        self._stream = pa.ipc.new_stream(sink, self._schema)
        self._length, self._room = length, length * batch
        self._ids, self._last = np.zeros(0, self._type), np.zeros(0, bool)
        self.n_tokens = self.n_sequences = 0

    def _emit(self, ids: np.ndarray, last: np.ndarray, n_real: int) -> None:
        mask = np.arange(len(ids)) < n_real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type)
                   for x, f in zip((ids, mask, last), self._schema)]
        self._stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self._schema))
        self.n_sequences += len(ids) // self._length

    def write(self, ids: np.ndarray, ends: np.ndarray) -> None:
        """``ends``: index in ``ids`` of each document's last token."""
        if len(ids) and int(ids.max()) > np.iinfo(self._type).max:
            raise ValueError("an id is beyond the n_ids that the file was made for")
        last = np.zeros(len(ids), bool)
        last[ends] = True
        self.n_tokens += len(ids)
        self._ids, self._last = np.concatenate((self._ids, ids.astype(self._type))), np.concatenate((self._last, last))
        while len(self._ids) >= self._room:
            self._emit(self._ids[:self._room], self._last[:self._room], self._room)
            self._ids, self._last = self._ids[self._room:], self._last[self._room:]

    def close(self) -> None:
        n = len(self._ids)
        if n:
            padding = -n % self._length
            self._emit(np.append(self._ids, np.zeros(padding, self._type)), np.append(self._last, np.zeros(padding, bool)), n)
        self._stream.close()


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text: str = "text",
          length: int = SEQUENCE, batch: int = BATCH, n_ids: int = 1 << 16, part_bytes: int = PART_BYTES) -> DataFrame:
    """Write all documents into ``folder``; the manifest, one row per part."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 16)).first()[0] or 0
    n_parts = max(1, -(-int(size) // part_bytes))
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(n_parts, F.asc_nulls_first("id"), F.asc("tie")) \
        .sortWithinPartitions(F.asc_nulls_first("id"), F.asc("tie")).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = task.partitionId()
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        name, attempt = f"{base}/part-{part:08d}", f".{task.taskAttemptId()}.tmp"
        tokenizer, sinks, n_docs = None, [], 0
        doc_schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64())])
        for rows in batches:
            for at, texts in chunks(rows.column(1), CHUNK_BYTES):
                if tokenizer is None:
                    tokenizer = worker_tokenizer(vocabulary)
                    sinks = [store.open_output_stream(f"{name}.{kind}.arrow{attempt}") for kind in ("seq", "docs")]
                    writer = SequenceWriter(sinks[0], length, batch, n_ids)
                    listed = pa.ipc.new_stream(sinks[1], doc_schema)
                sizes, ids = tokenizer.encode(texts, end_id)
                writer.write(ids, np.cumsum(sizes) - 1)
                listed.write_batch(pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(at, len(texts)), pa.array(sizes)], schema=doc_schema))
                n_docs += len(texts)
        if tokenizer is not None:
            writer.close()
            listed.close()
            for sink, kind in zip(sinks, ("seq", "docs")):
                sink.close()
                store.move(f"{name}.{kind}.arrow{attempt}", f"{name}.{kind}.arrow")
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "path": [f"{folder}/part-{part:08d}"], "n_docs": [n_docs],
                 "n_tokens": [writer.n_tokens], "n_sequences": [writer.n_sequences]})

    return shared_table(ranged.mapInArrow(run, MANIFEST), "token_manifest")


def open_stream(path: str) -> pa.ipc.RecordBatchStreamReader:
    """A reader over a file; a local file is mapped, so its batches are no copies."""
    from pyarrow import fs

    store, name = open_store(path)
    source = pa.memory_map(name) if isinstance(store, fs.LocalFileSystem) else store.open_input_stream(name)
    return pa.ipc.open_stream(source)


class SequenceFile:
    """Random access to the sequences of one file: ``f[i]`` is (ids, mask, last)."""

    def __init__(self, path: str):
        self._batches = list(open_stream(path))
        self._per_batch = self._batches[0].num_rows if self._batches else 1

    def __len__(self) -> int:
        return sum(b.num_rows for b in self._batches)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        row = self._batches[i // self._per_batch].slice(i % self._per_batch, 1)
        return tuple(c.flatten().to_numpy(zero_copy_only=False) for c in row.columns)


def _documents(path: str) -> Iterator[list[np.ndarray]]:
    """Per batch of sequences the ids of the documents that end in it."""
    rest = np.zeros(0, np.uint32)
    for batch in open_stream(f"{path}.seq.arrow"):
        ids, mask, last = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in range(3))
        ids, ends = ids[mask].astype("<u4"), np.flatnonzero(last[mask]) + 1
        parts = np.split(ids, ends)
        if len(parts) == 1:  # inside a long document
            rest = np.concatenate((rest, ids))
            continue
        parts[0] = np.concatenate((rest, parts[0]))
        rest = parts.pop()
        yield parts
    if len(rest):
        raise ValueError(f"{path}: tokens after the last document's end")


def read_back(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the tokens of all documents before; it needs one running sum
    over the manifest, one row per part."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # the running sum is over the parts (tens of MB of text each), not over rows
    parts = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    parts = parts.repartition(max(1, manifest.count()), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part in rows.to_pylist():
                listed = pa.Table.from_batches(open_stream(f"{part['path']}.docs.arrow")).to_pydict()
                sizes, names, at, start = listed["n_tokens"], listed["id"], 0, part["base"]
                for found in _documents(part["path"]):
                    n = np.array([len(x) for x in found])
                    if n.tolist() != sizes[at:at + len(n)]:
                        raise ValueError(f"{part['path']}: sequences and list of documents differ")
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": pa.array(names[at:at + len(n)], pa.int64()), "start": start + np.cumsum(n) - n,
                         "n_tokens": n, "ids_crc32": [zlib.crc32(x.tobytes()) for x in found]})
                    at, start = at + len(n), start + int(n.sum())
                if at != part["n_docs"]:
                    raise ValueError(f"{part['path']}: {at} of {part['n_docs']} documents")

    return parts.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_folder(docs: DataFrame) -> str:
    """A new folder for token files in the session's shared folder."""
    return scratch_folder(docs.sparkSession, "token_files")
