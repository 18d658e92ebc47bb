"""Token ids of whole texts with a public tokenizer, each distinct word encoded once.

For tokenizers whose pre-tokenizer never joins what ASCII white space separates
(true of ``word_bpe_49k.json``: white space is dropped and every word ends in
its own token), the ids of a text are those of its words one after the other.
So the words of a batch are reduced to distinct ones in Arrow, only those not
seen before are encoded, and the ids are put together with numpy. For fewer
distinct words, ASCII words are lower-cased (the tokenizer does so anyway),
and a full stop or comma after an ASCII letter is taken off (it is a token of its own).
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from smishlens.llm.arrow_text import release, split_words

#: Vocabulary used by the queries, found by name in the public tokenizer folder.
VOCABULARY = "word_bpe_49k.json"
#: Distinct words remembered per Python worker, and bytes of text handled at once.
MAX_CACHED = 1 << 19
CHUNK_BYTES = 12 << 20

_SEPARATOR = "\x01"
#: Words in one string to encode, and strings in one call (the library keeps
#: a good hundred bytes per token while a call lasts).
_JOIN = 256
_CALL = 64


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker, with the words that earlier tasks in it
    have encoded (functions are sent anew with each task, modules stay)."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_smishlens_by_path", {})
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]


class WordTokenizer:
    """Encodes arrays of texts with a vocabulary file."""

    def __init__(self, path: str, max_cached: int = MAX_CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel unit
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        separator = self._encode_each([_SEPARATOR])[0]
        if len(separator) != 1:
            raise ValueError("the vocabulary has no single token for U+0001")
        self._separator = separator[0]
        self._marks = np.array([0, *(self._encode_each([m])[0][0] for m in ".,")], np.uint32)
        self._max_cached = max_cached
        self._words = pa.array([], pa.string())
        self._sizes = np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def _encode_each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids per word, and all ids."""
        if len(words) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        odd = pc.match_substring(words, _SEPARATOR).to_numpy(zero_copy_only=False)
        texts = words.to_pylist()
        for i in np.flatnonzero(odd):
            texts[i] = "x"  # encoded on its own below
        joined = [f" {_SEPARATOR} ".join(texts[i:i + _JOIN]) + f" {_SEPARATOR}" for i in range(0, len(texts), _JOIN)]
        ids = np.concatenate([np.array(x, np.uint32) for i in range(0, len(joined), _CALL)
                              for x in self._encode_each(joined[i:i + _CALL])])
        cut = ids == self._separator
        ends = np.flatnonzero(cut)
        sizes = np.diff(np.concatenate(([-1], ends))) - 1
        ids = ids[~cut]
        if odd.any():
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            parts = [ids[bounds[i]:bounds[i + 1]] for i in range(len(sizes))]
            for i in np.flatnonzero(odd):
                parts[i] = np.array(self._encode_each([words[int(i)].as_py()])[0], np.uint32)
                sizes[i] = len(parts[i])
            ids = np.concatenate(parts)
        return sizes, ids

    def _remember(self, new: pa.Array, sizes: np.ndarray, ids: np.ndarray, times: np.ndarray) -> None:
        """Keep the new words that occur more than once in the batch, while there is room."""
        room = self._max_cached - len(self._words)
        keep = np.flatnonzero(times > 1)[:max(room, 0)]
        if len(keep) == 0:
            return
        chosen = np.zeros(len(sizes), bool)
        chosen[keep] = True
        self._words = pa.concat_arrays([self._words, new.take(pa.array(keep))])
        self._sizes = np.concatenate((self._sizes, sizes[keep]))
        self._pool = np.concatenate((self._pool, ids[np.repeat(chosen, sizes)]))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids per text, its ``end_id`` included, and all ids (null: only the end)."""
        counts, words = split_words(texts)
        coded = words.dictionary_encode()
        whole = coded.dictionary.cast(pa.string())
        whole = pc.if_else(pc.string_is_ascii(whole), pc.ascii_lower(whole), whole)
        marked = pc.match_substring_regex(whole, "[a-z][.,]$")
        mark = np.where(marked.to_numpy(zero_copy_only=False),
                        np.where(pc.ends_with(whole, ".").to_numpy(zero_copy_only=False), 1, 2), 0).astype(np.int8)
        bare = pc.if_else(marked, pc.utf8_slice_codeunits(whole, 0, -1), whole).dictionary_encode()
        distinct = bare.dictionary
        known = pc.index_in(distinct, value_set=self._words)
        is_new = pc.is_null(known)
        new = distinct.filter(is_new)
        sizes, ids = self._encode_words(new)
        # number of each distinct word in the cached words followed by the new ones
        place = pc.fill_null(known, 0).to_numpy(zero_copy_only=False).astype(np.int32)
        place[is_new.to_numpy(zero_copy_only=False)] = len(self._words) + np.arange(len(new), dtype=np.int32)
        all_sizes = np.concatenate((self._sizes, sizes))
        pool = np.concatenate((self._pool, ids))
        starts = np.cumsum(all_sizes) - all_sizes
        code = coded.indices.to_numpy(zero_copy_only=False)
        n_old, new_sizes = len(self._words), sizes
        base = place[bare.indices.to_numpy(zero_copy_only=False)]
        if len(new):
            times = np.bincount(np.maximum(base[code] - n_old + 1, 0), minlength=len(new) + 1)[1:]
            self._remember(new, new_sizes, ids, times)
        mark, size, start = mark[code], (all_sizes[base] + (mark > 0))[code], starts[base][code]
        # every text has its end id as one more word
        last = np.cumsum(counts + 1) - 1
        is_word = np.ones(len(code) + len(counts), bool)
        is_word[last] = False
        sizes = np.ones(len(is_word), np.int64)
        sizes[is_word] = size
        upto = np.cumsum(sizes)
        total = int(upto[-1]) if len(upto) else 0
        shift = np.zeros(len(is_word), np.int64)
        shift[is_word] = start - (upto[is_word] - size)
        gather = np.repeat(shift.astype(np.int32), sizes)
        gather += np.arange(total, dtype=np.int32)
        out = np.append(pool, np.uint32(0))[np.minimum(gather, len(pool), out=gather)]
        ends = upto - 1
        out[ends[is_word][mark > 0]] = self._marks[mark[mark > 0]]
        out[ends[last]] = end_id
        release()
        return np.diff(upto[last], prepend=0), out
