"""Token ids and token counts of whole texts with a public tokenizer."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .hashing import NOT_SPACE, words
from .shared import begins_of, cut_by_bytes, keyed_texts, typed

#: Distinct words kept per worker; beyond that the memory starts anew.
KEPT_WORDS = 1_000_000
#: Longer words without white space are cut between ASCII letters or digits and a following ASCII digit.
LONG_WORD = 1 << 16
ASCII_ALNUM = np.zeros(256, bool)
ASCII_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
ASCII_DIGIT = np.zeros(256, bool)
ASCII_DIGIT[0x30:0x3A] = True


class WordTokenizer:
    """Encodes texts word by word, for tokenizers that never join what white space separates.

    ASCII white space is a safe boundary of such a tokenizer: its normaliser, its word pattern and its special
    strings do not reach across it. Each distinct word is encoded once; texts then gather the ids of their words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.first = np.zeros(1, np.int64)  # of the ids of each known word, by the order of learning
        self.order = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, strings: list[str]) -> None:
        encoded, sizes = [], []
        for at in range(0, len(strings), 8192):
            for e in self.tokenizer.encode_batch_fast(strings[at : at + 8192], add_special_tokens=False):
                ids = e.ids
                sizes.append(len(ids))
                encoded += ids
        self.ids = np.concatenate((self.ids, np.array(encoded, np.uint32)))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(np.array(sizes, np.int64))))
        known = np.concatenate((self.known, hashes))
        place = np.concatenate((self.order, np.arange(len(self.order), len(known))))
        order = np.argsort(known, kind="stable")
        self.known, self.order = known[order], place[order]

    def places(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin of every word of ``data`` and the number under which it is known."""
        begin, end, hashes = words(data, NOT_SPACE)
        if len(begin) and (end - begin).max() > LONG_WORD:
            begin, end = cut_long(data, begin, end)
            hashes = np.array([hash(data[b:e].tobytes()) for b, e in zip(begin, end, strict=True)], np.int64).view(np.uint64)
        distinct, first, where = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > KEPT_WORDS:
            self.clear()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            chosen = first[new]
            raw = data.tobytes()
            self.learn(distinct[new], [raw[begin[i] : end[i]].decode("utf-8", "replace") for i in chosen])
        return begin, self.order[np.searchsorted(self.known, distinct)][where]

    def counts(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Tokens of each document."""
        begin, number = self.places(data)
        total = np.concatenate(([0], np.cumsum(np.diff(self.first)[number])))
        return np.diff(total[np.searchsorted(begin, begins)])

    def encode(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after the other, and where each document's begin."""
        begin, number = self.places(data)
        sizes = np.diff(self.first)[number]
        total = np.concatenate(([0], np.cumsum(sizes)))
        take = np.arange(total[-1]) + np.repeat(self.first[number] - total[:-1], sizes)
        return self.ids[take], total[np.searchsorted(begin, begins)]


def cut_long(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut long words before ASCII digits that follow an ASCII letter or digit: every digit is a token's border."""
    out = []
    for b, e in zip(begin.tolist(), end.tolist(), strict=True):
        while e - b > LONG_WORD:
            piece = data[b:e]
            safe = np.flatnonzero(ASCII_DIGIT[piece[LONG_WORD // 2 :]] & ASCII_ALNUM[piece[LONG_WORD // 2 - 1 : -1]])
            if not len(safe):
                break
            out.append((b, b + LONG_WORD // 2 + int(safe[0])))
            b = out[-1][1]
        out.append((b, e))
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer_of(path: str) -> WordTokenizer:
    """The tokenizer of this worker, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of every whole text: ``key``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit``).

    ``path`` is the tokenizer's file, present on every worker. Only lengths leave the Arrow function; texts are
    encoded in groups of equal bytes, long ones in segments that end at white space. No special tokens are added,
    special strings inside a text count as the library takes them by default. A null text counts as empty.
    Repeated rows, null keys and other columns are kept apart from the count; an empty table gives an empty one.
    """
    kind = docs.schema[key].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(path)
        for keys, lens, parts in cut_by_bytes(batches):
            data = np.frombuffer(b"".join(parts), np.uint8)
            n = tokenizer.counts(data, begins_of(lens))
            columns = [keys, pa.array(lens), pa.array(n, pa.int64()), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_bytes", "n_tokens", "over_limit"])

    schema = typed("n_bytes long, n_tokens long, over_limit boolean", 0, key, kind)
    return keyed_texts(docs, key, text).mapInArrow(count, schema)
