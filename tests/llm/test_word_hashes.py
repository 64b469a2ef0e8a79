"""Words that sums of byte values times powers modulo 2^64 cannot tell apart."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from stepwave.llm.hashing import BASE, BYTE_VALUES, LONG_WORD, NOT_SPACE, powers, words
from stepwave.llm.ngram_join import near_duplicates
from stepwave.llm.packing import pack_documents
from stepwave.llm.queries import VOCABULARY
from stepwave.llm.substring_dedup import remove_repeats


def pair(n=1024, letters="ab"):
    """The Thue-Morse word of two letters and its complement."""
    parity = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(letters[p] for p in parity), "".join(letters[1 - p] for p in parity)


def test_sums_are_equal_and_hashes_are_not():
    first, second = pair()
    sums = [int((BYTE_VALUES[np.frombuffer(w.encode(), np.uint8)] * powers(BASE, 1024)).sum()) for w in (first, second)]
    assert sums[0] == sums[1]
    data = np.frombuffer(f"{first} {second} {first}".encode(), np.uint8)
    _, _, hashes = words(data, NOT_SPACE)
    assert hashes[0] == hashes[2] != hashes[1]


@pytest.mark.parametrize("n", [LONG_WORD - 1, LONG_WORD, LONG_WORD + 1, 2_000_000])
def test_a_word_has_one_hash_wherever_it_stands(n):
    data = np.frombuffer(("x " * 3 + "é" + "a" * (n - 2) + " y " + "é" + "a" * (n - 2)).encode(), np.uint8)
    begin, end, hashes = words(data, NOT_SPACE)
    assert (end - begin)[[3, 5]].tolist() == [n, n]
    assert hashes[3] == hashes[5] and len(set(hashes.tolist())) == 3


def test_operators_tell_them_apart(spark):
    first, second = pair()
    rows = [(1, f"{first} tail"), (2, f"{second} tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    library = Tokenizer.from_file(VOCABULARY)
    for piece in pack_documents(docs, VOCABULARY).collect():
        ids = [*library.encode(dict(rows)[piece.doc_id], add_special_tokens=False).ids, 2]
        part = np.array(ids[piece.start : piece.start + piece.length], "<u4")
        assert piece.ids_crc32 == zlib.crc32(part.tobytes())
    assert {r.n_removed for r in remove_repeats(docs, 2).collect()} == {0}
    five = spark.createDataFrame([(1, f"{first} b c d e"), (2, f"{second} b c d e")], "doc_id long, text string")
    assert {r.class_id for r in near_duplicates(five).collect()} == {1, 2}
