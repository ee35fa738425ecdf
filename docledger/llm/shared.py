"""Helpers the operators share: words, folds, hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from docledger.storage import shared_dir, written, written_in_buckets  # noqa: F401  for the operators

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def text_bytes(text: str) -> Column:
    """The UTF-8 bytes of a text column; null is the empty text."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def tokenised(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words, the number of each text's words among them in turn, and the texts' word counts."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string(), safe=False)))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    codes = coded.indices.to_numpy().astype(np.int32)
    text = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    if b"" in words:  # what Arrow makes of white space at an end
        empty = words.index(b"")
        words.pop(empty)
        text, codes = text[codes != empty], codes[codes != empty]
        codes -= codes > empty
    return words, codes, np.bincount(text, minlength=len(lists))


def each(texts: pa.Array, at_once: int = 500) -> Iterator[bytes]:
    """The values of a long array, a few at a time as Python objects."""
    for start in range(0, len(texts), at_once):
        yield from texts.slice(start, at_once).to_pylist()


def give_back() -> None:
    """Freed memory goes back to the system: a worker waits between tasks, while others need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of some C libraries
    if trim:
        trim(0)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An order-sensitive 64-bit mix of two arrays of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x
