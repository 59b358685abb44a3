"""Words of texts as Arrow and numpy columns.

A word is a maximal run of characters other than space, tab, line feed,
vertical tab, form feed and carriage return; A-Z count as a-z. A batch's words
are dictionary-encoded, so each different word of a batch is hashed once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

GOLDEN = 0x9E3779B97F4A7C15


def as_large(column) -> pa.Array:
    """A text column as one array with 64-bit offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of the batch in order, and per text the offset of its first
    (one offset more than texts)."""
    texts = as_large(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))
    if not real.all():
        flat = flat.filter(pa.array(real))
        offsets = np.concatenate(([0], np.cumsum(real, dtype=np.int64)))[offsets]
    return flat, offsets


def encode(flat: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different words, and for each word its place among them."""
    if len(flat) == 0:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    enc = flat.dictionary_encode()
    return enc.dictionary, np.asarray(enc.indices, dtype=np.int64)


def hash_words(words: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words.cast(pa.large_binary()).to_pylist()),
                       dtype=np.uint64, count=len(words))


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (splitmix64's finish)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# Odd multipliers of the places in a window, without relations among them: with
# evenly spaced ones a, b, b, a and b, a, a, b would be alike.
MULTIPLIERS = scramble(np.arange(1, 1025, dtype=np.uint64) * np.uint64(GOLDEN)) | np.uint64(1)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash of every run of ``width`` words (none if there are fewer)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * MULTIPLIERS[0]
    for k in range(1, width):
        total += hashes[k:k + n] * MULTIPLIERS[k]
    return scramble(total)


def whole_hash(hashes: np.ndarray) -> np.ndarray:
    """The hash of a whole short sequence, told apart from a window's by its length."""
    total = np.array([len(hashes)], dtype=np.uint64)
    for k in range(len(hashes)):
        total += hashes[k:k + 1] * MULTIPLIERS[k]
    return scramble(total ^ np.uint64(GOLDEN))
