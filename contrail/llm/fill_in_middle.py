"""Fill-in-middle transformation: a document's middle moves behind its other parts.

A text is cut at two of its units (a word with the white space before it; the
white space at the end is a unit of its own). A task reads its texts as UTF-8
bytes in blocks of ``BLOCK``; a Fenwick tree for each text stores the blocks'
counts of unit ends and of code points. A descent by binary lifting finds the
block of a cut, and only that block is searched for the cut itself. The trees
of a batch lie in one array, so a descent serves all its texts at once.

Which texts change, where and how depends on a hash of seed and id alone, so
repeated rows and repeated runs agree. Nothing is shuffled.

A null text counts as empty; an empty text, or one that holds a marker, stays
plain (``n`` still counts its units). A null id hashes as no digits. Every row
gives one row; an empty table gives none. Only the id and text columns are
read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_arrow
from contrail.llm.words import as_large

# Fixed values of the contract.
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

BLOCK = 512   # bytes of a text block

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the batch's texts, and each text's offset in them (one more than texts)."""
    texts = as_large(texts)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True at each byte that ends a unit of its text."""
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    ends = ~space
    ends[:-1] &= space[1:]
    filled = offsets[1:] > offsets[:-1]
    ends[offsets[1:][filled] - 1] = True   # a text's last byte ends its word or its last white space
    return ends


class BlockTrees:
    """Fenwick trees, one for each text of a batch, over its blocks' counts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.ends = unit_ends(data, offsets)
        self.heads = (data & 0xC0) != 0x80   # first bytes of code points
        self.offsets = offsets
        self.sizes = -(-np.diff(offsets) // BLOCK)
        self.base = np.concatenate(([0], np.cumsum(self.sizes)))
        place = np.arange(self.base[-1]) - np.repeat(self.base[:-1], self.sizes)   # from 0 in each text
        starts = np.repeat(offsets[:-1], self.sizes) + place * BLOCK
        below = place + 1 - ((place + 1) & -(place + 1))
        first = np.repeat(self.base[:-1], self.sizes)
        self.units, self.chars = (self._tree(marks, starts, first, place, below) for marks in (self.ends, self.heads))

    @staticmethod
    def _tree(marks, starts, first, place, below) -> np.ndarray:
        """Entry i of a text (from 1) holds the sum of its blocks i - lowbit(i) + 1 to i."""
        counts = np.add.reduceat(marks.view(np.uint8), starts, dtype=np.int64) if len(starts) else starts
        before = np.concatenate(([0], np.cumsum(counts)))
        return before[first + place + 1] - before[first + below]

    def totals(self) -> np.ndarray:
        """Units of each text: the sum over its whole tree."""
        total = np.zeros(len(self.sizes), np.int64)
        at = self.sizes.copy()
        while (left := at > 0).any():
            rows = np.flatnonzero(left)
            total[rows] += self.units[self.base[rows] + at[rows] - 1]
            at[rows] -= at[rows] & -at[rows]
        return total

    def cut(self, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte and code point of each text behind its first ``after`` units."""
        block = np.zeros(len(after), np.int64)
        left, chars = after.copy(), np.zeros(len(after), np.int64)
        step = 1 << (int(self.sizes.max(initial=1)).bit_length() - 1)
        while step:
            rows = np.flatnonzero((block + step <= self.sizes) & (after > 0))
            entry = self.base[rows] + block[rows] + step - 1
            fits = self.units[entry] < left[rows]
            rows, entry = rows[fits], entry[fits]
            block[rows] += step
            left[rows] -= self.units[entry]
            chars[rows] += self.chars[entry]
            step >>= 1
        at = np.zeros(len(after), np.int64)
        for row in np.flatnonzero(after > 0):
            start = self.offsets[row] + block[row] * BLOCK
            stop = min(start + BLOCK, self.offsets[row + 1])
            end = start + np.flatnonzero(self.ends[start:stop])[left[row] - 1] + 1
            chars[row] += np.count_nonzero(self.heads[start:end])
            at[row] = end - self.offsets[row]
        return at, chars


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))


def transform(ids: list[int | None], texts: pa.Array, seed: int, fim_percent: int, spm_percent: int) -> pa.RecordBatch:
    data, offsets = text_bytes(texts)
    trees = BlockTrees(data, offsets)
    n = trees.totals()
    h = np.array([draws(i, seed) for i in ids], dtype=np.int64).reshape(-1, 4)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    at_prefix, prefix_chars = trees.cut(np.minimum(one, two))
    at_middle, middle_chars = trees.cut(np.maximum(one, two))
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    forms, outputs = [], []
    for k in range(len(ids)):
        text = data[offsets[k]:offsets[k + 1]].tobytes()
        if not text or h[k, 2] % 100 >= fim_percent or any(m in text for m in marks):
            forms.append("plain")
            outputs.append(text.decode())
            continue
        prefix, middle, suffix = text[:at_prefix[k]], text[at_prefix[k]:at_middle[k]], text[at_middle[k]:]
        if h[k, 3] % 100 < spm_percent:
            forms.append("spm")
            parts = (marks[1], suffix, marks[0], prefix, marks[2], middle)
        else:
            forms.append("psm")
            parts = (marks[0], prefix, marks[1], suffix, marks[2], middle)
        outputs.append(b"".join(parts).decode())
    plain = np.array([f == "plain" for f in forms], dtype=bool)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(n), pa.array(forms, pa.string()),
        pa.array(prefix_chars, mask=plain), pa.array(middle_chars - prefix_chars, mask=plain),
        pa.array(outputs, pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Per document its units, form, lengths of prefix and middle, and the new text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield transform(batch.column("doc_id").to_pylist(), batch.column("text"), seed, fim_percent, spm_percent)

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. A marker's first character occurs in
    it once, so the first place of a marker is the one that was put there."""
    def between(first: str, second: str) -> Column:
        start = F.instr(output, first) + len(first)
        return F.substring(output, start, F.instr(output, second) - start)

    middle = F.substring(output, F.instr(output, MIDDLE) + len(MIDDLE), F.length(output))
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
            .otherwise(output))
