"""Packing of tokenised documents into training windows by the sum-of-squares rule.

Each document's ids (and an end id) are cut into full windows and a rest. The
rest goes, as it comes, to the fill level that minimises the sum of squares of
the counts of partially filled windows; ``WindowPacker`` keeps those counts in
one array with an entry for each level. Every Spark task packs its own
partition, so nothing is shuffled and memory holds only the open windows'
piece lists, of which there are at most ``max_open``.

A window that finds no partner is finished by cutting: the emptiest open
windows' pieces are cut to fill the gaps of the fullest ones. The last rest of
a task is cut into windows of power-of-two lengths, which need no padding.

Empty tables give no rows, a null or empty text its end id alone, and a
repeated row is packed as often as it occurs. Null ids are kept as null. Only
the id and text columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from contrail.llm.common import map_arrow

# Fixed values of the window contract.
WINDOW = 1024
END_ID = 0

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")
IDS_SCHEMA = PIECE_SCHEMA + ", ids array<int>"


def byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write each byte as one letter: visible Latin-1
    characters as themselves, the other bytes as the characters from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


LETTERS_MARKS = re.compile(r"([^\W\d_]+)((?:[^\w\s]|_)+)")


class UnitTokenizer:
    """Ids of whole texts by the ``tokenizers`` library.

    The tokenizer's rule never joins characters across a single space or line
    break between two others, so a text is cut there and each different unit
    is tokenised once and kept (at most ``keep`` units). Nor does it join
    letters and the marks after them. Texts with other white space beside a cut,
    and texts that hold the marker or an added token, are tokenised whole.
    """

    START = "\x00"  # marks a unit that no space precedes

    def __init__(self, path: str, keep: int = 600_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # tokens that the library finds in a text before it cuts it into words
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.keep = keep
        self.known: dict[str, bytes | None] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _unit(self, unit: str) -> bytes | None:
        """The unit's ids, None if the text must be tokenised whole."""
        if unit == "\n":
            return self._whole(unit)
        started = unit.startswith(self.START)
        bare = unit[1:] if started else unit
        if bare.isalpha():
            text = bare if bare.isascii() else bare.encode().decode("latin-1").translate(self.letters)
            text = text if started else self.letters[32] + text
            return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()
        if (m := LETTERS_MARKS.fullmatch(bare)) and m.group(1).isalpha():
            return self._ids(unit[:len(unit) - len(m.group(2))]) + self._ids(self.START + m.group(2))
        if not bare or bare[0].isspace() or bare[-1].isspace() or self.START in bare:
            return None
        return self._whole(bare if started else " " + bare)

    def _ids(self, unit: str) -> bytes | None:
        if unit not in self.known:
            self.known[unit] = self._unit(unit)
        return self.known[unit]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        holds = np.zeros(len(texts), dtype=bool)
        for token in (self.START, *self.added):
            holds |= np.asarray(pc.match_substring(texts, token))
        marked = pc.replace_substring(texts, "\n", " \n " + self.START)
        marked = pc.binary_join_element_wise(pa.scalar(self.START, pa.large_string()), marked,
                                             pa.scalar("", pa.large_string()))
        lists = pc.split_pattern(marked, " ")
        bounds = np.asarray(lists.offsets, dtype=np.int64)
        bounds = bounds - bounds[0]
        enc = lists.flatten().dictionary_encode()
        index = np.asarray(enc.indices, dtype=np.int64)
        if len(self.known) > self.keep:
            self.known.clear()
        ids = list(map(self._ids, enc.dictionary.to_pylist()))
        none = np.array([x is None for x in ids], dtype=bool)
        sizes = np.array([0 if x is None else len(x) // 4 for x in ids], dtype=np.int64)
        joined = np.frombuffer(b"".join(x for x in ids if x is not None), dtype="<u4")
        first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        out = []
        for i in range(len(texts)):
            own = index[bounds[i]:bounds[i + 1]]
            if holds[i] or none[own].any():
                out.append(np.frombuffer(self._whole(texts[i].as_py()), dtype="<u4"))
                continue
            n = sizes[own]
            ends = np.cumsum(n)
            at = np.repeat(first[own] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
            out.append(joined[at])
        return out


class WindowPacker:
    """Online sum-of-squares packing with a level array.

    ``count[h]`` is the number of open windows filled to level h. An item of
    size s goes to the open level h (0: a new window) for which the sum of
    squares of the counts is least after the move from h to h + s; a filled
    window leaves the array. Ties go to the fullest level.
    """

    def __init__(self, window: int = WINDOW, max_open: int = 4096):
        self.window, self.max_open = window, max_open
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def add(self, size: int, piece) -> list | None:
        """Place a piece; the pieces of its window if that is now full."""
        w = self.window
        before = self.count[:w - size + 1]
        gain = 2 * self.count[size:w + 1] + 1          # the target level gains a window
        gain[-1] = 0                                   # full windows are not counted
        cost = gain - np.where(before > 0, 2 * before - 1, 0)
        cost[1:][before[1:] == 0] = np.iinfo(np.int64).max
        level = len(cost) - 1 - int(np.argmin(cost[::-1]))
        pieces = self._take(level) if level else []
        pieces.append(piece)
        if level + size == w:
            return pieces
        self._put(level + size, pieces)
        return None

    def _take(self, level: int) -> list:
        stack = self.open[level]
        pieces = stack.pop()
        if not stack:
            del self.open[level]
        self.count[level] -= 1
        self.n_open -= 1
        return pieces

    def _put(self, level: int, pieces: list) -> None:
        self.open.setdefault(level, []).append(pieces)
        self.count[level] += 1
        self.n_open += 1

    def close(self, keep: int, cut) -> Iterator[list]:
        """Finish open windows until at most ``keep`` stay: pieces of the
        emptiest fill the gaps of the fullest, cut (``cut(piece, n)`` gives the
        first n tokens and the rest) where they are too long."""
        while self.n_open > max(keep, 1):
            full = max(self.open)
            gap, target = self.window - full, self._take(full)
            while gap and self.n_open:
                low = min(self.open)
                donor = self._take(low)
                piece = donor.pop()
                if piece[1] > gap:
                    head, rest = cut(piece, gap)
                    target.append(head)
                    donor.append(rest)
                    low, gap = low - gap, 0
                else:
                    target.append(piece)
                    low, gap = low - piece[1], gap - piece[1]
                if low:
                    self._put(low, donor)
            if gap:
                self._put(self.window - gap, target)
            else:
                yield target


def _cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
    doc, size, start, total, ids = piece
    return (doc, n, start, total, ids[:n]), (doc, size - n, start + n, total, ids[n:])


def _rows(sequence: int, pieces: list, with_ids: bool) -> list[tuple]:
    rows, offset = [], 0
    for doc, size, start, total, ids in pieces:
        row = (doc, start, size, zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset)
        rows.append(row + (ids.astype(np.int32),) if with_ids else row)
        offset += size
    return rows


def pack_batches(batches: Iterator[pa.RecordBatch], tokenizer_path: str, window: int, end_id: int,
                 max_open: int, with_ids: bool, partition: int) -> Iterator[pa.RecordBatch]:
    tokenizer, packer = UnitTokenizer(tokenizer_path), WindowPacker(window, max_open)
    next_id = partition << 33
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64()] * 7
    if with_ids:
        names, kinds = [*names, "ids"], [*kinds, pa.list_(pa.int32())]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for b in batches:
        rows: list[tuple] = []
        for doc, ids in zip(b.column(0).to_pylist(), tokenizer.encode(b.column(1))):
            ids = np.append(ids, np.uint32(end_id)).astype(np.uint32)
            total = len(ids)
            whole = total - total % window
            for start in range(0, whole, window):
                rows += _rows(next_id, [(doc, window, start, total, ids[start:start + window])], with_ids)
                next_id += 1
            if total > whole:
                rest = ids[whole:].copy()
                done = packer.add(total - whole, (doc, total - whole, whole, total, rest))
                if done:
                    rows += _rows(next_id, done, with_ids)
                    next_id += 1
            if packer.n_open > max_open:
                for done in packer.close(max_open // 2, _cut):
                    rows += _rows(next_id, done, with_ids)
                    next_id += 1
            if len(rows) >= 20_000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)
    rows = []
    for done in packer.close(0, _cut):
        rows += _rows(next_id, done, with_ids)
        next_id += 1
    if packer.n_open:  # the last rest: windows of power-of-two lengths
        level = max(packer.open)
        pieces = packer._take(level)[::-1]
        for size in (1 << k for k in range(level.bit_length() - 1, -1, -1)):
            if not level & size:
                continue
            own, gap = [], size
            while gap:
                piece = pieces.pop()
                if piece[1] > gap:
                    piece, rest = _cut(piece, gap)
                    pieces.append(rest)
                own.append(piece)
                gap -= piece[1]
            rows += _rows(next_id, own, with_ids)
            next_id += 1
    if rows:
        yield batch(rows)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, end_id: int = END_ID, max_open: int = 4096,
                   with_ids: bool = True) -> DataFrame:
    """One row per piece, with the piece's ids unless ``with_ids`` is false.

    ``sequence_id`` is unique over the whole result: the Spark partition's
    number and a running number inside it, the same again when a lost task is
    run anew on the same partition.
    """
    def run(batches):
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        yield from pack_batches(batches, tokenizer_path, window, end_id, max_open, with_ids, part)

    two = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return map_arrow(two, run, IDS_SCHEMA if with_ids else PIECE_SCHEMA)
