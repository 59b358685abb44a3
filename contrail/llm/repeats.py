"""Repeated passages by sparse suffix arrays.

A passage is a run of ``LEAST`` words or more that two documents have in
common. Suffixes are kept only at minimiser positions: in every run of
``SPAN`` windows of ``GRAM`` words, the one whose window has the smallest hash,
so equal passages keep equal suffixes whatever stands around them. The suffixes
are sorted by their words, as hashes; each is compared with its neighbours of
other documents, and matches are extended right and left. Sorting once by what
follows and once by what stands before, and keeping the longest extent each
way, gives every suffix its passage; the union over a document's suffixes is
the whole of it, since an extension (``LEFT`` words back, ``DEPTH + MORE``
forward) reaches past the next kept suffix.

A passage's first kept suffix is among its first ``SPAN`` words, so copies of
one passage agree in ``DEPTH = LEAST - SPAN + 1`` words from there: only
suffixes whose first ``DEPTH`` words occur in two documents are looked at. Runs
shared by two documents are found if the neighbours in the order are them, or
agree in as much; passages of ``LEAST + SPAN`` words or more always.

How it scales: documents are read once for the suffixes' hashes and once more,
by a join, for the surroundings of those that repeat. Equal surroundings are
one row before they are sorted, so a hot group of copies costs no more than a
row for each task; rows of one first ``DEPTH`` words are sorted by Spark and
streamed, never gathered in memory.

Null and short texts have no passages. Only documents that hold one are in the
result. Repeated rows (equal id and text) are one document; null ids are
compared by text. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import map_arrow, stage

LEAST = 50
GRAM, SPAN = 5, 26
DEPTH = LEAST - SPAN + 1
LEFT, MORE = SPAN, LEAST - DEPTH
BYTES = 4               # of a word's hash in the sorted surroundings


def kept_places(hashes: np.ndarray) -> np.ndarray:
    """Minimiser positions of a text's word hashes, of which DEPTH words follow."""
    if len(hashes) < LEAST:
        return np.zeros(0, np.int64)
    grams = W.window_hashes(hashes, GRAM)
    view = np.lib.stride_tricks.sliding_window_view(grams, SPAN)
    places = np.unique(view.argmin(axis=1) + np.arange(len(view)))
    return places[places + DEPTH <= len(hashes)]


def _text_hashes(texts: pa.Array) -> list[np.ndarray]:
    flat, offsets = W.split_words(texts)
    words, index = W.encode(flat)
    hashes = W.hash_words(words)[index]
    return [hashes[a:b] for a, b in zip(offsets, offsets[1:])]


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("content"))


def suffixes(docs: DataFrame) -> DataFrame:
    """(id, content, at, key): the kept suffixes and the hash of their first words."""
    def run(batches):
        for b in batches:
            at, key, n = [], [], []
            for hashes in _text_hashes(b.column(1)):
                places = kept_places(hashes)
                at.append(places)
                key.append(W.window_hashes(hashes, DEPTH)[places] if len(places) else np.zeros(0, np.uint64))
                n.append(len(places))
            row = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(row), b.column(2).take(row), pa.array(np.concatenate(at).astype(np.int64)),
                 pa.array(np.concatenate(key).view(np.int64))], ["id", "content", "at", "key"])

    return map_arrow(docs, run, "id long, content long, at long, key long")


def surroundings(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(id, content, at, key, after, before): the words after a suffix's first
    DEPTH and, backwards, those before it, as bytes that sort and compare by word."""
    def run(batches):
        for b in batches:
            out: list[list] = [[], [], [], []]
            n = []
            for hashes, own in zip(_text_hashes(b.column(1)), b.column(3).to_pylist()):
                own = np.array(sorted(own), dtype=np.int64)
                small = hashes.astype(">u4")
                keys = W.window_hashes(hashes, DEPTH)
                n.append(len(own))
                out[0] += own.tolist()
                out[1].append(keys[own].view(np.int64))
                out[2] += [small[p + DEPTH:p + DEPTH + MORE].tobytes() for p in own]
                out[3] += [small[max(p - LEFT, 0):p][::-1].tobytes() for p in own]
            row = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(row), b.column(2).take(row), pa.array(out[0], pa.int64()),
                 pa.array(np.concatenate(out[1])), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
                ["id", "content", "at", "key", "after", "before"])

    same = docs["content"].eqNullSafe(places["content"]) & docs["id"].eqNullSafe(places["id"])
    both = docs.join(places, same).select(docs["id"], "text", docs["content"], "ats")
    return map_arrow(both, run, "id long, content long, at long, key long, after binary, before binary")


def _common_words(a: bytes, b: bytes) -> int:
    if a == b:
        return len(a) // BYTES
    n = min(len(a), len(b))
    x = np.frombuffer(a, np.uint32, n // BYTES) != np.frombuffer(b, np.uint32, n // BYTES)
    return int(x.argmax()) if x.any() else n // BYTES


class Neighbours:
    """Compares a sorted stream of (key, after, before, lo, hi, first_id, c) rows:
    each with the nearest row of another document on either side. ``lo`` and
    ``hi`` are the smallest and largest document that has these surroundings."""

    def __init__(self) -> None:
        self.key = None
        self.run: list[tuple] = []      # rows of one document that come together
        self.before: tuple | None = None  # the row before them
        self.out: list[tuple] = []

    @staticmethod
    def _one(row: tuple):
        return row[3] if row[3] == row[4] else None

    def _match(self, x: tuple, y: tuple) -> None:
        right, left = DEPTH + _common_words(x[1], y[1]), _common_words(x[2], y[2])
        if left + right >= LEAST:
            first = min((i for i in (x[5], y[5]) if i is not None), default=None)
            self.out += [(x[0], x[6], left, right, first), (y[0], y[6], left, right, first)]

    def add(self, row: tuple) -> None:
        if row[0] != self.key:
            self.key, self.run, self.before = row[0], [], None
        if self._one(row) is None:   # several documents have it: its own match
            left, right = len(row[2]) // BYTES, DEPTH + len(row[1]) // BYTES
            if left + right >= LEAST:
                self.out.append((row[0], row[6], left, right, row[5]))
        if self.run and self._one(row) is not None and self._one(self.run[-1]) == self._one(row):
            if self.before:
                self._match(row, self.before)
            self.run.append(row)
            return
        for other in self.run:
            self._match(row, other)
        self.before = self.run[-1] if self.run else None
        self.run = [row]


MATCH = "key long, c long, l long, r long, first_id long"


def compared(rows: DataFrame) -> DataFrame:
    """The matches of a sorted partition's neighbours."""
    def run(batches):
        state = Neighbours()
        for b in batches:
            for row in zip(*(b.column(n).to_pylist() for n in ("key", "after", "before", "lo", "hi", "first_id", "c"))):
                state.add(row)
            if state.out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*state.out)],
                                                 ["key", "c", "l", "r", "first_id"])
                state.out = []

    return map_arrow(rows, run, MATCH)


def merged(parts: DataFrame) -> DataFrame:
    """Per document the union of the extents [start, stop) that touch."""
    def run(batches):
        now, start, stop, first, done = None, 0, 0, None, []
        for b in batches:
            for doc, content, a, z, f in zip(*(c.to_pylist() for c in b.columns)):
                if (doc, content) == now and a <= stop:
                    stop = max(stop, z)
                    first = f if first is None else first if f is None else min(first, f)
                    continue
                if now is not None:
                    done.append((now[0], start, stop, stop - start, first))
                now, start, stop, first = (doc, content), a, z, f
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)],
                                                 ["doc_id", "start_word", "end_word", "n_words", "first_doc_id"])
                done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int64()) for c in (now[0], start, stop, stop - start, first)],
                ["doc_id", "start_word", "end_word", "n_words", "first_doc_id"])

    dealt = parts.repartition("id", "content").sortWithinPartitions("id", "content", "start", "stop")
    return map_arrow(dealt, run, "doc_id long, start_word long, end_word long, n_words long, first_doc_id long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage of a document that another document holds too: doc_id,
    start_word, end_word (exclusive), n_words, and first_doc_id, the smallest id
    seen with it: a copy to keep."""
    own = _documents(docs, id_col, text_col)
    every = suffixes(own)
    doc = F.xxhash64("id", "content")
    twice = every.groupBy("key").agg(F.min(doc).alias("lo"), F.max(doc).alias("hi")).where("lo < hi").select("key")
    places = every.join(twice, "key", "left_semi").groupBy("id", "content").agg(F.collect_set("at").alias("ats"))
    found = surroundings(own, places).withColumn("c", F.xxhash64("after", "before"))
    found = stage(found, "surroundings")
    # equal surroundings are one row, added up before the shuffle
    alike = found.groupBy("key", "after", "before", "c").agg(F.min(doc).alias("lo"), F.max(doc).alias("hi"),
                                                             F.min("id").alias("first_id"))
    by_key = alike.repartition("key")  # one exchange, sorted twice
    right = compared(by_key.sortWithinPartitions("key", "after", "before", "c"))
    left = compared(by_key.sortWithinPartitions("key", "before", "after", "c"))
    best = right.union(left).groupBy("key", "c").agg(F.max("l").alias("l"), F.max("r").alias("r"),
                                                     F.min("first_id").alias("first_id"))
    parts = found.select("key", "c", "id", "content", "at").join(best, ["key", "c"]).select(
        "id", "content", (F.col("at") - F.col("l")).alias("start"), (F.col("at") + F.col("r")).alias("stop"), "first_id")
    return merged(parts)
