"""Phrase collocations by Rabin-Karp fingerprints.

A task hashes the words of its texts and takes the prefix sums of the
polynomial of word hashes modulo 2^64; the fingerprint of any phrase is a
difference of two sums, so numpy hashes every phrase of a batch at once. A
shuffle adds up, per fingerprint, its occurrences and a second hash of each,
and keeps the smallest pointer: the bucket, by a hash of its text, of a document
with the phrase. A phrase is never more frequent than its parts, so passes go
by length: words, pairs of frequent words, then runs of three to five words
whose pairs are all frequent. Between passes a bit filter of the frequent
fingerprints (bounded size; a false hit only adds rows to a shuffle) goes to
the tasks. The empty phrase, which occurs before every word, counts a language's words.

Only frequent phrases become strings: the documents in the buckets that were
pointed to are read again, and the phrase is written out from its place there.
It stands for all occurrences if the sum of their second hashes is that of its
own. Fingerprints for which it is not (two phrases collide) are counted again by
their words, so the counts are of phrases, not of fingerprints.

Scores are computed in DECIMAL(38, 0): exact while 1000 * a * n and l * r have at
most 38 digits. The first rows of a language are ranked in two steps (shares of
its phrases, then their firsts), so no task sorts all phrases of one language.

Null or empty texts, and texts of separators alone, have no words; a null
language counts as ``und``. Repeated rows count as often as they occur. Equal
scores rank by count, then phrase. Empty tables give no rows. Only the text and
language columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import map_arrow, stage
from contrail.llm.words import GOLDEN, as_large, encode, scramble, split_words

# Fixed values of the contract.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
LONGEST = 5
MIN_COUNT = 100
SUBSUMED_PERCENT = 100
TOP = 2000
UNKNOWN = "und"

BASE = GOLDEN                       # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
MAX_FILTER_BITS = 26
PIECE_BITS = 19                     # a filter is put together from pieces of 64 KB
HELD = 2_000_000                    # fingerprints a task holds before it passes its counts on
POINTER_BITS = 20                   # documents are pointed to by bucket
CHECK_BITS = 24                     # of the second hash
SHARES = 64                         # a language's phrases are ranked in so many shares first

BYTES = np.arange(256, dtype=np.uint8)
BREAKS = np.isin(BYTES, np.frombuffer(SEPARATORS, np.uint8))
FOLDED = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype(np.uint8)
FOLDED[BREAKS] = 32
INSIDE = (FOLDED != 32) & (FOLDED != 9)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def two_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word."""
    both = b"".join(xxhash.xxh3_128_digest(w) for w in words.cast(pa.large_binary()).to_pylist())
    both = np.frombuffer(both, np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


class Phrases:
    """All phrases of one batch of texts, by first word and length."""

    def __init__(self, texts: pa.Array, langs: list[str | None]):
        texts = as_large(texts)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        folded = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(FOLDED[data]))
        flat, first = split_words(folded, lower=False)
        self.words, self.codes = encode(flat)
        self.langs = [UNKNOWN if x is None else x for x in langs]
        self.lang = np.repeat(np.arange(len(texts)), np.diff(first))       # the text of each word

        inside = INSIDE[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        at = offsets[:-1][offsets[1:] > offsets[:-1]]
        begins[at] = inside[at]
        starts = np.flatnonzero(begins)
        self.piece = np.cumsum(BREAKS[data], dtype=np.int64)[starts] + self.lang   # changes at separators and texts

        n = len(self.codes)
        up = powers(BASE, n)
        self.sums, self.check_sums = (
            np.concatenate((np.zeros(1, np.uint64), np.cumsum(h[self.codes] * up, dtype=np.uint64)))
            for h in two_hashes(self.words))
        self.back = powers(INVERSE, n)
        self.salts = np.array([xxhash.xxh3_64_intdigest(x) for x in self.langs], dtype=np.uint64)

    def fingerprints(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every run of ``length`` words its fingerprint, and whether it lies within a piece."""
        n = len(self.codes) - max(length - 1, 0)
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        value = (self.sums[length:length + n] - self.sums[:n]) * self.back[:n]
        value = scramble(value ^ self.salts[self.lang[:n]] ^ np.uint64(length * GOLDEN % (1 << 64)))
        return value, self.piece[:n] == self.piece[max(length - 1, 0):][:n]

    def checks(self, length: int, first: np.ndarray) -> np.ndarray:
        """The second hashes of the phrases that begin at the words ``first``."""
        value = (self.check_sums[first + length] - self.check_sums[first]) * self.back[first]
        return (scramble(value ^ np.uint64(length)) >> np.uint64(64 - CHECK_BITS)).astype(np.int64)

    def frequent(self, filters: dict[int, np.ndarray], lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length the first words and fingerprints of phrases that may be frequent: their
        own filter lets them through if there is one, and so do those of their words and pairs."""
        parts, size = None, 0   # may a part of ``size`` words be frequent, by its first word
        for length in range(max(lengths) + 1):
            own = filters.get(length)
            narrows = own is not None and length in (1, 2)
            if length not in lengths and not narrows:
                continue
            value, whole = self.fingerprints(length)
            if parts is not None:
                for k in range(length - size + 1):
                    whole &= parts[k:k + len(whole)]
            if own is not None:
                whole &= has(own, value)
            if length in lengths:
                chosen = np.flatnonzero(whole)
                yield length, chosen, value[chosen]
            if narrows:
                parts, size = whole, length


def has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


class Counts:
    """Fingerprints with occurrences, sum of second hashes and smallest pointer."""

    HOW = (np.add, np.add, np.minimum)

    def __init__(self):
        self.columns = np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in self.HOW)
        self.waiting, self.held = [], 0

    def add(self, fp: np.ndarray, check: np.ndarray, pointer: np.ndarray) -> None:
        self.waiting.append((fp, check.astype(np.int32), pointer.astype(np.int32)))
        self.held += len(fp)

    def fold(self) -> int:
        fps, checks, pointers = (list(c) for c in zip(*self.waiting)) if self.waiting else ([], [], [])
        more = [np.ones(self.held, np.int64)], checks, pointers
        self.waiting, self.held = [], 0
        old, *values = self.columns
        fp = np.concatenate([old, *fps])
        order = np.argsort(fp, kind="stable")
        fp = fp[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(fp)), bool), fp[1:] != fp[:-1])))
        if len(first):
            values = [how.reduceat(np.concatenate([v, *m], dtype=np.int64)[order], first)
                      for how, v, m in zip(self.HOW, values, more)]
        self.columns = fp[first], *values
        return len(first)

    def batch(self) -> pa.RecordBatch:
        fp, *values = self.columns
        return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), *map(pa.array, values)],
                                          names=["fp", "f", "checks", "pointer"])


def count_fingerprints(texts: DataFrame, lengths: list[int], filters: dict, min_count: int) -> DataFrame:
    """The fingerprints of ``lengths`` that occur ``min_count`` times, staged."""
    filters = texts.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for batch in batches:
            phrases = Phrases(batch.column("text"), batch.column("lang").to_pylist())
            pointer = np.asarray(batch.column("pointer"))
            for length, first, found in phrases.frequent(filters.value, lengths):
                counts.add(found, phrases.checks(length, first), pointer[phrases.lang[first]])
            if counts.held > HELD // 2 and counts.fold() > HELD:
                yield counts.batch()
                counts = Counts()
        counts.fold()
        yield counts.batch()

    found = map_arrow(texts, run, "fp long, f long, checks long, pointer long").groupBy("fp").agg(
        F.sum("f").alias("f"), F.sum("checks").alias("checks"), F.min("pointer").alias("pointer"))
    return stage(found.where(F.col("f") >= min_count), "collocation-fingerprints")


def bit_filter(values: DataFrame) -> np.ndarray:
    """The leading bits of the column ``fp`` as a bitmap of at most 2^26 bits: 16 for each row."""
    size = min(MAX_FILTER_BITS, max(POINTER_BITS, PIECE_BITS, (16 * values.count()).bit_length()))

    def piece(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << PIECE_BITS, np.uint8)
        bits[np.asarray(table["at"]) & ((1 << PIECE_BITS) - 1)] = 1
        return pa.table({"piece": table["piece"][:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()])})

    at = F.shiftrightunsigned("fp", 64 - size)
    places = values.select(at.alias("at"), F.shiftright(at, PIECE_BITS).alias("piece")).distinct()
    out = np.zeros((1 << (size - PIECE_BITS), 1 << (PIECE_BITS - 3)), np.uint8)
    for row in places.groupBy("piece").applyInArrow(piece, "piece long, bits binary").collect():
        out[row.piece] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def written(phrases: Phrases, length: int, first: np.ndarray) -> list[tuple[str, str]]:
    """Language and phrase at each of the words ``first``."""
    spelled = Spelled(phrases.words)
    return [(phrases.langs[phrases.lang[at]], " ".join(spelled[c] for c in phrases.codes[at:at + length].tolist()))
            for at in first.tolist()]


class Spelled(dict):
    """Words by code, taken from Arrow once."""

    def __init__(self, words: pa.Array):
        super().__init__()
        self.words = words

    def __missing__(self, code: int) -> str:
        self[code] = word = self.words[int(code)].as_py()
        return word


def pointed(found: DataFrame) -> DataFrame:
    """Fingerprint and pointer as one value, for a filter of the pairs."""
    return found.select(F.col("fp").bitwiseXOR(F.shiftleft("pointer", 64 - POINTER_BITS)).alias("fp"))


def materialise(texts: DataFrame, found: DataFrame, filters: dict) -> DataFrame:
    """``found`` with language, phrase and its second hash, from the documents pointed
    to; staged. Colliding phrases in these documents give a row each."""
    wanted = bit_filter(found.select(F.shiftleft("pointer", 64 - POINTER_BITS).alias("fp")).distinct())
    shared = texts.sparkSession.sparkContext.broadcast((filters, wanted, bit_filter(pointed(found))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, wanted, pairs = shared.value
        for batch in batches:
            high = np.asarray(batch.column("pointer")).astype(np.uint64) << np.uint64(64 - POINTER_BITS)
            rows = np.flatnonzero(has(wanted, high))
            if not len(rows):
                continue
            batch, high = batch.take(pa.array(rows)), high[rows]
            phrases = Phrases(batch.column("text"), batch.column("lang").to_pylist())
            for length, first, values in phrases.frequent(filters, list(range(LONGEST + 1))):
                near = has(pairs, values ^ high[phrases.lang[first]])
                first, values = first[near], values[near]
                at = high[phrases.lang[first]]
                checks = phrases.checks(length, first)
                order = np.lexsort((checks, at, values))
                first, values, at, checks = first[order], values[order], at[order], checks[order]
                new = np.ones(len(first), bool)   # one row for each fingerprint, bucket and second hash
                new[1:] = (values[1:] != values[:-1]) | (at[1:] != at[:-1]) | (checks[1:] != checks[:-1])
                first = first[new]
                langs, spelled = zip(*written(phrases, length, first)) if len(first) else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[new].view(np.int64)), pa.array((at[new] >> np.uint64(64 - POINTER_BITS)).view(np.int64)),
                     pa.array(langs, pa.string()), pa.array(spelled, pa.string()), pa.array(checks[new])],
                    names=["fp", "pointer", "lang", "phrase", "check"])

    spelled = map_arrow(texts, run, "fp long, pointer long, lang string, phrase string, check long")
    return stage(spelled.distinct().join(found, ["fp", "pointer"]), "collocation-phrases")


def recount(texts: DataFrame, collided: DataFrame, filters: dict, min_count: int) -> DataFrame:
    """Counts by language and phrase, from the texts, of all phrases whose fingerprints collide."""
    shared = texts.sparkSession.sparkContext.broadcast((filters, bit_filter(collided)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, chosen = shared.value
        for batch in batches:
            phrases = Phrases(batch.column("text"), batch.column("lang").to_pylist())
            for length, first, values in phrases.frequent(filters, list(range(LONGEST + 1))):
                near = has(chosen, values)
                rows = Counter(zip(values[near].view(np.int64).tolist(), written(phrases, length, first[near])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in rows], pa.int64()), pa.array([k[1][0] for k in rows], pa.string()),
                     pa.array([k[1][1] for k in rows], pa.string()), pa.array(list(rows.values()), pa.int64())],
                    names=["fp", "lang", "phrase", "f"])

    rows = map_arrow(texts, run, "fp long, lang string, phrase string, f long").groupBy("fp", "lang", "phrase").agg(
        F.sum("f").alias("f"))
    return rows.where(F.col("f") >= min_count).join(collided, "fp", "semi").select("lang", "phrase", "f")


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Exact counts (lang, phrase, f) of the phrases of up to five words that occur
    ``min_count`` times in a language; the empty phrase counts its words."""
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    texts = docs.select(text.alias("text"), lang.alias("lang"),
                        F.shiftrightunsigned(F.xxhash64(lang, text), 64 - POINTER_BITS).alias("pointer"))
    filters, found = {}, []
    for lengths in ([0, 1], [2], list(range(3, LONGEST + 1))):
        found.append(count_fingerprints(texts, lengths, filters, min_count))
        filters = filters | dict.fromkeys(lengths, bit_filter(found[-1]))
    found = found[0].unionByName(found[1]).unionByName(found[2])
    phrases = materialise(texts, found, filters)
    one = (F.col("f") * F.col("check") == F.col("checks")) & (F.count("*").over(Window.partitionBy("fp")) == 1)
    phrases = phrases.withColumn("one", one)
    counts = phrases.where("one").select("lang", "phrase", "f")
    collided = phrases.where(~F.col("one")).select("fp").distinct()
    if collided.isEmpty():
        return stage(counts, "collocation-counts")
    return stage(counts.unionByName(recount(texts, collided, filters, min_count)), "collocation-counts")


def exact_score(a: Column, l: Column, r: Column, n: Column) -> Column:
    """floor(1000 * a * n / (l * r)) without loss; it is at most 1000 * n."""
    wide = "decimal(38,0)"
    return F.call_function("div", a.cast(wide) * F.lit(1000) * n.cast(wide), l.cast(wide) * r.cast(wide))


def ranked(rows: DataFrame, top: int) -> DataFrame:
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    rows = rows.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    rows = rows.where(F.col("rank") <= top).drop("rank", "share")
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return rows.where(F.col("rank") <= top)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, subsumed_percent: int = SUBSUMED_PERCENT, top: int = TOP,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's first ``top`` phrases by the score of their weakest cut."""
    counts = frequent_phrases(docs, min_count, text_col, lang_col)
    sizes = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    known = counts.where("phrase <> ''")
    words, size = F.col("words"), F.size("words")
    phrases = (known.withColumn("words", F.split("phrase", " ")).where(size >= 2)
               .select("lang", "phrase", F.col("f").alias("a"), "words"))

    def joined(start: Column, length: Column) -> Column:
        return F.array_join(F.slice(words, start, length), " ")

    # The contiguous parts of two words or more of longer phrases, with the longer one's count.
    inner = phrases.where(size >= 3).withColumn("part_size", F.explode(F.sequence(F.lit(2), size - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), size - F.col("part_size") + 1)))
    longer = (inner.groupBy("lang", joined(F.col("start"), F.col("part_size")).alias("phrase"))
              .agg(F.max("a").alias("longer")))
    kept = phrases.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < subsumed_percent * F.col("a"))).drop("longer")

    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = (cuts.withColumns({"first": joined(F.lit(1), F.col("k")), "rest": joined(F.col("k") + 1, size - F.col("k"))})
            .drop("words").join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(sizes, "lang"))
    score = exact_score(F.col("a"), F.col("l"), F.col("r"), F.col("n"))
    best = (cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    return ranked(best, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
