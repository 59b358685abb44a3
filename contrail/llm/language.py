"""Language identification by compression.

For each language a zstandard raw-content dictionary is filled with excerpts
of labelled rows. A text (its letters, lower-cased, other characters as single
spaces) is compressed whole once per dictionary, and the language with the
smallest output wins; ties go to the language with more labelled rows, then by
name. Narrow margins are marked ``rejected``.

Learning reads a bounded, documented sample: of each language's different
labelled texts the ``sample_rows`` with the smallest hashes, of each an excerpt
of ``excerpt`` characters from a place in the whole text that the hash chooses,
``dict_bytes`` per dictionary and ``all_bytes`` for all of them. Equal texts
count once, so repeated rows neither fill the sample nor reach the driver.
Prediction reads every row and the whole text, and never the label, source or
id.

Null texts and texts without a letter are ``und`` with score 0, as is every
text if nothing was learned. Rows with a null id are predicted but not learned
from. Repeated rows give repeated results. Only the id, text and label columns
are read.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import map_arrow

UNKNOWN = "und"
SAMPLE_ROWS, EXCERPT = 200, 400
DICT_BYTES, ALL_BYTES = 32 << 10, 16 << 20
LEVEL = 6
# A margin under this many bytes, or this share of the smallest output, is narrow.
MARGIN_BYTES, MARGIN_SHARE = 2, 0.005
# How fast a larger output loses probability, for each byte.
PER_BYTE = 0.5

NOT_LETTERS = re.compile(r"[\W\d_]+")
SCALE = 1 << 30


def letters(text: str) -> str:
    """Lower-cased letters with single spaces around and between; empty if none."""
    kept = NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {kept} " if any(c.isalpha() for c in kept) else ""


def learn(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample_rows: int = SAMPLE_ROWS, excerpt: int = EXCERPT, dict_bytes: int = DICT_BYTES,
          all_bytes: int = ALL_BYTES) -> dict[str, tuple[int, bytes]]:
    """Per language its number of labelled rows and its dictionary's content."""
    own = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    own = own.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    counts = {r["lang"]: r for r in own.groupBy("lang").agg(
        F.count("*").alias("n"), F.approx_count_distinct("h", 0.02).alias("texts")).collect()}
    if not counts:
        return {}
    # about four times the texts wanted, so that only they are shuffled; the smallest hashes are among them
    near = F.create_map(*(F.lit(x) for lang, r in counts.items()
                          for x in (lang, min(SCALE, math.ceil(4 * SCALE * sample_rows / max(r["texts"], 1))))))
    place = F.pmod("h", F.lit(SCALE))
    at = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - excerpt, F.lit(0)) + 1) + 1
    some = own.where(place < near[F.col("lang")]).select(
        "lang", place.alias("place"), "h", F.substring(F.col("text"), at.cast("int"), F.lit(excerpt)).alias("text"))
    first = Window.partitionBy("lang").orderBy("place", "h")
    chosen = some.groupBy("lang", "place", "h").agg(F.min("text").alias("text")) \
        .withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= sample_rows)
    taken: dict[str, list[tuple[int, str]]] = {lang: [] for lang in counts}
    for r in chosen.select("lang", "nth", "text").collect():  # at most sample_rows a language
        taken[r["lang"]].append((r["nth"], r["text"]))
    limit = min(dict_bytes, all_bytes // len(counts))
    out = {}
    for lang in sorted(counts):
        parts = dict.fromkeys(letters(t) for _, t in sorted(taken[lang]))
        out[lang] = (counts[lang]["n"], "".join(parts).encode()[:limit])
    return out


class Classifier:
    def __init__(self, learned: dict[str, tuple[int, bytes]], level: int = LEVEL):
        import zstandard as z
        self.order = sorted(learned, key=lambda lang: (-learned[lang][0], lang))
        self.compressors = []
        for lang in self.order:
            content = z.ZstdCompressionDict(learned[lang][1] or b" " * 8, dict_type=z.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.compressors.append(z.ZstdCompressor(level=level, dict_data=content, write_content_size=False,
                                                     write_checksum=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in 0 to 1, and whether the margin was narrow."""
        kept = letters(text) if text and self.order else ""
        if not kept:
            return UNKNOWN, 0.0, True
        data = kept.encode()
        sizes = [len(c.compress(data)) for c in self.compressors]
        best = min(sizes)
        score = 1 / sum(math.exp(-PER_BYTE * (s - best)) for s in sizes)
        next_best = sorted(sizes)[1] if len(sizes) > 1 else best + len(data)
        narrow = next_best - best < max(MARGIN_BYTES, MARGIN_SHARE * best)
        return self.order[sizes.index(best)], score, narrow


def identify(docs: DataFrame, learned: dict[str, tuple[int, bytes]], text_col: str = "text",
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, lang_pred, score and rejected of every row."""
    n = len(keep)

    def run(batches):
        classifier = Classifier(learned)
        for b in batches:
            got = [classifier.predict(t) for t in b.column(n).to_pylist()]
            lang, score, narrow = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(narrow, pa.bool_())], [*keep, "lang_pred", "score", "rejected"])

    own = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:n])
    return map_arrow(own, run, f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
