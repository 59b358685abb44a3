"""Language identification: held-out accuracy, learning only from allowed rows, edges."""

from __future__ import annotations

import zlib

from contrail.llm import language
from contrail.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    out = QUERIES["op9_zstd_language_id"](spark, MEDIUM).collect()
    assert len(out) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)


def test_edges(spark):
    rows = [(i, t * 20, lang, "s") for i in range(40) for t, lang in (("the house and ", "en"), ("das haus und ", "de"))]
    odd = [(None, "the house and the", "en", "s"), (1000, None, "de", "s"), (1001, "12 34 !", "en", "s"),
           (1002, "", None, "s"), (1003, "und das haus", None, "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    learned = language.learn(docs.where("doc_id is not null"))
    assert {k: n for k, (n, _) in learned.items()} == {"en": 40, "de": 40}
    out = language.identify(docs, learned).collect()
    assert len(out) == 85
    got = {r.doc_id: r.lang_pred for r in out if r.doc_id is None or r.doc_id >= 1000}
    assert got == {None: "en", 1000: "und", 1001: "und", 1002: "und", 1003: "de"}
    nothing = language.identify(docs, {}).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language.learn(docs.limit(0)) == {} and language.identify(docs.limit(0), learned).count() == 0


def test_every_prediction_by_hand(spark):
    """The whole query against compression by hand, ties to the more frequent language."""
    import zstandard as z
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    learned = language.learn(docs.where(~language.held_out()))
    order = sorted(learned, key=lambda k: (-learned[k][0], k))
    out = {r.doc_id: r for r in QUERIES["op9_zstd_language_id"](spark, MEDIUM).collect()}
    for r in docs.collect():
        kept = language.letters(r.text or "").encode()
        if not kept:
            assert (out[r.doc_id].lang_pred, out[r.doc_id].score) == ("und", 0.0)
            continue
        size = {}
        for lang in order:
            content = z.ZstdCompressionDict(learned[lang][1], dict_type=z.DICT_TYPE_RAWCONTENT)
            size[lang] = len(z.ZstdCompressor(level=language.LEVEL, dict_data=content, write_content_size=False,
                                              write_checksum=False, write_dict_id=False).compress(kept))
        assert out[r.doc_id].lang_pred == min(order, key=lambda k: size[k])


def test_sample_is_bounded_and_of_different_texts(spark):
    """A third of a language's rows are one text, which counts once; no language sends more than its sample."""
    from pyspark.sql import functions as F
    same = spark.range(200_000).select("id", F.lit("the very same text again and again ").alias("text"))
    words = spark.range(400_000, 400_300).select("id", F.concat(F.lit("a house near the river "), F.translate(
        F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    rows = same.union(words).select(F.col("id").alias("doc_id"), "text", F.lit("en").alias("lang"))
    jobs = []
    real = language.letters
    try:
        language.letters = lambda t: (jobs.append(t), real(t))[1]
        learned = language.learn(rows, sample_rows=200)
    finally:
        language.letters = real
    assert learned["en"][0] == 200_300 and len(jobs) == len(set(jobs)) == 200


def test_sample_reaches_the_end_of_long_texts(spark):
    rows = [(i, "x" * 5000 + f" ending{chr(97 + i)}" * 3000, "en") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    _, content = language.learn(df)["en"]
    assert content.count(b"ending") > 500
    assert language.Classifier({"en": (1, content), "de": (1, b" das haus ")}).predict("endinga " * 500_000)[0] == "en"


def test_ties_and_repeated_rows(spark):
    rows = [(1, "abc def", "b"), (2, "abc def", "a"), (2, "abc def", "a"), (3, None, "a"), (None, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language.learn(df)
    assert learned["a"] == (2, learned["b"][1]) and learned["b"][0] == 1
    out = language.identify(df, learned).collect()
    assert sorted(r.lang_pred for r in out) == ["a", "a", "a", "und", "und"]
