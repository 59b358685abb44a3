"""Packing against whole-text tokenising, and the level array's rule."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa

from contrail.llm.packing import UnitTokenizer, WindowPacker, pack_documents
from contrail.llm.queries import QUERIES, tokenizer_path

SMALL = "/root/testdata/sf0.001"


def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return t


def check(pieces, texts, whole):
    by_doc = {}
    windows = {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert zlib.crc32(ids[r["start"]:at].tobytes()) == r["ids_crc32"]
        assert at == len(ids)
    padding = 0
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= 1024


def test_query_against_whole_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    pieces = [r.asDict() for r in QUERIES["op4_sum_of_squares_packing"](spark, SMALL).collect()]
    check(pieces, {r.doc_id: r.text for r in docs}, tokenizer())


def test_odd_texts(spark):
    texts = {1: None, 2: "", 3: "  a  b\n\n c ", 4: "a\n \nb \n", 5: "\x00x y", 6: "don't stop  it's",
             7: "<|endoftext|> x", 8: "word " * 5000, 9: "\n", 10: " ", 11: "a b\r\n c\td", 12: "\U0001f600 \U0001f600"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    pieces = [r.asDict() for r in pack_documents(docs.repartition(1), tokenizer_path()).collect()]
    check(pieces, texts, tokenizer())
    assert pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_unit_ids_equal_whole_ids():
    import pyarrow as pa
    rng, whole, units = random.Random(3), tokenizer(), UnitTokenizer(tokenizer_path())
    for _ in range(300):
        text = "".join(rng.choices(["the", " the", " ", "\n", "'s", "été", "42", ".", "\t", "ab", " "],
                                   k=rng.randint(0, 20)))
        assert units.encode(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_texts_that_hold_the_marker():
    import pyarrow as pa
    whole, units = tokenizer(), UnitTokenizer(tokenizer_path())
    texts = ["foo \x00bar", "foo bar", "a \x00.", "\x00\x00a", "x\n\x00y z", "\x00", "end \x00"]
    for text, ids in zip(texts, units.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_placement_minimises_the_sum_of_squares():
    rng, packer = random.Random(5), WindowPacker(16)
    for _ in range(500):
        size, before = rng.randint(1, 15), packer.count.copy()
        packer.add(size, (0, size, 0, size, None))
        after = packer.count
        best = None
        for level in [0, *np.flatnonzero(before[:16])]:
            if level + size <= 16:
                trial = before.copy()
                trial[level] -= level > 0
                if level + size < 16:
                    trial[level + size] += 1
                value = int((trial[1:16] ** 2).sum())
                best = value if best is None else min(best, value)
        assert int((after[1:16] ** 2).sum()) == best


def test_open_windows_stay_bounded(spark):
    docs = spark.createDataFrame([(i, "a b " * 300) for i in range(400)], "doc_id long, text string").repartition(1)
    out = pack_documents(docs, tokenizer_path(), max_open=8).groupBy("sequence_id").sum("length").collect()
    assert sum(1 for r in out if r["sum(length)"] != 1024) <= 10


def test_added_tokens_in_a_text_are_found_as_the_library_finds_them():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  z\n", "<|endo", None, "plain words"]
    own = UnitTokenizer(tokenizer_path()).encode(pa.array(texts))
    assert [x.tolist() for x in own] == [tokenizer().encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(own[0]) < 9
