"""Repeated passages against brute force over all positions, and edge rows."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from contrail.llm import repeats as R
from contrail.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def brute(rows):
    """Word places of each document in 50-word runs that a document with another id holds."""
    holders = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - 49):
            holders.setdefault(tuple(w[i:i + 50]), set()).add(doc)
    out = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - 49):
            if holders[tuple(w[i:i + 50])] - {doc}:
                out.setdefault(doc, set()).update(range(i, i + 50))
    return out


def covered(result):
    out = {}
    for r in result:
        assert r.n_words == r.end_word - r.start_word >= 50 and r.first_doc_id <= r.doc_id
        out.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    return out


def test_against_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"v{k}" for k in range(500)]
    passages = [rng.choices(vocabulary, k=n) for n in (49, 50, 51, 60, 90, 200, 400)]
    rows = []
    for i in range(60):
        w = rng.choices(vocabulary, k=rng.randint(0, 150))
        for p in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            w[at:at] = p
        rows.append((i, " ".join(w)))
    rows += [(100 + i, rows[3][1].upper()) for i in range(3)]
    rows += [(200, "the same " * 200), (201, " ".join(passages[5] * 2)), (202, " ".join(passages[3][5:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert covered(R.repeated_passages(docs).collect()) == brute(rows)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert covered(QUERIES["op2_sparse_suffix_repeats"](spark, SMALL).collect()) == brute(rows)


def test_edges(spark):
    text = " ".join(f"x{i}" for i in range(80))
    rows = [(1, text, "a"), (1, text, "a"), (2, None, "b"), (3, "", "c"), (4, "y " * 3000, None), (None, text + " z", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, content string").withColumn("id", F.lit(0))
    got = sorted(((r.doc_id, r.start_word, r.end_word) for r in R.repeated_passages(docs).collect()), key=str)
    assert got == [(1, 0, 80), (None, 0, 80)]
    alone = docs.where("doc_id = 1")
    assert R.repeated_passages(alone).count() == 0 and R.repeated_passages(docs.limit(0)).count() == 0
