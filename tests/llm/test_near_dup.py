"""Near duplicates against all pairs, hub rounds, edge rows, SQL."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from contrail.llm import near_dup as N
from contrail.llm.queries import ORACLE, QUERIES

MEDIUM = "/root/testdata/sf0.01"
KEY = "op1_bottom_k_near_duplicates"


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows, percent=85):
    sets, parent = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                n = len(sets[i] & sets[j])
                if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                    a, b = sorted((top(i), top(j)))
                    parent[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


def corpus(seed):
    """Groups of copies that drift apart, borderline groups, shared passages, short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    common = rng.choices(vocabulary, k=60)
    texts = ["", " \n", None, "one", "One", "a b c d", "a b c d e", "A b c\td e"]
    for _ in range(6):
        base = rng.choices(vocabulary, k=rng.choice([12, 60, 150, 400]))
        now = list(base)
        for _ in range(14):
            if rng.random() < 0.5:
                now = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                now[rng.randrange(len(now))] = rng.choice(vocabulary)
            texts.append(" ".join(now))
    for _ in range(12):
        texts.append(" ".join(rng.choices(vocabulary, k=60) + common + rng.choices(vocabulary, k=20)))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,small,block", [(1, 8, 256), (2, 1, 3), (3, 2, 256)])
def test_against_all_pairs(spark, seed, small, block):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = N.near_duplicates(docs, small=small, block=block).collect()
    want = brute(rows)
    assert len(out) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_window_hashes_tell_orders_apart():
    import itertools

    import numpy as np

    from contrail.llm import words as W
    two = np.array([0x1234567890ABCDEF, 0xFEDCBA0987654321], dtype=np.uint64)
    for width in (5, 25):
        rng = random.Random(width)
        orders = (list(itertools.product([0, 1], repeat=5)) if width == 5
                  else [tuple(rng.choices([0, 1], k=width)) for _ in range(3000)])
        seen = {o: int(W.window_hashes(two[list(o)], width)[0]) for o in orders}
        assert len(set(seen.values())) == len(seen)


def test_classes_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r["class"] for r in N.classes(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_edge_rows(spark):
    rows = [(5, "a b c d e f", "x"), (5, "a b c d e f", "x"), (None, "a b c d e f", "x"), (7, "a b c d e F", "y"),
            (8, None, "z"), (8, None, "z"), (None, "", "z"), (9, "other words", None), (9, "no such words here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, content string").withColumn("kept", F.lit(1))
    out = N.near_duplicates(docs)
    assert out.count() == len(rows)
    kept = sorted((tuple(r)[:2] for r in N.keep_one_each(docs).collect()), key=str)
    assert kept == sorted([(5, "a b c d e f"), (8, None), (8, None), (None, ""), (9, "other words"),
                           (9, "no such words here")], key=str)
    assert N.near_duplicates(docs.limit(0)).count() == 0 and N.keep_one_each(docs.limit(0)).count() == 0


def test_query_equals_sql(spark):
    from oracle_harness import compare
    problems, n, _ = compare(spark, KEY, QUERIES[KEY], ORACLE[KEY], MEDIUM)
    assert not problems and n == 1000


def test_words_are_split_at_six_characters_only():
    import re

    import pyarrow as pa

    from contrail.llm import words as W
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices("ab\x00\x08\t\n\x0b\x0c\r\x0e\x1c\x1f \x85\xa0 éÀK", k=rng.randint(0, 12)))
        flat, offsets = W.split_words(pa.array([text, "x"]))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        assert flat.to_pylist()[:offsets[1]] == [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def test_pipeline_stage_drops_copies_of_80_percent(spark):
    import corpus_pipeline
    words = [f"w{k}" for k in range(204)]                       # 200 shingles
    copy = words[:50] + ["x"] + words[51:100] + ["y"] + words[101:150] + ["z"] + words[151:]   # 185 of 215: 0.86
    near = copy[:180] + ["v"] + copy[181:]                      # 180 of 220: 0.818
    rows = [(1, " ".join(words)), (2, " ".join(near))]
    a, b = (shingles(t) for _, t in rows)
    assert 0.80 <= len(a & b) / len(a | b) < 0.85
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [1]
    assert sorted(r.component_id for r in N.near_duplicates(docs, percent=85).collect()) == [1, 2]


@pytest.mark.parametrize("percent,k,least", [(85, 64, 37), (80, 64, 32), (80, 128, 75)])
def test_least_shared_follows_from_percent_and_k(percent, k, least):
    assert N.least_of(percent, k) == least
