"""Collocations against a plain count of all phrases, and defined edge cases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contrail.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, phrase string"


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, min_count, top=2000, percent=100):
    f, n = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for words in words_of(text):
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    known = {k: c for k, c in f.items() if len(k[1]) >= 2 and c >= min_count}
    hidden = set()
    for (lang, phrase), c in known.items():
        for size in range(2, len(phrase)):
            for i in range(len(phrase) - size + 1):
                part = lang, phrase[i:i + size]
                if 100 * c >= percent * known[part]:
                    hidden.add(part)
    out = {}
    for (lang, phrase), a in known.items():
        if (lang, phrase) not in hidden:
            cuts = [(1000 * a * n[lang] // (f[lang, phrase[:k]] * f[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), f[lang, phrase[:k]], f[lang, phrase[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def ours(spark, rows, *args):
    return sorted(tuple(r) for r in C.collocations(spark.createDataFrame(rows, SCHEMA), *args).collect())


def random_rows(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "New", "york", "ciTY", "é", "𝔘", "x-y", "\x1c"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice((" ", " ", "  ", "\t", ", ", ".", "\n")) for _ in range(rng.randint(0, 30)))
        rows.append((i, text + rng.choice(("", "new york city")), rng.choice(("en", "de", None, "und")), "x"))
    return rows


@pytest.mark.parametrize("min_count", [1, 3, 20])
def test_random_texts(spark, min_count):
    rows = random_rows(min_count, 150) + [(900, None, "en", None), (901, "", "fr", "x"), (902, " .,\n", "fr", "x"),
                                          (903, "one", "fr", "x"), (904, "b a " * 20_000, "es", "x")]
    rows += [(905, "same row, same words here", "en", "x")] * 40
    want = brute(rows, min_count)
    assert want and ours(spark, rows, min_count) == want


def test_parameters_and_empty(spark):
    rows = random_rows(9, 100)
    assert ours(spark, rows, 4, 50, 3) == brute(rows, 4, 3, 50)
    assert ours(spark, [], 1) == [] and ours(spark, [(1, None, None, None)], 1) == []


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    """Half of all fingerprints are one of 16; the second hashes still differ."""
    mix = C.scramble
    monkeypatch.setattr(C, "scramble", lambda x: np.where(mix(x) % np.uint64(2) == 1, mix(x) << np.uint64(60), mix(x)))
    rows = random_rows(4, 80)
    assert ours(spark, rows, 5) == brute(rows, 5)


def test_tasks_that_pass_on_early(spark, monkeypatch):
    monkeypatch.setattr(C, "HELD", 50)
    monkeypatch.setattr(C, "POINTER_BITS", 2)
    monkeypatch.setattr(C, "SHARES", 2)
    rows = random_rows(5, 120)
    assert ours(spark, rows, 3, 100, 10) == brute(rows, 3, 10)


def test_prefix_polynomials_hash_equal_runs_alike():
    p = C.Phrases(pa.array(["a b c a b. c a b", "b c a"]), ["en", "en"])
    value, whole = p.fingerprints(3)
    runs = [tuple(p.words[int(c)].as_py() for c in p.codes[i:i + 3]) for i in range(len(value))]
    assert all((value[i] == value[j]) == (runs[i] == runs[j]) for i in range(len(runs)) for j in range(len(runs)))
    assert [r for r, w in zip(runs, whole) if w] == [tuple("abc"), tuple("bca"), tuple("cab"), tuple("cab"), tuple("bca")]


def test_scores_beyond_64_bits(spark):
    rows = [(10 ** 16 + 7, 10 ** 16 + 9, 10 ** 16 + 11, 10 ** 17 - 1), (100, 100, 100, 100), (3, 7, 11, 10 ** 17)]
    df = spark.createDataFrame(rows, "a long, l long, r long, n long")
    got = [r[0] for r in df.select(C.exact_score(F.col("a"), F.col("l"), F.col("r"), F.col("n"))).collect()]
    assert got == [1000 * a * n // (l * r) for a, l, r, n in rows]
