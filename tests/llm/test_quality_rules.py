"""Base counts against plain Python, the estimate against numpy, edges."""

from __future__ import annotations

import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import quality_rules as Q
from contrail.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    where = {}
    for i in range(len(words) - 4):
        where.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {k for at in where.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    n, repeat = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat,
            n < 10 or 100 * repeat > 20 * n)


TEXTS = ["", None, " \t\n\x0b\x0c\r ", "a", "a b c d e", "a b c d e a b c d e", "x " * 30, "a\x1cb \x85c d", "é#*$%&|<>",
         "l one\nl one\n\n\n l one\nl one", "a a a a a a b a a a a a", "\n\n", "ab cd ef gh ij kl " * 4 + "z", "\x00 a"]


def test_counts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("s"))
    out = {r.doc_id: r for r in Q.verdicts(docs).collect()}
    for i, text in enumerate(TEXTS):
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(text), text
        assert not (r.kept and r.base_failed)


def fast_mcd(x, steps):
    """The same concentration steps with numpy, on one group, from both starts."""
    floors = np.diag([Q.FLOORS[v] ** 2 for v in Q.VECTOR])

    def inner(bins):
        values, n = np.unique(bins, return_counts=True)
        before = np.cumsum(n) - n
        own = x[bins <= values[2 * before < len(x)].max()]
        return own.mean(0) / Q.GRAIN, np.cov(own.T, bias=True) / Q.GRAIN ** 2

    ends = []
    for first in (np.abs(x - [round(Q.GRAIN * np.log(Q.USUAL_LENGTH)), 0, 0, 0]).sum(1), np.zeros(len(x))):
        m, c = inner(first)
        c = c + floors
        for _ in range(steps):
            d = x / Q.GRAIN - m
            dist = np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)
            m, c = inner(np.floor(64 * np.log2(1 + dist)).astype(int))
            c = c * Q.CONSISTENCY + floors
        ends.append((m, c))
    return min(ends, key=lambda e: np.linalg.slogdet(e[1])[1])


def test_estimate_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = np.abs(rng.multivariate_normal([1700, 60, 80, 100], np.diag([90, 40, 60, 70]) ** 2 + 900, 500)).astype(int)
    x[:120] += [900, 400, 700, 500]
    rows = spark.createDataFrame([(["g"], *map(int, r)) for r in x],
                                 "keys array<string>, x0 long, x1 long, x2 long, x3 long")
    got = Q.estimates(rows).collect()[0]
    m, c = fast_mcd(x.astype(float), Q.STEPS)
    lower = np.linalg.cholesky(c)
    assert [got[f"m{i}"] for i in range(4)] == pytest.approx(m.tolist())
    assert all(got[f"l{i}{j}"] == pytest.approx(lower[i, j], abs=1e-9) for i, j in Q.PAIRS)
    assert abs(m[0] - 1.7) < 0.03   # the shifted rows have no say


def spread(rng, n, centre):
    return np.abs(rng.multivariate_normal(centre, np.diag([90, 40, 60, 70]) ** 2, n)).astype(int)


def test_the_smaller_determinant_counts(spark):
    """Ordinary text is not where this group is; repeated vectors count as often as they come."""
    rng = np.random.default_rng(5)
    x = np.concatenate([spread(rng, 300, [2600, 500, 60, 900]), spread(rng, 40, [1700, 20, 20, 20])])
    x = np.concatenate([x, np.repeat(x[:3], 50, axis=0)])
    rows = spark.createDataFrame([(["g"], *map(int, r)) for r in x], "keys array<string>, x0 long, x1 long, x2 long, x3 long")
    got = Q.estimates(rows).collect()[0]
    m, c = fast_mcd(x.astype(float), Q.STEPS)
    assert [got[f"m{i}"] for i in range(4)] == pytest.approx(m.tolist()) and got["size"] == len(x)
    assert all(got[f"c{i}{j}"] == pytest.approx(c[i, j], abs=1e-9) for i, j in Q.PAIRS)


def test_groups_are_drawn_to_the_coarser_one_by_their_rows(spark):
    rng = np.random.default_rng(6)
    sizes = {("en", "a"): 4, ("en", "b"): 400, (None, "a"): 3, ("de", None): 30}
    rows = [(lang, source, *map(int, r)) for (lang, source), n in sizes.items() for r in spread(rng, n, [1700, 60, 80, 100])]
    df = spark.createDataFrame(rows, "lang string, source string, x0 long, x1 long, x2 long, x3 long")
    found = Q.estimates(df.withColumn("keys", F.array(*Q._keys(F.col("lang"), F.col("source")))).drop("lang", "source"))
    raw = {tuple(sorted(json.loads(r.key).items())): r for r in found.collect()}
    out = {tuple(sorted(json.loads(r.key).items())): r for r in Q.drawn_to_coarser(found).collect()}
    assert len(raw) == 8 and len(out) == 4

    def key(**parts):
        return tuple(sorted(parts.items()))

    def moments(r):
        return np.array([r[f"m{i}"] for i in range(4)] + [r[f"c{i}{j}"] for i, j in Q.PAIRS])
    for lang, source in sizes:
        own = key(**{k: v for k, v in (("lang", lang), ("level", 0), ("source", source)) if v is not None})
        middle = key(**{k: v for k, v in (("lang", lang), ("level", 1)) if v is not None})
        want = moments(raw[key(level=2)])
        for k in (middle, own):
            w = raw[k].n / (raw[k].n + Q.PRIOR)
            want = w * moments(raw[k]) + (1 - w) * want
        c = np.zeros((4, 4))
        for (i, j), v in zip(Q.PAIRS, want[4:]):
            c[i, j] = c[j, i] = v
        lower = np.linalg.cholesky(c)
        assert [out[own][f"m{i}"] for i in range(4)] == pytest.approx(want[:4].tolist())
        assert all(out[own][f"l{i}{j}"] == pytest.approx(lower[i, j], abs=1e-9) for i, j in Q.PAIRS)


def test_keeps_clean_and_rejects_junk(spark):
    out = QUERIES["op3_mcd_quality_rules"](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = out.join(labels, "doc_id").where("not base_failed").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert out.count() == 1000 and np.mean(clean) >= 0.99 and np.mean(junk) <= 0.1


def test_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    plan = Q.verdicts(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_edge_tables(spark):
    docs = spark.createDataFrame([(1, "some words " * 30 + "end", None, None, "q")] * 2 + [(None, None, "en", "s", None)],
                                 "doc_id long, text string, lang string, source string, __quality string")
    out = Q.verdicts(docs)
    assert out.count() == 3 and Q.verdicts(docs.limit(0)).count() == 0
    assert Q.keep_good(docs).columns == docs.columns and Q.keep_good(docs.limit(0)).count() == 0
