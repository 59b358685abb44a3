"""Co-training: held-out accuracy, pseudo-labels between views, edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contrail.llm import quality_classifier as Q
from contrail.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    test = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0
    out = {r.doc_id: r for r in Q.score(docs, Q.train(docs, labels.where(~test))).collect()}
    assert len(out) == docs.count()
    held = [(out[r.doc_id], r.quality == 1 and r.toxic == 0) for r in labels.where(test).collect()]
    good = [r.kept for r, ok in held if ok]
    bad = [r.kept for r, ok in held if not ok]
    assert np.mean(good) >= 0.95 and np.mean(bad) <= 0.35
    assert all(0 <= r.score <= 1 for r in out.values())


def test_query_scores_every_document(spark):
    assert QUERIES["op7_co_trained_quality"](spark, MEDIUM).count() == 1000


def planted(n, labels, seed=3):
    """Rows of both views whose first feature tells good from bad, a tenth without it in the metadata."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < 0.5
    text = [[10 if g else 11, *np.unique(rng.integers(100, 200, 3)).tolist()] for g in good]
    meta = [[1 if g else 2] if rng.random() < 0.9 else [3] for g in good]
    return good, text, meta, np.arange(n) < labels, np.arange(n) % 4 == 0


def frames(spark, good, text, meta, labelled, check):
    rows = [(i, bytearray(Q.pack(np.array(t))), m, int(g), bool(b), bool(c))
            for i, (g, t, m, b, c) in enumerate(zip(good, text, meta, labelled, check))]
    df = spark.createDataFrame(rows, "doc_id long, ids binary, meta array<int>, good int, labelled boolean, check boolean")
    return df, (df.where("labelled and not check"), df.where("labelled and check"), df.where("not labelled"))


def brute(good, text, meta, labelled, check, rounds):
    """The same co-training on dense matrices, every row in memory."""
    views = []
    for lists in (text, meta):
        x = np.zeros((len(lists), 256))
        for i, ids in enumerate(lists):
            x[i, ids] = 1
        views.append(x)
    learn, test = labelled & ~check, labelled & check
    weight = [np.where(learn, 1.0, 0.0) for _ in views]
    target = [good.copy() for _ in views]
    for turn in range(rounds + 1):
        raw = []
        for k, x in enumerate(views):
            w1, w0 = weight[k] * target[k], weight[k] * ~target[k]
            n1, n0, g, b = w1.sum(), w0.sum(), w1 @ x, w0 @ x
            mean = (g + b) / (n1 + n0)
            z = np.abs(g / n1 - b / n0) / (np.sqrt(mean * (1 - mean) * (1 / n1 + 1 / n0)) + 1e-12)
            told = (z >= Q.TELLING[k]) & (g + b >= Q.MIN_ROWS)
            p1, p0 = (g + .5) / (n1 + 1), (b + .5) / (n0 + 1)
            bayes = (np.log(p1 / p0) - np.log((1 - p1) / (1 - p0))) * told
            rest = (np.log((1 - p1) / (1 - p0)) * told).sum() + np.log((n1 + 1) / (n0 + 1))
            full = np.column_stack([x * told, np.ones(len(x))])
            a, b = Q.calibrate((full[learn] @ np.append(bayes, rest))[:, None], good[learn].astype(float))
            start = np.append(a * bayes, a * rest + b)
            w, seen = start, 1e-8
            for _ in range(Q.STEPS):
                slope = full[learn].T @ (Q.sigmoid(full[learn] @ w) - good[learn]) / learn.sum()
                slope = slope + Q.PULL * (w - start)
                seen = seen + slope ** 2
                w = w - 0.3 * slope / np.sqrt(seen)
            raw.append(full @ w)
        fits = [Q.calibrate(r[test][:, None], good[test].astype(float)) for r in raw]
        p = [Q.sigmoid(a * r + b) for r, (a, b) in zip(raw, fits)]
        for k in range(2):
            q = p[1 - k]
            free = ~labelled
            target[k] = np.where(free, q > 0.5, good)
            weight[k] = np.where(learn, 1.0, 0.0)
            for c, sure in ((True, q >= Q.CONFIDENT), (False, q <= 1 - Q.CONFIDENT)):
                own = (learn & (good == c)).sum()
                weight[k][free & sure] = min(1.0, own / max((free & sure).sum(), 1))
    a, b, c = Q.calibrate(np.column_stack(raw)[test], good[test].astype(float))
    return p[0], p[1], Q.sigmoid(a * raw[0] + b * raw[1] + c)


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_exchange_equals_brute_force(spark, rounds):
    data = planted(1500, 300)
    df, parts = frames(spark, *data)
    out = Q.score_rows(df, Q.co_train(*parts, rounds=rounds)).orderBy("doc_id").toPandas()
    for name, want in zip(("p_text", "p_meta", "score"), brute(*data, rounds)):
        assert np.allclose(out[name], want, atol=1e-6), name


def test_views_teach_each_other_over_all_documents(spark):
    """The pool is far larger than any sample was: a word that no labelled row holds is learned from it."""
    good, text, meta, labelled, check = planted(20_000, 400)
    for i in range(400, 20_000):
        text[i][0] = 20 if good[i] else 21      # only unlabelled rows hold these
    df, parts = frames(spark, good, text, meta, labelled, check)
    model = Q.co_train(*parts)
    assert model.weights[0][20] > 1 and model.weights[0][21] < -1
    alone = Q.co_train(*parts, rounds=0)
    assert alone.weights[0][20] == alone.weights[0][21] == 0
    lost = [r for r in Q.score_rows(df, model).collect() if r.doc_id >= 400 and meta[r.doc_id] == [3]]
    assert np.mean([r.kept == good[r.doc_id] for r in lost]) > 0.99
    counted = Q.tally(parts[2], model)
    assert counted[0].rows.sum() == sum(m != [3] for m in meta[400:])   # every sure row took part


@pytest.mark.parametrize("ids", [[], [0], [65534], [65535], [65536, 262143], [0, 1, 131070, 131071], list(range(50))])
def test_packed_features(ids):
    column = pa.array([Q.pack(np.array(ids, np.int32)), b"", Q.pack(np.array([7])), Q.pack(np.array(ids[::-1], np.int32))])
    got = Q.Sparse.packed(column, 1 << Q.TEXT_BITS)
    assert [got.index[got.row == k].tolist() for k in range(4)] == [ids, [], [7], ids] and got.n == 4


def test_equal_rows_and_long_texts(spark):
    """Many rows of one labelled id teach once; a very long text is read whole."""
    rows = [(i, "fine words here" if i % 2 else "awful words here", "en", "s", 10) for i in range(200)]
    rows += [(1, "fine words here", "en", "s", 10)] * 3000 + [(500, "plain " * 300_000 + "awful " * 3, "en", "s", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    out = Q.classify(docs, labels).collect()
    assert len(out) == 3201 and all(r.kept == bool(r.doc_id % 2) for r in out if r.doc_id < 200)
    assert not next(r.kept for r in out if r.doc_id == 500)
    one = Q.classify(docs.limit(200), labels).collect()
    assert {r.doc_id: round(r.score, 6) for r in one}[1] > 0.5


def test_edges(spark):
    rows = [(i, "fine words here" if i % 2 else "awful words here", "en", "s", 10) for i in range(200)]
    rows += [(None, "fine words", None, None, None), (900, None, "en", "s", 1), (900, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("score", F.lit("x")).withColumn("label_id", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(200)] + [(0, 1, 0), (None, 1, 0), (5, None, 1)],
                                   "doc_id long, quality int, toxic int")
    out = Q.score(docs, Q.train(docs, labels)).collect()
    assert len(out) == len(rows)
    assert all(r.kept == bool(r.doc_id % 2) for r in out if r.doc_id is not None and r.doc_id < 200)
    assert [r.score for r in out if r.doc_id == 900] == [0.0, 0.0]
    assert Q.train(docs, labels.limit(0)) == 0.5 and Q.train(docs, labels.where("quality = 1")) == 1.0
    assert Q.score(docs, 0.5).where("kept").count() == 201
    assert Q.score(docs.limit(0), 0.5).count() == 0
