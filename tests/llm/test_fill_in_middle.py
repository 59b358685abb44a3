"""Fill-in-middle against the plain definition, and defined edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from contrail.llm import fill_in_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_form(doc_id, text):
    text = text or ""
    h = [int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[k:k + 8], 16)
         for k in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", " ", "a", " a ", "\n\n", "a b \x1cc", "<P>", "x <S> y", "<P <S <M <", "äöü " * 700, " " * 3000,
         "𝔘" * 2000, "wort\t" * 40_000, "\x00 \x00", "a" * fim.BLOCK, "a" * fim.BLOCK + " b", "a " * (fim.BLOCK // 2)]


def test_every_cut_of_random_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab é𝔘 \n\t", k=rng.choice((0, 1, 5, 80, 700, 2500)))) for _ in range(60)]
    data, offsets = fim.text_bytes(pa.array(texts))
    trees = fim.BlockTrees(data, offsets)
    units = [UNIT.findall(t) for t in texts]
    assert trees.totals().tolist() == [len(u) for u in units]
    for share in (0, 0.01, 0.3, 0.5, 0.99, 1):
        after = np.array([round(share * len(u)) for u in units])
        at, chars = trees.cut(after)
        for k, text in enumerate(texts):
            head = "".join(units[k][:after[k]])
            assert (at[k], chars[k]) == (len(head.encode()), len(head))


def test_rows_and_restored_texts(spark):
    rows = [(i * len(TEXTS) + k, t, "out") for i in range(12) for k, t in enumerate(TEXTS)]
    rows += [(None, "no id here", "x"), (7, TEXTS[7], "again"), (10, TEXTS[10], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    out = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(rows)
    want = sorted(((i,) + plain_form(i, t) + (t or "",) for i, t, _ in rows), key=str)
    assert sorted((tuple(r) for r in out), key=str) == want
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_parameters(spark):
    docs = spark.createDataFrame([(i, "one two three four") for i in range(50)], "doc_id long, text string")
    assert {r.form for r in fim.fill_in_middle(docs, fim_percent=0).collect()} == {"plain"}
    assert {r.form for r in fim.fill_in_middle(docs, fim_percent=100, spm_percent=0).collect()} == {"psm"}
    first, second = (fim.fill_in_middle(docs, seed=s).collect() for s in (1, 2))
    assert first != second and first == fim.fill_in_middle(docs, seed=1).collect()
