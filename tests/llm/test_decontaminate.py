"""Decontamination: planted items, re-parameterised questions, brute force, edges."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from contrail.llm import decontaminate as D
from contrail.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"
ITEM = ("Each morning the farmer Carla sells 12 baskets at the market for 5 dollars while her brother Pedro sells "
        "7 baskets near the church. How many baskets do Carla and Pedro sell together in a normal week?")


def brute_shares(doc, item):
    """Share of the item's plain five-word windows that the document holds."""
    def grams(text):
        w = [re.sub(r"^[\W_]+|[\W_]+$", "", x).lower() for x in re.split(r"[\x20\x09-\x0D]+", text or "")]
        w = [x for x in w if x]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    own = grams(item)
    return len(own & grams(doc)) / len(own) if own else 0.0


def test_query_finds_exactly_the_planted_items(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    items = spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()
    out = QUERIES["op6_template_decontamination"](spark, MEDIUM).collect()
    got = {(r.doc_id, r.item_id) for r in out}
    shares = {(d.doc_id, i.item_id): brute_shares(d.text, i.text) for d in docs for i in items}
    assert got >= {k for k, s in shares.items() if s >= 0.85}
    assert all(shares[k] >= 0.6 for k in got) and got


def run(spark, texts, items):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in D.leaks(docs, bench).collect()}


def test_reparameterised_questions(spark):
    other = ITEM.replace("12", "40").replace("Carla", "Ingrid").replace("Pedro", "Tom").replace("dollars", "euros")
    broken = ITEM.replace("farmer Carla", "farmer Ingrid").replace("Carla and Pedro", "Marta and Jonas").replace(
        "12 baskets", "7 baskets")
    got = run(spark, [f"Some words before. {ITEM} And after.", f"x y z {other}", broken, ITEM.lower(), "nothing to see here at all",
                      f"{other} Then again: {ITEM}"], [ITEM])
    assert {k for k, _ in got} >= {0, 1, 5} and 4 not in {k for k, _ in got}
    assert got[0, 0].verbatim and not got[1, 0].verbatim and got[1, 0].share >= 0.8
    assert got[2, 0].n_matched < got[1, 0].n_matched if (2, 0) in got else True


def test_slots_must_correspond():
    assert D.consistent([((1, 0), (5, 0)), ((1, 2), (5, 6)), ((2, 0), (6, 0))]) == [True] * 3
    assert D.consistent([((1, 0), (5, 0)), ((1, 0), (5, 0)), ((1, 0), (7, 0))]) == [True, True, False]
    assert D.consistent([((1, 0), (5, 0)), ((1, 0), (5, 0)), ((2, 0), (5, 0))]) == [True, True, False]


def family(rng, n, shared):
    """Texts of own words that hold one shared sentence or more."""
    words = [f"{a}{b}{c}" for a in ("ba", "de", "ki", "lo", "mu") for b in ("r", "s", "t", "v") for c in ("an", "el", "ir", "op")]
    own = [" ".join(rng.choices(words, k=rng.randint(5, 30))) for _ in range(n)]
    return [f"{x}. {' '.join(rng.sample(shared, rng.randint(1, len(shared))))} {' '.join(rng.choices(words, k=4))}." for x in own]


def test_common_sentences_do_not_pair_everything(spark):
    rng = random.Random(4)
    shared = ["The committee of the old town met again on the first evening of spring.", "Nobody knew who had left the gate of the garden open."]
    items = family(rng, 120, shared)
    texts = family(rng, 100, shared) + rng.sample(items, 20) + [" ".join(items[:10])] + [" ".join(x.split()[:-2]) for x in items[:5]]
    docs = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    one = D.windows(bench, "item_id", "text").withColumnRenamed("at", "item_at").withColumnRenamed("slots", "item_slots")
    one = one.select(F.col("id").cast("string").cast("binary").alias("class"), F.col("total").alias("n_windows"),
                     F.lit(0).alias("place"), "h", "item_at", "item_slots")
    found = D.windows(docs, "doc_id", "text").where("size = 0").drop("total", "size")
    plain, few = D.meetings(found, one, 80, 10 ** 9), D.meetings(found, one, 80)
    assert few.columns == plain.columns and few.count() < plain.count() / 4
    per_pair = plain.groupBy("id", "content", "class").agg(F.count_distinct("item_at").alias("k"), F.first("n_windows").alias("n"),
                                                           F.count("*").alias("rows"))
    enough = {(r.id, r.content, bytes(r["class"])): r.rows for r in per_pair.collect() if 100 * r.k >= 80 * r.n}
    kept = {(r.id, r.content, bytes(r["class"])): r.rows for r in
            few.groupBy("id", "content", "class").agg(F.count("*").alias("rows")).collect()}
    assert len(enough) >= 30 and all(kept.get(k) == n for k, n in enough.items())

    def result():
        return sorted(map(str, D.leaks(docs, bench).collect()))
    got, was = result(), D.meetings
    try:
        D.meetings = lambda found, one, percent: was(found, one, percent, 10 ** 9)
        assert got == result() and len(got) >= 30
    finally:
        D.meetings = was


def test_recall_of_reparameterised_questions(spark):
    rng = random.Random(9)
    names = ("Anna Ben Carla Diego Emma Farid Greta Hugo Ines Jonas Kira Liam Mary Nils Olga Pavel Quentin Rosa Sven Tara".split()
             + ["Mary Ann", "Jean Paul"])
    units = "kilometers meters pounds liters hours minutes dollars euros cups gallons".split()
    verbs, things = "buys sells carries bakes paints washes collects repairs".split(), "apples books lamps tickets stones shirts".split()
    places = "near the harbor|in the village school|behind the station|at the weekly market|by the frozen lake".split("|")

    def question():
        a, b = rng.choice(verbs), rng.choice(verbs)
        x, y = rng.choice(things), rng.choice(places)
        return (f"{{A}} {a} {{n}} {x} {y} every {rng.choice(['morning', 'evening', 'weekend'])} and walks {{m}} {{u}} to get there. "
                f"{{B}} {b} {{k}} {x} more than that {rng.choice(['on', 'before', 'after'])} a holiday. "
                f"How many {x} do they have left when {{A}} gives {{n}} of them to {{B}}?")

    def fill(template):
        a, b = rng.sample(names, 2)
        n, m, k = (rng.choice([str(rng.randint(2, 99)), "twenty five", "1,250", "3.5"]) + "" for _ in range(3))
        alike.append((n == m, n == k, m == k))
        return template.format(A=a, B=b, n=n, m=m, k=k, u=rng.choice(units))
    alike = []
    templates = [question() for _ in range(100)]
    got = run(spark, [f"We read this today. {fill(t)} It was hard." for t in templates], [fill(t) for t in templates])
    found = [(i, i) in got for i in range(100)]
    # where values are equal by chance on one side only, slots do not correspond and windows are lost by the method
    corresponding = [found[i] for i in range(100) if alike[i] == alike[100 + i]]
    assert len(corresponding) >= 30 and all(corresponding) and sum(found) >= 85


def test_edges(spark):
    rows = [(1, ITEM, "a"), (1, ITEM, "a"), (None, ITEM, "b"), (2, None, "c"), (3, "", "d"), (4, "w " * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, content string").withColumn("h", F.lit(0))
    bench = spark.createDataFrame([(7, ITEM), (5, ITEM), (6, None), (8, ""), (9, "too short")], "item_id long, text string")
    out = D.leaks(docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in out), key=str) == [(1, 5), (None, 5)]
    kept = D.drop_leaks(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4] and kept.columns == docs.columns
    assert D.leaks(docs.limit(0), bench).count() == 0 and D.leaks(docs, bench.limit(0)).count() == 0
    assert D.drop_leaks(docs, bench.limit(0)).count() == 6


CLIPS = ("Natalia sold 48 clips to her friends in April. Natalia then sold half as many clips in May near the old school. "
         "Natalia kept the rest. How many clips did Natalia sell in all of these weeks?")


def test_names_at_a_sentence_start_and_other_word_counts(spark):
    long_name = CLIPS.replace("Natalia", "Mary Ann")
    words = ITEM.replace("12", "twenty five").replace("5 dollars", "thirty-one dollars").replace("Carla", "Mary Ann")
    got = run(spark, [CLIPS.replace("Natalia", "Weng"), f"Some words before. {long_name} And after.", words, CLIPS,
                      ITEM.replace("12", "twenty one")], [CLIPS, ITEM])
    assert set(got) == {(0, 0), (1, 0), (2, 1), (3, 0), (4, 1)}
    assert all(got[k].share == 1.0 for k in got) and [k for k in got if got[k].verbatim] == [(3, 0)]
    assert set(run(spark, [CLIPS, ITEM], [long_name, words])) == {(0, 0), (1, 1)}


def test_units_are_placeholders(spark):
    item = "The blue train runs 30 kilometers past the river and then 5 meters along the wall"
    got = run(spark, [item.replace("kilometers", "miles").replace("meters", "feet")], [item])
    assert got[0, 0].share == 1.0


def test_items_of_few_windows_are_matched_whole(spark):
    items = ["What is 5 + 3?", "Yes.", "Does Anna know 7 people in Rome?"]
    got = run(spark, ["Try this one. What is 7 + 8? Good.", "he asked what is 7 8 of them", "Yes. It is.",
                      "Does Mary Ann know 12 people in New York?", "What is 5 + 3?"], items)
    assert set(got) == {(0, 0), (3, 2), (4, 0)} and got[4, 0].verbatim and not got[0, 0].verbatim


def test_items_of_one_template_keep_their_ids_and_slots(spark):
    base = "The old farmer packs 5 apples and {} pears into the wooden box and sells 5 apples at the market"
    a, b, c = base.format(5), base.format(7), base.format(9)
    got = run(spark, [b, a, base.format(8)], [a, b, c, b])
    assert {k for k, r in got.items() if r.verbatim} == {(0, 1), (1, 0)}
    assert {(0, 1), (0, 2), (2, 1), (2, 2)} <= set(got) and (0, 3) not in got
    assert got[0, 1].share == got[0, 2].share == got[1, 0].share == 1.0
    assert got[0, 1].item_ids == [1, 3] and got[0, 2].item_ids == [2] and got[1, 0].item_ids == [0]
    names = "Yesterday the teacher asked {} to help {} with the long homework about rivers and mountains"
    kept = D.drop_leaks(spark.createDataFrame([(1, names.format("Ann", "Bob"))], "doc_id long, text string"),
                        spark.createDataFrame([(1, names.format("Ann", "Ann")), (2, names.format("Ann", "Bob"))],
                                              "item_id long, text string"))
    assert kept.count() == 0
