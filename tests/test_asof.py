"""The as-of merge against the range join."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from contrail.operators import asof as A
from contrail.operators import scd as S

OPEN = date(9999, 12, 31)


def day(n):
    return date(2020, 1, 1) + timedelta(days=n)


def both(spark, facts, history, ranges):
    f = spark.createDataFrame(facts, "id int, k string, d date, tier string")
    h = spark.createDataFrame(history, "k string, tier string, effective_date date, expiry_date date")
    got = A.asof_merge(f, h, "k", "d", ["tier"], "of_", ranges)
    assert got.columns == ["id", "k", "d", "tier", "of_tier"]
    return sorted(map(str, got.collect())), sorted(map(str, S.scd2_as_of(f, h, "k", "d", ["tier"], "of_").collect())), got


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_equals_the_range_join(spark, ranges):
    rng = random.Random(ranges)
    history, facts = [], []
    for k in range(15):
        at = rng.randint(0, 30)
        for _ in range(rng.randint(0, 6)):
            end = at + rng.randint(1, 20)
            history.append((f"k{k}", rng.choice(["a", "b", None]), day(at), day(end)))
            at = end + rng.choice((0, 0, 5))
        if rng.random() < 0.5:
            history.append((f"k{k}", "last", day(at), OPEN))
    facts = [(n, rng.choice([None, "other", *[f"k{k}" for k in range(15)]]), rng.choice([None, day(rng.randint(0, 120))]), "x")
             for n in range(400)]
    got, want, _ = both(spark, facts + facts[:5], history, ranges)
    assert got == want
    assert both(spark, [], history, ranges)[0] == []
    assert both(spark, facts, [], ranges)[0] == both(spark, facts, [], ranges)[1]


def test_a_key_with_a_third_of_the_facts_and_ten_thousand_versions(spark):
    history = [("hot", str(n), day(n), day(n + 1)) for n in range(10_000)] + [("cold", "c", day(5), OPEN)]
    facts = [(n, "hot" if n % 3 == 0 else f"k{n}", day(n * 7 % 10_050), "x") for n in range(9_000)]
    got, want, df = both(spark, facts, history, 8)
    assert got == want
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < len(facts) / 3   # the hot key does not come together
