"""Property tests: Spark expressions against plain-Python statements of the rules."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.functions import coerce, dates
from contrail.functions.numeric import fround

RAW_TIMES = st.one_of(
    st.integers(min_value=-3000, max_value=3000).map(str),
    st.floats(min_value=-100, max_value=2600, allow_nan=False).map(lambda x: f"{x:.1f}"),
    st.sampled_from(["", "abc", "12:30", " 930", "2400", "1275", None]),
)


def hhmm_rule(v):
    """int(float(v)); NULL if unparsable, < 0 or > 2400; else HH:MM."""
    try:
        i = int(float(v))
    except (TypeError, ValueError):
        return None
    if i < 0 or i > 2400:
        return None
    return f"{i // 100:02d}:{i % 100:02d}"


def int_or_zero_rule(v):
    try:
        return int(float(v))
    except (TypeError, ValueError):
        return 0


@settings(max_examples=3, deadline=None, derandomize=True)
@given(st.lists(RAW_TIMES, min_size=50, max_size=200))
def test_hhmm_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(dates.parse_hhmm("v")).collect()]
    assert got == [hhmm_rule(v) for v in values]


@settings(max_examples=3, deadline=None, derandomize=True)
@given(st.lists(RAW_TIMES, min_size=50, max_size=200))
def test_int_or_zero_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(coerce.to_int_or_zero("v")).collect()]
    assert got == [int_or_zero_rule(v) for v in values]


@settings(max_examples=3, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(-10**6, 10**6), st.integers(1, 997)), min_size=50, max_size=200),
       st.integers(0, 4))
def test_fround_is_half_up_on_the_rational(spark, pairs, digits):
    """Averages of integers (p/q) round HALF_UP on their exact value."""
    df = spark.createDataFrame([(p / q,) for p, q in pairs], "x double")
    got = [r[0] for r in df.select(fround("x", digits)).collect()]
    want = []
    for p, q in pairs:
        exact = Decimal(p) / Decimal(q)
        want.append(float(exact.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)))
    # with q < 1000 a rational is either exactly on a rounding boundary or at
    # least 1e-7 away from it, so decimal-first rounding must agree everywhere
    assert [(p, q) for (p, q), g, w in zip(pairs, got, want) if g != w] == []
