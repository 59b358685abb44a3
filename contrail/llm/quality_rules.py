"""Quality rules by robust multivariate outliers, in DataFrame functions alone.

Each text gets counts (words, symbols, repeated lines and word windows). Four
transformed shares of them form its statistic vector. For each language and
source, for each language and for all rows, the minimum-covariance-determinant
estimate of centre and covariance is found by concentration steps: distances
from the current estimate, then the estimate of the half of the rows with the
smallest distances. There are two starts, the rows nearest to ordinary text and
the group's own moments; the smaller determinant counts. An estimate of h rows
is drawn to that of the next coarser group by the weight ``PRIOR`` / (h + ``PRIOR``),
alike at every size: small groups lean on their language, large ones hardly. A
row is rejected if its Mahalanobis distance from the estimate of its language and
source is beyond ``CUTOFF``, or if it fails a base rule.

How it scales: texts are read once, to one small row each, which are written
to the shared folder. Rows of equal groups and statistics are added up to one
with a weight. A concentration step is one pass over those: moments
are added up per group and distance bin (map-side first, so a hot group costs
no more than any other), and a window over a group's bins, a bounded set,
finds the half. Estimates meet their rows in ``SALTS`` parts, so that no group's
rows go to one task however many groups there are. Sums are of integers, so
results do not depend on row order.

Null and empty texts have no words and fail the base rule. Null languages and
sources are groups of their own. Every input row gives one row, repeated or
not. The distance is null in groups whose rows all fail the base rules. An empty table gives no rows. Columns of the input that are kept may have
any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import stage

# Fixed values of the base rules.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
VECTOR = ("length", "symbols", "dup_lines", "repeats")
P = len(VECTOR)
# Standard deviations added to every estimate: differences this small mean nothing.
FLOORS = {"length": 0.06, "symbols": 0.03, "dup_lines": 0.10, "repeats": 0.10}
# Words, characters and lines of ordinary text mixed into every share, so short texts vary no more than long ones.
EXTRA_WORDS, EXTRA_CHARS, EXTRA_LINES, USUAL_LENGTH = 50, 50, 4, 5.5
GRAIN = 1000            # statistics are kept as integers of this unit
PRIOR = 50              # rows that the coarser group's estimate weighs
STEPS = 5
SALTS = 8
STARTS = ("ordinary", "own")
TAIL = 1e-9             # chi-square tail beyond which a row is an outlier


def chi2_tail(x: float, even_df: int) -> float:
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(even_df // 2))


def chi2_point(tail: float, even_df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_tail(middle, even_df) > tail else (low, middle)
    return low


CUTOFF = chi2_point(TAIL, P)
# The covariance of the inner half of a normal sample, made that of the whole.
CONSISTENCY = 0.5 / (1 - chi2_tail(chi2_point(0.5, P), P + 2))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def _windows(words: Column) -> Column:
    """A hash of every run of five words."""
    at = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    return F.when(F.size(words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered(hashes: Column, ordered: Column) -> Column:
    """Words in windows whose hash occurs twice or more; ``ordered`` are (hash, place) pairs in order."""
    twice = F.filter(ordered, lambda p, i: (F.get(ordered, i - 1)["h"] == p["h"])
                     | (F.get(ordered, i + 1)["h"] == p["h"]))
    return F.sort_array(F.transform(twice, lambda p: p["i"]))


def with_statistics(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """The rows with a struct column ``name`` of the counts."""
    w, h, o, p = (f"{name}_{k}" for k in "whop")
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike(WORD_CHAR))
    out = docs.withColumn(w, _words(F.col(text_col))).withColumn(f"{name}_l", lines)
    out = out.withColumn(h, _windows(F.col(w)))
    pairs = F.sort_array(F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    out = out.withColumn(o, F.when(F.size(F.array_distinct(F.col(h))) < F.size(h), pairs).otherwise(none))
    out = out.withColumn(p, _covered(F.col(h), F.col(o)))
    gaps = F.transform(F.col(p), lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(p), i + 1) - x,
                                                                                F.lit(WINDOW))))
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(F.col(w), "")),
        "n_symbols": F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(SYMBOL)),
        "n_dup_lines": F.size(f"{name}_l") - F.size(F.array_distinct(F.col(f"{name}_l"))),
        "n_repeat_words": F.aggregate(gaps, F.lit(0), lambda a, x: a + x),
        "n_lines": F.size(f"{name}_l"),
    }
    own = F.struct(*(c.cast("long").alias(k) for k, c in counts.items()))
    return out.withColumn(name, own).drop(w, h, o, p, f"{name}_l")


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def vector(s: Column) -> list[Column]:
    """The transformed statistics, as integers of 1/``GRAIN``."""
    length = F.least(F.log((s["word_chars"] + EXTRA_WORDS * USUAL_LENGTH) / (s["n_words"] + EXTRA_WORDS)), F.lit(4.0))
    shares = [s["n_symbols"] / (s["word_chars"] + EXTRA_CHARS), s["n_dup_lines"] / (s["n_lines"] + EXTRA_LINES),
              s["n_repeat_words"] / (s["n_words"] + EXTRA_WORDS)]
    values = [length, *(F.asin(F.sqrt(F.least(x, F.lit(1.0)))) for x in shares)]
    return [F.round(v * GRAIN).cast("long") for v in values]


ALL_ROWS = '{"level":2}'


def _keys(lang: Column, source: Column) -> list[Column]:
    """A row's groups from fine to coarse, as text (null stays apart from any value)."""
    lang, source = lang.cast("string").alias("lang"), source.cast("string").alias("source")
    return [F.to_json(F.struct(F.lit(0).alias("level"), lang, source)),
            F.to_json(F.struct(F.lit(1).alias("level"), lang)), F.lit(ALL_ROWS)]


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _moments() -> list[Column]:
    x, w = [F.col(f"x{i}") for i in range(P)], F.col("weight")
    return [F.sum(w).alias("n"), *(F.sum(w * x[i]).alias(f"s{i}") for i in range(P)),
            *(F.sum(w * x[i] * x[j]).alias(f"s{i}{j}") for i, j in PAIRS)]


def _with_factor(covariances: DataFrame) -> DataFrame:
    """The Cholesky factor l of the covariance c, beside it."""
    out = covariances
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    return out


MEANS = [f"m{i}" for i in range(P)]
COVARIANCES, FACTORS = [f"c{i}{j}" for i, j in PAIRS], [f"l{i}{j}" for i, j in PAIRS]


def _estimate(sums: DataFrame, consistency: Column) -> DataFrame:
    """Per group and start the centre, the covariance plus floors and its Cholesky factor."""
    n = F.col("n")
    mean = {i: F.col(f"s{i}") / n / GRAIN for i in range(P)}
    return _with_factor(sums.select(
        "key", "start", "size", "n", *(mean[i].alias(f"m{i}") for i in range(P)),
        *(((F.col(f"s{i}{j}") / n / GRAIN / GRAIN - mean[i] * mean[j]) * consistency
           + (FLOORS[VECTOR[i]] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in PAIRS)))


def _distance() -> Column:
    """The squared Mahalanobis distance, by forward substitution."""
    y: list[Column] = []
    for i in range(P):
        rest = F.col(f"x{i}") / GRAIN - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * y[k]
        y.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _inner_half(rows: DataFrame, bins: Column) -> DataFrame:
    """Moments per group and start of the rows in the lowest bins that hold half of the group."""
    by_bin = rows.groupBy("key", "start", bins.alias("bin")).agg(*_moments())
    up_to = Window.partitionBy("key", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("key", "start")
    kept = by_bin.withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0))) \
        .withColumn("size", F.sum("n").over(whole)).where(2 * F.col("before") < F.col("size"))
    names = ["n", *(f"s{i}" for i in range(P)), *(f"s{i}{j}" for i, j in PAIRS)]
    return kept.groupBy("key", "start").agg(F.max("size").alias("size"), *(F.sum(c).alias(c) for c in names))


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant estimates of every group. ``rows`` have
    the groups' ``keys`` and x0, x1, ... The first start is the half of the rows
    nearest to the point of no symbols and no repeats and the usual length, the
    second all rows; of the two ends the smaller determinant counts."""
    x = [f"x{i}" for i in range(P)]
    weighed = stage(rows.groupBy("keys", *x).agg(F.count("*").alias("weight")), "vectors")
    each = weighed.select(F.explode("keys").alias("key"), *x, "weight") \
        .withColumn("start", F.explode(F.array(*map(F.lit, STARTS)))) \
        .withColumn("salt", F.pmod(F.xxhash64(*x), F.lit(SALTS)))
    start = F.abs(F.col("x0") - round(GRAIN * math.log(USUAL_LENGTH)))
    for i in range(1, P):
        start = start + F.col(f"x{i}")
    # all rows of the second start are in its lowest bin
    sums = _inner_half(each, F.when(F.col("start") == STARTS[0], start).otherwise(0))
    found = stage(_estimate(sums, F.lit(1.0)), "mcd")
    for _ in range(steps):
        parts = found.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        far = each.join(parts.drop("n", "size", *COVARIANCES), ["key", "start", "salt"])
        bins = F.floor(64 * F.log2(1 + _distance())).cast("long")
        found = stage(_estimate(_inner_half(far, bins), F.lit(CONSISTENCY)), "mcd")
    determinant = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, P)), F.log(F.col("l00")))
    names = ["size", "n", *MEANS, *COVARIANCES, *FACTORS]
    order = F.struct(determinant, F.array_position(F.array(*map(F.lit, STARTS)), F.col("start")))
    return found.groupBy("key").agg(F.min_by(F.struct(*names), order).alias("best")).select("key", "best.*")


def drawn_to_coarser(found: DataFrame, prior: float = PRIOR) -> DataFrame:
    """The estimates of the finest groups, each drawn to its language's and that to all rows'."""
    parts = F.from_json("key", "level int, lang string, source string")
    lang = F.to_json(F.struct(F.lit(1).alias("level"), parts["lang"].alias("lang")))
    by_level = found.withColumn("level", parts["level"]).withColumn(
        "up", F.when(F.col("level") == 0, lang).otherwise(F.lit(ALL_ROWS)))
    names = [*MEANS, *COVARIANCES]
    above = by_level.where("level = 2").select("key", *names)
    for level in (1, 0):
        coarser = above.select(F.col("key").alias("up"), *(F.col(c).alias(f"up_{c}") for c in names))
        own = F.col("n") / (F.col("n") + prior)
        above = by_level.where(F.col("level") == level).join(coarser, "up").select(
            "key", *((own * F.col(c) + (1 - own) * F.col(f"up_{c}")).alias(c) for c in names))
    return _with_factor(above).select("key", *MEANS, *FACTORS)


def judge(docs: DataFrame, keep: list[str], text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> tuple[DataFrame, str]:
    """The ``keep`` columns of every row and, in a struct column whose name is
    returned too, the counts, base_failed, kept and distance."""
    name = "__quality"
    while any(c.startswith(name) for c in docs.columns):
        name += "_"
    own = with_statistics(docs, name, text_col)
    keys = F.array(*_keys(F.col(lang_col), F.col(source_col)))
    # one copy for the steps and the verdict: the texts are read and counted once
    rows = stage(own.select(*keep, F.col(name), keys.alias(f"{name}_keys")), "quality")
    s = F.col(name)
    vectors = rows.select(F.col(f"{name}_keys").alias("keys"), *(v.alias(f"x{i}") for i, v in enumerate(vector(s))),
                          base_failed(s).alias("failed"))
    found = estimates(vectors.where(~F.col("failed")).drop("failed"))
    finest = drawn_to_coarser(found).select(F.struct(*MEANS, *FACTORS).alias(f"{name}_e"), F.col("key").alias(f"{name}_k"))
    lay = rows.join(finest, F.col(f"{name}_keys")[0] == F.col(f"{name}_k"), "left")
    values = {f"x{i}": v for i, v in enumerate(vector(s))} | {c: F.col(f"{name}_e")[c] for c in MEANS + FACTORS}
    y: list[Column] = []
    for i in range(P):
        rest = values[f"x{i}"] / GRAIN - values[f"m{i}"]
        for k in range(i):
            rest = rest - values[f"l{i}{k}"] * y[k]
        y.append(rest / values[f"l{i}{i}"])
    distance = sum((v * v for v in y[1:]), y[0] * y[0])
    verdict = F.struct(*(s[c].alias(c) for c in STATS), base_failed(s).alias("base_failed"),
                       (~base_failed(s) & F.coalesce(distance <= CUTOFF, F.lit(False))).alias("kept"),
                       distance.alias("distance"))
    return lay.withColumn(name, verdict).select(*keep, name), name


def verdicts(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    out, name = judge(docs, [id_col])
    return out.select(F.col(id_col).alias("doc_id"), f"{name}.*")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that the rules keep, with their own columns."""
    out, name = judge(docs, docs.columns)
    return out.where(F.col(name)["kept"]).select(*docs.columns)
