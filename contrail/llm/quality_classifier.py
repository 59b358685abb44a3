"""Quality classifier by co-training.

Two views of a document: its words (text content) and its metadata (language,
source, size). Each view has a naive Bayes classifier of *good* documents,
those labelled good quality and not toxic, whose weights a logistic fit to the
labelled rows then corrects. In each of ``ROUNDS`` rounds both
classifiers score every document without a label in use, and what one view is
sure of becomes a pseudo-label for the other's next training. The views are
calibrated on labelled rows that neither saw, and combined into one score.

How it scales: texts are read once, to a packed list of hashed features each,
written to the shared folder. A round is one pass over that table: tasks score
their rows and add up, per feature, how many good and bad (pseudo-)labelled
rows hold it; the sums are merged by a shuffle on the feature. The driver sees
one row for each of the ``2 ** TEXT_BITS + 2 ** META_BITS`` features and the
labelled rows' features, whatever the number of documents. Counts are integers
and labelled rows are put in order, so results do not depend on row order.

Labels are bounded: at most ``MAX_LABELLED`` label ids, those with the smallest
hashes; documents of the other labels take part as unlabelled. No other row is
left out. All pseudo-labels of a class together weigh at most as much as its
labels do.

Labels without id or quality are not used; a null toxic mark counts as not
toxic; of several labels of one id the worst counts, and of several documents
of one labelled id the one with the smallest features. Without labels of both
kinds every score is the share of good labels (0.5 if there are none). Texts
without words score 0 and teach nothing. Every input row gives one row,
repeated or not; null ids are scored too. An empty table gives no rows. Only
the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import map_arrow, stage

MAX_LABELLED = 10_000
TEXT_BITS, META_BITS = 18, 12
WIDTHS = (1 << TEXT_BITS, 1 << META_BITS)
ROUNDS = 3
# Standard errors that a feature's share must differ by to be used: of many words, and of few metadata.
TELLING, MIN_ROWS = (4.5, 3.0), 5
CONFIDENT = 0.97        # calibrated probability that a pseudo-label needs
KEEP_AT = 0.5
STEPS, PULL = 200, 1e-4  # of the logistic fit, and its pull to where it starts
FOLDS = 4               # one of so many folds of the labelled rows calibrates


def word_features(word: str) -> tuple[int, ...]:
    """Of one word: its letters, the marks around it, and its shape."""
    core = word.strip("".join({c for c in word if not c.isalnum()})) if not word.isalnum() else word
    out = []
    mask = (1 << TEXT_BITS) - 1
    if core:
        out.append(xxhash.xxh3_64_intdigest(core.lower()) & mask)
    if len(core) < len(word):
        out.append(xxhash.xxh3_64_intdigest("marks " + word.replace(core, " ", 1)[:12]) & mask)
    if len(core) > 1 and core.isupper():
        out.append(xxhash.xxh3_64_intdigest("upper case") & mask)
    if any(c.isdigit() for c in core):
        out.append(xxhash.xxh3_64_intdigest("digits") & mask)
    return tuple(out)


class TextView:
    """Distinct features of each text of a batch."""

    def __init__(self, keep: int = 300_000):
        self.known: dict[str, tuple[int, ...]] = {}
        self.keep = keep

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        flat, offsets = W.split_words(texts, lower=False)
        words, index = W.encode(flat)
        if len(self.known) > self.keep:
            self.known.clear()
        table = np.full((len(words), 4), -1, dtype=np.int32)
        for k, w in enumerate(words.to_pylist()):
            if w not in self.known:
                self.known[w] = word_features(w)
            own = self.known[w]
            table[k, :len(own)] = own
        again = np.zeros(len(index), dtype=bool)   # the same word as the one before
        again[1:] = index[1:] == index[:-1]
        twice = xxhash.xxh3_64_intdigest("said twice") & ((1 << TEXT_BITS) - 1)
        out = []
        for a, b in zip(offsets, offsets[1:]):
            ids = np.unique(table[np.unique(index[a:b])])
            ids = ids[ids >= 0]
            if b - a > 1 and 10 * again[a + 1:b].sum() > b - a:
                ids = np.append(ids, np.int32(twice))
            out.append(ids)
        return out


def meta_features(lang: Column, source: Column, size: Column) -> Column:
    """Hashed metadata: language, source, size class, and their pairs with the size class."""
    parts = [F.concat(F.lit("lang "), F.coalesce(lang.cast("string"), F.lit("?"))),
             F.concat(F.lit("source "), F.coalesce(source.cast("string"), F.lit("?"))),
             F.concat(F.lit("size "), F.floor(F.log2(F.coalesce(size, F.lit(0)) + 1)).cast("string"))]
    parts += [F.concat(parts[0], parts[2])]
    return F.array_distinct(F.array(*(F.pmod(F.xxhash64(p), F.lit(1 << META_BITS)).cast("int") for p in parts)))


GAP = 0xFFFF            # a packed gap of this value only carries on the next one


def pack(ids: np.ndarray) -> bytes:
    """Distinct feature ids as 16-bit gaps between them."""
    gaps = np.diff(np.unique(ids).astype(np.int64), prepend=0)
    out = np.full(int((gaps // GAP + 1).sum()), GAP, dtype="<u2")
    out[np.cumsum(gaps // GAP + 1) - 1] = gaps % GAP
    return out.tobytes()


class Sparse:
    """Rows of distinct feature ids: ``index`` are the ids, ``row`` their rows."""

    def __init__(self, index: np.ndarray, row: np.ndarray, n: int, width: int):
        self.index, self.row, self.n, self.width = index, row, n, width

    @classmethod
    def packed(cls, column: pa.Array, width: int) -> Sparse:
        values = column.to_pylist()
        size = np.array([len(v) // 2 for v in values], dtype=np.int64)
        gaps = np.frombuffer(b"".join(values), "<u2").astype(np.int64)
        row = np.repeat(np.arange(len(values)), size)
        total = np.concatenate([[0], np.cumsum(gaps)])
        first = np.cumsum(size) - size
        end = gaps != GAP
        return cls((total[1:] - total[first][row])[end], row[end], len(values), width)

    @classmethod
    def lists(cls, column: pa.Array, width: int) -> Sparse:
        values = column.to_pylist()
        index = np.array([i for v in values for i in v], dtype=np.int64)
        return cls(index, np.repeat(np.arange(len(values)), [len(v) for v in values]), len(values), width)

    def dot(self, weight: np.ndarray) -> np.ndarray:
        """Per row the sum of its features' weights and the intercept, which comes last."""
        return np.bincount(self.row, weight[self.index], minlength=self.n) + weight[-1]

    def count(self, chosen: np.ndarray) -> np.ndarray:
        """Per feature the number of chosen rows that hold it."""
        return np.bincount(self.index[chosen[self.row]], minlength=self.width)


def sparse_views(batch: pa.RecordBatch) -> tuple[Sparse, Sparse]:
    return Sparse.packed(batch.column("ids"), WIDTHS[0]), Sparse.lists(batch.column("meta"), WIDTHS[1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Counts:
    """Of one view: per feature, the good and bad rows that hold it, and all good and bad rows."""

    def __init__(self, held: np.ndarray, rows: np.ndarray):
        self.held, self.rows = held, rows

    def with_pseudo(self, more: Counts) -> Counts:
        """Plus pseudo-labelled rows, each class scaled to weigh no more than its labels."""
        scale = np.minimum(1.0, self.rows / np.maximum(more.rows, 1))
        return Counts(self.held + scale[:, None] * more.held, self.rows + scale * more.rows)

    def weights(self, least: float) -> np.ndarray:
        """Naive Bayes weights of the telling features, those in ``MIN_ROWS`` rows or
        more whose shares differ by ``least`` standard errors; the last is the intercept."""
        (good, bad), (n1, n0) = self.held, self.rows
        mean = (good + bad) / max(n1 + n0, 1)
        error = np.sqrt(mean * (1 - mean) * (1 / max(n1, 1) + 1 / max(n0, 1))) + 1e-12
        told = (np.abs(good / max(n1, 1) - bad / max(n0, 1)) / error >= least) & (good + bad >= MIN_ROWS)
        p1, p0 = (good + 0.5) / (n1 + 1), (bad + 0.5) / (n0 + 1)
        absent = np.where(told, np.log1p(-p1) - np.log1p(-p0), 0.0)
        present = np.where(told, np.log(p1) - np.log(p0), 0.0)
        return np.append(present - absent, absent.sum() + np.log((n1 + 1) / (n0 + 1)))


def calibrate(columns: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic weights of a few dense columns and an intercept, by Newton steps
    that are halved until the loss falls."""
    scale = np.maximum(columns.std(0), 1e-9)
    x = np.column_stack([columns / scale, np.ones(len(y))])
    w = np.zeros(x.shape[1])

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + 0.5e-2 * w @ w

    for _ in range(steps):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + 1e-2 * w)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
    return w / np.append(scale, 1.0)


def refine(rows: Sparse, y: np.ndarray, bayes: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights of the same features, fitted to labelled rows: from the calibrated
    ``bayes`` weights on, by full gradients with a step size per feature. What
    labelled rows do not tell stays as the counts of all rows have it."""
    used = bayes[:-1] != 0
    told = used[rows.index]
    rows = Sparse(rows.index[told], rows.row[told], rows.n, rows.width)
    a, b = calibrate(rows.dot(bayes)[:, None], y)
    start = a * bayes + np.append(np.zeros(rows.width), b)
    weight, seen, free = start, np.full(len(start), 1e-8), np.append(used, True)
    for _ in range(steps):
        error = sigmoid(rows.dot(weight)) - y
        gradient = np.append(np.bincount(rows.index, error[rows.row], minlength=rows.width), error.sum()) / rows.n
        gradient = np.where(free, gradient + PULL * (weight - start), 0.0)
        seen += gradient ** 2
        weight = weight - 0.3 * gradient / np.sqrt(seen)
    return weight


class CoTrained:
    """Weights of both views, their calibrations, and their combination."""

    def __init__(self, weights: list[np.ndarray], alone: list[np.ndarray], both: np.ndarray | None = None):
        self.weights, self.alone, self.both = weights, alone, both

    def raw(self, views: tuple[Sparse, Sparse]) -> list[np.ndarray]:
        return [v.dot(w) for v, w in zip(views, self.weights)]

    def single(self, raw: list[np.ndarray]) -> list[np.ndarray]:
        """Each view's calibrated probability."""
        return [sigmoid(a * r + b) for (a, b), r in zip(self.alone, raw)]

    def scores(self, views: tuple[Sparse, Sparse]) -> tuple[np.ndarray, ...]:
        raw = self.raw(views)
        a, b, c = self.both
        return *self.single(raw), sigmoid(a * raw[0] + b * raw[1] + c)


def tally(rows: DataFrame, model: CoTrained | None = None) -> list[Counts]:
    """Counts of both views: by the rows' own ``good``, or, given a model, by what
    the other view is sure of."""
    def run(batches):
        held = [np.zeros((2, w), dtype=np.int64) for w in WIDTHS]
        total = np.zeros((2, 2), dtype=np.int64)
        for b in batches:
            views = sparse_views(b)
            if model is None:
                good = np.array(b.column("good").to_pylist()) > 0
                taught = [(good, ~good)] * 2
            else:
                p = model.single(model.raw(views))
                taught = [(q >= CONFIDENT, q <= 1 - CONFIDENT) for q in reversed(p)]
            for k in range(2):
                for c in range(2):
                    held[k][c] += views[k].count(taught[k][c])
                    total[k, c] += taught[k][c].sum()
        for k in range(2):
            at = np.flatnonzero(held[k].any(0))
            columns = [np.full(len(at) + 1, k), np.append(at, -1), *(np.append(held[k][c][at], total[k, c])
                                                                     for c in range(2))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             ["view", "feature", "good", "bad"])

    parts = map_arrow(rows, run, "view long, feature long, good long, bad long")
    # one row a feature at most, and one for each view's totals
    sums = parts.groupBy("view", "feature").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow()
    view, feature, good, bad = (sums.column(c).to_numpy() for c in ("view", "feature", "good", "bad"))
    out = []
    for k, width in enumerate(WIDTHS):
        own = view == k
        held = np.zeros((2, width + 1))     # the totals' place -1 is the last
        held[:, feature[own]] = good[own], bad[own]
        out.append(Counts(held[:, :-1], held[:, -1]))
    return out


def check_scores(rows: DataFrame, model: CoTrained) -> tuple[np.ndarray, np.ndarray]:
    """Both views' scores of the labelled rows that calibrate, and their labels."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*map(pa.array, model.raw(sparse_views(b))), b.column("good")],
                                             ["text", "meta", "good"])

    got = map_arrow(rows, run, "text double, meta double, good int").orderBy("text", "meta", "good").toArrow()
    return np.column_stack([got.column(c).to_numpy() for c in ("text", "meta")]), got.column("good").to_numpy()


def co_train(learned: DataFrame, checked: DataFrame, pool: DataFrame, rounds: int = ROUNDS) -> CoTrained:
    """``learned`` and ``checked`` are labelled rows (ids, meta, good), ``pool`` all others (ids, meta)."""
    labelled = now = tally(learned)
    # at most the labelled rows' bound
    known = learned.orderBy("ids", "meta", "good").toArrow().combine_chunks()
    rows = Sparse.packed(known.column("ids"), WIDTHS[0]), Sparse.lists(known.column("meta"), WIDTHS[1])
    target = known.column("good").to_numpy().astype(float)
    for turn in range(rounds + 1):
        model = CoTrained([refine(v, target, c.weights(z)) for v, c, z in zip(rows, now, TELLING)], [])
        raw, y = check_scores(checked, model)
        model.alone = [calibrate(raw[:, k:k + 1], y) for k in range(2)]
        if turn < rounds:
            now = [own.with_pseudo(more) for own, more in zip(labelled, tally(pool, model))]
    model.both = calibrate(raw, y)
    return model


def good_labels(labels: DataFrame) -> DataFrame:
    good = (F.col("quality") > 0) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    own = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return own.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min(good.cast("int")).alias("good"))


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def views(docs: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Per row its doc_id and the features of both views, staged. ``columns``
    name the id, text, language, source and size."""
    def run(batches):
        view = TextView()
        for b in batches:
            ids = [pack(r) for r in view(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), b.column(2)],
                                             ["doc_id", "ids", "meta"])

    id_col, text_col, lang_col, source_col, size_col = columns
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      meta_features(F.col(lang_col), F.col(source_col), F.col(size_col)).alias("meta"))
    return stage(map_arrow(own, run, "doc_id long, ids binary, meta array<int>"), "co_training_views")


def train_on(rows: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
             rounds: int = ROUNDS) -> CoTrained | float:
    """The co-trained model of ``views`` rows; without labels of both kinds, the share of good ones."""
    good = good_labels(labels)
    counts = {r["good"]: r["count"] for r in good.groupBy("good").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return counts.get(1, 0) / total if total else 0.5
    chosen = F.broadcast(good.orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled))
    told = rows.where(F.length("ids") > 0)
    one = told.join(chosen, F.col("doc_id") == F.col("label_id")).groupBy("label_id").agg(
        F.min(F.struct("ids", "meta")).alias("v"), F.first("good").alias("good"))
    fold = F.pmod(F.xxhash64("label_id", F.lit(7)), F.lit(FOLDS)) == 0
    labelled = stage(one.select("v.ids", "v.meta", "good", fold.alias("check")), "co_training_labelled")
    learned, checked = (labelled.where(c).select("ids", "meta", "good") for c in (~F.col("check"), F.col("check")))
    kinds = labelled.groupBy("check").agg(F.countDistinct("good").alias("n")).collect()
    if [r["n"] for r in kinds] != [2, 2]:
        return counts.get(1, 0) / total
    pool = told.join(chosen, F.col("doc_id") == F.col("label_id"), "left_anti").select("ids", "meta")
    return co_train(learned, checked, pool, rounds)


def score_rows(rows: DataFrame, model: CoTrained | float, keep_at: float = KEEP_AT) -> DataFrame:
    """Per ``views`` row: doc_id, the views' calibrated probabilities, the combined score, kept."""
    def run(batches):
        for b in batches:
            own = sparse_views(b)
            t, m, s = model.scores(own) if isinstance(model, CoTrained) else [np.full(own[0].n, float(model))] * 3
            words = np.bincount(own[0].row, minlength=own[0].n) > 0
            s = np.where(words, s, 0.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, (t, m, s, s >= keep_at))],
                                             ["doc_id", "p_text", "p_meta", "score", "kept"])

    return map_arrow(rows, run, "doc_id long, p_text double, p_meta double, score double, kept boolean")


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
          columns: tuple[str, ...] = COLUMNS) -> CoTrained | float:
    return train_on(views(docs, columns), labels, max_labelled)


def score(docs: DataFrame, model: CoTrained | float, keep_at: float = KEEP_AT,
          columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    return score_rows(views(docs, columns), model, keep_at)


def classify(docs: DataFrame, labels: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Co-training and its verdict on every row, the texts read once."""
    rows = views(docs, columns)
    return score_rows(rows, train_on(rows, labels))
