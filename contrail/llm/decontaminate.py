"""Benchmark decontamination by template canonicalisation.

Texts become templates: words without the marks around them, in lower case,
with units and runs of numbers or names replaced by typed placeholders whose
values are kept as slots. A capitalised word at a sentence's start is read both
ways, as itself and as a name (or the start of one). Windows of five template
words of every document are joined by
hash with those of the benchmark. The windows that a document shares with an
item are grouped by how far they are shifted; in each group the slots must
correspond one to one (each benchmark value to one value of the document and
back), so a question with other numbers or names is caught, and windows whose
slots contradict the rest do not count. A document leaks an item if such a
group holds 80 % of the item's windows or more.

How it scales: a bit filter of the benchmark's window hashes (of bounded size,
built by Spark) goes to the tasks that read the documents, so only windows that
may match leave them; the join and the grouping by document are Spark's. Windows
that many items hold are looked at only for documents and items that share one of
the item's rarest windows, of which every leak holds one (a prefix filter, exact).

Windows with fewer than three ordinary words are not used (words at a sentence's
start count; two must be left where such words are read as names). Items of
fewer than five windows are looked for whole too: their template, with two
ordinary words or more, as whole sentences of the document. Items of equal
templates whose slots repeat alike are compared once, and each is reported under
its own id and judged verbatim by its own values; items that are equal in those
too are one row, of the smallest id, that names them all. Null and empty texts
match nothing; repeated rows, null ids and
ties are defined: a (doc_id, item) pair is reported once for each different
text of that id. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import map_arrow, stage

WIDTH = 5
LITERALS = 3            # ordinary words that a window needs
LEAST_LITERALS = 2      # and that are left where words at a sentence's start are read as names
FEW = 5                 # windows: items of fewer are looked for whole as well
SHARE_PERCENT = 80
MAX_SHIFT = 5           # words put in or left out between parts of one occurrence
COMMON = 8              # classes that hold a window before it counts as common
MAX_FILTER_BITS = 26    # of the filter's size: 8 MB

# Words that count as numbers and as units.
NUMBERS = frozenset("""zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
billion dozen""".split())
UNITS = frozenset("""mm cm dm m km millimeter millimeters millimetre millimetres centimeter centimeters centimetre
centimetres meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet yard yards mile miles milligram milligrams mg g kg gram grams kilogram kilograms
ton tons tonne tonnes lb lbs pound pounds ounce ounces oz milliliter milliliters millilitre millilitres ml cl l liter liters litre litres gallon gallons pint pints quart quarts cup cups second seconds
sec minute minutes min hour hours hr hrs day days week weeks month months year years decade decades century centuries usd eur gbp dollar dollars euro
euros cent cents penny pennies pence rupee rupees yen peso pesos franc francs acre acres hectare hectares percent kmh
mph km/h m/s watt watts kw kwh volt volts hz khz mhz ghz kb mb gb tb degree degrees celsius
fahrenheit kelvin""".split())
LITERAL, NUMBER, UNIT, NAME, NOTHING = range(5)

EDGES = re.compile(r"^[\W_]+|[\W_]+$")
NUMERIC = re.compile(r"\d[\d.,:/]*(?:st|nd|rd|th)?")
STOP = re.compile(r"[.!?:;…][\"'»”’)\]]*$")
NUMBER_PARTS = NUMBERS | {"one"}


def word_kind(word: str) -> tuple[int, int, bool, bool, bool]:
    """Kind (a capitalised word counts as a name), hash of its value, whether a
    sentence ends after it, whether a run of names or numbers does, and whether
    it is *one*, a number only beside another."""
    stop = bool(STOP.search(word))
    core = EDGES.sub("", word)
    if not core:
        return NOTHING, 0, stop, True, False
    low = core.lower()
    kind = (NUMBER if NUMERIC.fullmatch(low) or low in NUMBERS or "-" in low and NUMBER_PARTS.issuperset(low.split("-"))
            else UNIT if low in UNITS
            else NAME if core[0].isupper() and core[1:] != core[1:].upper() else LITERAL)
    return kind, xxhash.xxh3_64_intdigest(low), stop, not word[-1].isalnum(), low == "one"


# A run's value is that of its words by place, of one word its own.
PLACES = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(PLACES), -1, 1 << 64))
SALT = np.uint64(0xD6E8FEB86659FD93)


class Template:
    """Template words of a batch of texts, one after the other: ``literal`` is
    each word's hash in the text's literal reading and ``slot`` its slot there (0:
    none); ``open`` marks the words at a sentence's start that may be names too,
    with ``name_slot`` as their slot. ``plain`` marks ordinary words, ``first`` and
    ``last`` a sentence's ends; ``word`` is the place in the text, ``bounds`` the texts'."""

    def __init__(self, kind, value, stop, breaks, one, offsets):
        first = np.ones(len(kind), dtype=bool)
        first[1:] = stop[:-1]
        first[offsets[:-1][offsets[:-1] < len(kind)]] = True
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        ends = np.cumsum(breaks)
        real = np.flatnonzero(kind != NOTHING)
        kind, value, first, one, text = kind[real], value[real], first[real], one[real], text[real]
        word = real - offsets[text]
        # nothing between a word and the one before ends a run
        near = np.zeros(len(real), dtype=bool)
        if len(real):
            before = ends - breaks
            near[1:] = (text[1:] == text[:-1]) & (before[real[1:]] == before[real[:-1]])
        number = kind == NUMBER
        beside = np.zeros(len(real), dtype=bool)
        beside[1:] |= near[1:] & number[:-1]
        beside[:-1] |= near[1:] & number[1:]
        kind = np.where(one & beside, np.int8(NUMBER), kind)
        joins = near.copy()
        joins[1:] &= (kind[1:] == kind[:-1]) & ((kind[1:] == NAME) | (kind[1:] == NUMBER))
        start = np.flatnonzero(~joins)
        group = np.cumsum(~joins) - 1
        place = np.arange(len(real)) - start[group] if len(real) else group
        power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(place.max(initial=0), PLACES))))
        run = np.add.reduceat(value * power[place], start) if len(start) else value
        kind, own = kind[start], value[start]
        rest = (run - own) * BACK
        self.open = (kind == NAME) & first[start]
        self.plain = (kind == LITERAL) | self.open
        self.literal = np.where(self.plain, own, kind.astype(np.uint64))
        self.literal = np.where(self.open & (rest != 0), W.scramble(own ^ SALT), self.literal)
        self.slot = np.where(self.open, rest, np.where(kind == LITERAL, np.uint64(0), run))
        self.name_slot = np.where(self.open, run, self.slot)
        self.word, self.first, text = word[start], first[start], text[start]
        self.bounds = np.searchsorted(text, np.arange(len(offsets)))
        # a sentence ends with a template word if the next one starts a sentence or there is none
        self.last = np.ones(len(start), dtype=bool)
        self.last[:-1] = self.first[1:] | (text[1:] != text[:-1])
        self.text = text


class Canonical:
    """Templates of batches of texts; what is known of a word is kept."""

    def __init__(self, keep: int = 400_000):
        self.known: dict[str, tuple] = {}
        self.keep = keep

    def __call__(self, texts: pa.Array) -> Template:
        flat, offsets = W.split_words(texts, lower=False)
        words, index = W.encode(flat)
        if len(self.known) > self.keep:
            self.known.clear()
        known, facts = self.known, []
        for w in words.to_pylist():
            if w not in known:
                known[w] = word_kind(w)
            facts.append(known[w])
        columns = (np.array([f[k] for f in facts], dtype=t)[index]
                   for k, t in enumerate((np.int8, np.uint64, bool, bool, bool)))
        return Template(*columns, offsets)


def read_windows(t: Template) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(places, hashes, mask) of the used windows: in the literal reading (mask 0)
    and in each reading with the open words of the mask as names."""
    n = len(t.literal) - WIDTH + 1
    if n <= 0:
        return
    sums = np.concatenate(([0], np.cumsum(t.plain)))
    plain = sums[WIDTH:] - sums[:n]
    used = (t.text[WIDTH - 1:] == t.text[:n]) & (plain >= LITERALS)
    at = np.flatnonzero(used)
    yield at, W.window_hashes(t.literal, WIDTH)[at], 0
    mask = np.zeros(n, dtype=np.int64)
    for k in range(WIDTH):
        mask |= t.open[k:k + n].astype(np.int64) << k
    some = np.flatnonzero(used & (mask > 0))
    for names in range(1, 1 << WIDTH):
        chosen = some[((mask[some] & names) == names) & (plain[some] - names.bit_count() >= LEAST_LITERALS)]
        if len(chosen):
            own = t.literal[chosen[:, None] + np.arange(WIDTH)]
            own[:, [k for k in range(WIDTH) if names >> k & 1]] = np.uint64(NAME)
            yield chosen, W.scramble((own * W.MULTIPLIERS[:WIDTH]).sum(axis=1, dtype=np.uint64)), names


def read_whole(t: Template, starts: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(places, hashes, with names) of runs of ``size`` words from these places on:
    in the literal reading, and with every open word as a name."""
    places = starts[:, None] + np.arange(size)
    for names in (False, True):
        own, plain = t.literal[places], t.plain[places]
        keep = plain.sum(axis=1) >= LEAST_LITERALS
        if names:
            own = np.where(t.open[places], np.uint64(NAME), own)
            keep = t.open[places].any(axis=1) & ((plain & ~t.open[places]).sum(axis=1) >= LEAST_LITERALS)
        power = np.multiply.accumulate(np.full(size, PLACES, dtype=np.uint64))
        yield starts[keep], W.scramble((own[keep] * power).sum(axis=1, dtype=np.uint64) ^ SALT), names


SLOTS = pa.list_(pa.int64())


WINDOW_SCHEMA = "id long, content long, h long, at long, word long, slots array<long>, total long, size long"


def windows(rows: DataFrame, id_col: str, text_col: str, bits: np.ndarray | None = None,
            sizes: list[int] | None = None) -> DataFrame:
    """(id, content, h, at, word, slots, total, size): the used windows in all
    their readings, of those that the bit filter lets through; total counts the
    text's used windows. Texts of few windows, and runs of whole sentences of one
    of the ``sizes`` if given, have rows of their whole template too (``at`` -1;
    ``size`` is its words, 0 of a window)."""
    def run(batches):
        canonical = Canonical()
        mask = None if bits is None else np.uint64(len(bits) * 64 - 1)
        for b in batches:
            t = canonical(b.column(1))
            counts = np.zeros(len(b), dtype=np.int64)
            parts = []

            def put(at, h, slot, size, parts=parts):
                if mask is not None:
                    low = h & mask
                    sel = ((bits[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1)).astype(bool)
                    at, h, slot = at[sel], h[sel], slot(sel)
                else:
                    slot = slot(np.ones(len(at), dtype=bool))
                if len(at):
                    parts.append((t.text[at], h.view(np.int64), np.full(len(at), -1) if size else at - t.bounds[t.text[at]],
                                  t.word[at], slot, np.full(len(at), size)))

            for at, h, names in read_windows(t):
                if not names:
                    counts = np.bincount(t.text[at], minlength=len(b))

                def slot(sel, at=at, names=names):
                    places = at[sel][:, None] + np.arange(WIDTH)
                    named = (names >> np.arange(WIDTH) & 1).astype(bool)
                    return list(np.where(named, t.name_slot[places], t.slot[places]).view(np.int64))
                put(at, h, slot, 0)
            length = np.diff(t.bounds)
            if sizes is None:
                few = np.flatnonzero((counts < FEW) & (length > 0))
                runs = [(t.bounds[i:i + 1], int(length[i])) for i in few]
            else:
                begins = np.flatnonzero(t.first)
                runs = [(begins, n) for n in sizes]
            for starts, size in runs:
                end = starts + size - 1
                starts = starts[end < len(t.text)]
                end = starts + size - 1
                starts = starts[(t.text[end] == t.text[starts]) & t.last[end]]
                for at, h, names in read_whole(t, starts, size) if len(starts) else ():
                    def slot(sel, at=at, names=names, size=size):
                        places = at[sel][:, None] + np.arange(size)
                        return list((t.name_slot if names else t.slot)[places].view(np.int64))
                    put(at, h, slot, size)
            if parts:
                text = np.concatenate([p[0] for p in parts])
                order = pa.array(text)
                columns = [np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (1, 2, 3, 5)]
                slots = pa.array([x for p in parts for x in p[4]], SLOTS)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(order), b.column(2).take(order), *map(pa.array, columns[:3]), slots,
                     pa.array(counts[text].astype(np.int64)), pa.array(columns[3])],
                    ["id", "content", "h", "at", "word", "slots", "total", "size"])

    text = F.col(text_col).cast("string")
    own = rows.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("content"))
    return map_arrow(own, run, WINDOW_SCHEMA)


def bit_filter(items: DataFrame) -> np.ndarray:
    """Bits of the window hashes, at least 16 for each, at most 2 ** MAX_FILTER_BITS in all."""
    n = items.count()
    size = 1 << min(MAX_FILTER_BITS, max(12, (16 * n).bit_length()))
    low = F.col("h").bitwiseAND(F.lit(size - 1))
    rows = items.select(low.alias("low")).selectExpr("cast(shiftright(low, 6) as int) AS w",
                                                     "shiftleft(1L, cast(low & 63 AS int)) AS b")
    out = np.zeros(size // 64, dtype=np.int64)
    for r in rows.groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        out[r["w"]] = r["b"]
    return out.view(np.uint64)


def consistent(pairs: list[tuple]) -> list[bool]:
    """Which windows' slots fit the one-to-one mapping most windows agree on.
    ``pairs`` are (item slots, document slots)."""
    votes: Counter = Counter()
    for own, other in pairs:
        votes.update({(x, y) for x, y in zip(own, other) if x or y})
    there: dict = {}
    back: dict = {}
    for (x, y), n in sorted(votes.items(), key=lambda v: (-v[1], v[0])):
        if x not in there and y not in back:
            there[x], back[y] = y, x
    return [all(there.get(x) == y for x, y in zip(own, other) if x or y) for own, other in pairs]


WHOLE = -1


def best_match(rows: list[tuple]) -> tuple[int, int, int, list[tuple]]:
    """Of one document and item: the most item windows that one occurrence holds,
    its first and last word in the document, and for each window its place among
    the item's and the document's slots. An item that is there with its whole
    template holds ``WHOLE`` windows.
    ``rows`` are (at, item_at, word, slots, item_slots, place)."""
    rows = sorted(rows, key=lambda r: (r[0] - r[1], r[0], r[1], r[5]))
    best, begin = (0, 0, 0, []), 0
    for at, item_at, word, slots, own, place in (r for r in rows if r[1] < 0):   # the whole item, as it is
        if all(consistent([(own, slots)])) and (not best[0] or list(slots) == list(own)):
            best = (WHOLE, word, word, [(place, list(slots))])
    if best[0]:
        return best
    rows = [r for r in rows if r[1] >= 0]
    for k in range(1, len(rows) + 1):
        if k < len(rows) and (rows[k][0] - rows[k][1]) - (rows[k - 1][0] - rows[k - 1][1]) <= MAX_SHIFT:
            continue
        group = rows[begin:k]
        begin = k
        fit = consistent([(r[4], r[3]) for r in group])
        good = [r for r, ok in zip(group, fit) if ok]
        n = len({r[1] for r in good})
        if n > best[0]:
            best = (n, min(r[2] for r in good), max(r[2] for r in good), [(r[5], list(r[3])) for r in good])
    return best


def item_classes(items: DataFrame) -> DataFrame:
    """The different (id, content) of the items' windows with ``class``, equal for
    items of equal templates whose slots are equal to each other alike, ``values``,
    a hash of the slots' values, and ``t``, the windows in one order for the class."""
    whole = items.groupBy("id", "content", "total").agg(
        F.sort_array(F.collect_set(F.struct("size", "at", "h", "slots"))).alias("t"))

    def run(batches):
        for b in batches:
            keys, values = [], []
            for t in b.column(3).to_pylist():
                slots = np.array([0, *(x for w in t for x in w["slots"])], dtype=np.int64)
                _, first, back = np.unique(slots, return_index=True, return_inverse=True)
                form = np.array([x for w in t for x in (w["size"], w["at"], w["h"])], dtype=np.int64)
                keys.append(xxhash.xxh3_128_digest(form.tobytes() + first[back].astype(np.int64).tobytes()))
                values.append(xxhash.xxh3_128_digest(slots.tobytes()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary()), pa.array(values, pa.binary())],
                                             ["id", "content", "total", "t", "class", "values"])

    return map_arrow(whole, run, "id long, content long, total long, t array<struct<size: bigint, at: bigint, h: bigint, "
                                 "slots: array<bigint>>>, class binary, values binary")


def with_spread(one: DataFrame, percent: int) -> DataFrame:
    """The classes' windows with ``spread``, the number of classes that hold one's
    hash, and ``lead``: a document that holds enough of a class's windows holds one
    of its leading ones, the least spread (and any whole template)."""
    spread = one.groupBy("h").agg(F.count_distinct("class").alias("spread"))
    rows = one.join(spread, "h")
    places = rows.where("item_at >= 0").groupBy("class", "n_windows", "item_at").agg(F.max("spread").alias("s"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("s", "item_at"))
    needed = F.ceil(F.lit(percent) * F.col("n_windows") / 100)
    leading = places.withColumn("lead", rank <= F.col("n_windows") - needed + 1).select("class", "item_at", "lead")
    return rows.join(leading, ["class", "item_at"], "left").withColumn("lead", F.coalesce("lead", F.lit(True)))


def meetings(found: DataFrame, one: DataFrame, percent: int, common: int = COMMON) -> DataFrame:
    """Documents' windows beside the classes' with the same hash. Those that more than
    ``common`` classes hold are looked at only for pairs that share a leading window,
    so a sentence of many documents and items does not pair them all."""
    marked = stage(with_spread(one, percent), "benchmark-spread")
    late = (F.col("spread") > common) & ~F.col("lead")
    columns = one.columns
    if marked.where(late).isEmpty():
        return found.join(one, "h")
    own = stage(found.join(one.select("h").distinct(), "h", "left_semi"), "windows")
    direct = own.join(marked.where(~late).select(*columns, "lead"), "h")
    pairs = direct.where("lead").select(F.col("id").alias("pair_id"), F.col("content").alias("pair_content"), "class").distinct()
    wanted = pairs.join(marked.where(late).select(*(F.col(c).alias("late_h" if c == "h" else c) for c in columns)), "class")
    rest = own.join(wanted, own["id"].eqNullSafe(wanted["pair_id"]) & (own["content"] == wanted["pair_content"])
                    & (own["h"] == wanted["late_h"])).drop("pair_id", "pair_content", "late_h")
    return direct.drop("lead").unionByName(rest)


def leaked(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
           percent: int) -> tuple[DataFrame, DataFrame]:
    """The classes of items that documents leak, one row per document text and
    class, and the classes' items."""
    items = stage(windows(benchmark, item_col, item_text_col), "benchmark-windows")
    # the whole lengths of items with few windows: few different small numbers
    sizes = sorted(r["size"] for r in items.where("size > 0").select("size").distinct().collect())
    items = stage(item_classes(items), "benchmark-items")
    # any item stands for its class: slots correspond one to one to all of them or to none
    chosen = items.groupBy("class").agg(F.min_by(F.struct("total", "t"), F.struct("id", "content")).alias("r"))
    one = chosen.select("class", F.col("r.total").alias("n_windows"), F.posexplode("r.t").alias("place", "x"))
    one = stage(one.select("class", "n_windows", "place", "x.h", F.col("x.at").alias("item_at"),
                           F.col("x.slots").alias("item_slots")), "benchmark-classes")
    found = meetings(windows(docs, id_col, text_col, bit_filter(one), sizes).drop("total", "size"), one, percent)
    keys = ["id", "content", "class"]
    dealt = found.repartition(*keys).sortWithinPartitions(*keys, "at", "item_at")

    def run(batches):
        now, rows = None, []

        def finish():
            n, first, last, good = best_match([r[:6] for r in rows])
            total = max(rows[0][6], 1)
            n = total if n == WHOLE else n
            if 100 * n >= percent * total:
                return (*now, total, n, n / total, first, last, [{"place": p, "slots": s} for p, s in good])
            return None

        def batch(done):
            good = pa.list_(pa.struct([("place", pa.int64()), ("slots", SLOTS)]))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), good]
            names = ["doc_id", "content", "class", "n_windows", "n_matched", "share", "first_word", "last_word", "good"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

        for b in batches:
            done = []
            for r in zip(*(b.column(c).to_pylist() for c in (*keys, "at", "item_at", "word", "slots", "item_slots",
                                                             "place", "n_windows"))):
                if r[:3] != now:
                    if rows and (row := finish()):
                        done.append(row)
                    now, rows = r[:3], []
                rows.append(r[3:])
            if done:
                yield batch(done)
        if rows and (row := finish()):
            yield batch([row])

    return map_arrow(dealt, run, "doc_id long, content long, class binary, n_windows long, n_matched long, share double, "
                                 "first_word long, last_word long, "
                                 "good array<struct<place: bigint, slots: array<bigint>>>"), items


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", percent: int = SHARE_PERCENT) -> DataFrame:
    """One row per document text and benchmark item that it leaks: doc_id, content
    (hash of the text), item_id, n_windows of the item, n_matched, share, the
    first and last matched windows' word places, whether it is verbatim, and
    item_ids: all items of the same template and values (item_id is the smallest)."""
    found, items = leaked(docs, benchmark, id_col, text_col, item_col, item_text_col, percent)
    members = items.groupBy("class", "values").agg(
        F.min("id").alias("item_id"), F.sort_array(F.collect_set("id")).alias("item_ids"),
        F.first("t")["slots"].alias("own"))
    same = F.forall("good", lambda g: F.get("own", g["place"].cast("int")) == g["slots"])
    return found.join(members, "class").select(
        "doc_id", "content", "item_id", "n_windows", "n_matched", "share", "first_word", "last_word",
        same.alias("verbatim"), "item_ids")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", percent: int = SHARE_PERCENT) -> DataFrame:
    """The documents that leak no benchmark item, with their own columns."""
    key = "__leak"
    while any(c.startswith(key) for c in docs.columns):
        key += "_"
    found, _ = leaked(docs, benchmark, id_col, text_col, item_col, item_text_col, percent)
    found = stage(found.select(
        F.col("doc_id").alias(f"{key}_id"), F.col("content").alias(f"{key}_content")).distinct(), "leaks")
    own = docs.withColumn(key, F.xxhash64(F.col(text_col).cast("string")))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(f"{key}_id")) & (F.col(key) == F.col(f"{key}_content"))
    return own.join(found, same, "left_anti").drop(key)
