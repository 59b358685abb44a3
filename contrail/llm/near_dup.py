"""Near-duplicate documents by bottom-k sketches from one hash function.

1. A text's set is its distinct runs of five words (fewer words: the whole
   sequence). Texts with equal sets are one *node*; its sketch is the ``k``
   smallest hashes of the set.
2. Inverted lists: a hash that several sketches retain lists their nodes. Two
   sets with similarity ``percent`` or more share at least ``least_shared`` retained
   hashes, so with one order of hashes (rarest first) they meet in a list even
   if each node is listed only under its first ``size - least_shared + 1``
   hashes. Hashes that many texts share, as of a common passage, come last in
   that order and drop out.
3. Pairs of a list pass a size test and an estimate from the union's sketch,
   and are confirmed on the full sets of both texts.
4. Links make classes. Short lists pair all their nodes; a long one pairs its
   hub, the node with the commonest hashes, with the others, so a large group
   of near copies costs about one pair for each copy. A list whose nodes are
   then in one class needs no more. The nodes of the other long lists, once
   for all lists of a hub, are compared in blocks of ``block`` on their full
   sets inside tasks, which give only links that join classes; a class that
   fills blocks is not compared with itself. So no link between classes is
   lost whatever a list's length.

``least_shared`` follows from ``percent`` and ``k``, six standard deviations below
the average: 32 of 64 where 0.80 of the union's sketch is 51 on average, 37 where
0.85 is 54. So a pair at exactly ``percent`` is overlooked with a chance near
1e-8; sets of up to 64 shingles are compared exactly.

Null and empty texts have an empty set and are linked with nothing. Rows are
never dropped: repeated rows and null ids get a row each. Empty tables give no
rows. Only the id and text columns are read, so other columns may have any
names. A null id's class is the smallest id reachable that is not null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import map_arrow, stage

WIDTH = 5
PERCENT = 85            # the op1 query's contract
WORD_PERCENT = 80       # of stages on word shingles
K = 64
SMALL_LIST = 16
BLOCK = 256
COLUMNS = 8192          # shingles that a block's comparison holds at a time


def least_of(percent: int, k: int) -> int:
    """The retained hashes that two sets of this similarity share at least: six
    standard deviations below the average."""
    p = percent / 100
    return max(1, int(k * p - 6 * (k * p * (1 - p)) ** 0.5))


def shingle_set(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingle hashes (signed) of one text's word hashes."""
    if len(hashes) == 0:
        return np.zeros(0, np.int64)
    own = W.window_hashes(hashes, width) if len(hashes) >= width else W.whole_hash(hashes)
    return np.unique(own.view(np.int64))


def text_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    flat, offsets = W.split_words(texts)
    words, index = W.encode(flat)
    hashes = W.hash_words(words)[index]
    return [shingle_set(hashes[a:b], width) for a, b in zip(offsets, offsets[1:])]


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, width: int) -> DataFrame:
    """Per row: id, hash of the text, size and 128-bit hash of its set, sketch."""
    def run(batches):
        for b in batches:
            sets = text_sets(b.column(1), width)
            size = pa.array([len(s) for s in sets], pa.int64())
            key = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())
            sketch = pa.array([s[:k] for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), size, key, sketch],
                                             ["doc_id", "content", "n_shingles", "set_key", "sketch"])

    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                      F.xxhash64(text).alias("content"))
    return map_arrow(own, run, "doc_id long, content long, n_shingles long, set_key binary, sketch array<long>")


def _need(size: Column, k: int, least_shared: int) -> Column:
    return F.ceil(size * F.lit(least_shared) / F.lit(k)).cast("int")


def listed(nodes: DataFrame, k: int, least_shared: int) -> DataFrame:
    """The inverted lists: hash, node, and how common the node's hashes are."""
    each = nodes.select("node", F.size("sketch").alias("s"), F.explode("sketch").alias("h"))
    common = each.groupBy("h").agg(F.count("*").alias("f")).where("f > 1")
    shared = each.join(common, "h").groupBy("node").agg(
        F.first("s").alias("s"), F.sum("f").alias("weight"),
        F.sort_array(F.collect_list(F.struct("f", "h"))).alias("hs"))  # at most k of a node
    # the node's other hashes are its own and come first in the order
    left = F.col("s") - _need(F.col("s"), k, least_shared) + 1 - (F.col("s") - F.size("hs"))
    return shared.where(left > 0).select(
        "node", "weight", F.explode(F.slice("hs", F.lit(1), left)).alias("x")).select("x.h", "node", "weight")


def estimated(pairs: DataFrame, nodes: DataFrame, k: int, least_shared: int, percent: int) -> DataFrame:
    """The pairs (a, b) that the sizes and the union's sketch allow."""
    own = nodes.select("node", "n_shingles", "sketch")
    both = pairs.join(own.toDF("a", "na", "sa"), "a").join(own.toDF("b", "nb", "sb"), "b")
    both = both.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = both.withColumn("u", union)
    shared = F.size(F.array_intersect(F.array_intersect("sa", "sb"), "u"))
    return both.where(shared >= _need(F.size("u"), k, least_shared)).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough. ``texts`` are (node, text)."""
    def run(batches):
        last, own = None, None
        for b in batches:
            left, right = b.column(0).to_pylist(), text_sets(b.column(3), width)
            fresh = [i for i, a in enumerate(left) if a != (left[i - 1] if i else last)]
            sets = iter(text_sets(b.column(2).take(pa.array(fresh, pa.int64())), width)) if fresh else iter(())
            keep = []
            for i, a in enumerate(left):
                if a != last:
                    last, own = a, next(sets)
                inter = len(np.intersect1d(own, right[i], assume_unique=True))
                keep.append(100 * inter >= percent * (len(own) + len(right[i]) - inter))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # the many texts travel once with their pair; a hub's text meets them in the last join
    with_b = pairs.join(texts.toDF("b", "tb"), "b")
    both = with_b.join(texts.toDF("a", "ta"), "a").select("a", "b", "ta", "tb")
    return map_arrow(both, run, "a long, b long")


def classes(links: DataFrame) -> DataFrame:
    """(node, class): the smallest node reachable over the links (a, b), by
    neighbours' minima and pointer jumping; nodes without links are left out."""
    both = stage(links.union(links.select("b", "a")).distinct(), "links")
    label = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("class")), "classes")
    while True:
        near = both.join(label.toDF("b", "class"), "b").groupBy("a").agg(F.min("class").alias("m"))
        least = label.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("class").alias("old"), F.least("class", "m").alias("c"))
        # a label's own label is a shorter way
        jump = least.join(label.toDF("c", "further"), "c").select(
            "node", F.least("c", "further").alias("class"), "old")
        new = stage(jump, "classes")
        changed = new.where(F.col("class") != F.col("old")).limit(1).count()
        label = new.select("node", "class")
        if not changed:
            return label


def block_links(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes inside each group (ball, x, y) of the rows
    (ball, x, y, node, class, text): a group is two blocks, so of bounded size.
    Of a group's links those that join classes are enough."""
    def joins(nodes: list[int], own: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        size = np.array([len(s) for s in sets])
        values, place, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), size)
        shared = n[place] > 1
        column, row = (np.cumsum(n > 1) - 1)[place[shared]], row[shared]
        inter = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for at in range(0, int((n > 1).sum()), COLUMNS):
            part = (column >= at) & (column < at + COLUMNS)
            x = np.zeros((len(sets), COLUMNS), dtype=np.float32)
            x[row[part], column[part] - at] = 1
            inter += x @ x.T
        close = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
        label, out = np.array(own), []
        for i, j in zip(*np.nonzero(np.triu(close, 1))):
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                out.append((nodes[i], nodes[j]))
        return out

    def run(batches):
        now, nodes, own, texts = None, [], [], []

        def finish():
            links = joins(nodes, own, text_sets(pa.array(texts, pa.large_string()), width)) if len(nodes) > 1 else []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])

        for batch in batches:
            for ball, x, y, node, cls, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (ball, x, y) != now:
                    yield from finish()
                    now, nodes, own, texts = (ball, x, y), [], [], []
                nodes.append(node)
                own.append(cls)
                texts.append(text)
        yield from finish()

    keys = ("ball", "x", "y")
    dealt = rows.select(*keys, "node", "class", "text").repartition(*keys).sortWithinPartitions(*keys)
    return map_arrow(dealt, run, "a long, b long")


def balls(rows: DataFrame, block: int) -> DataFrame:
    """(ball, x, y, node, class) of the lists' rows (h, node, weight, class, hub):
    the nodes of all lists with one hub, once, in pairs of blocks. A class that
    fills a block has blocks of its own, which need no pairs among them."""
    member = rows.select(F.col("hub").alias("ball"), "node", "class").distinct()
    sized = member.join(member.groupBy("ball", "class").agg(F.count("*").alias("of_class")), ["ball", "class"])
    side = F.when(F.col("of_class") >= block, F.col("class")).otherwise(F.lit(-1))
    sized = sized.withColumn("side", side)
    sides = sized.groupBy("ball", "side").agg(F.ceil(F.count("*") / block).alias("parts"))
    put = sized.join(sides, ["ball", "side"]).select(
        "ball", "side", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"), "node", "class")
    put = stage(put.withColumn("z", F.struct("side", "part")), "balls")
    blocks = put.groupBy("ball", "z").agg(F.count("*").alias("n")).drop("n")
    pairs = blocks.select("ball", F.col("z").alias("x")).join(blocks.select("ball", F.col("z").alias("y")), "ball")
    pairs = pairs.where((F.col("x") <= F.col("y")) & ((F.col("x.side") != F.col("y.side")) | (F.col("x.side") == -1)))
    ends = pairs.select("ball", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("z"))
    return ends.join(put.select("ball", "z", "node", "class"), ["ball", "z"]).select("ball", "x", "y", "node", "class")


def linked(lists: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, least_shared: int, width: int,
           percent: int, small: int, block: int) -> DataFrame:
    """(node, class) of all nodes with links. ``lists`` are (h, node, weight, n)
    with n the list's length. Pairs (a, b) have the node of greater weight, that
    is a list's hub, first."""
    few = lists.where(F.col("n") <= small).groupBy("h").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("w"), "node"))).alias("m"))
    later = F.transform("m", lambda x: F.struct(x["node"].alias("a"), F.filter("m", lambda y: y > x).alias("bs")))
    pairs = few.select(F.explode(later).alias("p")).select("p.a", F.explode("p.bs.node").alias("b"))
    many = lists.where(F.col("n") > small).select("h", "node", "weight")
    hub = many.groupBy("h").agg(F.min(F.struct((-F.col("weight")).alias("w"), "node")).alias("x"))
    many = stage(many.join(hub.select("h", F.col("x.node").alias("hub")), "h"), "lists")
    spokes = many.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    found = stage(pairs.union(spokes).distinct(), "pairs")
    links = stage(confirmed(estimated(found, nodes, k, least_shared, percent), texts, width, percent), "links")
    label = classes(links)
    # long lists whose nodes are in several classes yet
    rows = many.join(label, "node", "left").withColumn("class", F.coalesce("class", "node"))
    spread = rows.groupBy("h").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi")
    rows = stage(rows.join(spread.select("h"), "h", "left_semi"), "lists")
    if rows.limit(1).count() == 0:
        return label
    more = block_links(balls(rows, block).join(texts, "node"), width, percent)
    return classes(stage(links.union(more), "links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                    least_shared: int | None = None, width: int = WIDTH, percent: int = PERCENT,
                    small: int = SMALL_LIST, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, content (a hash of its text), n_shingles, class (null for
    an empty set), component_id, kept."""
    least_shared = least_of(percent, k) if least_shared is None else least_shared
    rows = stage(signatures(docs, id_col, text_col, k, width), "signatures")
    nodes = rows.where("n_shingles > 0").groupBy("set_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")).alias("r"),
        F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    nodes = stage(nodes.select(F.monotonically_increasing_id().alias("node"), "set_key", "r.doc_id", "r.content",
                               "n_shingles", "sketch"), "nodes")
    lists = listed(nodes, k, least_shared)
    length = lists.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    lists = stage(lists.join(length, "h"), "lists")
    wanted = nodes.join(lists.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "content")
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("d"), text.alias("text"), F.xxhash64(text).alias("c"))
    texts = source.join(wanted, (F.col("c") == F.col("content")) & F.col("d").eqNullSafe(F.col("doc_id")))
    texts = stage(texts.select("node", "text").dropDuplicates(["node"]), "texts")
    label = linked(lists, nodes, texts, k, least_shared, width, percent, small, block)
    named = nodes.join(label, "node", "left").select("set_key", F.coalesce("class", "node").alias("class"),
                                                     F.col("doc_id").alias("least_id"))
    named = stage(named, "named")
    smallest = named.groupBy("class").agg(F.min("least_id").alias("component_id"))
    by_set = named.join(smallest, "class").select("set_key", "class", "component_id")
    own = rows.select("doc_id", "content", "n_shingles", "set_key").join(by_set, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return own.select("doc_id", "content", "n_shingles", "class", component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class, with the input's own columns: the one with the
    smallest id (null ids last), by the text's hash among equal ids; rows that
    repeat its id and text go too. Texts without words all stay."""
    found = near_duplicates(docs, id_col, text_col, **options).where(F.col("class").isNotNull())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content"))
    key = "__kept"
    while any(c.startswith(key) for c in docs.columns):
        key += "_"
    chosen = found.groupBy("class").agg(first.alias("r")).select(F.col("r.doc_id").alias(f"{key}_id"),
                                                                 F.col("r.content").alias(f"{key}_content"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    wordless = ~text.rlike(r"[^\x20\x09-\x0D]")
    own = docs.where(~wordless).withColumn(key, F.xxhash64(F.col(text_col).cast("string")))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(f"{key}_id")) & (F.col(key) == F.col(f"{key}_content"))
    own = own.join(chosen, same, "left_semi").dropDuplicates([id_col, key]).drop(key)
    return own.unionByName(docs.where(wordless))
