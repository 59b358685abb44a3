"""Exact top-k search by inner product: tiles of queries times shards of vectors.

Queries are packed into tiles and vectors into shards, each a matrix of bounded
size in one row. Shards are dealt to buckets; a tile goes to every bucket and a
bucket to every tile, so their equi-join on (tile, bucket) has each pair of
matrices once and no key is hot, however alike the vectors are. A task
multiplies its pairs chunk by chunk, keeps per query the best k so far and looks
only at rows of a chunk whose maximum beats them. The lists of the buckets are
then merged in a tree: each level groups ``FAN_IN`` neighbouring buckets, so a
group has a bounded number of bounded rows whatever the number of vectors.

Components are taken to floor(256 * x). The product is computed in 32-bit
floats where the norms prove every partial sum below 2^24, in 64-bit floats
below 2^53 (less the chunk's width), else in Python's integers; so scores are
exact. Scores beyond 64 bits become the nearest long.

Every row counts for itself, so repeated rows take one rank each; a repeated
query gives its list again. A query's own rows are those with its id. Equal
scores rank the smaller id first. Vectors that are null or hold a null or
non-finite component (or one whose 256-fold is not finite), and rows without an
id, take no part. Vectors meet only those of their own length (0 included).
Empty tables give no rows. Only the id and vector columns are read, so extra
columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_arrow

# Fixed values of the contract.
SCALE = 256.0
TOP = 5
QUERY_EVERY = 50

MATRIX_BYTES = 16 << 20   # of a tile or shard as 64-bit values: 32,768 vectors of 64 components
FAN_IN = 16               # lists merged by one group of a tree level
CHUNK = 2048              # rows and columns multiplied at once
SPREAD_ROWS = 2048        # no more buckets than one for so many vectors, unless their size asks for it

ABSENT = np.iinfo(np.int64).min
NO_ID = np.iinfo(np.int64).max

MATRIX_SCHEMA = "dim int, part int, seq int, ids binary, kind string, data binary, norm double"
LIST_SCHEMA = "dim int, tile int, seq int, bucket int, query_ids binary, ids binary, scores binary"
RESULT_SCHEMA = "query_id long, rank int, vec_id long, score long"


def scaled(ids: pa.Array, vectors: pa.Array, scale: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length of vector the ids and matrix of the rows that take part."""
    ids = np.asarray(ids, dtype=np.int64)
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), -1), dtype=np.int64)
    flat = np.asarray(pc.fill_null(vectors.flatten().cast(pa.float64()), np.nan))
    starts = np.concatenate(([0], np.cumsum(np.maximum(lengths, 0))))[:-1]
    for dim in np.unique(lengths[lengths >= 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        with np.errstate(over="ignore", invalid="ignore"):
            matrix = np.floor(flat[starts[rows, None] + np.arange(dim)] * scale)
        fit = np.isfinite(matrix).all(axis=1)
        yield dim, ids[rows[fit]], matrix[fit]


def packed(dim: int, part: int, seq: int, ids: np.ndarray, matrix: np.ndarray) -> dict:
    """One matrix as a row, by ascending id, in the narrowest of three types that holds it."""
    order = np.argsort(ids, kind="stable")
    matrix = matrix[order]
    top = np.abs(matrix).max(initial=0)
    kind = "<i2" if top < 2 ** 15 else "<i4" if top < 2 ** 31 else "<f8"
    norm = float(np.sqrt(np.square(matrix).sum(axis=1)).max(initial=0))
    return {"dim": dim, "part": part, "seq": seq, "ids": ids[order].tobytes(), "kind": kind,
            "data": matrix.astype(kind).tobytes(), "norm": norm}


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["data"], row["kind"]).reshape(len(ids), row["dim"])


def pack(vectors: DataFrame, id_col: str, vector_col: str, scale: float, name: str) -> DataFrame:
    """The vectors of each partition as matrices of at most ``MATRIX_BYTES``."""
    schema = pa.schema([("dim", pa.int32()), ("part", pa.int32()), ("seq", pa.int32()), ("ids", pa.binary()),
                        ("kind", pa.string()), ("data", pa.binary()), ("norm", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        waiting: dict[int, list] = {}

        def row(dim: int) -> pa.RecordBatch:
            pairs = waiting.pop(dim)
            return pa.RecordBatch.from_pylist([packed(dim, part, seq, np.concatenate([i for i, _ in pairs]),
                                                      np.concatenate([m for _, m in pairs]))], schema)

        for batch in batches:
            for dim, ids, matrix in scaled(batch.column(0), batch.column(1), scale):
                room = max(1, MATRIX_BYTES // (8 * max(dim, 1)))
                for k in range(0, len(ids), room):
                    piece = ids[k:k + room], matrix[k:k + room]
                    if sum(len(i) for i, _ in waiting.get(dim, ())) + len(piece[0]) > room:
                        yield row(dim)
                        seq += 1
                    waiting.setdefault(dim, []).append(piece)
        for dim in list(waiting):
            yield row(dim)
            seq += 1

    chosen = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"),
                                                             F.col(vector_col).alias("vector"))
    return map_arrow(chosen, run, MATRIX_SCHEMA).withColumnsRenamed(
        {c: f"{name}_{c}" for c in ("part", "seq", "ids", "kind", "data", "norm")})


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k columns of each row: higher score, then smaller id."""
    order = np.lexsort((ids, ~scores), axis=1)[:, :k]   # ~x falls as x rises, for every long
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


class Lists:
    """The best k of each query of a tile, by falling score and rising id."""

    def __init__(self, n: int, k: int):
        self.scores, self.ids = np.full((n, k), ABSENT), np.full((n, k), NO_ID)

    def merge(self, rows, scores: np.ndarray, ids: np.ndarray) -> None:
        self.scores[rows], self.ids[rows] = best(np.concatenate((self.scores[rows], scores), axis=1),
                                                 np.concatenate((self.ids[rows], ids), axis=1), self.scores.shape[1])

    def least(self, rows) -> np.ndarray:
        last = self.scores[rows, -1]
        return np.where(last == ABSENT, -np.inf, last.astype(np.float64))


def multiply(queries: np.ndarray, vectors: np.ndarray, reach: float) -> np.ndarray:
    """Exact products, as floats while they hold them, else as longs."""
    if reach < 2 ** 53 // (2 * CHUNK):
        kind = np.float32 if reach < 2 ** 24 - 1 else np.float64
        return queries.astype(kind) @ vectors.astype(kind).T
    def whole(matrix):
        return np.array([[int(x) for x in row] for row in matrix.tolist()], dtype=object).reshape(matrix.shape)
    if queries.shape[1] == 0:
        return np.zeros((len(queries), len(vectors)), np.int64)
    product = whole(queries).dot(whole(vectors).T)
    return np.clip(product, ABSENT + 1, NO_ID).astype(np.int64)


def select(product: np.ndarray, ids: np.ndarray, own: list[tuple[int, int, int]], lists: Lists, floor: np.ndarray,
           first: int) -> None:
    """Take a chunk's best into the lists of the rows from ``first`` on. ``ids`` rise, and are
    above those seen before in this shard; a score has to pass ``floor`` to count."""
    k, width = lists.scores.shape[1], product.shape[1]
    rows = slice(first, first + len(product))
    if product.dtype == np.int64:
        for r, a, b in own:
            product[r, a:b] = ABSENT
        lists.merge(rows, *best(product, np.broadcast_to(ids, product.shape), k))
        return
    for r, a, b in own:
        product[r, a:b] = -np.inf
    need = np.flatnonzero(product.max(axis=1) > np.maximum(lists.least(rows), floor))
    if not len(need):
        return
    some = product[need].astype(np.float64)
    keys = some * width + np.arange(width - 1, -1, -1)   # all different: equal scores by rising id
    take = np.argpartition(keys, width - k, axis=1)[:, width - k:] if k < width else \
        np.broadcast_to(np.arange(width), keys.shape)
    scores = np.take_along_axis(some, take, 1)
    real = np.isfinite(scores)
    lists.merge(first + need, np.where(real, scores, 0).astype(np.int64) + np.where(real, 0, ABSENT),
                np.where(real, ids[take], NO_ID))


def search(tile: dict, shard: dict, lists: Lists) -> None:
    """Merge the best of one shard into the lists of one tile."""
    query_ids, queries = unpacked(tile)
    ids, vectors = unpacked(shard)
    reach = tile["norm"] * shard["norm"] * (1 + 1e-6)
    here = Lists(len(query_ids), lists.scores.shape[1])
    before = lists.least(slice(None)) - 1   # equal scores of this shard may have smaller ids
    left, right = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    for a in range(0, len(query_ids), CHUNK):
        rows = slice(a, a + CHUNK)
        met = np.flatnonzero(right[rows] > left[rows])
        for b in range(0, len(ids), CHUNK):
            own = [(r, max(left[a + r] - b, 0), right[a + r] - b) for r in met.tolist()
                   if left[a + r] < b + CHUNK and right[a + r] > b]
            select(multiply(queries[rows], vectors[b:b + CHUNK], reach), ids[b:b + CHUNK], own, here, before[rows], a)
    lists.merge(slice(None), here.scores, here.ids)


def as_row(key: tuple, query_ids: bytes, lists: Lists, bucket: int) -> pa.RecordBatch:
    values = (*key, bucket, query_ids, lists.ids.tobytes(), lists.scores.tobytes())
    kinds = (pa.int32(),) * 4 + (pa.binary(),) * 3
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)],
                                      names=[c.split()[0] for c in LIST_SCHEMA.split(", ")])


def search_pairs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lists, query_ids = None, None, b""   # a bucket's shards follow each other
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["dim"], r["tile_part"], r["tile_seq"]), r["bucket"]
                if key != now:
                    if now:
                        yield as_row(now[0], query_ids, lists, now[1])
                    now, query_ids = key, r["tile_ids"]
                    lists = Lists(len(query_ids) // 8, k)
                tile, shard = ({c: r[f"{side}_{c}"] for c in ("ids", "kind", "data", "norm")} | {"dim": r["dim"]}
                               for side in ("tile", "shard"))
                search(tile, shard, lists)
        if now:
            yield as_row(now[0], query_ids, lists, now[1])
    return run


def merge_lists(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Merge rows that follow each other with the same (dim, tile, seq, bucket)."""
        now, lists, query_ids = None, None, b""
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["dim"], r["tile"], r["seq"]), r["bucket"]
                if key != now:
                    if now:
                        yield as_row(now[0], query_ids, lists, now[1])
                    now, query_ids = key, r["query_ids"]
                    lists = Lists(len(query_ids) // 8, k)
                lists.merge(slice(None), np.frombuffer(r["scores"], np.int64).reshape(-1, k),
                            np.frombuffer(r["ids"], np.int64).reshape(-1, k))
        if now:
            yield as_row(now[0], query_ids, lists, now[1])
    return run


def unfold(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                scores, ids = (np.frombuffer(r[c], np.int64) for c in ("scores", "ids"))
                query_ids = np.repeat(np.frombuffer(r["query_ids"], np.int64), k)
                real = scores != ABSENT
                ranks = np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids) // k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[real]) for x in (query_ids, ranks, ids, scores)],
                    names=["query_id", "rank", "vec_id", "score"])
    return run


def matrices(vectors: DataFrame, vector_col: str) -> tuple[int, int]:
    """How many rows there are, and how many full matrices their components fill."""
    n, size = vectors.agg(F.count("*"), F.sum(F.greatest(F.size(vector_col), F.lit(1)).cast("long"))).first()
    return n, -(-8 * (size or 0) // MATRIX_BYTES)


def exact_top_k(queries: DataFrame, vectors: DataFrame, k: int = TOP, scale: float = SCALE,
                id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query its k vectors of highest inner product: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    n, full = matrices(vectors, vector_col)
    buckets = max(1, full, min(2 * spark.sparkContext.defaultParallelism, -(-n // SPREAD_ROWS)))
    tiles = max(1, matrices(queries, vector_col)[1])

    tile = pack(queries.select(id_col, vector_col).repartition(tiles), id_col, vector_col, scale, "tile")
    shard = pack(vectors, id_col, vector_col, scale, "shard")
    tile = tile.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    shard = (shard.withColumn("bucket", (F.col("shard_part") + F.col("shard_seq")) % buckets)
             .withColumn("tile_part", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))))
    pairs = tile.join(shard.drop("shard_part", "shard_seq"), ["dim", "tile_part", "bucket"])
    lists = map_arrow(pairs, search_pairs(k), LIST_SCHEMA)
    while True:
        buckets = -(-buckets // FAN_IN)
        key = ["dim", "tile", "seq", "bucket"]
        lists = lists.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("int"))
        lists = map_arrow(lists.repartition(*key).sortWithinPartitions(*key), merge_lists(k), LIST_SCHEMA)
        if buckets == 1:
            return map_arrow(lists, unfold(k), RESULT_SCHEMA)
