"""Operator 3: exact top-k inner products by columnar branch-and-bound.

Vectors are scaled to whole numbers, floor(1024 x), and packed into blocks in
vertical layout: one contiguous run per dimension, and per block of dimensions
the length of what is left of each vector. A query goes through a candidate
block a few dimensions at a time: partial scores are accumulated, and a
candidate survives while its partial score plus (length left of the query) x
(length left of the candidate) reaches the query's k-th best score so far;
survivors are compacted. Whole-number sums are exact, the bound is rounded up,
and ties survive, so nothing is lost.

Queries are the rows whose id is divisible by ``every``; they meet all rows in
blocks: candidate blocks fall into ranges, and one task works off one range for
one block of queries, carrying the k-th best score from block to block. What a
task holds is bounded by the block sizes. Each task leaves k rows per query, and
one window per query over those picks the k best.

Cases: rows with a null id, a null vector, or a null, NaN or infinite component
take no part; every other row is a candidate and, by its id, a query, also where
rows share an id or are equal (a query leaves out its own row alone); a shorter
vector counts as filled up with zeros, an empty one scores 0; ties go to
the smaller id; fewer than k candidates give all; products beyond 62 bits are
reckoned with unbounded integers, and scores beyond a long stop at its limits;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, written

K = 10
EVERY = 100
SCALE = 1024
DIM_BLOCK = 8
BLOCK = 4096        # candidates per block
QUERY_BLOCK = 16_384  # queries per block: as large as a task can hold, because every candidate goes to every query block
RANGE_BLOCKS = 8    # candidate blocks per range
LONG = 1 << 63
PACKED = "first long, n int, dims int, ids binary, tags binary, data binary"


def whole(values: np.ndarray) -> np.ndarray:
    """floor(1024 x): int64, or Python integers where a double is too coarse for int64."""
    scaled = np.floor(values * float(SCALE))
    if not len(scaled) or np.abs(scaled).max() < 2.0 ** 62:
        return scaled.astype(np.int64)
    return np.array([math.floor(v * SCALE) if abs(v) < 2.0 ** 50 else int(v) * SCALE for v in values.tolist()], object)


def _pack(size: int):
    """A task that packs rows (id, vector) into blocks of ``size`` vectors."""

    def block(ids: list, tags: list, vectors: list) -> tuple:
        dims = max(map(len, vectors))
        flat = np.zeros((dims, len(ids)), float)  # vertical: one row per dimension
        for k, v in enumerate(vectors):
            flat[: len(v), k] = v
        return tags[0], len(ids), dims, np.array(ids, np.int64).tobytes(), np.array(tags, np.int64).tobytes(), flat.tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        tags: list = []
        vectors: list = []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            tags += batch.column(1).to_pylist()
            vectors += batch.column(2).to_numpy(zero_copy_only=False).tolist()
            while len(ids) >= size:
                yield _one(block(ids[:size], tags[:size], vectors[:size]))
                ids, tags, vectors = ids[size:], tags[size:], vectors[size:]
        if ids:
            yield _one(block(ids, tags, vectors))

    return task


def _one(row: tuple) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                      names=["first", "n", "dims", "ids", "tags", "data"])


class Columns:
    """A candidate block in vertical layout with the lengths left after each block of dimensions."""

    def __init__(self, n: int, dims: int, ids: bytes, tags: bytes, data: bytes, total_dims: int):
        values = whole(np.frombuffer(data, float)).reshape(dims, n)
        self.ids, self.tags = np.frombuffer(ids, np.int64), np.frombuffer(tags, np.int64)
        self.values = np.zeros((total_dims, n), values.dtype)
        self.values[:dims] = values
        self.largest = int(np.abs(values).max()) if values.size else 0
        squares = self.values.astype(float) ** 2
        cuts = range(0, total_dims + 1, DIM_BLOCK)
        self.left = [np.sqrt(squares[c:].sum(axis=0)) for c in cuts]


def search(block: Columns, query: np.ndarray, tag: int, best: tuple[np.ndarray, np.ndarray], k: int):
    """The k best (scores, ids) so far, after this block."""
    scores, ids = best
    dims = len(query)
    if dims * block.largest * (int(np.abs(query).max()) if dims else 0) >= 1 << 62 or query.dtype == object or block.values.dtype == object:
        acc = np.zeros(len(block.ids), object)
        for d in range(dims):
            acc = acc + block.values[d].astype(object) * int(query[d])
        found = np.array([min(max(int(a), -LONG), LONG - 1) for a in acc], np.int64)
        alive = np.flatnonzero(block.tags != tag)
        found = found[alive]
    else:
        floor = scores[-1] if len(scores) == k else None
        rest = np.sqrt(np.add.accumulate((query.astype(float) ** 2)[::-1])[::-1])
        alive = np.flatnonzero(block.tags != tag)
        found = np.zeros(len(alive), np.int64)
        every = len(alive) == len(block.ids)
        for b, at in enumerate(range(0, dims, DIM_BLOCK)):
            for d in range(at, min(dims, at + DIM_BLOCK)):
                found += query[d] * (block.values[d] if every else block.values[d, alive])
            end = at + DIM_BLOCK
            if floor is None or end >= dims:
                continue
            left = block.left[b + 1] if every else block.left[b + 1][alive]
            stay = found + (rest[end] * left * (1 + 1e-9) + 1) >= floor
            if np.count_nonzero(stay) < 0.8 * len(stay):
                alive, found, every = alive[stay], found[stay], False
                if not len(alive):
                    return best
    if len(found) > k:  # the k best of this block, ties kept for the ids to decide
        low = np.partition(found, len(found) - k)[len(found) - k]
        top = found >= low
        alive, found = alive[top], found[top]
    scores, ids = np.concatenate([scores, found]), np.concatenate([ids, block.ids[alive]])
    order = np.lexsort((ids, -scores.astype(float) if scores.dtype == object else np.bitwise_not(scores)))[:k]
    return scores[order], ids[order]


def _search_range(k: int):
    def task(key: tuple, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            dims = int(max(queries["dims"].max(), candidates["dims"].max()))
            asked = []
            for q in queries.itertuples(index=False):
                values = whole(np.frombuffer(q.data, float)).reshape(q.dims, q.n)
                filled = np.zeros((dims, q.n), values.dtype)
                filled[: q.dims] = values
                asked += [(int(i), int(t), np.ascontiguousarray(filled[:, j])) for j, (i, t) in enumerate(
                    zip(np.frombuffer(q.ids, np.int64), np.frombuffer(q.tags, np.int64)))]
            none = np.zeros(0, np.int64)
            best = [(none, none)] * len(asked)
            for c in candidates.sort_values("first").itertuples(index=False):
                block = Columns(c.n, c.dims, c.ids, c.tags, c.data, dims)
                best = [search(block, v, t, b, k) for (_, t, v), b in zip(asked, best)]
            out = [(i, t, int(v), int(s)) for (i, t, _), (scores, ids) in zip(asked, best) for s, v in zip(scores, ids)]
        return pd.DataFrame(out, columns=["query_id", "tag", "vec_id", "score"], dtype="int64")

    return task


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY,
            block: int = BLOCK, query_block: int = QUERY_BLOCK, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best per query."""
    ship(df.sparkSession)
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
              .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~odd))
    # A row's tag tells it from others of its id; it is written once, with the row.
    rows = written(rows.select("id", F.monotonically_increasing_id().alias("tag"), "v"), "vectors")
    candidates = written(rows.mapInArrow(_pack(block), PACKED), "candidates")
    queries = written(rows.filter(F.col("id") % every == 0).mapInArrow(_pack(query_block), PACKED), "queries")
    ranges = max(1, math.ceil(candidates.count() / range_blocks))
    turns = max(1, queries.count())
    number = lambda n: F.pmod(F.xxhash64("first"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = candidates.withColumn("r", number(ranges)).withColumn("q", all_of(turns))
    left = queries.withColumn("q", number(turns)).withColumn("r", all_of(ranges))
    found = left.groupBy("q", "r").cogroup(right.groupBy("q", "r")).applyInPandas(
        _search_range(k), "query_id long, tag long, vec_id long, score long")
    best = Window.partitionBy("tag").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
