"""Operator 9: SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: A-Z lower-cased, words, three-word shingles (repeats included,
joined by a space), XXH64 with seed 42; a bit is 1 if set in over half of the
hashes. Two fingerprints link at 3 or fewer differing bits; a component is what
links reach.

Covering masks: every bit position i gets a vector m(i) of r + 1 = 4 bits, and
for every v other than zero, table v keeps the positions with <m(i), v> = 1.
Any 3 or fewer differing positions leave a v that is orthogonal to all of their
vectors, so the two fingerprints agree on the whole mask of table v: each pair
within the radius meets in at least one of the 15 tables, with certainty.

Equal fingerprints are one class from the start, so a table holds distinct
fingerprints only. Buckets of one are left out before anything is gathered, and
buckets of more than ``BUCKET`` fingerprints are cut again by a further covering
family over the positions their mask leaves free (the guarantee holds again),
level by level, until all are small: no bucket is capped. Within a small bucket
only the edges of a spanning forest of its links are kept. Components then come
from star contractions over tables in the checkpoint folder.

Cases: a null or wordless text has fingerprint zero and is linked like any
other; one or two words form one shingle; texts are read whole; repeated rows
share a component; rows that share an id are judged each by its own text; a null
id is kept and takes no part in the smallest id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, packed, ship, text_of, written

SHINGLE = 3
RADIUS = 3
BITS = 64
SEED = 42
BUCKET = 1024    # fingerprints compared with each other in one task's memory
LEVELS = 6       # after 6 families no free position is left (each halves them)


# -- fingerprints -----------------------------------------------------------
def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash as a signed integer (bit 63 is the sign)."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, digest = b" ".join(words), xxhash.xxh64_intdigest
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        ends = (ends[shingle - 1:] - 1).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends)]
    data = np.array(hashes, ">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(data), 65_536):
        part = data[at:at + 65_536]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    value = int.from_bytes(np.packbits(ones * 2 > len(data)).tobytes(), "big")
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``id`` and ``fp`` (signed 64-bit) of every row."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = T.StructType([rows.schema[0], T.StructField("fp", T.LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]  # one text at a time
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])
        give_back()

    return rows.mapInArrow(task, schema)


# -- covering masks ---------------------------------------------------------
def covering_masks(free: list[int], radius: int = RADIUS, seed: int = 0) -> list[int]:
    """2**(radius+1) - 1 masks over the positions ``free``, as unsigned integers."""
    rng = np.random.default_rng(seed)
    # Every vector occurs about equally often, zero left out: each mask then keeps about half of the positions.
    size = (1 << (radius + 1)) - 1
    vectors = 1 + np.resize(np.arange(size), len(free))
    rng.shuffle(vectors)
    return [sum(1 << p for p, m in zip(free, vectors) if bin(int(m) & v).count("1") & 1) for v in range(1, size + 1)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def level_masks(path: str, level: int) -> list[int]:
    """The masks of the next level below the bucket path ``path`` ("" at first):
    the path's fixed positions and half of what is left."""
    fixed = 0
    for k, step in enumerate(x for x in path.split(".") if x):
        fixed |= covering_masks([p for p in range(BITS) if not fixed >> p & 1], seed=k)[int(step)]
    free = [p for p in range(BITS) if not fixed >> p & 1]
    return [fixed | m for m in covering_masks(free, seed=level)]


def _spanning(fps: np.ndarray, ids: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among a bucket's fingerprints."""
    n = len(fps)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for i in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= radius)
        for j in (near + i + 1).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                edges.append((int(ids[i]), int(ids[j])))
    return edges


def links(classes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect the classes (``node``, ``fp``) as all links within the radius do."""
    ship(classes.sparkSession)
    todo = classes.select("node", "fp", F.lit("").alias("path"))
    found = None
    for level in range(LEVELS):
        paths = [""] if level == 0 else [r.path for r in todo.select("path").distinct().collect()]
        if not paths:
            break
        if level == 0:
            first = F.array(*[F.struct(F.lit(str(k)).alias("path"), F.lit(signed(m)).alias("mask"))
                              for k, m in enumerate(level_masks("", 0))])
            masked = todo.select("node", "fp", F.explode(first).alias("t"))
        else:  # masks by path, only of buckets that were too large
            masks = classes.sparkSession.createDataFrame(
                [(p, [(f"{p}.{k}", signed(m)) for k, m in enumerate(level_masks(p, level))]) for p in paths],
                "path string, masks array<struct<path: string, mask: long>>")
            masked = todo.join(masks, "path").select("node", "fp", F.explode("masks").alias("t"))
        keyed = masked.select("node", "fp", "t.path", F.col("fp").bitwiseAND(F.col("t.mask")).alias("key"))
        sizes = keyed.groupBy("path", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        keyed = keyed.join(sizes, ["path", "key"])
        if level < LEVELS - 1:
            keyed = written(keyed, "buckets")
            small = keyed.filter(F.col("n") <= bucket)
        else:
            small = keyed

        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                edges = [e for fps, ids in zip(pdf["fps"], pdf["ids"])
                         for e in _spanning(np.asarray(fps, np.int64).view(np.uint64), np.asarray(ids), radius)]
                yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

        grouped = small.groupBy("path", "key").agg(F.collect_list(F.struct("fp", "node")).alias("m")).select(
            F.col("m.fp").alias("fps"), F.col("m.node").alias("ids"))
        edges = written(grouped.mapInPandas(task, "a long, b long").distinct(), "edges")
        found = edges if found is None else found.unionByName(edges)
        if level < LEVELS - 1:
            todo = keyed.filter(F.col("n") > bucket).select("node", "fp", "path")
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that edges (a, b) reach, for every node with
    an edge. Large-star and small-star contraction: each round hooks every node
    to the smallest neighbour, and the rounds end when no edge changes; their
    number grows with the logarithm of a component's width. Each round is
    written to the checkpoint folder."""
    now = written(edges.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "star")
    while True:
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            now.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo <> hi").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(
            F.struct(F.col("m").alias("lo"), F.col("hi")), F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")))).alias("e"))
        nxt = written(small.select("e.*").filter("lo <> hi").distinct(), "star")
        changed = nxt.join(now, ["lo", "hi"], "left_anti").limit(1).count() + now.join(nxt, ["lo", "hi"], "left_anti").limit(1).count()
        now = nxt
        if not changed:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``id_col``, ``fp`` (signed 64-bit) and ``component_id`` of every row."""
    if radius != RADIUS:
        raise ValueError("the covering masks are laid out for a radius of 3 bits")
    rows = written(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    # The fingerprint names its class: ids may be null or shared by unrelated texts.
    classes = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(links(classes.select(F.col("fp").alias("node"), "fp"), radius, bucket))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce(F.col("root"), F.col("fp")).alias("root"), "least")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    final = rooted.drop("least").join(named, "root").drop("root")
    return rows.join(final, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: the fingerprint as 16 hex digits."""
    return near_duplicates(df, id_col, text_col).select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``df`` of each component, that of its smallest id (where texts
    share it: of the smallest MD5 of the text), with all columns. Rows without an
    id belong to no component and are kept; of equal rows one is kept."""
    digest = lambda text: F.md5(text_of(text).cast("binary"))
    keyed = df.filter(F.col(id_col).isNotNull()).select(
        F.struct(F.col(id_col).alias("id"), digest(text_col).alias("digest")).alias("place"), F.col(text_col).alias("text"))
    found = near_duplicates(keyed, "place", "text", **options)
    kept = found.filter(F.col("place") == F.col("component_id")).select("place.*").distinct()
    rows = packed(df).withColumn("id", F.col(f"row.{id_col}")).withColumn("digest", digest(F.col(f"row.{text_col}")))
    one = rows.filter("id is not null").join(kept, ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"])
    return one.unionByName(rows.filter("id is null")).select("row.*")
