"""Operator 6: sharding by longest-processing-time scheduling (law ``bytes``).

Rows of equal text form a group that must stay together; groups, sorted by
size, go one by one to the least-loaded shard, kept in a heap. Groups of one
size are interchangeable, so the schedule needs only how many groups each size
has: sizes of up to 2**PRECISION bytes are told apart exactly, larger ones by
their PRECISION leading bits, which bounds the table of size classes at any
corpus size (about 75,000 classes for sizes below 2**63). The driver schedules
that table from the largest class down. Many groups of a class are dealt at
once: the heap hands them out in order of the loads they start from, so each
shard first gets all that start at least one group below the level that the
class reaches, and the heap deals the rest; the loads are those of dealing one
by one. Where many rows share a class, groups take their places in it from
``common.ranked``, without a window over a class.

Rows learn their shard by a join on the group. Groups with more than a
thousandth of all rows, of which there are less than a thousand, are broadcast,
so their rows stay where they are; all others meet their groups by a shuffle.
A row's slot is its place in its shard, numbered the same way as the places.

Cases: a null text is the empty text (size 16, CRC 0) and of one group with
empty ones; repeated rows are rows of their own, of one group; one group may
hold any share of the rows (it stays whole, as it must, in one shard, while its
rows are spread over tasks); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, text_of, written

SHARDS = 40
ROW_BYTES = 16
PRECISION = 12  # leading bits of a size that tell classes apart
HOT_PART = 1000  # a group with more than one row in so many is hot; fewer than that can be


def size_class(size: str) -> Column:
    """The size with all but its PRECISION leading bits cleared (sizes are positive)."""
    low = f"greatest(cast(floor(log2(cast({size} as double))) as int) - {PRECISION - 1}, 0)"
    return F.expr(f"shiftleft(shiftright({size}, {low}), {low})")


def schedule(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """(class, shard, first place, groups) by longest processing time first.

    ``classes``: (class, groups, bytes); a group counts with its class's mean size."""
    loads = [(0.0, s) for s in range(shards)]
    heapq.heapify(loads)
    out: list[tuple[int, int, int, int]] = []
    for cls, groups, total in sorted(classes, reverse=True):
        mean, left = total / groups, groups
        counts = dict.fromkeys(range(shards), 0)
        if groups > shards:  # a short cut only: same loads as one by one
            order, upto = sorted(loads), 0.0
            level = None
            for k, (load, _) in enumerate(order):
                upto += load
                level = (upto + total) / (k + 1)
                if k + 1 == shards or level <= order[k + 1][0]:
                    break
            dealt = []
            for load, s in order:
                n = max(0, int((level - load) // mean))
                n = min(n, left)
                left -= n
                counts[s] += n
                dealt.append((load + n * mean, s))
            loads = dealt
            heapq.heapify(loads)
        for _ in range(left):
            load, s = loads[0]
            heapq.heapreplace(loads, (load + mean, s))
            counts[s] += 1
        first = 0
        for s, n in counts.items():
            if n:
                out.append((cls, s, first, n))
                first += n
    return out


def sharded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """``id_col``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row."""
    spark = df.sparkSession
    data = text_of(text_col).cast("binary")
    rows = written(df.select(F.col(id_col).alias("id"), F.unhex(F.md5(data)).alias("key"),
                             (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"),
                             F.crc32(data).alias("text_crc32")), "sizes")
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    groups = written(groups.withColumn("cls", size_class("bytes")), "groups")
    # Bounded by PRECISION, whatever the corpus: one row per size class.
    classes = groups.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect()
    plan = schedule([(r["cls"], r["n"], r["bytes"]) for r in classes], shards)
    total = sum(r["rows"] for r in classes)
    plan = spark.createDataFrame(plan, "__cls long, shard int, first long, n long")
    # At most `shards` stretches of places per class; a group's place falls in one of them.
    stretches = plan.groupBy("__cls").agg(F.sort_array(F.collect_list(F.struct("first", "n", "shard"))).alias("stretches"))
    placed = ranked(groups.withColumn("one", F.lit(0)), ["cls"], "one", ["key"], "place")
    placed = placed.join(stretches, F.col("cls") == F.col("__cls"))
    placed = written(placed.select("key", "rows", F.expr(
        "filter(stretches, s -> s.first <= place and place < s.first + s.n)[0].shard").alias("shard")), "places")
    is_hot = F.col("rows") * HOT_PART > total
    hot = F.broadcast(placed.filter(is_hot).drop("rows"))  # fewer than HOT_PART rows
    spread = rows.join(hot, "key")
    others = rows.join(hot, "key", "left_anti").join(placed.filter(~is_hot).drop("rows"), "key")
    dealt = spread.unionByName(others).select("id", "size", "text_crc32", "shard")
    dealt = written(dealt.withColumn("zero", F.lit(0)), "dealt")
    return (ranked(dealt, ["shard"], "zero", ["id", "text_crc32", "size"], "slot")
            .select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot"))


def shard_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """The contract's columns; the law is ``bytes``, which says nothing of a grown shard."""
    return sharded(df, id_col, text_col, shards).select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
