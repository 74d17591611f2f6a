"""Operator 8: mixing sources to target weights by systematic sampling.

Sources, ordered by code point with null last, take the weights 5, 2, 1 in turn
and share 150 % of all sizes; a target stops at twice its source's size, and the
excess is shared again by weight until no target is above. A document's
expected copies are target / source size. Within a source the documents stand
in order of size; their expected copies are summed up from the first on, one
random offset (by source) is added, and a document is emitted once per whole
number its stretch of the sum crosses. As neighbours have like sizes, the words
taken come within about one document of the target.

Only DataFrame functions. There may be any number of sources: their order comes
from range partitions, the level they share from a few aggregates. A source may
hold any share of the rows: positions come from ``common.ranked`` (windows over size classes cut by hash, counts
summed up per source). Sums are whole numbers (units of 2**-24 copies), so that
reruns agree and no document is emitted more than ceil(rate) <= 2 times.

Cases: a null text has size 0 and takes part; a source whose sizes are all 0
has target 0 and is left out; null sources form one source, the last; rows with
equal ids are rows of their own; an empty table gives an empty result; other
columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import sequential_row_number
from .common import WORD, packed, ranked, text_of, written

WEIGHTS = (5, 2, 1)
TOTAL = 1.5      # of all sizes
MOST = 2         # times a source's size
UNIT = 1 << 24   # parts of a copy
SEED = 42


def word_count(text: Column) -> Column:
    """Number of words: runs of anything but space and tab to carriage return."""
    return F.regexp_count(text, F.lit(WORD + "+")).cast("long")  # possessive: a run is taken at once


def shared_level(per: DataFrame) -> float:
    """Words per weight of the sources below their cap: shared out by weight, then
    what sources have above their cap shared out again among the others, until
    none is above. Each round is an aggregate over ``per``, one row per source."""
    at_cap, capped, level = F.lit(False), -1, 0.0
    while True:
        got = per.agg(F.sum("source_size").alias("all"), F.count(F.when(at_cap, 1)).alias("capped"),
                      F.coalesce(F.sum(F.when(at_cap, F.col("source_size"))), F.lit(0)).alias("held"),
                      F.sum(F.when(~at_cap, F.col("weight"))).alias("weights")).first()
        if got["capped"] == capped or not got["weights"]:
            return level
        capped, level = got["capped"], (TOTAL * got["all"] - MOST * got["held"]) / got["weights"]
        at_cap = F.col("weight") * F.lit(level) > MOST * F.col("source_size")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``src``, ``source_size``, ``target`` from rows (src, size). Sources may be as
    many as hosts: their order comes from a range partitioning, their shared level
    from aggregates, so none of it needs all sources in one task."""
    per = written(sizes.groupBy("src").agg(F.sum("size").alias("source_size")), "sources")
    # UTF-8 binary order is code point order.
    per = sequential_row_number(per, F.col("src").asc_nulls_last(), "__turn", save=written)
    turn = F.pmod(F.col("__turn") - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (turn + 1).cast("int"))
    per = written(per.select("src", "source_size", weight.alias("weight")), "weights")
    cap = (MOST * F.col("source_size")).cast("double")
    return per.select("src", "source_size", F.least(cap, F.col("weight") * F.lit(shared_level(per))).alias("target"))


def sized(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Every row as ``row``, with its id, source, size and size class (an eighth
    of an octave; sizes rise from class to class)."""
    rows = packed(df).select("row", F.col(f"row.{id_col}").alias("id"), F.col(f"row.{source_col}").alias("src"),
                             word_count(text_of(f"row.{text_col}")).alias("size"))
    return rows.withColumn("cls", F.when(F.col("size") > 0, F.floor(F.log2(F.col("size").cast("double")) * 8).cast("int"))
                                   .otherwise(-1))


def with_copies(rows: DataFrame, slim: DataFrame, seed: int) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``copies``; ``slim``: the same rows without text, to count."""
    targets = written(source_targets(slim.select("src", "size")), "targets")
    placed = ranked(rows, ["src"], "cls", ["size", "id"], "place", counted=slim)
    t = targets.select(F.col("src").alias("__src"), "source_size", "target")
    placed = placed.join(t, F.col("src").eqNullSafe(F.col("__src"))).drop("__src")
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long")
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("src")), F.lit(UNIT))
    end = F.shiftright((F.col("place") + 1) * rate + offset, 24)
    start = F.shiftright(F.col("place") * rate + offset, 24)
    return placed.withColumn("copies", end - start)


def mix_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               seed: int = SEED) -> DataFrame:
    """Per row: id, size, its source's size and target, and the words taken."""
    slim = written(sized(df, id_col, text_col, source_col).drop("row"), "sizes")
    return with_copies(slim, slim, seed).select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, with its own columns."""
    rows = sized(df, id_col, text_col, source_col)
    taken = with_copies(rows, written(rows.drop("row"), "sizes"), seed).filter(F.col("copies") > 0)
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return taken.select("row", F.explode(copies).alias("copy")).select("row.*")
