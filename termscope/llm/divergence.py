"""Operator 13: source divergence audit by three-dimensional cube partitioning.

Per language, the terms in at least ``LEAST_DOCS`` of its documents are kept. A
group (the documents of a language and source) gives a kept term the share
p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)), N the sum of its counts over
the V kept terms; so does the language as a whole. Two groups diverge by the sum
of |p - p'| over all kept terms; a group's telling terms are those it gives more
than its language does.

The cube: a language's groups are dealt into blocks of about ``GROUPS`` and its
terms into blocks of about ``TERMS``, both by hash. A task owns cells (group
block, group block, term block): the slices of both group blocks are sent there
(a slice goes to as many cells as there are group blocks), made dense, and give
the partial divergences of their pairs. The partial sums are then added along
the term axis. A cell is small however many documents, terms or groups a
language has, so one language may hold any share of the rows. All arithmetic is
on whole numbers; the shares are divided as decimals of 38 digits.

Counting: a task keeps counts per (language, source, term) and hands them on
when they reach ``HELD``, so a frequent term leaves a task as few rows.

Cases: null text, language and source count as ''; a text without terms still
makes its group occur, with the share 1 + floor(10**9 / V) for every term; a
language that keeps no term has divergences of 0 and no telling terms; texts are
read whole; repeated rows count each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, text_of, written

LEAST_DOCS = 30
ADDED = 5                 # to every count
SCALE = 1_000_000_000     # shares are whole multiples of 1 / SCALE
TOP = 50                  # telling terms of a group
GROUPS = 64               # groups in a block, on average
TERMS = 2048              # terms in a block, on average
HELD = 400_000            # counts that a task keeps

#: Bytes of a term: ASCII letters, the capital ones lower-cased, and all bytes of other characters; the rest become blanks.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTS = "lang string, source string, term binary, n long, docs long"


def counted(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences), ``docs`` (documents with
    it): one row per group and term. Every group also has a row of the term ''."""
    ship(df.sparkSession)
    rows = df.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).cast("binary").alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        held = 0

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in seen.items():
                n[b""] += 0
                terms = list(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()),
                     pa.array([n[t] for t in terms], pa.int64()), pa.array([docs[t] for t in terms], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*(batch.column(k) for k in range(3))):
                terms = text.as_py().translate(_BYTES).split()
                n, docs = seen[lang.as_py(), source.as_py()]
                before = len(n)
                n.update(terms)
                docs.update(set(terms))
                held += len(n) - before + 1
                if held >= HELD:
                    yield from handed()
                    seen.clear()
                    held = 0
        yield from handed()

    tasks = rows.mapInArrow(task, COUNTS)
    return tasks.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * terms)), exact; 0 where nothing is kept."""
    return F.expr(f"case when {terms} = 0 then 0L else 1 + (cast({SCALE} as decimal(10, 0)) * cast({n} + {ADDED} as decimal(20, 0))) "
                  f"div cast({total} + {ADDED} * {terms} as decimal(20, 0)) end")


class Audit:
    """The tables of one audit: ``groups`` (a row per language and source) and
    ``kept`` (a row per group and kept term that it has)."""

    def __init__(self, df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                 least_docs: int = LEAST_DOCS, group_block: int = GROUPS, term_block: int = TERMS):
        counts = written(counted(df, text_col, lang_col, source_col), "counts")
        real = counts.filter("term <> ''")
        # Numbered within hash blocks, so that no window spans a language.
        kept = real.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= least_docs)
        langs = counts.groupBy("lang").agg(F.count_distinct("source").alias("g")).join(
            kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left").select(
            "lang", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
            F.ceil(F.col("g") / F.lit(float(group_block))).cast("int").alias("group_blocks"),
            F.greatest(F.lit(1), F.ceil(F.col("v") / F.lit(float(term_block))).cast("int")).alias("term_blocks"))
        langs = written(langs, "langs")
        block = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int")
        self.terms = written(kept.join(langs, "lang").withColumn("tb", block).withColumn(
            "at", F.row_number().over(Window.partitionBy("lang", "tb").orderBy("term")) - 1).select(
            "lang", "term", "tb", "at", "lang_n", share("lang_n", "lang_total", "v").alias("q")), "terms")
        met = written(real.select("lang", "source", "term", "n").join(self.terms, ["lang", "term"]), "kept")
        totals = met.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        self.groups = written(counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
                              .join(langs, "lang").withColumn("total", F.coalesce("total", F.lit(0)))
                              .withColumn("gb", F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int"))
                              .withColumn("base", share("0", "total", "v")), "groups")
        self.kept = met.join(self.groups.select("lang", "source", "total", "v"), ["lang", "source"]).select(
            "lang", "source", "term", "tb", "at", "n", "q", share("n", "total", "v").alias("p"))

    def slices(self) -> DataFrame:
        """One row per group and term block: the shares of its terms there by
        position, the share of all others (``base``) and the block's ``width``."""
        own = self.kept.groupBy("lang", "source", "tb").agg(F.collect_list(F.struct("at", "p")).alias("own"))  # a block's terms at most
        width = self.terms.groupBy("lang", "tb").agg(F.count(F.lit(1)).cast("int").alias("width"))
        every = self.groups.select("lang", "source", "gb", "group_blocks", "base",
                                   F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("tb"))
        return every.join(width, ["lang", "tb"], "left").join(own, ["lang", "source", "tb"], "left").select(
            "lang", "source", "gb", "group_blocks", "tb", "base", F.coalesce("width", F.lit(0)).alias("width"),
            F.col("own.at").alias("at"), F.col("own.p").alias("p"))

    def pairs(self) -> DataFrame:
        """``lang``, ``source``, ``item``, ``value``: the divergence of every two
        groups of a language, in both directions."""
        cells = F.transform(F.sequence(F.lit(0), F.col("group_blocks") - 1),
                            lambda h: F.struct(F.least("gb", h).alias("x"), F.greatest("gb", h).alias("y")))
        cube = self.slices().select("lang", "tb", F.explode(cells).alias("c"), "source", "gb", "base", "width", "at", "p")
        cube = cube.select("lang", "c.x", "c.y", "tb", "source", "gb", "base", "width", "at", "p")
        partial = cube.groupBy("lang", "x", "y", "tb").applyInArrow(_cell, "lang string, a string, b string, value long")
        sums = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                 F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("of")
        return sums.select("lang", both, "value").select("lang", "of.source", "of.item", "value")

    def telling(self) -> DataFrame:
        """``lang``, ``source``, ``item`` (a term), ``value``: what a group gives a term beyond its language."""
        return self.kept.filter("n > 0 and p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def _cell(slices: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of one cell."""
    gb, source, width = slices["gb"].to_numpy(), slices["source"].to_pylist(), slices["width"][0].as_py()
    x, y = slices["x"][0].as_py(), slices["y"][0].as_py()
    dense = np.empty((len(gb), width), np.int64)
    for k in range(len(gb)):
        dense[k] = slices["base"][k].as_py()
        if slices["at"][k].is_valid:
            dense[k, slices["at"][k].values.to_numpy()] = slices["p"][k].values.to_numpy()
    order = sorted(range(len(gb)), key=lambda k: (gb[k], source[k]))
    dense, source, gb = dense[order], [source[k] for k in order], gb[order]
    second = np.flatnonzero(gb == y)
    a, b, value = [], [], []
    for k in np.flatnonzero(gb == x).tolist():
        others = second[second > k] if x == y else second
        sums = np.abs(dense[others] - dense[k]).sum(axis=1)
        a += [source[k]] * len(others)
        b += [source[j] for j in others.tolist()]
        value += sums.tolist()
    return pa.table({"lang": pa.array([slices["lang"][0].as_py()] * len(a), pa.string()), "a": pa.array(a, pa.string()),
                     "b": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})


def report(df: DataFrame, top: int = TOP, **options) -> DataFrame:
    """The contract's rows: part ``pair`` with all ranks, part ``term`` with ranks up to ``top``."""
    audit = Audit(df, **options)
    both = audit.pairs().withColumn("part", F.lit("pair")).unionByName(audit.telling().withColumn("part", F.lit("term")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs, terms = (both.filter(F.col("part") == part).withColumn("rank", F.row_number().over(order)) for part in ("pair", "term"))
    return pairs.unionByName(terms.filter(F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
