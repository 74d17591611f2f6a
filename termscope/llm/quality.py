"""Operator 4: quality rules with robust multivariate outliers.

Plain rules come first (too few words, too many words in repeated five-word
windows). Then every document's statistics become a transformed vector, and per
language and source the minimum covariance determinant (MCD) estimate of centre
and scatter is found: from three starts concentration steps are taken
(distances under the present estimate, the half of the documents with the
smallest distances, mean and covariance of those), the start whose scatter has
the smallest determinant goes on. A document whose Mahalanobis distance exceeds
the cut is rejected.

All of it covers all documents. Vectors are integers (1/1024), distances are
binned on a logarithmic scale, and one aggregate per step keeps counts, sums and
products per (stratum, start, bin), so that estimates do not depend on the order
of rows and a stratum may hold any share of the rows: each task leaves at most
one row per stratum, start and bin. Every stratum is drawn towards the estimate
of its language with the weight of ``PRIOR_ROWS`` rows, whatever its size, and
scatter has a small ridge, because some statistics are zero in most documents.
Real distances have a longer tail than chi-square, so the cut is a stratum's
own (``cuts``), between the 0.999 quantile of chi-square and four times it.

Cases: a null text has no words, its vector takes part, and the base rules
reject it; null language or source form strata of their own; texts of any
length are read whole; repeated rows count each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import give_back, packed, ship, text_of, written

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

SHARE = 0.5             # of a stratum's documents that an estimate rests on
FIRST_STEPS = 2         # concentration steps of every start
STEPS = 6               # concentration steps of the best one, the first ones included
PRIOR_ROWS = 30         # weight of the language's estimate in a stratum's
UNIT = 1024             # vectors are whole multiples of 1 / UNIT
BINS = 64               # distance bins per doubling of 1 + distance squared
LEAST_CUT_SQ = 22.46    # the 0.999 quantile of chi-square with 6 degrees of freedom
MOST_CUT_SQ = 4 * LEAST_CUT_SQ  # twice that distance: the ceiling of a cut
SLICE = 64              # texts that a task holds as Python strings at a time
NORMAL_999, NORMAL_75 = 3.0902, 0.6745  # quantiles of the normal law
CUT_PRIOR_ROWS = 300    # weight of the language's distances in a stratum's cut
#: Ridge of the scatter, as a standard deviation of: symbols, capitals and stuttered words per word, repeated lines, repeated words, word length.
FLOOR = (0.02, 0.008, 0.008, 0.04, 0.02, 0.015)
DIMS = len(FLOOR)


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words covered by windows of ``size`` words that occur twice or more."""
    windows = list(zip(*[words[i:] for i in range(size)]))
    if len(set(windows)) == len(windows):
        return 0
    many = {w for w, n in Counter(windows).items() if n > 1}
    total, upto = 0, 0
    for i, w in enumerate(windows):
        if w in many:
            total += i + size - max(i, upto)
            upto = i + size
    return total


def text_stats(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_stutter."""
    data = text.encode("utf-8")
    words = data.split()
    without = lambda chars: len(data) - len(data.translate(None, chars))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (len(words), len(text) - without(SPACES), without(SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), without(UPPER),
            sum(map(operator.eq, words, words[1:])))


def vector(s: tuple[int, ...]) -> list[int]:
    """The transformed statistics, in whole multiples of 1 / UNIT. Pseudo-counts
    keep short texts from extreme rates; logarithms shorten the upper tails."""
    n, chars, symbols, dup, repeat, lines, upper, stutter = s
    values = (math.log1p(symbols / (n + 30)), math.log1p(upper / (n + 30)), math.log1p(stutter / (n + 30)),
              dup / (lines + 5), repeat / (n + 30), math.log((chars + 180) / (n + 30)))
    return [round(v * UNIT) for v in values]


def document_stats(df: DataFrame, id_col: str, text_col: str, strata: list[str]) -> DataFrame:
    """One slim row per document: id, stratum columns, counts and vector."""
    ship(df.sparkSession)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(strata)],
                     text_of(text_col).alias("text"))
    schema = T.StructType([*rows.schema[:-1], *[T.StructField(n, T.LongType()) for n in names],
                           *[T.StructField(f"x{i}", T.LongType()) for i in range(DIMS)]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                stats = [text_stats(t.as_py()) for t in batch.column(batch.num_columns - 1)]
                vectors = [vector(s) for s in stats]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *[pa.array([s[i] for s in stats], pa.int64()) for i in range(len(names))],
                     *[pa.array([v[i] for v in vectors], pa.int64()) for i in range(DIMS)]],
                    names=schema.names)
        give_back()

    return rows.mapInArrow(task, schema)


def chi_square(x: float, dof: int) -> float:
    """Distribution function of chi-square with an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def consistency(share: float, dof: int) -> float:
    """What the scatter of the nearest ``share`` of a normal sample falls short by."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dof) < share else (low, mid)
    return share / chi_square(low, dof + 2)


PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
ESTIMATE = ("level string, key string, outer_key string, start string, n long, "
            "centre array<double>, scatter array<double>, inverse array<double>, log_det double")
MOMENTS = [*[f"s{i}" for i in range(DIMS)], *[f"p{i}_{j}" for i, j in PAIRS]]


def _estimate_task(factor: float, prior_rows: float):
    """Moments (one row per stratum and start) to centre, scatter, inverse and log-determinant."""
    floor = np.diag((np.array(FLOOR) * UNIT) ** 2)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                n = r["n"]
                centre = np.array([r[f"s{i}"] for i in range(DIMS)], float) / n
                scatter = np.zeros((DIMS, DIMS))
                for i, j in PAIRS:
                    scatter[i, j] = scatter[j, i] = r[f"p{i}_{j}"] / n - centre[i] * centre[j]
                scatter *= factor
                if r["prior_centre"] is not None:
                    w = n / (n + prior_rows)
                    centre = w * centre + (1 - w) * np.array(r["prior_centre"])
                    scatter = w * scatter + (1 - w) * np.array(r["prior_scatter"]).reshape(DIMS, DIMS)
                out.append(dict(level=r["level"], key=r["key"], outer_key=r["outer_key"], start=r["start"], n=n,
                                centre=centre.tolist(), scatter=scatter.ravel().tolist(),
                                inverse=np.linalg.inv(scatter + floor).ravel().tolist(),
                                log_det=float(np.linalg.slogdet(scatter + floor)[1])))
            doubles = pa.list_(pa.float64())
            schema = schema or pa.schema([("level", pa.string()), ("key", pa.string()), ("outer_key", pa.string()),
                                          ("start", pa.string()), ("n", pa.int64()), ("centre", doubles),
                                          ("scatter", doubles), ("inverse", doubles), ("log_det", pa.float64())])
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return task


def _estimates(moments: DataFrame, factor: float, prior: DataFrame | None = None, name: str = "estimates") -> DataFrame:
    """One estimate per row of ``moments``; with ``prior`` drawn towards the outer level's."""
    none = F.lit(None).cast("array<double>")
    if prior is None:
        moments = moments.withColumns({"prior_centre": none, "prior_scatter": none})
    else:
        moments = moments.join(prior.select(F.col("key").alias("outer_key"), F.col("centre").alias("prior_centre"),
                                            F.col("scatter").alias("prior_scatter")), "outer_key", "left")
    columns = ["level", "key", "outer_key", "start", "n", *MOMENTS, "prior_centre", "prior_scatter"]
    return written(moments.select(*columns).mapInArrow(_estimate_task(factor, PRIOR_ROWS), ESTIMATE), name)


def _distance_sq(centre: str = "centre", inverse: str = "inverse"):
    d = [F.col(f"x{i}") - F.col(centre)[i] for i in range(DIMS)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + d[i] * d[j] * F.col(inverse)[i * DIMS + j] * (1 if i == j else 2)
    return F.greatest(total, F.lit(0.0))


def _sums(weight, values: list) -> list:
    """Sums and sums of products of ``values``, the columns that ``MOMENTS`` names."""
    return [F.sum("weight").alias("n"), *[F.sum(v * weight).alias(f"s{i}") for i, v in enumerate(values)],
            *[F.sum(values[i] * values[j] * weight).alias(f"p{i}_{j}") for i, j in PAIRS]]


def first_estimates(rows: DataFrame) -> DataFrame:
    """Three starts per stratum: ``ridge`` (medians, the ridge alone), ``signs``
    (medians, the covariance of the directions from them: a row weighs the same
    however far it lies) and ``all`` (mean and covariance of every row)."""
    by = ["level", "key", "outer_key"]
    xs = [F.col(f"x{i}") for i in range(DIMS)]
    weight = F.col("weight")
    plain = rows.groupBy(*by).agg(*_sums(weight, xs)).withColumn("start", F.lit("all"))
    medians = written(rows.groupBy("level", "key").agg(
        *[F.expr(f"percentile(x{i}, 0.5D, weight)").alias(f"m{i}") for i in range(DIMS)]), "medians")
    off = rows.join(medians, ["level", "key"])
    z = [(F.col(f"x{i}") - F.col(f"m{i}")) / (FLOOR[i] * UNIT) for i in range(DIMS)]
    off = off.withColumn("norm_sq", sum((v * v for v in z), F.lit(0.0)))
    # Products of directions are at most one: rounded to whole multiples of 2^-30 their sums do not depend on order.
    signs = [F.when(F.col("norm_sq") > 0, F.round(z[i] * z[j] / F.col("norm_sq") * (1 << 30))).otherwise(0).cast("long") * weight
             for i, j in PAIRS]
    near = off.groupBy(*by, *[f"m{i}" for i in range(DIMS)]).agg(
        F.sum("weight").alias("n"), F.expr("percentile(floor(log2(1 + norm_sq) * 64), 0.5D, weight)").alias("mid"),
        *[F.sum(s).alias(f"g{i}_{j}") for s, (i, j) in zip(signs, PAIRS)])
    # As moments with that centre and scatter, so that one task makes all estimates.
    scale = F.pow(F.lit(2.0), F.col("mid") / BINS) - 1
    near = near.withColumn("start", F.explode(F.array(F.lit("ridge"), F.lit("signs"))))
    as_moments = [*[(F.col(f"m{i}") * F.col("n")).alias(f"s{i}") for i in range(DIMS)],
                  *[(F.col(f"m{i}") * F.col(f"m{j}") * F.col("n") + F.when(F.col("start") == "signs", F.lit(
                      FLOOR[i] * FLOOR[j] * UNIT * UNIT) * scale * F.col(f"g{i}_{j}") / F.lit(float(1 << 30))).otherwise(0.0)
                     ).alias(f"p{i}_{j}") for i, j in PAIRS]]
    near = near.select(*by, "start", F.col("n"), *as_moments)
    plain = plain.select(*by, "start", "n", *[F.col(m).cast("double").alias(m) for m in MOMENTS])
    return _estimates(plain.unionByName(near), 1.0, name="starts")


def concentrated(rows: DataFrame, now: DataFrame, prior: DataFrame | None = None, level: str | None = None) -> DataFrame:
    """One concentration step for every stratum and start of ``now``: moments of
    the ``SHARE`` of the rows nearest under the present estimate. Distances are
    compared by bins, whose moments are summed; equal bins go in together."""
    by = ["level", "key", "outer_key", "start"]
    met = rows.drop("outer_key").join(now.select(*by, "centre", "inverse"), ["level", "key"])
    if level:
        met = met.filter(F.col("level") == level)
    binned = met.withColumn("bin", F.floor(F.log2(1 + _distance_sq()) * BINS))
    moments = binned.groupBy(*by, "bin").agg(*_sums(F.col("weight"), [F.col(f"x{i}") for i in range(DIMS)]))
    stratum = Window.partitionBy(*by)
    before = stratum.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    moments = (moments.withColumn("all_n", F.sum("n").over(stratum))
                      .withColumn("seen", F.coalesce(F.sum("n").over(before), F.lit(0)))
                      .filter(F.col("seen") < F.ceil(F.col("all_n") * SHARE)))
    moments = moments.groupBy(*by).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in MOMENTS])
    return _estimates(moments, consistency(SHARE, DIMS), prior)


def robust_estimates(stats: DataFrame, level_keys: dict[str, list[str]]) -> DataFrame:
    """MCD estimates per stratum. ``level_keys``: the columns of the outer
    ("lang") and the inner level ("stratum"); the outer draws the inner ones.
    Every start takes ``FIRST_STEPS`` steps, the one of smallest determinant
    (ties: by name) goes on to ``STEPS`` in all."""
    key = lambda cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    levels = F.explode(F.array(*[F.struct(F.lit(name).alias("level"), key(cols).alias("key"))
                                 for name, cols in level_keys.items()])).alias("at")
    xs = [f"x{i}" for i in range(DIMS)]
    rows = stats.select(levels, key(level_keys["lang"]).alias("outer_key"), *xs).select("at.*", "outer_key", *xs)
    # Equal vectors of a stratum weigh as one row with a count: less to scan in every step.
    rows = written(rows.groupBy("level", "key", "outer_key", *xs).agg(F.count(F.lit(1)).alias("weight")), "vectors")
    now = first_estimates(rows)
    for _ in range(FIRST_STEPS):
        now = concentrated(rows, now)
    best = now.groupBy("level", "key").agg(F.min(F.struct("log_det", "start", *[c for c in now.columns if c not in ("level", "key", "log_det", "start")])).alias("best"))
    now = best.select("level", "key", "best.*")
    for _ in range(STEPS - FIRST_STEPS - 1):
        now = concentrated(rows, now)
    outer = concentrated(rows, now, level="lang")
    return concentrated(rows, now, prior=outer, level="stratum").drop("level", "outer_key")


def cuts(distances: DataFrame) -> DataFrame:
    """The largest distance a stratum (``k0``, ``key``) keeps, from the rows that
    the base rules keep: the 0.999 quantile of a log-normal law through the lower
    quartile and the median of its distances, within ``LEAST_CUT_SQ`` and
    ``MOST_CUT_SQ``. Only the nearer half decides, so outliers cannot raise it but
    by shifting ranks, and never beyond the ceiling. Distances are binned, so
    that a quantile is found among few values whatever the stratum's rows."""
    bins = (distances.filter(~F.col("base_failed"))
            .groupBy("k0", "key", F.floor(F.log2(F.greatest("distance_sq", F.lit(1 / UNIT))) * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    quartiles = F.expr("percentile(bin, array(0.25D, 0.5D), n)").alias("at")
    of = lambda d, *cols: d.groupBy(*cols).agg(F.sum("n").alias("rows"), quartiles)
    outer = of(bins, "k0").select(F.col("k0").alias("outer_k0"), F.col("at").alias("outer_at"))
    w = F.col("rows") / (F.col("rows") + CUT_PRIOR_ROWS)
    lower, half = (w * F.col("at")[i] + (1 - w) * F.col("outer_at")[i] for i in (0, 1))
    at = half + (half - lower) * (NORMAL_999 / NORMAL_75)
    return of(bins, "k0", "key").join(outer, F.col("k0").eqNullSafe(F.col("outer_k0"))).select(
        "key", F.least(F.greatest(F.pow(F.lit(2.0), at / BINS), F.lit(LEAST_CUT_SQ)), F.lit(MOST_CUT_SQ)).alias("cut"))


def judged(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           strata: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``id_col``, the counts, ``base_failed``, ``distance_sq`` and ``kept`` of every row."""
    stats = written(document_stats(df, id_col, text_col, list(strata)), "stats")
    estimates = robust_estimates(stats, {"lang": ["k0"], "stratum": ["k0", "k1"]})
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    key = F.to_json(F.struct("k0", "k1"), {"ignoreNullFields": "false"})
    joined = stats.withColumn("key", key).join(estimates.drop("n"), "key")
    columns = ["id", "k0", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    distances = written(joined.select(*columns, base.alias("base_failed"), _distance_sq().alias("distance_sq")), "distances")
    return distances.join(cuts(distances), "key", "left").select(
        F.col("id").alias(id_col), *columns[3:], "base_failed",
        (~F.col("base_failed") & (F.col("distance_sq") <= F.col("cut"))).alias("kept"), "distance_sq")


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              strata: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """The rows of ``df`` that the rules keep, with all their columns. Rows are
    told apart by id, text (its MD5) and strata; equal ones have equal verdicts."""
    rows = packed(df)
    marked = df.select(F.struct(F.col(id_col).alias("i"), F.md5(text_of(text_col).cast("binary")).alias("digest"),
                                *[F.col(c).cast("string").alias(f"k{n}") for n, c in enumerate(strata)]).alias("mark"),
                       text_of(text_col).alias("text"), *[F.col(c).alias(f"s{n}") for n, c in enumerate(strata)])
    rejected = judged(marked, "mark", "text", ("s0", "s1")).filter(~F.col("kept")).select("mark.*").distinct()
    same = (F.col(f"row.{id_col}").eqNullSafe(F.col("i"))
            & (F.md5(text_of(f"row.{text_col}").cast("binary")) == F.col("digest")))
    for n, c in enumerate(strata):
        same = same & F.col(f"row.{c}").cast("string").eqNullSafe(F.col(f"k{n}"))
    return rows.join(rejected, same, "left_anti").select("row.*")
