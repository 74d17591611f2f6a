"""Operator 11: periodic run detection by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that is at least ``LEAST`` words and ``REPEATS`` periods long and
that no neighbouring word extends. All of a text's runs are found.

Scales: blocks of ``FIRST`` words look for themselves 1 to 2 * FIRST - 1 words
further on, blocks of 2**k > FIRST words 2**k to 2**(k+1) - 1 words further on.
A run of period q is 3q words or more (24 at least), so of the scale that q
belongs to it holds one whole aligned block together with the block's occurrence
q words later: no run is missed. The sum of squared differences between a block
and each place of its window is (block squares) + (window squares) - 2 *
(correlation); squares come from prefix sums, the correlation from a number
theoretic transform modulo 65537, in which every block of a scale goes through
at once. The transform is exact: its matrix products stay below 2**53. Blocks
beyond 32,768 words are cut into parts whose correlations are added.

A distance of sum zero (modulo 65537) seeds an extension, which compares words
themselves in both directions, so that what is zero by the modulus only falls
out, and gives the maximal stretch of that period. Seeds are taken by rising
distance; those inside a stretch of a divisor of their distance are implied by
it and go. What is left of 3 periods or more therefore has its smallest period.

One text is one row; a task holds a slice of texts, and transforms of bounded
size, whatever the length. No shuffle.

Cases: a null text has no words and no run; a text of any length is read whole;
repeated rows give equal rows; a null id is kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, ship, text_of

LEAST = 24           # words
REPEATS = 3          # periods
FIRST = 8            # words in the smallest blocks: 2 * FIRST - 1 + q <= LEAST for all q up to FIRST + 1
PART = 32_768        # words of a block that one transform takes
PRIME, GENERATOR = 65_537, 3
CELLS = 1 << 18      # numbers in a batch of transforms
SLICE_WORDS = 1 << 17  # words of the texts that a task works on at a time (one text at least)


# -- transform --------------------------------------------------------------
def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME in place, for whole floats from 0 to 2**53."""
    q = x / PRIME
    np.floor(q, out=q)
    q *= PRIME
    x -= q
    return x


@lru_cache(maxsize=None)
def _tables(size: int) -> tuple[int, int, tuple, tuple]:
    """Matrices of the transform of ``size`` (a power of 2) in two factors, and of its inverse."""
    rows = 1 if size <= 64 else 1 << (size.bit_length() - 1) // 2
    cols = size // rows

    def matrices(root: int, scale: int) -> tuple:
        powers, x = np.empty(size), 1
        for e in range(size):
            powers[e] = x
            x = x * root % PRIME
        at = lambda a, b, step: powers[np.outer(np.arange(a), np.arange(b)) * step % size]
        return at(rows, rows, cols) * scale % PRIME, at(rows, cols, 1), at(cols, cols, rows)

    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    return rows, cols, matrices(root, 1), matrices(pow(root, -1, PRIME), pow(size, -1, PRIME))


def _transform(x: np.ndarray) -> np.ndarray:
    """Transform of every row; the order of frequencies is its own, ``_inverse`` takes it."""
    n, size = x.shape
    rows, cols, (outer, twiddle, inner), _ = _tables(size)
    if rows > 1:
        x = np.ascontiguousarray(x.reshape(n, rows, cols).transpose(0, 2, 1)).reshape(-1, rows)
        x = _mod(x @ outer).reshape(n, cols, rows)
        x = _mod(x * twiddle.T)
        x = np.ascontiguousarray(x.transpose(0, 2, 1))
    return _mod(x.reshape(-1, cols) @ inner).reshape(n, size)


def _inverse(x: np.ndarray) -> np.ndarray:
    n, size = x.shape
    rows, cols, _, (outer, twiddle, inner) = _tables(size)
    x = _mod(x.reshape(-1, cols) @ inner)
    if rows == 1:
        return _mod(x * outer[0, 0]).reshape(n, size)
    x = _mod(x.reshape(n, rows, cols) * twiddle)
    x = np.ascontiguousarray(x.transpose(0, 2, 1)).reshape(-1, rows)
    return np.ascontiguousarray(_mod(x @ outer).reshape(n, cols, rows).transpose(0, 2, 1)).reshape(n, size)


def correlations(padded: np.ndarray, blocks: np.ndarray, length: int, first: int, count: int, part: int = PART) -> np.ndarray:
    """Per block (a start in ``padded``) and distance first, ..., first + count - 1:
    the sum of products of the block's words and those so much further on, modulo PRIME."""
    out = np.zeros((len(blocks), count))
    step, wide = min(length, part), min(count, part)
    size = 1 << (wide + step - 2).bit_length()
    for at in range(0, length, step):
        block = np.zeros((len(blocks), size))
        block[:, :step] = padded[blocks[:, None] + (at + step - 1 - np.arange(step))]
        block = _transform(block)
        for d in range(0, count, wide):
            window = np.zeros((len(blocks), size))
            window[:, :wide + step - 1] = padded[blocks[:, None] + (at + first + d + np.arange(wide + step - 1))]
            found = _inverse(_mod(block * _transform(window)))[:, step - 1:step - 1 + wide]
            out[:, d:d + wide] += found[:, :count - d]
    return _mod(out)


# -- seeds and extension ----------------------------------------------------
def seeds(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, part: int = PART) -> list[np.ndarray]:
    """(text, distance, block start, block length) of every block that recurs, by
    the transform. ``words``: the numbered words of all texts, one after another."""
    values = words % PRIME
    squares = np.concatenate([[0], np.cumsum(values * values)])
    found = [np.empty((0, 4), np.int64)]
    length, first, count = FIRST, 1, 2 * FIRST - 1
    longest = int(sizes.max(initial=0))
    while longest >= max(LEAST, REPEATS * first):
        texts = np.flatnonzero(sizes >= max(LEAST, REPEATS * first))
        number = (sizes[texts] - first) // length
        of = np.repeat(texts, number)
        blocks = starts[of] + length * (np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number))
        room = starts[of] + sizes[of] - length - blocks  # the largest distance within the text
        padded = np.concatenate([values, np.zeros(first + count + 2 * length, np.int64)]).astype(float)
        batch = max(1, CELLS // (2 * length))
        for at in range(0, len(blocks), batch):
            b, most = blocks[at:at + batch], room[at:at + batch]
            products = correlations(padded, b, length, first, count, part).astype(np.int64)
            d = np.arange(first, first + count)
            place = np.minimum(b[:, None] + d, len(words) - length)
            total = (squares[b + length] - squares[b])[:, None] + squares[place + length] - squares[place] - 2 * products
            i, j = np.nonzero((total % PRIME == 0) & (d <= most[:, None]))
            if len(i):
                found.append(np.stack([of[at + i], d[j], b[i], np.full(len(i), length)], axis=1))
        length, first, count = 2 * length, 2 * length, 2 * length
    return found


def _equal(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading elements agree."""
    at, size = 0, 64
    while at < len(x):
        differ = np.flatnonzero(x[at:at + size] != y[at:at + size])
        if len(differ):
            return at + int(differ[0])
        at, size = at + size, size * 2
    return len(x)


def extended(words: np.ndarray, distance: np.ndarray, block: np.ndarray, length: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one text from its seeds, by start, then period."""
    order = np.lexsort((block, distance))
    distance, block, length = distance[order], block[order], length[order]
    n, runs = len(words), []
    while len(block):
        d, b = int(distance[0]), int(block[0])
        after = _equal(words[b:n - d], words[b + d:])
        if after < length[0]:  # zero by the modulus only
            distance, block, length = distance[1:], block[1:], length[1:]
            continue
        start = b - _equal(words[:b][::-1], words[d:b + d][::-1])
        end = b + after + d
        if end - start >= max(LEAST, REPEATS * d):
            runs.append((start, end - start, d))
        left = ~((distance % d == 0) & (block >= start) & (block + length + distance <= end))
        distance, block, length = distance[left], block[left], length[left]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list[bytes]], part: int = PART) -> list[list[tuple[int, int, int]]]:
    """Runs of every text (a list of words)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    number: dict[bytes, int] = {}
    words = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = np.concatenate(seeds(words, starts, sizes, part))
    found = found[np.argsort(found[:, 0], kind="stable")]
    for own in np.split(found, np.flatnonzero(np.diff(found[:, 0])) + 1):
        if len(own):
            k = int(own[0, 0])
            text = words[starts[k]:starts[k] + sizes[k]]
            out[k] = extended(text, own[:, 1], own[:, 2] - starts[k], own[:, 3])
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0)])


# -- Spark ------------------------------------------------------------------
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id``, ``n_words``, ``runs`` (by start, then period), ``best``
    (the run of most periods; ties: smallest start, then period) and
    ``collapsed`` (the text without the repeats)."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).cast("binary").alias("text"))
    schema = T.StructType([rows.schema[0], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                           T.StructField("best", RUN), T.StructField("collapsed", T.BinaryType())])
    run = pa.struct([(n, pa.int64()) for n in RUN.names])
    as_dict = lambda r: dict(zip(RUN.names, r))

    def done(ids: list[pa.Array], texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(texts)
        best = [as_dict(_best(r)) if r else None for r in found]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(ids), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([[as_dict(x) for x in r] for r in found], pa.list_(run)), pa.array(best, run),
             pa.array([collapsed(t, r) for t, r in zip(texts, found)], pa.binary())], names=schema.names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for k in range(batch.num_rows):
                words = batch.column(1)[k].as_py().split()  # bytes: ASCII white space only
                ids.append(batch.column(0).slice(k, 1))
                texts.append(words)
                held += len(words)
                if held >= SLICE_WORDS or len(texts) >= 4096:
                    yield done(ids, texts)
                    ids, texts, held = [], [], 0
            if texts:
                yield done(ids, texts)

    return rows.mapInArrow(task, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of greatest exact length / period."""
    best = runs[0]
    for r in runs[1:]:
        mine, other = r[1] * best[2], best[1] * r[2]
        if mine > other or (mine == other and (r[0], r[2]) < (best[0], best[2])):
            best = r
    return best


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: number of runs, the best run, and digests of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return periodic_runs(df, id_col, text_col).select(
        F.col("id").alias(id_col), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def with_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The query's input: in every text whose id's CRC-32 h is divisible by ten,
    the words from a = g % n on repeat the first p = 1 + (n - a) // (3 + g % 8) of
    them, where g = h // 10. Other texts stay as they are; a null id has no h."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    worded = df.select(id_col, text_col, h.alias("h"),
                       F.when((h % 10 == 0) & F.col(text_col).isNotNull(), F.regexp_extract_all(text_col, F.lit(WORD), 0)).alias("words"))
    worded = worded.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    at = worded.withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)")))
    at = at.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.expr("cast((n - a + p - 1) div p as int)"))), F.lit(1), F.col("n") - F.col("a"))
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return at.select(id_col, F.when(F.col("a").isNotNull(), repeated).otherwise(F.col(text_col)).alias(text_col))
