"""Operator 12: language identification by multilingual mixture inference.

Model: every learned language gives each of ``BUCKETS`` hashed letter trigrams
(words lower-cased, their edges marked by blanks) a probability, from counts over
all documents to learn from. A text is a mixture of languages: an n-gram comes
from language k with the text's proportion pi(k). Expectation-maximisation finds
the proportions of greatest likelihood; the language set is chosen by penalised
likelihood: the best single language, then the first 2, 3, ... by proportion in
the mixture of all, each set with proportions of its own, each further language
at the price of ``PRICE`` * ln(n-grams). The prediction is the language of the
greatest proportion in the chosen set.

The likelihood is concave, so after any step the best mixture is at most
max_k(sum of p_k / mixture) - n-grams better than the present one. Texts leave
the iteration once that bound is under ``NEAR``, or once no mixture can repay
the price of a second language.

Learning counts n-grams in tasks and adds them up in Spark. The model has
``BUCKETS`` numbers per learned language (512 KB), whatever the corpus, and
goes to the tasks as a broadcast variable; texts are judged without a shuffle.

Cases: a null text and one without letters is ``und`` (score 0), as is every
text if nothing could be learned; documents without a language are judged but
not learned from; a null id counts as held out; texts are read whole; repeated
rows count each; an empty table gives an empty result; other columns are
ignored. Ties go to the language name that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, text_of

BUCKETS = 1 << 16
ADDED = 0.5               # to every n-gram's count
PRICE = 3.0               # of a further language, times ln(n-grams); an n-gram shares its letters with two others
NEAR = 0.01               # log-likelihood left to gain at which iteration ends
STEPS, MOST_STEPS = 4, 200
SLICE_CHARS = 1 << 17     # characters of the texts that a task works on at a time (one text at least)
HELD_LANGUAGES = 64       # count tables that a learning task keeps
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every letter trigram: three characters around a letter, others than letters as blanks."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letter = _letters()[codes]
    codes = np.where(letter, codes, np.uint64(32))
    mid = np.flatnonzero(letter)  # never at an end: there are blanks
    of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    hashed = (codes[mid - 1] << np.uint64(42) ^ codes[mid] << np.uint64(21) ^ codes[mid + 1]) * np.uint64(0x9E3779B97F4A7C15)
    return of[mid - 1], (hashed >> np.uint64(48)).astype(np.int64)


# -- learning ---------------------------------------------------------------
def learned(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages of ``df`` (sorted) and their n-gram probabilities, a row per
    bucket and a column per language. Rows without text or language teach nothing."""
    ship(df.sparkSession)
    rows = df.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for lang, n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])],
                                                 names=["lang", "bucket", "n"])
            counts.clear()

        for batch in batches:
            for langs, texts in _slices(batch):
                of, bucket = ngrams(texts)
                names = sorted(set(langs))
                number = np.array([names.index(x) for x in langs])[of]
                for k, lang in enumerate(names):
                    found = np.bincount(bucket[number == k], minlength=BUCKETS)
                    counts[lang] = counts[lang] + found if lang in counts else found
                if len(counts) > HELD_LANGUAGES:
                    yield from handed()
        yield from handed()

    found = rows.mapInArrow(task, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(found["lang"].unique().to_pylist())
    counts = np.zeros((BUCKETS, len(langs)))
    column = np.array([langs.index(x) for x in found["lang"].dictionary_encode().combine_chunks().dictionary.to_pylist()], np.int64)
    if len(langs):
        codes = found["lang"].dictionary_encode().combine_chunks().indices.to_numpy()
        counts[found["bucket"].to_numpy(), column[codes]] = found["n"].to_numpy()
    return langs, (counts + ADDED) / (counts.sum(axis=0) + ADDED * BUCKETS)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """The rows (first column, text) of a batch, in lists of bounded size."""
    first, texts, held = [], [], 0
    for a, t in zip(batch.column(0), batch.column(1)):
        first.append(a.as_py())
        texts.append(t.as_py())
        held += len(texts[-1]) + 1
        if held >= SLICE_CHARS:
            yield first, texts
            first, texts, held = [], [], 0
    if texts:
        yield first, texts


# -- inference --------------------------------------------------------------
def mixtures(p: np.ndarray, c: np.ndarray, sizes: np.ndarray, enough: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of every text's best mixture. ``p``: the
    probabilities of its n-grams by language (zero: left out for the text), ``c``:
    their counts, ``sizes``: how many each text has. A text stops early once it
    cannot reach ``enough``; what it returns then is no maximum."""
    total = np.add.reduceat(c, np.cumsum(sizes) - sizes)
    allowed = np.add.reduceat(p, np.cumsum(sizes) - sizes) > 0
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    out, value = pi.copy(), np.zeros(len(sizes))
    active = np.arange(len(sizes))
    for step in range(0, MOST_STEPS, STEPS):
        starts = np.cumsum(sizes) - sizes
        for _ in range(STEPS):
            mix = np.einsum("mk,mk->m", p, np.repeat(pi, sizes, axis=0))
            gradient = np.add.reduceat(p * (c / mix)[:, None], starts)
            pi = pi * gradient / total[:, None]
            pi /= pi.sum(axis=1, keepdims=True)
        mix = np.einsum("mk,mk->m", p, np.repeat(pi, sizes, axis=0))
        like = np.add.reduceat(c * np.log(mix), starts)
        gain = np.add.reduceat(p * (c / mix)[:, None], starts).max(axis=1) - total
        out[active], value[active] = pi, like
        done = gain < NEAR
        if enough is not None:
            done |= like + gain < enough
        if done.all():
            break
        if done.any():
            left, rows = ~done, np.repeat(~done, sizes)
            p, c, sizes, pi, total, active = p[rows], c[rows], sizes[left], pi[left], total[left], active[left]
            enough = enough[left] if enough is not None else None
    return out, value


def proportions(texts: list[str], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: proportions by language in the chosen set (zeros: no letters), and
    the posterior of the best single language among single ones."""
    count, k = len(texts), model.shape[1]
    out, posterior = np.zeros((count, k)), np.zeros(count)
    of, bucket = ngrams(texts)
    if not len(of) or not k:
        return out, posterior
    cells, c = np.unique(of * BUCKETS + bucket, return_counts=True)
    of, bucket = cells // BUCKETS, cells % BUCKETS
    docs, sizes = np.unique(of, return_counts=True)
    starts = np.cumsum(sizes) - sizes
    p, c = model[bucket], c.astype(float)
    single = np.add.reduceat(c[:, None] * np.log(p), starts)
    best, at = single.max(axis=1), single.argmax(axis=1)
    posterior[docs] = 1 / np.exp(single - best[:, None]).sum(axis=1)
    chosen = np.zeros((len(docs), k))
    chosen[np.arange(len(docs)), at] = 1
    price = PRICE * np.log(np.add.reduceat(c, starts))
    if k > 1:
        full, reached = mixtures(p, c, sizes, best + price)
        value = best.copy()
        order = np.argsort(-full, axis=1, kind="stable")
        for m in range(2, k + 1):
            todo = np.flatnonzero(reached + NEAR - (m - 1) * price > value)  # others cannot gain by m languages
            if not len(todo):
                break
            rows = np.isin(np.repeat(np.arange(len(docs)), sizes), todo)
            own = np.zeros((len(docs), k), bool)
            np.put_along_axis(own, order[:, :m], True, axis=1)
            pi, like = mixtures(p[rows] * np.repeat(own[todo], sizes[todo], axis=0), c[rows], sizes[todo])
            better = like - (m - 1) * price[todo] > value[todo]
            value[todo[better]] = (like - (m - 1) * price[todo])[better]
            chosen[todo[better]] = pi[better]
    out[docs] = chosen
    return out, posterior


LANGS = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))


def identified(df: DataFrame, langs: list[str], model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id``, ``lang_pred``, ``score`` (the predicted language's proportion;
    its posterior among single languages where it is the only one) and ``langs``
    (the chosen set with proportions, greatest first)."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((langs, model))
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = T.StructType([rows.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("langs", LANGS)])
    pair = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, p = shared.value
        for batch in batches:
            at = 0
            for _, texts in _slices(batch):
                shares, posterior = proportions(texts, p)
                pred, score, sets = [], [], []
                for x, y in zip(shares, posterior.tolist()):
                    order = np.argsort(-x, kind="stable")[:int((x > 0).sum())].tolist()
                    pred.append(names[order[0]] if order else UNKNOWN)
                    score.append(0.0 if not order else y if len(order) == 1 else float(x[order[0]]))
                    sets.append([{"lang": names[k], "share": float(x[k])} for k in order])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(pred, pa.string()),
                                                  pa.array(score, pa.float64()), pa.array(sets, pair)], names=schema.names)
                at += len(texts)

    return rows.mapInArrow(task, schema)


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The contract's columns; a fifth of the documents, by their id's CRC-32, is held out from learning."""
    held_out = F.crc32(text_of(F.col(id_col).cast("string")).cast("binary")) % 5 == 0
    langs, model = learned(df.filter(~held_out), text_col, lang_col)
    marked = df.select(F.struct(F.col(id_col).alias("id"), held_out.alias("held_out")).alias("mark"), F.col(text_col).alias("text"))
    return identified(marked, langs, model, "mark", "text").select(
        F.col("id.id").alias(id_col), F.col("id.held_out").alias("held_out"), "lang_pred", "score",
        F.size("langs").alias("n_langs"), "langs")
