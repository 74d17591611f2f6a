"""Operator 7 against brute force over every 50-byte string."""

import random

import numpy as np
import pytest

from termscope.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, id string, data int, b int"


def brute(rows):
    least = {}
    for i, t, *_ in rows:
        data = (t or "").encode()
        for p in range(len(data) - 49) if i is not None else ():
            s = data[p:p + 50]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, t, *_ in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 49) if i is not None else ():
            if least[data[p:p + 50]] < i:
                gone[p:p + 50] = b"\x01" * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(data), sum(gone), spans, kept))
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [rng.choice(["the", "of", "é", "ß", "\n"]) if rng.random() < .3 else "".join(rng.choices("abcdeü", k=rng.randint(1, 9))) for _ in range(80)]
    prose = lambda k: " ".join(rng.choices(words, k=k))
    passages = [prose(30) for _ in range(6)]
    line = "a line of just about sixty bytes that very many texts hold.."
    texts = []
    for _ in range(n):
        r = rng.random()
        t = prose(rng.choice([0, 3, 20, 80]))
        if r < .3:
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            t = t[: len(t) // 2] + p[a: a + rng.choice([40, 50, 51, 70, 200])] + t[len(t) // 2:]
        elif r < .5 and texts:
            t = list(rng.choice(texts) or "")
            for _ in range(rng.randrange(3)):
                if t:
                    t[rng.randrange(len(t))] = rng.choice("xyz")
            t = "".join(t)
        elif r < .7:
            t = prose(5) + line + prose(5)
        texts.append(t)
    texts += ["a" * 400, "a" * 120 + "b" + "a" * 130, "ab" * 100, None, "", "\0" * 120, "x" + "\0" * 80, prose(6000)]
    rows = [(i, t, "clash", 1, 2) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [(None, texts[0], None, None, None), (3, texts[1], "x", 1, 1), (3, passages[0], "x", 1, 1), rows[5], rows[5]]
    return rows


@pytest.mark.parametrize("hot,size", [(10_000, 20_000), (2, 20_000), (30, 1 << 24)])
def test_against_brute_force(spark, hot, size):
    rows = corpus(hot, 160)
    got = sd.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4), hot=hot, bytes_per_task=size).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str)
    assert got == brute(rows)
    assert sum(r[2] > 0 for r in got) > 60


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(2)
    for k in (1, 2, 3, 5, 8, 13):
        runs = [sorted(bytes(rng.choices(b"ab", k=rng.randint(1, 9))) for _ in range(rng.randrange(40))) for _ in range(k)]
        coded = []
        for run in runs:
            coded.append(iter([(sd._common(p, x, 0), x) for p, x in zip([b"", *run], run)]))
        out = list(sd.merged(coded))
        assert [x for _, x in out] == sorted(x for run in runs for x in run)
        assert all(n == sd._common(a[1], b, 0) for a, (n, b) in zip(out, out[1:]))


def test_buckets_agree_with_spark(spark):
    rng = random.Random(1)
    ids = [rng.getrandbits(64) - (1 << 63) for _ in range(300)] + list(range(50)) + [-1, -(1 << 63), (1 << 63) - 1]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    from pyspark.sql import functions as F
    got = {r.id: r.b for r in df.select("id", sd.bucket_column(F.col("id"), 37).alias("b")).collect()}
    assert [got[i] for i in ids] == sd.bucket_of(np.array(ids, np.int64), 37).tolist()


def test_empty_table(spark):
    assert sd.report(spark.createDataFrame([], SCHEMA)).count() == 0
