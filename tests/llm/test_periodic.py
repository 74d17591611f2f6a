"""Operator 11 against brute force: every period of every stretch, compared word by word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from termscope.llm import catalog, periodic

SCHEMA = "doc_id long, text string, n_runs int, start string, words int"


def smallest_period(x):
    """By the failure function."""
    fail, k = [0] * len(x), 0
    for i in range(1, len(x)):
        while k and x[i] != x[k]:
            k = fail[k - 1]
        k += x[i] == x[k]
        fail[i] = k
    return len(x) - fail[-1]


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j - i + q
                if length >= max(24, 3 * q) and smallest_period(words[i:i + length]) == q:
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_report(i, text, planted=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(i).encode())
    g = h // 10
    if planted and i is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    return (i, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest())


def words_with_runs(rng, n):
    """Words over few or many letters, with planted repeats, some broken or abutting."""
    many = rng.choice([1, 2, 3, 50, 1000])
    out = []
    while len(out) < n:
        if rng.random() < .5:
            out += [f"w{rng.randrange(many)}" for _ in range(rng.randint(1, 40))]
        else:
            unit = [f"w{rng.randrange(many)}" for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 40]))]
            out += (unit * 12)[:rng.randint(2 * len(unit), 12 * len(unit))]
            if rng.random() < .3:
                out[-rng.randint(1, len(unit))] = "broken"
    return out[:n]


@pytest.mark.parametrize("size", [16, 32, 64, 128, 1024])
def test_transform_is_exact(size):
    rng = np.random.default_rng(size)
    x, y = (rng.integers(0, periodic.PRIME, (3, size)) for _ in range(2))
    x[0] = y[0] = periodic.PRIME - 1  # the largest products
    back = periodic._inverse(periodic._transform(x.astype(float)))
    assert (back == x).all()
    got = periodic._inverse(periodic._mod(periodic._transform(x.astype(float)) * periodic._transform(y.astype(float))))
    for a, b, c in zip(x.tolist(), y.tolist(), got.tolist()):
        want = [sum(a[i] * b[(k - i) % size] for i in range(size)) % periodic.PRIME for k in range(0, size, 7)]
        assert c[::7] == want


@pytest.mark.parametrize("part", [periodic.PART, 16])
def test_runs_equal_brute_force(part):
    rng = random.Random(part)
    texts = [words_with_runs(rng, rng.choice([0, 1, 23, 24, 25, 60, 200, 500])) for _ in range(300)]
    texts += [["x"] * k for k in (23, 24, 25, 400)] + [["x", "y"] * 12, ["x", "y"] * 11 + ["x"], list("abcdefgh") * 3]
    got = periodic.runs_of([[w.encode() for w in t] for t in texts], part)
    assert got == [brute_runs(t) for t in texts]
    assert sum(map(len, got)) > 150


@pytest.mark.parametrize("period", list(range(1, 40)) + [63, 64, 65, 100])
def test_every_period_and_alignment(period):
    """Just long enough runs at every offset to the blocks are found, one word shorter ones are not."""
    length = max(24, 3 * period)
    unit = [f"u{k}" for k in range(period)]
    texts = []
    for off in range(0, 70, 3):
        texts.append([f"p{k}" for k in range(off)] + (unit * 24)[:length] + ["q"])
        texts.append([f"p{k}" for k in range(off)] + (unit * 24)[:length - 1] + ["q"])
    got = periodic.runs_of([[w.encode() for w in t] for t in texts])
    assert got == [x for off in range(0, 70, 3) for x in ([(off, length, period)], [])]


def test_equal_by_the_modulus_only():
    """Words whose numbers differ by the modulus are zero to the transform and told apart by the extension."""
    filler = [b"%d" % k for k in range(periodic.PRIME)]
    twice = [b"a%d" % k for k in range(8)]
    texts = [twice, filler[:-8], [b"b%d" % k for k in range(8)], (twice + [b"b%d" % k for k in range(8)]) * 2, twice * 3]
    assert periodic.runs_of(texts) == [[], [], [], [], [(0, 24, 8)]]


def test_long_text():
    words = [b"w%d" % (k % 9000) for k in range(27_500)] + [b"x"] * 30_000 + [b"end"]
    assert periodic.runs_of([words, words[:100]]) == [[(0, 27_500, 9000), (27_500, 30_000, 1)], []]


def test_whole_query(spark, tmp_path):
    rng = random.Random(9)
    texts = [rng.choice([" ", "\n", "\t"]).join(words_with_runs(rng, rng.choice([0, 1, 5, 40, 300]))) for _ in range(200)]
    texts += [None, "", " \n", "é\x85 " * 30, " ".join(f"w{k}" for k in range(3000)), texts[0]]
    rows = [(i, t, 1, "clash", 2) for i, t in enumerate(texts)] + [(None, "a b " * 20, 1, None, 2), (7, texts[7], 0, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.schema.simpleString().startswith(
        "struct<doc_id:bigint,n_runs:bigint,start:bigint,length:bigint,period:bigint,exponent_milli:bigint,runs_sha256:string,collapsed_sha256:string")
    want = sorted((brute_report(i, t) for i, t, *_ in rows), key=str)
    assert sorted((tuple(r)[:8] for r in got.collect()), key=str) == want
    assert sum(r[1] > 0 for r in want) > 30
    plain = periodic.report(df).collect()
    assert sorted((tuple(r)[:8] for r in plain), key=str) == sorted((brute_report(i, t, False) for i, t, *_ in rows), key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic.report(periodic.with_repeats(empty)).count() == 0
