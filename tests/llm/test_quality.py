"""Operator 4: counts against plain Python, the MCD against numpy, verdicts on planted junk."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from termscope.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_words int, kept string, key int"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def rows(n=700, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgéü", k=rng.randint(2, 9))) for _ in range(400)]
    out = []
    for i in range(n):
        lang, source = rng.choice(["en", "fr"]), rng.choices(["a", "b", "c", None], weights=[30, 4, 4, 1])[0]
        ws = rng.choices(words, k=int(rng.lognormvariate(4.5, .8)) + 12)
        kind = "junk" if rng.random() < .12 else "good"
        if kind == "junk":
            make = rng.choice([lambda w: w + "***", lambda w: w.upper() + "!!", lambda w: "| " + w + " |"])
            ws = [make(w) for w in ws]
        text = " ".join(w + ("\n" if rng.random() < .05 else "") for w in ws)
        out.append((i, text, lang, source, 1, kind, 2))
    return out


def test_counts():
    rng = random.Random(3)
    bits = ["a", "b", "a b a b a", " ", "\n", "\n\n", "\t", "#*", "é", "\x85", "\xa0", "x|y", "😀", "\x1c", "\x0b"]
    for _ in range(2000):
        text = "".join(rng.choices(bits, k=rng.choice([0, 1, 5, 30, 80])))
        assert quality.text_stats(text)[:5] == plain_counts(text), repr(text)


def test_verdicts_and_whole_rows(spark):
    data = rows()
    data += [(9000, None, None, None, 1, "base", 2), (9001, "", "en", "a", 1, "base", 2), (9002, "x y " * 40_000, "en", "a", 1, "base", 2),
             (None, data[0][1], "en", "a", 1, "any", 2), data[3], data[3]]
    df = spark.createDataFrame(data, SCHEMA)
    got = quality.judged(df).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in data)
    by_id = {r[0]: r for r in data}
    for r in got:
        n, chars, symbols, dup, repeat = plain_counts(by_id[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        kind = by_id[r.doc_id][5]
        if kind in ("good", "junk"):
            assert r.kept == (kind == "good"), (by_id[r.doc_id][1][:80], r.distance_sq)
        if r.base_failed:
            assert not r.kept
    kept = quality.keep_good(df)
    assert kept.schema.names == df.schema.names
    verdict = {(r.doc_id, r.kept) for r in got}
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in df.collect() if (r.doc_id, True) in verdict)


def numpy_mcd(x, floor, share=quality.SHARE):
    """Three starts, concentration steps and the smallest determinant, reckoned anew; equal bins go in together."""
    factor = quality.consistency(share, quality.DIMS)

    def step(centre, inverse):
        d = np.einsum("ni,ij,nj->n", x - centre, inverse, x - centre)
        bins = np.floor(np.log2(1 + d) * quality.BINS)
        near = x[bins <= np.sort(bins)[int(np.ceil(len(x) * share)) - 1]]
        scatter = np.cov(near.T, bias=True) * factor + floor
        return near.mean(axis=0), np.linalg.inv(scatter), np.linalg.slogdet(scatter)[1], len(near)

    middle, ridge = np.median(x, axis=0), np.sqrt(np.diag(floor))
    z = (x - middle) / ridge
    size = (z ** 2).sum(axis=1)
    u = z[size > 0] / np.sqrt(size[size > 0])[:, None]
    mid = 2 ** (np.median(np.floor(np.log2(1 + size) * 64)) / quality.BINS) - 1
    signs = u.T @ u / len(x) * mid * np.outer(ridge, ridge)
    starts = {"ridge": (middle, np.linalg.inv(floor)), "signs": (middle, np.linalg.inv(signs + floor)),
              "all": (x.mean(axis=0), np.linalg.inv(np.cov(x.T, bias=True) + floor))}
    done = {}
    for name, at in starts.items():
        for _ in range(quality.FIRST_STEPS):
            at = step(*at[:2])
        done[name] = at
    name = min(done, key=lambda k: (done[k][2], k))
    at = done[name]
    for _ in range(quality.STEPS - quality.FIRST_STEPS):
        at = step(*at[:2])
    return name, at, {k: v[2] for k, v in done.items()}


@pytest.mark.parametrize("shift", [3000, 400, 0])
def test_estimates_equal_numpy(spark, shift):
    """The starts, the steps and the choice by determinant, with numpy; a fifth of the rows may lie apart."""
    rng = np.random.default_rng(shift)
    x = rng.normal([100, 200, 20, 0, 30, 1700], [60, 50, 30, 0, 20, 90], (500, 6)).round().astype(int)
    x[:100] += shift
    df = spark.createDataFrame([("en", "s", *map(int, v)) for v in x], "k0 string, k1 string, " + ", ".join(f"x{i} long" for i in range(6)))
    got = quality.robust_estimates(df, {"lang": ["k0"], "stratum": ["k0", "k1"]}).collect()
    assert len(got) == 1 and got[0].key == '{"k0":"en","k1":"s"}'
    name, (centre, inverse, log_det, n), dets = numpy_mcd(x, np.diag((np.array(quality.FLOOR) * quality.UNIT) ** 2))
    assert got[0].n == n and got[0].start == name
    assert np.allclose(got[0].centre, centre, rtol=1e-6)
    assert np.allclose(np.array(got[0].inverse).reshape(6, 6), inverse, rtol=1e-4, atol=1e-9)
    assert got[0].log_det == pytest.approx(log_det, rel=1e-6)
    if shift:  # the outliers take no part
        assert np.abs(np.array(got[0].centre) - x[100:].mean(axis=0)).max() < 30


@pytest.mark.parametrize("share", [.05, .15, .24])
def test_contaminated_stratum(spark, share):
    """Junk of one kind in one small stratum cannot raise that stratum's cut: it all goes, the good rows stay."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgéü", k=rng.randint(2, 9))) for _ in range(400)]
    data = []
    for i in range(400):
        source = "small" if i < 140 else "large"
        junk = source == "small" and i < 140 * share
        ws = rng.choices(words, k=rng.randint(40, 200))
        data.append((i, " ".join(w.upper() + "!!" if junk else w for w in ws), "fr", source, 1, "junk" if junk else "good", 2))
    got = {r.doc_id: r for r in quality.judged(spark.createDataFrame(data, SCHEMA)).collect()}
    kinds = {r[0]: r[5] for r in data}
    assert not [i for i, r in got.items() if kinds[i] == "junk" and r.kept]
    assert sum(r.kept for i, r in got.items() if kinds[i] == "good") >= .99 * sum(k == "good" for k in kinds.values())


def test_any_size_of_stratum(spark):
    """Strata of 1, 2, 29 and 31 rows are judged by one rule, the language's estimate weighing by ``PRIOR_ROWS``."""
    data = rows(400, 4)
    clean = [r[1] for r in data if r[5] == "good"]
    data += [(5000 + 100 * k + i, clean[i], "en", f"tiny{k}", 1, "good", 2) for k in (1, 2, 29, 31) for i in range(k)]
    data += [(9000 + k, clean[0].upper() + " ***" * 30, "en", f"tiny{k}", 1, "junk", 2) for k in (1, 2, 29, 31)]
    got = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(data, SCHEMA)).collect()}
    assert not any(got[9000 + k] for k in (1, 2, 29, 31))
    tiny = [got[5000 + 100 * k + i] for k in (1, 2, 29, 31) for i in range(k)]
    assert sum(tiny) >= len(tiny) - 1


def test_scatter_decides(spark):
    """The same deviation in capitals is usual in a stratum that varies and junk in one that does not."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(3, 8))) for _ in range(400)]

    def text(share):
        return " ".join(w.capitalize() if rng.random() < share else w for w in rng.choices(words, k=150))
    data = [(i, text(.1), "en", "even", 1, "", 2) for i in range(300)] + [(1000 + i, text(rng.uniform(.0, .4)), "en", "varied", 1, "", 2) for i in range(300)]
    data += [(9000, text(.45), "en", "even", 1, "", 2), (9001, text(.45), "en", "varied", 1, "", 2)]
    got = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(data, SCHEMA)).collect()}
    assert (got.pop(9000), got.pop(9001)) == (False, True)
    assert sum(got.values()) >= 0.98 * len(got)


def test_chi_square():
    assert quality.chi_square(22.458, 6) == pytest.approx(.999, abs=1e-5)
    assert quality.consistency(1 - 1e-12, 6) == pytest.approx(1, abs=1e-6)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.judged(empty).count() == 0 and quality.keep_good(empty).count() == 0
