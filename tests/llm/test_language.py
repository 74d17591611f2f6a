"""Operator 12: counts and mixtures against plain Python, accuracy on held-out texts, mixed texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from termscope.llm import language

SCHEMA = "doc_id long, text string, lang string, source string, score int, id string"
PARTS = {"aa": ["ka", "lo", "mi", "tus", "er"], "bb": ["sch", "un", "gen", "ä", "wer"], "cc": ["où", "eau", "ler", "mi", "ç"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choices(PARTS[lang], k=rng.randint(1, 4))) for _ in range(n))


def rows(n, seed, langs=tuple(PARTS)):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(langs)
        text = sentence(rng, lang, rng.choice([2, 5, 20, 100]))
        out.append((i, text.title() if rng.random() < .3 else text, lang, "src", 1, "clash"))
    return out


def plain_ngrams(text):
    padded = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    return Counter(padded[i - 1:i + 2] for i in range(1, len(padded) - 1) if padded[i] != " ")


def bucket_of(gram):
    a, b, c = (ord(x) for x in gram)
    return ((a << 42 ^ b << 21 ^ c) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 48


def test_ngrams():
    rng = random.Random(1)
    texts = ["".join(rng.choices("aBé 7\nß😀İx", k=rng.choice([0, 1, 2, 9, 50]))) for _ in range(200)]
    of, bucket = language.ngrams(texts)
    for k, t in enumerate(texts):
        want = Counter()
        for gram, n in plain_ngrams(t).items():
            want[bucket_of(gram)] += n
        assert Counter(bucket[of == k].tolist()) == want


def test_learned_counts(spark, monkeypatch):
    monkeypatch.setattr(language, "HELD_LANGUAGES", 1)  # tables are handed on early
    data = rows(80, 2) + [(900, None, "zz", "s", 1, ""), (901, "abc", None, "s", 1, ""), (902, "123", "nn", "s", 1, "")]
    langs, model = language.learned(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert langs == sorted(PARTS)
    for k, lang in enumerate(langs):
        counts = np.zeros(language.BUCKETS)
        for _, text, own, *_ in data:
            if own == lang:
                for gram, n in plain_ngrams(text).items():
                    counts[bucket_of(gram)] += n
        assert np.allclose(model[:, k], (counts + .5) / (counts.sum() + .5 * language.BUCKETS))


def test_mixture_is_the_maximum():
    """Against a fine grid over the proportions of two and three languages."""
    rng = np.random.default_rng(3)
    for k in (2, 3):
        sizes = rng.integers(1, 30, 12)
        p, c = rng.dirichlet(np.ones(40), k).T[rng.integers(0, 40, sizes.sum())], rng.integers(1, 9, sizes.sum()).astype(float)
        pi, like = language.mixtures(p, c, sizes)
        grid = [np.array([a, b, 1 - a - b][:k]) if k == 3 else np.array([a, 1 - a])
                for a in np.linspace(0, 1, 41) for b in (np.linspace(0, 1 - a, 41) if k == 3 else [0])]
        for d, end in enumerate(np.cumsum(sizes)):
            own, n = p[end - sizes[d]:end], c[end - sizes[d]:end]
            with np.errstate(divide="ignore"):
                best = max(float((n * np.log(own @ g)).sum()) for g in grid)
            assert like[d] >= best - language.NEAR
            assert math.isclose(like[d], float((n * np.log(own @ pi[d])).sum()), rel_tol=1e-9) and math.isclose(pi[d].sum(), 1)


def test_neighbours_do_not_matter():
    rng = random.Random(4)
    texts = [sentence(rng, rng.choice(list(PARTS)), rng.choice([1, 4, 40])) + " " + sentence(rng, "bb", rng.choice([0, 0, 20])) for _ in range(40)]
    model = np.random.default_rng(0).dirichlet(np.ones(language.BUCKETS) * .05, 3).T + 1e-9
    shares, posterior = language.proportions(texts, model)
    for k, t in enumerate(texts):
        one, single = language.proportions([t], model)
        assert np.allclose(one[0], shares[k], atol=1e-9) and math.isclose(single[0], posterior[k], rel_tol=1e-9)


def test_early_stops_change_nothing(monkeypatch):
    """Texts that leave the iteration early would have kept one language at its end, too."""
    rng = random.Random(5)
    texts = [" ".join(sentence(rng, lang, rng.choice([0, 0, 3, 10])) for lang in PARTS) for _ in range(150)]
    rows_by = {lang: sum((plain_ngrams(sentence(rng, lang, 400)) for _ in range(5)), Counter()) for lang in PARTS}
    model = np.full((language.BUCKETS, 3), 1e-7)
    for k, lang in enumerate(PARTS):
        for gram, n in rows_by[lang].items():
            model[bucket_of(gram), k] += n / 20_000
    got, _ = language.proportions(texts, model)
    full = language.mixtures
    monkeypatch.setattr(language, "mixtures", lambda p, c, sizes, enough=None: full(p, c, sizes))
    want, _ = language.proportions(texts, model)
    assert np.allclose(got, want, atol=2e-3) and len({tuple(x) for x in got > 0}) > 3


def test_held_out_accuracy_and_cases(spark):
    data = rows(600, 6)
    rng = random.Random(7)
    mixed = [(2000 + i, sentence(rng, "aa", 60) + "\n" + sentence(rng, "bb", 30), None, None, 1, "") for i in range(20)]
    cases = [(3000, None, "aa", "s", 1, ""), (3001, "", "aa", "s", 1, ""), (3002, "12 !? 34", "aa", "s", 1, ""),
             (3003, sentence(rng, "cc", 40_000), None, "s", 1, ""), (None, sentence(rng, "bb", 30), "aa", "s", 1, ""), data[0], data[0]]
    df = spark.createDataFrame(data + mixed + cases, SCHEMA).repartition(4)
    result = language.report(df)
    assert result.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    got = result.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in data + mixed + cases)
    by_id = {r.doc_id: r for r in got}
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [(by_id[i].lang_pred, lang) for i, _, lang, *_ in data if by_id[i].held_out]
    assert len(held) > 80 and sum(a == b for a, b in held) >= .98 * len(held)
    for i, *_ in mixed:
        shares = {x.lang: x.share for x in by_id[i].langs}
        assert list(shares) == ["aa", "bb"] and abs(shares["aa"] - 2 / 3) < .12 and by_id[i].score == shares["aa"]
    for i in (3000, 3001, 3002):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].langs) == ("und", 0.0, [])
    assert by_id[3003].lang_pred == "cc" and by_id[None].lang_pred == "bb"


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "some text", None, "s", 1, ""), (2, None, "aa", "s", 1, "")], SCHEMA)
    assert {(r.lang_pred, r.score) for r in language.report(df).collect()} == {("und", 0.0)}
    assert language.report(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("langs", [("aa",), ("aa", "")])
def test_one_language_and_an_empty_name(spark, langs):
    rng = random.Random(8)
    data = [(i, sentence(rng, "aa" if i % 2 or len(langs) == 1 else "bb", 20), "aa" if i % 2 or len(langs) == 1 else "", "s", 1, "") for i in range(60)]
    got = {r.doc_id: r.lang_pred for r in language.report(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {i: lang for i, _, lang, *_ in data}
