"""Operator 13 against brute force, with blocks small enough that a cube has many cells."""

import random
import re
from collections import Counter, defaultdict

import pytest

from termscope.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, p int"


def brute(rows, least=30, top=50):
    docs = defaultdict(Counter)
    n = defaultdict(Counter)
    groups = defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        docs[lang].update(set(terms))
        n[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, k in docs[lang].items() if k >= least]
        total = Counter()
        for s in sources:
            total.update(n[lang, s])

        def shares(c):
            size = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (size + 5 * len(kept)) for t in kept}
        p, q = {s: shares(n[lang, s]) for s in sources}, shares(total)
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def rows(n, seed, langs=("en", "fr", None, ""), sources=9, words=60):
    rng = random.Random(seed)
    pool = [rng.choice(["w", "W", "é", "Ab", "😀", "ß", "x́"]) + "".join(rng.choices("abC", k=rng.randint(0, 4))) for _ in range(words)]
    out = []
    for i in range(n):
        own = rng.randrange(sources)
        near = pool[own * 3:own * 3 + 20]
        text = "".join(rng.choice([*near, *pool[:5]]) + rng.choice([" ", "-", "7", "\n", "\x00", "_", "@", "{", "\x7f"]) for _ in range(rng.choice([0, 1, 8, 60])))
        out.append((i, text, rng.choice(langs), rng.choice([f"s{own}", f"s{own}", None]) if own else "", "clash", 1))
    return out


@pytest.mark.parametrize("group_block,term_block,least", [(64, 2048, 30), (2, 5, 3), (1, 1, 8), (3, 1000, 2)])
def test_against_brute_force(spark, group_block, term_block, least):
    data = rows(260, group_block)
    data += [(900, None, "xx", "only", "c", 1), (901, "7 8 9", "yy", "a", "c", 1), (902, "rare words", "yy", "b", "c", 1),
             (903, None, "yy", None, "c", 1), data[0], data[0], (None, "wa wb " * 5000, "en", "s1", "c", 1)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = divergence.report(df, group_block=group_block, term_block=term_block, least_docs=least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(data, least)
    assert any(r[2] == "term" for r in brute(data, least)) and ("yy", "a", "pair", "", 0, 1) in brute(data, least)


def test_more_telling_terms_than_ranks(spark):
    rng = random.Random(4)
    data = [(i, " ".join(f"{'ab'[i % 2]}{rng.choice('xyz')}{'q' * rng.randint(0, 40)}" for _ in range(60)), "en", f"s{i % 2}", "", 1) for i in range(80)]
    got = divergence.report(spark.createDataFrame(data, SCHEMA), least_docs=2)
    want = brute(data, 2)
    assert sorted(map(tuple, got.collect())) == want and sum(r[2] == "term" for r in want) == 100


def test_counts_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 7)
    data = rows(60, 11)
    assert sorted(map(tuple, divergence.report(spark.createDataFrame(data, SCHEMA), least_docs=2).collect())) == brute(data, 2)


def test_shares_beyond_64_bits(spark):
    df = spark.createDataFrame([(400_000_000_000, 900_000_000_000, 1_000_000)], "n long, total long, v long")
    assert df.select(divergence.share("n", "total", "v")).first()[0] == 1 + 10 ** 9 * 400_000_000_005 // 900_005_000_000


def test_empty_table(spark):
    assert divergence.report(spark.createDataFrame([], SCHEMA)).count() == 0
