"""Operator 9 against brute force: fingerprints, links of all pairs, components."""

import random
import re

import numpy as np
import pytest
import xxhash

from termscope.llm import simhash

SCHEMA = "doc_id long, text string, fp string, node int"


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius=3):
    ids, fps = list(ids), np.array(fps, np.uint64)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[k]) <= radius).tolist():
            a, b = root(ids[k]), root(ids[j])
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def flip(value, rng, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        value ^= 1 << b
    return value


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.level_masks("", 0)
    rng = random.Random(0)
    assert len(masks) == 15
    for _ in range(3000):
        diff = flip(0, rng, 3)
        k = next(k for k, m in enumerate(masks) if not diff & m)
        assert any(not diff & m for m in simhash.level_masks(str(k), 1))


@pytest.mark.parametrize("bucket", [1024, 24])
def test_links_and_components(spark, bucket):
    rng = random.Random(bucket)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(250):
        fps.append(flip(rng.choice(fps), rng, 5))
    base = rng.getrandbits(64)
    for _ in range(120):  # one dense cluster: buckets beyond the bound
        fps.append(flip(base, rng, 3))
    chain = 0
    for b in range(0, 60, 3):  # a chain far wider than the radius
        chain ^= 7 << b
        fps.append(chain)
    fps = list(dict.fromkeys(fps))
    ids = rng.sample(range(10_000), len(fps))
    df = spark.createDataFrame([(i, simhash.signed(f)) for i, f in zip(ids, fps)], "node long, fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(df, bucket=bucket)).collect()}
    assert {i: got.get(i, i) for i in ids} == brute_components(ids, fps)


def test_whole_query(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["É", "ß", "The", "THE", "\x85x", "a b"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 2, 3, 4, 30, 200]))) for _ in range(120)]
    for _ in range(60):
        t = rng.choice(texts).split(" ")
        t[rng.randrange(len(t))] = rng.choice(words)
        texts.append("\n".join(t))
    texts += [None, "", " \t\r\n", "x " * 30_000, texts[0], texts[0]]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    got = simhash.report(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [brute_fingerprint(t) for t in texts]
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in enumerate(fps)}
    want = brute_components(range(len(texts)), fps)
    assert {r.doc_id: r.component_id for r in got} == want
    kept = simhash.keep_one(spark.createDataFrame(rows + rows[:3] + [(None, "x", "y", 2)], SCHEMA))
    assert kept.schema.names == ["doc_id", "text", "fp", "node"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*set(want.values()), None], key=str)


def test_rows_without_an_id(spark):
    rows = [(None, "a b c d", "x", 1), (5, "a b c d", "x", 1), (None, "quite another text here", "x", 1), (9, "A B C D", None, None)]
    got = sorted(((str(r.doc_id), r.component_id) for r in simhash.report(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == [("5", 5), ("9", 5), ("None", 5), ("None", None)]


def test_ids_shared_by_unrelated_texts(spark):
    rows = [(1, "a b c d", "x", 1), (1, "quite another text here", "x", 2), (1, "quite another text here", "x", 2),
            (2, "a b c d", "x", 3), (3, "QUITE another text here", "x", 4), (4, "none of the former at all", "x", 5), (4, None, "x", 6)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.report(df).collect()}
    assert got == {(i, f"{brute_fingerprint(t):016x}", {1: 1, 2: 1, 3: 1, 4: 4}[i]) for i, t, *_ in rows}
    assert len({f for _, f, _ in got}) == 4
    kept = sorted((r.doc_id, r.text or "") for r in simhash.keep_one(df).collect())
    assert kept == [(1, "a b c d"), (1, "quite another text here"), (4, ""), (4, "none of the former at all")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.report(empty).count() == 0 and simhash.keep_one(empty).count() == 0
