"""Operator 8 against a brute-force reckoning."""

import random
import re

import pytest
from pyspark.sql import functions as F

from termscope.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, row int"


def brute_targets(rows):
    size = {}
    for _, text, source, *_ in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted(size, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(size.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(2 * size[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 2 * size[s] * (1 + 1e-12)}
        if not over:
            return size, {**target, **{s: 2.0 * size[s] for s in capped}}
        capped |= over


def make(n, seed, sources):
    rng = random.Random(seed)
    return [(i, None if rng.random() < .03 else " ".join(["w"] * int(rng.lognormvariate(3, 1))) + rng.choice(["", "\n", " x"]),
             rng.choices(sources, weights=[30] + [1] * (len(sources) - 1))[0], "clash", 1) for i in range(n)]


@pytest.mark.parametrize("sources", [["a"], ["a", "b", "é", "z", None, "", "B"], [f"s{i}" for i in range(11)]])
def test_targets_and_taken_words(spark, sources):
    rows = make(1500, 3, sources)
    size, target = brute_targets(rows)
    got = mixing.mix_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    taken = dict.fromkeys(size, 0)
    for r in got:
        _, text, source, *_ = rows[r.doc_id]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) and r.source_size == size[source]
        assert r.target == pytest.approx(target[source], rel=1e-9)
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        taken[source] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 60, (s, taken[s], target[s])
    again = mixing.mix_report(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).collect()
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in again}


def test_many_sources_share_in_rounds(spark):
    """Sizes from one word to millions: many caps, met one round after another."""
    sizes = [(None if i == 7 else f"{'é' if i % 2 else 'h'}{i:03d}", 1 if i > 200 else 3 ** (i % 15)) for i in range(300)]
    _, target = brute_targets([(i, " ".join(["w"] * min(n, 9)), s) for i, (s, n) in enumerate(sizes)])
    df = spark.createDataFrame([(s, min(n, 9)) for s, n in sizes], "src string, size long")
    got = {r.src: r.target for r in mixing.source_targets(df).collect()}
    assert set(got) == set(target) and all(got[s] == pytest.approx(target[s], rel=1e-9) for s in got)

    wide = dict(sizes)
    names = sorted(wide, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    per = spark.createDataFrame([(s, wide[s], weight[s]) for s in names], "src string, source_size long, weight int")
    level = mixing.shared_level(per)
    shared = sum(min(2 * wide[s], weight[s] * level) for s in names)
    assert shared == pytest.approx(1.5 * sum(wide.values()), rel=1e-9)


def test_mix_keeps_columns_and_copies(spark):
    rows = make(400, 5, ["a", "b", None])
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(df)
    assert out.schema.names == df.schema.names
    want = {r.doc_id: r.copies for r in mixing.mix_report(df).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want
    assert all(tuple(r) == rows[r.doc_id] for r in out.collect())


def test_sub_buckets_number_rows_without_gaps(spark):
    from termscope.llm.common import ranked
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"), F.lit(0).alias("c"))
    out = ranked(df, ["g"], "c", ["id"], "n", rows_per_bucket=100).collect()
    for g in range(3):
        n = sorted(r.n for r in out if r.g == g)
        assert n == list(range(len(n)))


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0
    same = spark.createDataFrame([(1, "a b", "s", "x", 1)] * 4, SCHEMA)
    assert sum(r.taken for r in mixing.mix_report(same).collect()) in (10, 12, 14)
    long = spark.createDataFrame([(1, "w " * 500_000, "s", "x", 1)] + [(i, "a b", "t", "x", 1) for i in range(2, 50)], SCHEMA)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in mixing.mix_report(long).collect())
    blank = spark.createDataFrame([(1, None, "s", "x", 1), (None, "", None, None, None)], SCHEMA)
    assert [r.taken for r in mixing.mix_report(blank).collect()] == [0, 0]
