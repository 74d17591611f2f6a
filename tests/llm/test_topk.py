"""Operator 3 against brute force with Python integers."""

import math
import random

import pytest

from termscope.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score int, first int"


def brute(rows, k, every):
    """Every row is a candidate but the query's own; rows are told apart by their place."""
    vectors = [(i, v) for i, v, *_ in rows if i is not None and v is not None and not any(x is None or not math.isfinite(x) for x in v)]
    scaled = [(i, [math.floor(x * 1024) if abs(x) < 2 ** 50 else int(x) * 1024 for x in v]) for i, v in vectors]
    out = []
    for place, (q, own) in enumerate(scaled):
        if q % every == 0:
            best = sorted((-max(min(sum(a * b for a, b in zip(own, v)), 2 ** 63 - 1), -2 ** 63), i)
                          for other, (i, v) in enumerate(scaled) if other != place)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("dims,blocks", [(64, (64, 3, 2)), (5, (4096, 512, 8)), (17, (7, 2, 1))])
def test_against_brute_force(spark, dims, blocks):
    rng = random.Random(dims)
    centres = [[rng.gauss(0, .2) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, .05) for x in rng.choice(centres)], 1, 2) for i in range(600)]
    rows += [(600 + i, list(rows[30 * i][1]), 1, 2) for i in range(12)]  # equal vectors: ties by id
    rows += [(700, None, 1, 1), (701, [math.nan] + [0.1] * (dims - 1), 1, 1), (702, [None] * dims, 1, 1), (703, [math.inf] * dims, 1, 1),
             (None, [1.0] * dims, 1, 1), (800, [], 1, 1), (801, [.5], 1, 1), (-20, [.1] * dims, None, None), rows[40], rows[20]]
    df = spark.createDataFrame(rows, SCHEMA)
    block, query_block, ranges = blocks
    got = topk.nearest(df, every=20, block=block, query_block=query_block, range_blocks=ranges)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, 20)


def test_large_numbers(spark):
    rows = [(i, [float(2 ** (i % 120)), -1.5 * i], 1, 1) for i in range(130)]
    got = topk.nearest(spark.createDataFrame(rows, SCHEMA), every=10)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, 10)


def test_few_and_none(spark):
    assert topk.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert topk.nearest(spark.createDataFrame([(0, [1.0], 1, 1)], SCHEMA)).count() == 0
    two = topk.nearest(spark.createDataFrame([(0, [1.0], 1, 1), (7, [-1.0], 1, 1)], SCHEMA)).collect()
    assert [tuple(r) for r in two] == [(0, 1, 7, -1024 * 1024)]


def test_rows_that_share_an_id(spark):
    """Every row counts: other vectors of the query's id, and equal rows."""
    rows = [(0, [1.0, 0.0], 1, 1), (0, [0.0, 1.0], 1, 1), (5, [1.0, 1.0], 1, 1), (5, [2.0, 0.0], 1, 1), (7, [1.0, 0.0], 1, 1), (7, [1.0, 0.0], 1, 1), (0, [1.0, 0.0], 2, 2)]
    got = sorted(tuple(r) for r in topk.nearest(spark.createDataFrame(rows, SCHEMA), k=4).collect())
    assert got == brute(rows, 4, 100) and len(got) == 12
    assert {(v, s) for q, _, v, s in got if q == 0} >= {(5, 2 * 1024 * 1024), (0, 1024 * 1024)}
