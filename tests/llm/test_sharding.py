"""Operator 6: groups stay together, loads are those of the plain heap schedule, slots have no gaps."""

import heapq
import random
import zlib

import pytest

from termscope.llm import sharding

SCHEMA = "doc_id long, text string, shard string, size int"


def plain_heap(sizes, shards):
    loads = [0] * shards
    heapq.heapify(loads)
    for s in sorted(sizes, reverse=True):
        heapq.heapreplace(loads, loads[0] + s)
    return sorted(loads)


@pytest.mark.parametrize("n,shards", [(3000, 40), (500, 7), (30, 40)])
def test_shards(spark, n, shards):
    rng = random.Random(n)
    texts = [None if rng.random() < .02 else "é" * int(rng.lognormvariate(4, 1.5)) + str(rng.randrange(n)) for _ in range(n)]
    texts += [texts[5]] * (n // 10)
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    got = sharding.shard_report(spark.createDataFrame(rows, SCHEMA), shards=shards).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    group, load, slots, where = {}, [0] * shards, {}, {}
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        assert 0 <= r.shard < shards and where.setdefault(data, r.shard) == r.shard
        group[data] = group.get(data, 0) + r["size"]
        load[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    best = plain_heap(group.values(), shards)
    assert max(load) <= best[-1] * 1.01 + 1


def test_bulk_dealing_equals_the_heap():
    rng = random.Random(1)
    classes = [(s, rng.choice([1, 3, 50, 4000, 100_000])) for s in range(17, 400, 5)]
    plan = sharding.schedule([(s, n, s * n) for s, n in classes], 40)
    load = [0] * 40
    for cls, shard, _, n in plan:
        load[shard] += cls * n
    assert sorted(load) == plain_heap([s for s, n in classes for _ in range(n)], 40)
    for cls, n in classes:
        places = sorted((f, c) for k, _, f, c in plan if k == cls)
        assert places[0][0] == 0 and sum(c for _, c in places) == n
        assert all(a + c == b for (a, c), (b, _) in zip(places, places[1:]))


@pytest.mark.parametrize("seed", range(30))
def test_schedule_has_the_heap_s_loads(seed):
    rng = random.Random(seed)
    shards = rng.choice([1, 2, 7, 40])
    classes = {rng.randrange(16, 4096): rng.choice([1, 2, shards, shards + 1, 5 * shards, 999]) for _ in range(60)}
    load = [0] * shards
    for cls, shard, _, n in sharding.schedule([(s, n, s * n) for s, n in classes.items()], shards):
        load[shard] += cls * n
    assert sorted(load) == plain_heap([s for s, n in classes.items() for _ in range(n)], shards)


@pytest.mark.parametrize("sigma", [0.5, 1.5, 2.5])
def test_sizes_beyond_the_exact_classes(sigma):
    """Sizes of some hundred KB, told apart by 12 leading bits, places within a class at random."""
    rng = random.Random(9)
    sizes = [16 + int(100 * rng.lognormvariate(8, sigma)) for _ in range(20_000)]
    classes = {}
    for s in sizes:
        low = max(s.bit_length() - sharding.PRECISION, 0)
        classes.setdefault(s >> low << low, []).append(s)
    load = [0] * 40
    for cls, shard, first, n in sharding.schedule([(c, len(m), sum(m)) for c, m in classes.items()], 40):
        load[shard] += sum(classes[cls][first:first + n])
    best = plain_heap(sizes, 40)
    assert max(load) <= best[-1] * 1.001


def test_hot_groups_meet_their_shard_by_broadcast(spark, monkeypatch):
    texts = ["hot"] * 400 + ["warm"] * 60 + [f"own {i}" for i in range(340)]
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)
    seen = []
    for part in (1, 10, 1000):  # no hot group, two, all
        monkeypatch.setattr(sharding, "HOT_PART", part)
        seen.append(sorted(map(tuple, sharding.sharded(df, shards=7).collect())))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 800
    assert len({r[3] for r in seen[0] if r[0] < 400}) == 1 and len({r[3] for r in seen[0] if 400 <= r[0] < 460}) == 1


def test_empty_and_repeated_rows(spark):
    assert sharding.shard_report(spark.createDataFrame([], SCHEMA)).count() == 0
    long = sharding.shard_report(spark.createDataFrame([(1, "é" * 3_000_000, "s", 1), (2, "x", "s", 1)], SCHEMA)).collect()
    assert sorted(r["size"] for r in long) == [17, 6_000_016] and len({r.shard for r in long}) == 2
    same = sharding.shard_report(spark.createDataFrame([(7, "x", "s", 1)] * 5 + [(None, None, None, None)], SCHEMA)).collect()
    assert len(same) == 6 and len({r.shard for r in same if r.doc_id == 7}) == 1
    assert sorted(r.slot for r in same if r.doc_id == 7) in ([0, 1, 2, 3, 4], [1, 2, 3, 4, 5])
