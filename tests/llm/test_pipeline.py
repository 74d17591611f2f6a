"""The corpus pipeline: each stage on its own input against brute force, and run() as their sequence."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline as cp
from tests.llm import test_line_dedup, test_mixing, test_quality, test_simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Good and junk documents, near copies, shared lines, nulls, an empty text and a long one."""
    data = [(i, t, lang, source, len(t)) for i, t, lang, source, *_ in test_quality.rows(300, 8)]
    for k, (_, t, lang, source, _) in enumerate(data[:60]):
        words = t.split(" ")
        words[len(words) // 2] = "changed"
        data.append((1000 + k, " ".join(words), lang, source, len(t)))
    shared = "\n".join(f"shared line {i} of a passage" for i in range(5))
    data += [(2000 + k, f"{t}\n{shared}\nend {k}", lang, source, None) for k, (_, t, lang, source, _) in enumerate(data[60:110])]
    data += [(3000, None, None, None, None), (3001, "", "en", "a", 0), (None, data[5][1], "en", "a", 1), data[7], (3002, data[9][1] * 300, "en", "a", 1)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    frames = [docs]
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, frames[-1], folder).write.parquet(f"{tmp_path}/{k}")
        frames.append(spark.read.parquet(f"{tmp_path}/{k}"))
    start, good, cut, unique, mixed, final = ([tuple(r) for r in f.collect()] for f in frames)
    for f in frames[:-1]:
        assert f.columns == docs.columns

    kinds = {r[0]: r[5] for r in test_quality.rows(300, 8)}
    junk = {i for i, k in kinds.items() if k == "junk"}
    junk |= {1000 + k for k in range(60) if k in junk} | {2000 + k for k in range(50) if 60 + k in junk}
    counts = {i: test_quality.plain_counts(t) for i, t, *_ in start}
    base = {i for i, (n, *_, repeat) in counts.items() if n < 10 or 100 * repeat > 20 * n}
    assert base >= {3000, 3001, 3002}  # no words, no words, the same words 300 times
    good_ids = {r[0] for r in good}
    assert good_ids == {i for i, *_ in start} - junk - base
    assert len(good) == sum(r[0] in good_ids for r in start)

    want = test_line_dedup.brute(good)
    assert Counter((i, t) for i, t, *_ in cut) == Counter((i, t) for (i, _), found in want.items() for t, *_ in found)
    assert all(n == len(t) for i, t, _, _, n in cut if i is not None and i >= 2000 and i < 3000 and t.count("shared") < 5)
    assert sum("shared line 2" in t for _, t, *_ in cut) == 1

    # The second copy of row 7 is now an empty text under the same id: rows are told apart by id and MD5 of the text.
    places = sorted({(i, hashlib.md5(t.encode()).hexdigest(), t) for i, t, *_ in cut if i is not None})
    roots = test_simhash.brute_components(range(len(places)), [test_simhash.brute_fingerprint(t) for *_, t in places])
    assert Counter((r[0], r[1]) for r in unique if r[0] is not None) == Counter((places[k][0], places[k][2]) for k in set(roots.values()))
    ids = {i for i, *_ in places}
    assert {i for i in ids if i >= 1000 and i < 1060} and len(unique) < len(cut)

    size, target = test_mixing.brute_targets([(i, t, s) for i, t, _, s, _ in unique])
    copies, longest = Counter(mixed), max(len(t.split()) for _, t, *_ in unique)
    assert set(copies) <= set(unique) and max(copies.values()) <= 2 * max(Counter(unique).values())
    for s in size:
        taken = sum(n * len(r[1].split()) for r, n in copies.items() if r[3] == s)
        assert abs(taken - target[s]) <= .05 * target[s] + longest

    texts = Counter((r[0], hashlib.sha256(r[1].encode()).hexdigest()) for r in mixed)
    assert Counter((r[0], r[3]) for r in final) == texts


def test_run_is_the_sequence_of_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert Counter(map(tuple, cp.run(spark, folder).collect())) == Counter(map(tuple, docs.collect()))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_run_leaves_one_stage(spark, folder):
    """Of all tables that the stages write only the last stage's input stays, as the result reads it."""
    import glob
    from termscope.session import ensure_checkpoint_dir
    tables = f"{ensure_checkpoint_dir(spark)}/tables/*"
    before = set(glob.glob(tables))
    cp.run(spark, folder).count()
    assert len(set(glob.glob(tables)) - before) == 1
