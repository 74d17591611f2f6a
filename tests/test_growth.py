"""What must not grow with the number of files, names or hits in one place."""

import glob
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termscope.sinks import writers


def _bodies(root):
    return {f.split("/")[-2]: open(f, "rb").read() for f in glob.glob(f"{root}/**/part-*", recursive=True)}


@pytest.mark.parametrize("fmt, options", [("text", {}), ("csv", writers.CSV_OPTIONS), ("json", {})])
def test_file_each_has_what_sparks_writer_writes(spark, tmp_path, fmt, options):
    texts = ["a\nb", None, "", ' x "q", y ', "é\r\n\\ z", "\n", '"', "a,b", "tab\t ", 'a\\"b']
    rows = [(i - 2, t) for i, t in enumerate(texts)] + [(50, "twice")] * 2
    df = spark.createDataFrame(rows, "id long, text string")
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    df.repartition(3, "id").write.partitionBy("id").options(**options).format(fmt).save(old)
    writers.write_file_each(df, new, "id", fmt, **options)
    assert _bodies(new) == _bodies(old) and len(_bodies(new)) == len(texts) + 1
    assert {f.rsplit(".", 1)[1] for f in glob.glob(f"{new}/*/*/part-*")} == {{"text": "txt"}.get(fmt, fmt)}


def test_many_files_lie_in_few_folders(spark, tmp_path):
    from termscope.sources.inventory import list_files
    root, n = str(tmp_path / "texts"), 2 * writers.FILE_GROUPS
    writers.write_file_each(spark.range(n).select("id", F.lit("x").alias("text")), root, "id")
    assert len(os.listdir(root)) <= writers.FILE_GROUPS
    assert not [f for f in glob.glob(f"{root}/*/*/.*")]
    files = list_files(spark, root, "*.txt")
    assert files.count() == n and files.select("folder").distinct().count() == n


def test_scan_in_few_tasks_reads_all(spark):
    from termscope.sources.inventory import few_tasks
    most = 32 * spark.sparkContext.defaultParallelism
    many = spark.range(0, most * 3, 1, most * 3)
    assert few_tasks(many).rdd.getNumPartitions() == most
    assert few_tasks(many).agg(F.sum("id")).first()[0] == sum(range(most * 3))
    assert few_tasks(spark.range(0, 10, 1, 3)).rdd.getNumPartitions() == 3


def test_csv_chunks_compose_across_batches():
    from termscope.sources import csv_files as c
    chunks = [("/a", 0, 0, b'1,"x\n'), ("/a", 0, 1, b'y"\n2,z\n'), ("/a", 9, 0, b"3,w\n"), ("/b", 0, 0, b"1\n2\n"), ("/c", 0, 0, b"\xff\n"), ("/c", 0, 1, b"1\n")]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*some)], names=["path", "block", "seq", "body"]) for some in (chunks[:1], chunks[1:4], chunks[4:])]
    states = [r for b in c._states(c._scanned(iter(batches))) for r in b.to_pylist()]
    got = [(r["path"], r["block"], r["seq"], r["quoted"], r["before"], bool(r["error"])) for r in states]
    assert got == [("/a", 0, 0, False, 0, False), ("/a", 0, 1, True, 0, False), ("/a", 9, 0, False, 2, False),
                   ("/b", 0, 0, False, 0, False), ("/c", 0, 0, False, 0, True)]


def test_request_names_in_cells_equal_brute_force(spark):
    from termscope.plans.requests import any_matches, request_report_any
    rng = random.Random(2)
    words = ["red", "Blue", "ring", "it's", "a b"]
    index = [(f"/{rng.randint(1, 12)}", name, w) for _ in range(60) for name in [rng.choice("xyz")] for w in rng.sample(words, 2)]
    index += [("/9", None, "red"), (None, "n", "red")]
    reqs = [(str(i), "HR", " ".join(rng.sample(words, rng.randint(0, 3))).upper(), i) for i in range(15)] + [("bad", "IT", "red", 99)]
    sheet = spark.createDataFrame(reqs, "request_no string, area string, sentence string, row_ord int")
    idx = spark.createDataFrame(index, "path string, file_name string, match string")
    pairs = {(i, p, f) for no, _, s, i in reqs if no != "bad" for p, f, w in index if w.lower() in s.lower()}
    assert {tuple(r) for r in any_matches(sheet, idx).collect()} == pairs
    assert any_matches(sheet, idx).count() == len(pairs)
    for size in (1, 4, 1000):
        got = {r.row_ord: (r.n_files, r.file_names) for r in request_report_any(sheet, idx, size).collect()}
        want = {}
        for i in {x[0] for x in pairs}:
            own = sorted(((p or "", f or "", f) for k, p, f in pairs if k == i))
            want[i] = (len(own), " ".join(f for *_, f in own if f is not None))
        assert got == want


def test_hits_of_one_category_are_written_by_many_tasks(spark, tmp_path):
    n = 200_000  # several MB: Spark makes no smaller tasks than of one
    raw = spark.range(0, n, 1, 1).select(F.lit("c").alias("category"), F.concat_ws("/", F.sha1(F.col("id").cast("string")), "id").alias("path"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        writers.write_hits(raw, str(tmp_path / "raw"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(glob.glob(f"{tmp_path}/raw/category_part=c/*.parquet")) > 1
    assert spark.read.parquet(str(tmp_path / "raw")).select("path").distinct().count() == n


def test_requests_meet_sets_of_files_not_match_lists(spark, monkeypatch):
    """Many match lists of which requests know two terms: no table but the files' own has a row per list."""
    import itertools

    from termscope.plans import requests as r
    words = ["red", "blue", *(f"w{i:02d}x" for i in range(10))]
    lists = [c for k in (1, 2, 3) for c in itertools.combinations(words, k)]
    idx = spark.createDataFrame([(f"/{i:03d}", f"n{i}", w) for i, own in enumerate(lists) for w in own], "path string, file_name string, match string")
    sheet = spark.createDataFrame([("1", "HR", "a RED one", 1), ("2", "IT", "red again", 2), ("3", "IT", "blue, red", 3), ("4", "IT", "none", 4)],
                                  "request_no string, area string, sentence string, row_ord int")
    sizes, write = {}, r.materialize

    def counted(df, name="table"):
        out = write(df, name)
        sizes[name] = out.count()
        return out
    monkeypatch.setattr(r, "materialize", counted)
    got = {x.row_ord: (x.n_files, x.file_names) for x in r.request_report_any(sheet, idx, 50).collect()}
    red, both = ([i for i, own in enumerate(lists) if set(own) & known] for known in ({"red"}, {"red", "blue"}))
    assert got == {k: (len(own), " ".join(f"n{i}" for i in own)) for k, own in ((1, red), (2, red), (3, both))}
    assert max(n for name, n in sizes.items() if name != "met-files") <= 3


def test_alternation_looks_at_first_characters_to_the_same_matches(spark):
    from termscope.functions.patterns import category_alternation
    texts = ["Kelvin is Kelvin", "sun ſun ẞe", "it ıt İt IT, ßße", "Été été 1a _b", "xthe the", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kws, looks in ((["kelvin", "sun", "it", "the"], True), (["1a", "_b"], True), (["ße", "été", "it"], False), ([], False)):
        p = spark.range(1).select(category_alternation(F.array(*[F.lit(k) for k in kws]).cast("array<string>")).alias("p")).first().p
        assert ("(?=[" in p) == looks
        plain = p.replace(p[p.index("(?=["):p.index("])") + 2], "") if looks else p
        a, b = ([r.m for r in df.select(F.regexp_extract_all("t", F.lit(x), F.lit(0)).alias("m")).collect()] for x in (p, plain))
        assert a == b
