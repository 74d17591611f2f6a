"""Folders listed and read by the tasks: the same files, lines and texts as Spark's readers give, none of them on the driver."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from termscope.functions.paths import plain_path
from termscope.sources import chunks, inventory, scans, walk


def _lines(body):
    body = body.removeprefix(b"\xef\xbb\xbf").replace(b"\r\n", b"\n").replace(b"\r", b"\n") if body != b"\xef\xbb\xbf" else b"\n"
    return body if not body or body.endswith(b"\n") else body + b"\n"


def test_splits_of_a_file_give_every_line_once(tmp_path):
    rng, path = random.Random(3), str(tmp_path / "f")
    for n in range(400):
        body = (b"\xef\xbb\xbf" if n % 9 == 0 else b"") + b"".join(rng.choices([b"a", b"bc", b"\r", b"\n", b"\r\n"], k=rng.randint(0 if n % 9 == 0 else 1, 14)))
        with open(path, "wb") as f:
            f.write(body)
        for split in (4, 5, 9, 100):
            for size in (1, 3, 50):
                got = [c for at in range(0, len(body), split) for c in walk._line_chunks(path, at, min(at + split, len(body)), size)]
                assert b"".join(got) == _lines(body), (body, split, size)
                assert all(c.endswith(b"\n") and (len(c) < size or b"\n" not in c[size - 1:-1]) for c in got)


@pytest.fixture
def tree(tmp_path):
    for name in ("a.txt", "d/b.txt", "d/e=1/_c.txt", "_k=2/x.txt", "_gone/x.txt", ".hid/x.txt", "d/.hid.txt", "d/_no.txt", "d/zero.txt", "d/y._COPYING_",
                 "ü é+1%/q.csv", "ü é+1%/r.txt", "d/e=1/f/g/h.txt", "d/e=1/f/g/h.md", "_metadata"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"" if "zero" in name else b"one\r\ntwo\rthree \xc3\xa9\n" + name.encode())
    os.symlink(tmp_path / "nowhere", tmp_path / "d/link.txt")
    return str(tmp_path)


@pytest.mark.parametrize("glob", [None, "*.txt", "*.{txt,md}", "[a-q]*.t?t"])
def test_walk_finds_what_spark_lists(spark, tree, monkeypatch, glob):
    monkeypatch.setattr(walk, "FOLDERS", 1)  # more rounds
    files, tables = walk.walked(spark, tree, glob)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    want = (reader.option("pathGlobFilter", glob) if glob else reader).load(tree).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), "length", "modificationTime")
    assert sorted(map(tuple, files.collect())) == sorted(map(tuple, want.collect())) != []
    assert len(tables) > 2


def test_readers_of_a_folder_hold_no_file_of_it_on_the_driver(spark, tree):
    frames = [inventory.list_files(spark, tree, "*.txt"), scans.read_whole_text(spark, tree), scans.read_lines_latin1(spark, tree),
              chunks.file_chunks(spark, tree, "*.txt")]
    for df in frames:
        assert df.count() and not [f for f in df.inputFiles() if f.startswith(f"file://{tree}")]
    texts = {r.path: r.text for r in frames[1].collect()}
    want = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(tree, wholetext=True).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))
    assert texts == {r.path: r.text for r in want.collect()}


def test_scan_of_a_folder_walks_it_once_and_deletes_its_tables(spark, tree, monkeypatch):
    from termscope.plans import folder
    calls = []
    monkeypatch.setattr(folder, "walked", lambda *a: calls.append(a) or walk.walked(*a))
    scan = folder.scan_folder(spark, tree, {"unknown": lambda path, body: [(1, "1", 1, body.decode())]})
    assert len(calls) == 1
    for df in (scan.files, scan.segments):
        assert not [f for f in df.inputFiles() if f.startswith(f"file://{tree}")]
    assert {r.path[len(tree):]: r.n for r in scan.segments.groupBy("path").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        "/a.txt": 1, "/d/b.txt": 1, "/d/e=1/f/g/h.txt": 1, "/ü é+1%/r.txt": 1, "/_k=2/x.txt": 1, "/ü é+1%/q.csv": 4, "/d/e=1/f/g/h.md": 1}
    paths = [df._table_path for df in scan.owned]
    scan.close()
    assert not [p for p in paths if os.path.exists(p.removeprefix("file:"))]


def test_compressed_files_are_decoded_by_spark(spark, tmp_path):
    (tmp_path / "a.txt.gz").write_bytes(gzip.compress(b"one\ntwo\n"))
    assert [r.text for r in scans.read_whole_text(spark, str(tmp_path), "*").collect()] == ["one\ntwo\n"]
    assert [bytes(r.body) for r in chunks.file_chunks(spark, str(tmp_path)).collect()] == [b"one\ntwo\n"]


def test_files_without_own_folders_hold_the_same(spark, tmp_path):
    from termscope.sinks import writers
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(20)] + [(3, "again"), (None, "none"), (7, None)], "id long, text string")
    got = []
    for own in (True, False):
        root = str(tmp_path / str(own))
        writers.write_file_each(rows, root, "id", own_folder=own)
        got.append({r.i: sorted(r.text.split("\n")) for r in scans.read_whole_text(spark, root).select(F.regexp_extract("path", "/id=([^/]*?)(?:/part-0)?[.]txt$", 1).alias("i"), "text").collect()})
        assert len(list(os.walk(root))) == 1 + len(os.listdir(root)) + 21 * own
    assert got[0] == got[1] and len(got[0]) == 21


def test_inventory_lists_without_a_file_index(spark, tmp_path):
    from termscope.plans import room_files
    docs = spark.createDataFrame([(i, "x" * i) for i in range(30)] + [(7, "again")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = room_files.q_inventory(spark, str(tmp_path))
    assert not [f for f in out.inputFiles() if "/texts-" in f]
    want = {(i, i + 1 + 6 * (i == 7), "txt", f"doc_id={i}") for i in range(30)}
    assert {(r.doc_id, r.length, r.file_type, r.folder) for r in out.collect()} == want
