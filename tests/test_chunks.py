"""Files in chunks: one CSV file parsed by many tasks, text windows and their
edges, parsers with a time limit."""

import csv
import io
import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from termscope.operators.extract import errors_of, extract, segments_of
from termscope.operators.match import keyword_hits
from termscope.plans.folder import scan_folder
from termscope.sources import chunks, csv_files


def py_cells(text):
    return [(r, c, v) for r, row in enumerate(csv.reader(io.StringIO(text, newline="\n")), 1) for c, v in enumerate(row, 1)]


def random_csv(rng, records):
    """Well-formed and odd cells: quotes in unquoted cells, quotes after a closing quote, blank lines, an open end."""
    bits = ["a", "b c", '""', ",", "\n", "é", "x" * 30, "'", " "]
    lines = []
    for _ in range(records):
        cells = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            body = "".join(rng.choices(bits, k=rng.randint(0, 6)))
            plain = body.replace(",", "").replace("\n", "").replace('"', "")
            cells.append(f'"{body}"' if kind < .4 else plain + '"' + plain if kind < .5 and plain else f'"{plain}"tail' if kind < .6 else plain)
        lines.append(",".join(cells))
    return "\n".join(lines) + rng.choice(["", "\n", '\n"open,\nend', "\n\n"])


def test_chunk_functions_equal_the_csv_library():
    """Every cut of a text into chunks gives the library's cells."""
    rng = random.Random(1)
    for _ in range(150):
        text = random_csv(rng, rng.randint(1, 12))
        lines = text.split("\n")
        lines = lines[:-1] if lines[-1] == "" else lines
        cuts = sorted(rng.sample(range(len(lines) + 1), min(len(lines), rng.randint(0, 6))))
        parts = [p for p in (lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)])) if p]
        quoted, before, cells, pieces = False, 0, [], {}
        for part in parts:
            ends, goes_on, head, tail = csv_files.scan(part, quoted)
            if quoted:
                pieces.setdefault(before + 1, []).extend(part[:head])
            if not quoted or ends:
                if goes_on:
                    pieces.setdefault(before + ends + 1, []).extend(part[tail:])
                for k, (values, *_) in enumerate(csv_files.records(part[head if quoted else 0:tail], False), before + quoted + 1):
                    cells += [(k, c, v) for c, v in enumerate(values, 1)]
            quoted, before = goes_on, before + ends
        for row, got in pieces.items():
            (values, *_), = csv_files.records(got, False)
            cells += [(row, c, v) for c, v in enumerate(values, 1)]
        assert sorted(cells) == py_cells("\n".join(lines) + "\n"), (text, parts)


@pytest.mark.parametrize("size,split", [(1, "64"), (200, "300"), (1 << 20, "2k")])
def test_one_file_parsed_by_many_tasks(spark, tmp_path, size, split):
    rng = random.Random(size)
    texts = {f"{k}.csv": random_csv(rng, n) for k, n in enumerate((0, 1, 40, 150))}
    texts["long.csv"] = '1,"' + "line of one cell\n" * 400 + '"\n2,"next"\n'
    texts["plain.csv"] = "a,b\n" * 1500
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        files = csv_files.CsvFiles(spark, str(tmp_path), size=size)
        got = {}
        for r in files.cells().collect():
            got.setdefault(os.path.basename(r.path), []).append((r.row, r.col, r.value))
        counts = {os.path.basename(r.path): r.n_rows for r in files.row_counts().collect()}
        tasks = files.states.where(F.col("path").endswith("/plain.csv")).select("block", "seq").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, text in texts.items():
        text = text if text.endswith("\n") or not text else text + "\n"
        assert sorted(got.get(name, [])) == py_cells(text), name
        assert counts.get(name, 0) == sum(1 for _ in csv.reader(io.StringIO(text, newline="\n"))), name
    assert tasks > 8 or size > 1000


def test_the_text_of_a_csv_file_is_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\ny"\n' * 50)
    plan = csv_files.csv_cells(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 1 and "hashpartitioning(path#" in exchanges[0] and "row#" in exchanges[0]  # parts of records only


def py_count(keyword, text):
    return len(re.compile(r"(?<!\w)%s(?!\w)" % re.escape(keyword), flags=re.I).findall(text))


@pytest.mark.parametrize("limit", [0, 1000])
@pytest.mark.parametrize("size", [1, 9, 40, 1 << 20])
def test_keywords_across_window_edges_count_once(spark, tmp_path, size, limit, monkeypatch):
    """Keywords with line feeds at every edge, words and symbols at the edges, at any window size."""
    monkeypatch.setattr(chunks, "CHUNK_BYTES", size)
    monkeypatch.setattr(chunks.file_chunks, "__defaults__", (None, None, size))
    rng = random.Random(size)
    keywords = ["on\nthe", "the", "c++", "the\n", "a\nb\nc", "on", ".", "\nb", "on the", "x\n\ny"]
    bits = ["on", "the", "c++", "x", "a", "b", "c", "y", ".", "on\nthe", "a\nb\nc"]
    texts = {f"{k}.txt": "".join(rng.choice(bits) + rng.choice(["\n", "\n", " ", "\n\n", ""]) for _ in range(n)) + "\n" for k, n in enumerate([0, 3, 60, 400])}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    scan = scan_folder(spark, str(tmp_path), reach=max(map(len, keywords)))
    d = spark.createDataFrame([("c", k, i) for i, k in enumerate(keywords)], "category string, keyword string, row_ord int")
    got = {}
    for r in keyword_hits(scan.segments, d, broadcast_limit=limit).collect():
        key = os.path.basename(r.path), r.keyword
        got[key] = got.get(key, 0) + r.hits
    want = {(name, k): py_count(k, text) for name, text in texts.items() for k in keywords if py_count(k, text)}
    assert got == want and ("3.txt", "on\nthe") in got
    if size == 1:
        assert scan.segments.where("edge >= 0").count() > 50
    scan.close()


def test_files_of_any_size_are_scanned(spark, tmp_path):
    """Text and CSV files know no size bound; a parser that takes whole files has one, and says so."""
    (tmp_path / "a.txt").write_text("the " * 100)
    (tmp_path / "b.csv").write_text('the,"the\nthe"\n' * 100)
    (tmp_path / "c.pdf").write_bytes(b"the " * 100)
    (tmp_path / "d.pdf").write_bytes(b"the")
    (tmp_path / "bad.txt").write_bytes(b"the \xff")
    scan = scan_folder(spark, str(tmp_path), {"pdf": lambda path, body: [(1, "1", 1, bytes(body).decode())]}, max_bytes=50)
    status = {r.file_name: (r.status, r.reason) for r in scan.files.collect()}
    assert status == {"a.txt": ("scanned", None), "b.csv": ("scanned", None), "c.pdf": ("failed", "larger than 50 bytes"),
                      "d.pdf": ("scanned", None), "bad.txt": ("failed", "UnicodeDecodeError: invalid start byte")}
    d = spark.createDataFrame([("c", "the", 1)], "category string, keyword string, row_ord int")
    hits = keyword_hits(scan.segments, d).groupBy("path").agg(F.sum("hits").alias("n")).collect()
    assert {os.path.basename(r.path): r.n for r in hits} == {"a.txt": 100, "b.csv": 300, "d.pdf": 1}
    scan.close()


def test_a_parser_that_hangs_or_dies_fails_its_file_only(spark):
    files = spark.createDataFrame([(f"/{k}", "hang" if k == 3 else "die" if k == 5 else "late" if k == 6 else f"ok {k}") for k in range(10)], "path string, content string")

    def fn(path, body):
        yield 1, "1", 1, body
        if body == "hang":
            while True:
                time.sleep(1)
        if body == "die":
            os._exit(3)
        if body == "late":
            raise OSError("cut off")
    out = extract(files.repartition(2), fn, seconds=2).cache()
    errors = {r.path: r.error for r in errors_of(out).collect()}
    assert errors == {"/3": "TimeoutError: more than 2 s", "/5": "RuntimeError: the parser ended its process", "/6": "OSError: cut off"}
    assert sorted((r.path, r.text) for r in segments_of(out).collect()) == [(f"/{k}", f"ok {k}") for k in range(10) if k not in (3, 5, 6)]


def test_segments_are_handed_over_in_parts(spark):
    files = spark.createDataFrame([("/many", "x")], "path string, content string")
    out = extract(files, lambda path, body: ((k, str(k), 1, f"t{k}") for k in range(12_345)))
    assert segments_of(out).agg(F.count("*"), F.sum("seg_ord")).first()[:] == (12_345, 12_345 * 12_344 // 2)
