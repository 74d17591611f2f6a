"""Sources, dictionaries, density routing and the extractor hook."""

import pytest
from pyspark.sql import functions as F

from termscope.operators.density import density_route, slide_skip
from termscope.operators.extract import errors_of, extract, segments_of
from termscope.sources.dictionary import dedup_keywords, unpivot_wide, user_keywords
from termscope.sources.scans import csv_cells, line_segments


def test_user_keywords(spark):
    for arg in ["", "None", "nan", " NAN "]:
        assert user_keywords(spark, arg).count() == 0
    assert [r.keyword for r in user_keywords(spark, "LAN, ,WAN").orderBy("row_ord").collect()] == ["LAN", "WAN"]


def test_dedup_first_wins(spark):
    d = spark.createDataFrame([("fr", "que", 1), ("es", "que", 2), ("es", "los", 3)],
                              "category string, keyword string, row_ord int")
    assert sorted((r.category, r.keyword) for r in dedup_keywords(d).collect()) == [("es", "los"), ("fr", "que")]


def test_unpivot_drops_blanks(spark):
    s = spark.createDataFrame([(1, "CRM", ""), (2, None, "LAN")], "row long, apps string, infra string")
    got = sorted((r.category, r.keyword) for r in unpivot_wide(s, ["apps", "infra"]).collect())
    assert got == [("apps", "CRM"), ("infra", "LAN")]


def test_density_route(spark):
    # Two pages need 300 letters: 150 + 150 is text, 150 + 149 goes to OCR.
    pages = spark.createDataFrame([("/p.pdf", 1, "a" * 150), ("/p.pdf", 2, "a" * 150), ("/q.pdf", 1, "a" * 150),
                                   ("/q.pdf", 2, "a" * 149), ("/r.doc", 1, "a" * 10)],
                                  "path string, page int, text string")
    got = {r.path: r.route for r in density_route(pages).collect()}
    assert got == {"/p.pdf": "text", "/q.pdf": "ocr", "/r.doc": "text"}


def test_slide_skip(spark):
    runs = spark.createDataFrame([("/d", 1, 1, "x", True), ("/d", 2, 1, "y", True), ("/e", 1, 1, "ok", False)],
                                 "path string, slide int, run_ord int, text string, failed boolean")
    got = {r.path: r.skipped for r in slide_skip(runs).collect()}
    assert got == {"/d": True, "/e": False}


def test_extractor_errors_do_not_fail_the_job(spark):
    files = spark.createDataFrame([("/ok.txt", "a\nb"), ("/bad.bin", "\x00")], "path string, content string")

    def fn(path, body):
        if "\x00" in body:
            raise ValueError("binary")
        lines = body.split("\n")
        return [(i + 1, str(i + 1), len(lines), x) for i, x in enumerate(lines)]
    out = extract(files, fn).cache()
    assert segments_of(out).count() == 2
    assert [tuple(r) for r in errors_of(out).collect()] == [("/bad.bin", "ValueError: binary")]


def test_csv_cells_equal_the_csv_library(spark, tmp_path):
    import csv
    bodies = {
        "a b.csv": "x,y\n" + "\n".join(f"r{i},v{i}" for i in range(1, 500)) + "\n",
        "wide+1.csv": ",".join(f"c{i}" for i in range(300)) + "\n\n" + ",".join("z" * 80) + "\n",
        "quoted.csv": 'a,"say ""the"" word","two\nlines"\n\n"",b\n"x\ny","z"\r\nlast,"",\n',
        "empty.csv": "",
    }
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body.encode())
    got = {}
    for r in csv_cells(spark, str(tmp_path)).collect():
        got.setdefault(r.path, []).append((r.row, r.col, r.value))
    want = {}
    for name in bodies:
        with open(tmp_path / name) as f:
            cells = [(i, j, v) for i, row in enumerate(csv.reader(f), 1) for j, v in enumerate(row, 1)]
        if cells:
            want[str(tmp_path / name)] = cells
    assert {k: sorted(v) for k, v in got.items()} == want


def test_csv_cells_of_any_length_and_bad_files(spark, tmp_path):
    from termscope.plans.folder import scan_folder
    (tmp_path / "a.csv").write_text('1,"' + "long " * 40_000 + '"\n2,short\n')
    got = {(r.row, r.col): r.value for r in csv_cells(spark, str(tmp_path)).collect()}
    assert got == {(1, 1): "1", (1, 2): "long " * 40_000, (2, 1): "2", (2, 2): "short"}
    scan = scan_folder(spark, str(tmp_path))
    assert [r.status for r in scan.files.collect()] == ["scanned"] and scan.segments.count() == 4
    scan.close()
    (tmp_path / "b.csv").write_bytes(b"1,\xff\xfe\n")
    with pytest.raises(Exception, match="b.csv"):
        csv_cells(spark, str(tmp_path)).groupBy("row").count().collect()


def test_csv_cells_of_files_in_splits(spark, tmp_path):
    """Files read in many splits and beyond the whole-file bound; row numbers of a source run on over its files."""
    from termscope.plans import room_files
    (tmp_path / "a.csv").write_text("".join(f'{i},"x{i}\n""y"""\n' for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = sorted((r.row, r.col, r.value) for r in csv_cells(spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(c for i in range(3000) for c in [(i + 1, 1, str(i)), (i + 1, 2, f'x{i}\n"y"')])
    sf_dir = "/root/testdata/sf0.001"
    one = [sorted(map(str, room_files.q_csv_cells(spark, sf_dir, n).collect())) for n in (3, 100_000)]
    assert one[0] == one[1]


def test_whole_texts_and_inventory_join(spark, tmp_path):
    from termscope.sources.inventory import list_files
    from termscope.sources.scans import read_lines_latin1, read_whole_text
    (tmp_path / "d e").mkdir()
    (tmp_path / "d e" / "ü+1%.txt").write_bytes("one\r\ntwo\nthree".encode())
    (tmp_path / "b.txt").write_bytes(b"caf\xe9\nx")
    (tmp_path / "c.bin").write_bytes(b"x")
    texts = {r.path: (r.seg_ord, r.text) for r in read_whole_text(spark, str(tmp_path), glob="*1%.txt").collect()}
    assert texts == {str(tmp_path / "d e" / "ü+1%.txt"): (1, "one\ntwo\nthree")}
    assert {r.path for r in list_files(spark, str(tmp_path)).collect()} == {str(p) for p in tmp_path.rglob("*") if p.is_file()}
    lines = [(r.path, r.text) for r in read_lines_latin1(spark, str(tmp_path), "b.txt").orderBy("seg_ord").collect()]
    assert lines == [(str(tmp_path / "b.txt"), "café"), (str(tmp_path / "b.txt"), "x")]


def test_cells_of_two_sheets_stay_apart(spark):
    from termscope.sources.scans import cell_segments, workbook_segments
    cells = spark.createDataFrame([("/w", "S1", 1, 100001, 1, "the", None), ("/w", "S2", 2, 1, 1, "the", None), ("/w", "S2", 2, 1_048_576, 16_384, "0", None),
                                   ("/w", "S3", 3, 1, 1, "", None), ("/w", "S3", 3, 2, 1, None, 0.0)],
                                  "path string, sheet string, sheet_ord int, row int, col int, value string, number double")
    seg = workbook_segments(cells, skip_falsy=True).orderBy("seg_ord").collect()
    assert [(r.location, r.text, r.page_count) for r in seg] == [("S1: A100001", "the", 3), ("S2: A1", "the", 3), ("S2: XFD1048576", "0", 3)]
    assert cell_segments(cells).select("seg_ord").distinct().count() == 4


def test_slides_without_text_count(spark):
    from termscope.sources.scans import slide_counts, slide_texts
    runs = spark.createDataFrame([("/d", 1, 1, "x"), ("/d", 2, 1, None), ("/d", 3, 1, None)], "path string, slide int, run_ord int, text string")
    assert slide_counts(runs).collect()[0].page_count == 3 and slide_texts(runs).count() == 1


def test_letters_of_a_page(spark):
    from termscope.functions.text import letter_count
    for text, n in [("\n\nabc\n", 3), ("a\\nb", 3), ("\t a b \u00a0", 2), ("x0cy", 3), ("", 0)]:
        want = len(text.strip().replace(" ", "").replace("\\r", " ").replace("\\n", " ").replace("\\x", " ").replace("0c", " "))
        assert want == n and spark.range(1).select(letter_count(F.lit(text)).alias("n")).collect()[0].n == n


def test_late_parser_failure_leaves_one_error_row(spark):
    files = spark.createDataFrame([("/late", "x"), ("/ok", "y")], "path string, content string")

    def fn(path, body):
        yield 1, "1", 1, body
        if path == "/late":
            raise OSError("cut off")
    out = extract(files, fn).cache()
    assert [tuple(r) for r in errors_of(out).collect()] == [("/late", "OSError: cut off")]
    assert [(r.path, r.text) for r in segments_of(out).collect()] == [("/ok", "y")]


def test_line_segments(spark):
    df = spark.createDataFrame([("/a", "l1\nl2\n")], "path string, text string")
    got = [tuple(r) for r in line_segments(df).orderBy("seg_ord").collect()]
    assert got == [("/a", 1, "1", 3, "l1"), ("/a", 2, "2", 3, "l2"), ("/a", 3, "3", 3, "")]
