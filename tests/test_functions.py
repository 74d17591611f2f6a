"""Scalar functions on the edge rows of FIXTURES.md."""

from pyspark.sql import functions as F

from termscope.functions.cells import cell_address
from termscope.functions.paths import file_name, file_type, folder, handler, index_number, kind
from termscope.functions.text import cleanup_extraction, letter_count, null_token, numeric_looking, text_cell_keep


def _one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_index_number_latest(spark):
    names = ["1.2.1 ILS.csv", "2020_plan.xlsx", "1. Intro.txt", "7 x.txt", "1.2.csv", "_x.txt", "Report.csv", ".env"]
    want = ["1.2.1", "2020", "1.", "7", "1.2.", "", "", " "]
    got = _one(spark, [(n,) for n in names], "n string", index_number(F.col("n")))
    assert [g[0] for g in got] == want


def test_index_number_older_variants(spark):
    rows = [("1.2.1 ILS.csv",), ("2020_plan.xlsx",), ("Report.csv",), ("EN doc.txt",), ("3.1_en doc.txt",)]
    got = _one(spark, rows, "n string", *[index_number(F.col("n"), v) for v in
                                           ["token_test", "cut_then_test", "token_cut", "token"]])
    assert got[0] == ("1.2.1", "1.2.1", "1.2.1", "1.2.1")
    assert got[1][0] == " " and got[1][1] == "2020" and got[1][2] == "2020"
    assert got[2][0] == " " and got[2][2] == " "          # 'Report.csv' keeps '.', lone dot -> space
    assert got[3][0] == " "                                # single-case token
    assert got[4][0] == " " and got[4][1] == "3.1"         # '_' is special before the cut, not after


def test_path_parts(spark):
    rows = [("/a.b/c",), ("/a/c",), ("/a/x.CSV",), ("/r/1 x/1 x.txt",)]
    got = _one(spark, rows, "p string", file_type("p"), file_name("p"), folder("p"), handler("p"))
    assert got[0][0] == "b/c" and got[1][0] == "/a/c" and got[2][0] == "CSV"
    assert got[2][3] == "unknown"                          # routing is case-sensitive
    assert got[3][1] == "1 x.txt" and got[3][2] == "/r/1 x/"  # folder cut at the last component


def test_handler_routing(spark):
    cases = {"/a/b.docx": "docx", "/a/b.DOCX": "docx", "/a/b.doc": "doc", "/a/b.ppt": "ppt",
             "/a/bppt": "ppt", "/a/b.XLSX": "xlsx", "/a/bXLSX": "xlsx", "/a/b.xlsm": "xlsx",
             "/a/b.jfif": "tiff", "/a/b.PNG": "image", "/a/b.Csv": "unknown", "/a/b.md": "unknown",
             "/a/b.msg": "msg", "/a/b.pdf": "pdf"}
    got = _one(spark, [(k,) for k in cases], "p string", "p", handler("p"), handler("p", case_sensitive=False))
    for p, h, hl in got:
        assert h == cases[p], p
    assert dict((p, hl) for p, _, hl in got)["/a/b.Csv"] == "csv"


def test_kind(spark):
    got = _one(spark, [("a.xlsx",), ("a.doc",), ("a.txt",), ("a.pptx",), ("a.pdf",), ("a.csv",)], "n string", kind("n"))
    assert [g[0] for g in got] == ["Microsoft Excel", "Microsoft Word", "Text File", "Microsoft Powerpoint",
                                   "Adobe PDF", "Unknown"]


def test_cell_address(spark):
    cols = [1, 26, 27, 52, 53, 702, 703, 16384]
    got = _one(spark, [(c,) for c in cols], "c int", cell_address(F.col("c"), F.lit(1)))
    assert [g[0] for g in got] == ["A1", "Z1", "AA1", "AZ1", "BA1", "ZZ1", "AAA1", "XFD1"]


def test_text_helpers(spark):
    got = _one(spark, [("a\\nb 0c",), (None,), ("nan",), ("12",), ("1.5e3",), ("Brand#2",), ("7",), ("-4.5",)],
               "v string", cleanup_extraction("v"), null_token("v"), numeric_looking("v"), text_cell_keep("v"))
    assert got[0][0] == "a b  "
    assert got[1][1] == "" and got[2][1] == ""
    assert got[3][2] and not got[3][3]                  # numeric text is not matched
    assert got[4][2]
    assert not got[5][2] and got[5][3]
    assert not got[6][3]                                # too short
    assert got[7][2]                                    # the sign is stripped first
    assert _one(spark, [(" ab c ",)], "v string", letter_count("v"))[0][0] == 3


def test_path_id_check(spark):
    from termscope.functions.paths import path_id_matches
    row = spark.range(1).select(path_id_matches("s3://b/u/g1/room", "s3://b/u/g1/req", "g1").alias("a"),
                                path_id_matches("s3://b/u/g2/room", "s3://b/u/g1/req", "g1").alias("b"),
                                path_id_matches("room", "req", "g1").alias("c")).collect()[0]
    assert row.a is True and row.b is False and not row.c
