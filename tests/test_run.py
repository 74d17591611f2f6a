"""End-to-end run with sinks, and the incremental (streaming) scan."""

import json
import os

from termscope.plans.run import run, write_run
from termscope.sources import testbed as tb

SF = "/root/testdata/sf0.001"


def test_run_writes_reports(spark, tmp_path):
    res = run(tb.room_files(spark, SF), tb.room_segments(spark, SF), tb.room_dictionary(spark),
              tb.room_requests(spark, SF))
    out = str(tmp_path / "out")
    write_run(res, out)
    back = spark.read.parquet(f"{out}/file_report")
    assert back.count() == res["file_report"].count() > 0
    assert spark.read.parquet(f"{out}/raw_details").select("category").distinct().count() > 1
    summary = [json.loads(l) for f in os.listdir(f"{out}/run_summary") if f.endswith(".json")
               for l in open(f"{out}/run_summary/{f}")]
    assert summary[0]["n_files"] == 200
    details = spark.read.parquet(f"{out}/raw_details")
    assert details.where("category = ''").count() == res["raw_details"].where("category = ''").count() > 0
    assert details.where("category is null").count() == 0
    numbers = [r.row_no for r in spark.read.parquet(f"{out}/scope_index").orderBy("folder_path").collect()]
    assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) == 221
    tables = [p for p in res["keyword_files"].inputFiles() if "hits-" in p]
    assert tables
    res.close()
    assert not os.path.exists(tables[0].replace("file://", ""))


def test_folder_to_reports(spark, tmp_path):
    """A folder of real files gives the reports of the in-memory run over the same segments."""
    from termscope.plans.folder import run_folder
    from termscope.plans.run import run
    from termscope.functions.paths import with_path_parts
    room, sheet_dir = tmp_path / "room", tmp_path / "requests"
    (room / "1 sub").mkdir(parents=True)
    sheet_dir.mkdir()
    (room / "1.2 a.txt").write_text("the cat of the house\nof it")
    (room / "1 sub" / "b c.csv").write_text('the,"of ""the""\nrow"\n\nx,the')
    (room / "none.txt").write_text("nothing")
    (room / "bad.csv").write_bytes(b"\xff\xfe\xff")
    (room / "d.pdf").write_bytes(b"%PDF")
    (room / "e.zzz").write_bytes(b"?")
    (sheet_dir / "list.csv").write_text("a,no,c,d,e,area,sentence\nx,12.0,,,,IT,the and of\nx,12,,,,it ,nothing\nx,bad,,,,IT,the\n")
    d = spark.createDataFrame([("c1", "the", 1), ("c2", "of", 2)], "category string, keyword string, row_ord int")
    res = run_folder(spark, str(room), d, str(sheet_dir), "cat, the", lists=True, request_min_keywords=2)
    rows = {r.file_name: r for r in res["file_report"].collect()}
    assert (rows["1.2 a.txt"].n_keywords_found, rows["b c.csv"].n_keywords_found) == (2 + 2 + 1 + 2, 3 + 1 + 3)
    assert rows["e.zzz"].scan_status == "Unsuccessful" and len(rows) == 3
    assert {(r.file_name, r.reason) for r in res["skipped_files"].collect()} == {("bad.csv", "failed"), ("d.pdf", "failed"), ("e.zzz", "unknown")}
    assert [r.file_name for r in res["unmatched_files"].collect()] == ["none.txt"]
    cells = {r.location for r in res["raw_details"].where("file_name = 'b c.csv'").collect()}
    assert cells == {"A1", "B1", "B3"}
    out = {r.row_ord: (r.request_no, r.paths) for r in res["request_report"].collect()}
    assert out == {2: (12, f"{room}/1 sub/b c.csv, {room}/1.2 a.txt, "), 3: (12, "")}
    s = res["run_summary"].collect()[0]
    assert (s.n_files, s.number_of_file_skipped, s.message) == (6, 3, "|request list has rows without a valid number")
    assert {r.folder_path for r in res["scope_index"].where("kind = 'Folder'").collect()} == {str(room / "1 sub")}

    files = with_path_parts(spark.createDataFrame([(str(room / "1.2 a.txt"), "scanned"), (str(room / "1 sub" / "b c.csv"), "scanned"),
                                                   (str(room / "none.txt"), "scanned"), (str(room / "e.zzz"), "unknown")], "path string, status string"))
    seg = spark.createDataFrame([(str(room / "1.2 a.txt"), 1, "1", 1, "the cat of the house\nof it"), (str(room / "none.txt"), 1, "1", 1, "nothing")]
                                + [(str(room / "1 sub" / "b c.csv"), (r << 24) + c, f"{'AB'[c - 1]}{r}", 1, t) for r, c, t in
                                   [(1, 1, "the"), (1, 2, 'of "the"\nrow'), (3, 1, "x"), (3, 2, "the")]],
                                "path string, seg_ord long, location string, page_count int, text string")
    terms = spark.createDataFrame([("c1", "the", 1), ("c2", "of", 2), ("User Input", "cat", 3), ("User Input", "the", 4)], "category string, keyword string, row_ord int")
    mem = run(files, seg, terms, root=str(room), lists=True)
    for name in ("file_report", "keyword_report", "keyword_files", "raw_details"):
        assert sorted(map(str, res[name].collect())) == sorted(map(str, mem[name].collect())), name
    res.close(), mem.close()


def test_no_table_is_written_to_a_local_folder_on_a_cluster():
    import pytest
    from unittest import mock
    from termscope.session import ensure_checkpoint_dir
    session = mock.Mock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"):
        session.sparkContext.master = master
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(session)


def test_streaming_incoming(spark, tmp_path):
    from termscope.streaming.incoming import start
    inc = tmp_path / "in"
    inc.mkdir()
    (inc / "a.txt").write_text("the cat and the dog")
    (inc / "b.txt").write_text("nothing here")
    d = spark.createDataFrame([("c", "the", 1), ("c", "and", 2)], "category string, keyword string, row_ord int")
    q = start(spark, str(inc), d, str(tmp_path / "hits"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = {(r.keyword, r.hits) for r in spark.read.parquet(str(tmp_path / "hits")).collect()}
    assert got == {("the", 2), ("and", 1)}
