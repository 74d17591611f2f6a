"""Reports on the tiny room of FIXTURES.md section 4."""

import pytest

from termscope.functions.paths import with_path_parts
from termscope.operators.match import keyword_hits
from termscope.plans import reports
from termscope.plans.requests import request_report


@pytest.fixture(scope="module")
def room(spark):
    files = with_path_parts(spark.createDataFrame(
        [("/room/a/1 x.txt", "scanned"), ("/room/b/1 x.txt", "scanned"), ("/room/b/2 y.txt", "scanned"),
         ("/room/b/3 z.md", "unknown")], "path string, status string"))
    seg = spark.createDataFrame(
        [("/room/a/1 x.txt", 1, "the of the"), ("/room/a/1 x.txt", 2, "of the"),
         ("/room/b/1 x.txt", 1, "the the the"), ("/room/b/2 y.txt", 1, "nothing")],
        "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c1", "the", 1), ("c2", "of", 2)], "category string, keyword string, row_ord int")
    hits = keyword_hits(seg, d).cache()
    return files, hits, d


def test_file_report(room):
    files, hits, _ = room
    rows = {r.path or r.file_name: r for r in reports.file_report(files, hits).collect()}
    a = rows["/room/a/1 x.txt"]
    assert (a.n_keywords_found, a.n_keyword_categories, a.relevant) == (5, 2, "Yes")
    assert a.keyword_details == "of(2), the(3), " and a.category_details == "c1, c2"
    b = rows["/room/b/1 x.txt"]
    assert (b.n_keywords_found, b.relevant) == (3, "No")
    z = rows["3 z.md"]
    assert (z.file_type, z.scan_status, z.n_keywords_found, z.keyword_details) == ("Unknown", "Unsuccessful", 0, "")
    assert len(rows) == 3


def test_keyword_report(room):
    files, hits, _ = room
    rows = {r.keyword: r for r in reports.keyword_report(files, hits, lists=True).collect()}
    the = rows["the"]
    assert the.total_hits == 6 and the.n_files == 2 and the.max_hits == 3
    plain = {r.keyword: (r.n_files, r.total_hits, r.max_hits) for r in reports.keyword_report(files, hits).collect()}
    assert plain["the"] == (2, 6, 3)
    assert the.max_file_paths == "/room/a/1 x.txt, /room/b/1 x.txt"   # tie kept
    assert the.all_file_names == "1 x.txt"
    by_name = {r.keyword: r.n_files for r in reports.keyword_report(files, hits, by="name").collect()}
    assert by_name["the"] == 1


def test_unmatched_and_skipped(room, spark):
    files, hits, _ = room
    assert [r.file_name for r in reports.unmatched_files(files, hits).collect()] == ["2 y.txt"]
    assert [r.file_name for r in reports.skipped_files(files).collect()] == ["3 z.md"]
    s = reports.run_summary(files, hits).collect()[0]
    assert (s.n_files, s.number_of_file_skipped, s.total_hits, s.message) == (4, 1, 8, "")


def test_request_report(room, spark):
    files, hits, d = room
    from termscope.operators.match import prepare_dictionary
    reqs = spark.createDataFrame(
        [("1", "IT", "the of", 1), ("2", " it ", "nothing", 2), ("3", "HR", "the of", 3), ("x", "IT", "the", 4), ("4", None, "the", 5)],
        "request_no string, area string, sentence string, row_ord int")
    out = {r.request_no: r for r in request_report(files, hits, reqs, prepare_dictionary(d), min_keywords=2, lists=True).collect()}
    assert set(out) == {1, 2}                                 # area gate, bad number quarantined
    assert out[1].n_relevant_files == 1 and out[1].paths == "/room/a/1 x.txt, "
    assert out[2].relevant_files_found == "No" and out[2].file_names == ""


def test_request_report_by_name_pools_same_named_files(room, spark):
    files, hits, d = room
    from termscope.operators.match import prepare_dictionary
    reqs = spark.createDataFrame([("1", "IT", "the of", 1)], "request_no string, area string, sentence string, row_ord int")
    by_path = request_report(files, hits, reqs, prepare_dictionary(d), min_keywords=2).collect()[0]
    by_name = request_report(files, hits, reqs, prepare_dictionary(d), min_keywords=2, by="name", lists=True).collect()[0]
    assert by_path.n_relevant_files == 1
    # '/room/b/1 x.txt' has only 'the', but shares its name with a/1 x.txt.
    assert by_name.n_relevant_files == 1 and by_name.paths == "/room/a/1 x.txt, "


@pytest.mark.parametrize("partitions", [7, 3])
def test_sequential_row_number(spark, partitions):
    # All columns, many rows: offsets and rows must come from one partitioning.
    from termscope.operators.ordering import sequential_row_number
    df = spark.range(0, 200_000).selectExpr("lpad(cast((id * 7919) % 200000 as string), 6, '0') as k", "id", "id % 7 as other")
    got = sequential_row_number(df, "k", partitions=partitions)
    wrong = got.where("row_no <> cast(k as long) + 1")
    assert got.count() == 200_000 and wrong.count() == 0 and got.select("row_no").distinct().count() == 200_000


def test_folder_rows_at_the_root_and_in_an_object_store(spark):
    from termscope.sources.inventory import with_folders
    files = with_path_parts(spark.createDataFrame([("/top.txt",), ("/a/b/x.txt",), ("s3://bkt/k/y.txt",), ("s3://bkt/z.txt",)], "path string"))
    dirs = lambda **kw: sorted(r.path for r in with_folders(files, **kw).where("entry = 'Folder'").collect())
    assert dirs() == ["/a", "/a/b", "s3://bkt/k"]
    assert dirs(root="/a") == ["/a/b"] and dirs(root="/a/") == ["/a/b"] and dirs(root="s3://bkt") == ["s3://bkt/k"]
    assert with_folders(files, exclude_suffix="top.txt").where("entry = 'File'").count() == 3


def test_requests_with_one_number_are_judged_apart(room, spark):
    files, hits, d = room
    from termscope.operators.match import prepare_dictionary
    from termscope.plans.requests import request_report_weighted
    reqs = spark.createDataFrame([("7", "IT", "the", 1), ("7", "IT", "of", 2), ("7", "IT", "of the", 3)],
                                 "request_no string, area string, sentence string, row_ord int")
    out = {r.row_ord: r.relevant_files_found for r in request_report(files, hits, reqs, prepare_dictionary(d), min_keywords=2).collect()}
    assert out == {1: "No", 2: "No", 3: "Yes"}
    out = {r.row_ord: r.paths for r in request_report_weighted(files, hits, reqs, prepare_dictionary(d), min_score=3, lists=True).collect()}
    assert out == {1: "/room/a/1 x.txt, /room/b/1 x.txt, ", 2: "", 3: "/room/a/1 x.txt, /room/b/1 x.txt, "}


def test_request_pairs_equal_brute_force(spark):
    import random
    from termscope.operators.match import prepare_dictionary
    from termscope.plans.requests import request_matches, request_report_any, weighted_matches
    rng = random.Random(1)
    words = [f"w{i}" for i in range(14)]
    d = prepare_dictionary(spark.createDataFrame([("c", w, i) for i, w in enumerate(words)], "category string, keyword string, row_ord int"))
    reqs = [(str(i), "IT", " ".join(rng.sample(words, rng.randint(0, 8))), i) for i in range(40)]
    held = {f"/f{i}": rng.sample(words, rng.randint(1, 9)) for i in range(60)}
    rows = [(p, 1, "c", 1, w, i, rng.randint(1, 4)) for p, ws in held.items() for i, w in enumerate(ws)]
    hits = spark.createDataFrame(rows, "path string, seg_ord long, category string, cat_ord int, keyword string, kw_ord long, hits long")
    sheet = spark.createDataFrame(reqs, "request_no string, area string, sentence string, row_ord int")
    for needed in (1, 3, 5):
        got = {(r.path, r.row_ord): r.n_keywords for r in request_matches(None, hits, sheet, d, needed).collect()}
        assert got == {(p, i): n for p, ws in held.items() for _, _, s, i in reqs if (n := len(set(ws) & set(s.split()))) >= needed}
    want = {}
    for p, *_, w, _, n in rows:
        for _, _, s, i in reqs:
            if w in s:
                want[p, i] = want.get((p, i), 0) + n
    for least in (1, 6, 15):  # at 15 most sets have keywords that are no entry
        got = {(r.path, r.row_ord): r.score for r in weighted_matches(hits, sheet, d, least).collect()}
        assert got == {k: v for k, v in want.items() if v >= least}
    index = spark.createDataFrame([("/a", "a", "W1"), ("/a", "a", "w9"), ("/b", "b", ""), ("/c", "c", "it's")], "path string, file_name string, match string")
    got = {r.row_ord: r.file_names for r in request_report_any(sheet, index).collect()}
    assert got == {i: "a b" if "w1" in s or "w9" in s else "b" for _, _, s, i in reqs}


def test_scope_index_searches_by_kind_and_parses_back(spark):
    from termscope.plans.requests import parse_prior_index
    from termscope.sources.inventory import with_folders
    files = with_path_parts(spark.createDataFrame([("/r/a.txt",), ("/r/b.xlsx",), ("/r/c.zzz",)], "path string"))
    seg = spark.createDataFrame([("/r/a.txt", 1, "red\nblue and red"), ("/r/b.xlsx", 1, "blue"), ("/r/b.xlsx", 2, "l'or red"), ("/r/c.zzz", 1, "red")],
                                "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", "red", 1), ("c", "blue", 2), ("q", "l'or", 3)], "category string, keyword string, row_ord int")
    idx = reports.scope_index(with_folders(files), reports.scope_first_hits(seg, d))
    notes = {r.folder_path: r.notes for r in idx.collect()}
    assert notes["/r/a.txt"] == "Matches: ['blue', 'red']"                 # line by line
    assert notes["/r/b.xlsx"] == "Matches: ['blue', 'l\\'or']" and notes["/r/c.zzz"] == ""   # the whole workbook once
    assert sorted(r.match for r in parse_prior_index(idx.where("title = 'b.xlsx'")).collect()) == ["blue", "l'or"]


def test_inventory_lists_files(spark, tmp_path):
    from termscope.sources.inventory import list_files, with_folders
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.2 a.txt").write_text("x")
    (tmp_path / "b.csv").write_text("y")
    files = list_files(spark, str(tmp_path))
    got = {r.file_name: (r.index_number, r.file_type) for r in files.collect()}
    assert got == {"1.2 a.txt": ("1.2", "txt"), "b.csv": ("", "csv")}
    entries = with_folders(files, root=str(tmp_path))
    assert {r.file_name for r in entries.where("entry = 'Folder'").collect()} >= {"d"}


def test_keyword_files_long_form(room):
    from termscope.plans.reports import keyword_files
    files, hits, _ = room
    rows = {(r.keyword, r.path): (r.hits, r.is_max) for r in keyword_files(files, hits).collect()}
    assert rows[("the", "/room/a/1 x.txt")] == (3, True) and rows[("the", "/room/b/1 x.txt")] == (3, True)
    assert rows[("of", "/room/a/1 x.txt")] == (2, True)


def test_request_numbers_truncate_like_int(spark):
    from termscope.plans.requests import it_requests, quarantined_requests
    reqs = spark.createDataFrame([("12.0", "IT", "a", 1), ("7.9", "it\t", "b", 2), ("x1", "IT", "c", 3), ("3", "HR", "d", 4)],
                                 "request_no string, area string, sentence string, row_ord int")
    assert sorted(r.request_no for r in it_requests(reqs).collect()) == [7, 12]
    assert [r.sentence for r in quarantined_requests(reqs).collect()] == ["c"]


def test_lists_in_chunks_equal_the_rendered_lists(spark):
    """A keyword in every file: no value holds more files than a chunk may, and the chunks joined are the old lists."""
    from collections import defaultdict
    from termscope.plans.requests import request_lists, request_report
    from termscope.operators.match import prepare_dictionary
    paths = [f"/room/{i % 7}/{i % 3}.{i % 5} f{i % 40}.txt" for i in range(300)]
    files = with_path_parts(spark.createDataFrame([(p, "scanned") for p in dict.fromkeys(paths)], "path string, status string"))
    rows = [(p, i, "c", 1, k, n, i % 4 + 1) for i, p in enumerate(paths) for n, k in ((1, "the"), (2, "of")) if k == "the" or i % 9 == 0]
    hits = spark.createDataFrame(rows, "path string, seg_ord long, category string, cat_ord int, keyword string, kw_ord long, hits long")
    got = defaultdict(list)
    for r in sorted(reports.keyword_lists(files, hits, size=20).collect(), key=lambda r: r.chunk):
        assert r.n_values <= 20 and len(r["items"].split(", ")) == r.n_values and r.chunk == len(got[r.keyword, r.list]) + 1
        got[r.keyword, r.list].append(r["items"])
    for r in reports.keyword_report(files, hits, lists=True).collect():
        for name, column in (("paths", "paths"), ("file_names", "all_file_names"), ("index_numbers", "index_numbers"),
                             ("max_file_names", "max_file_names"), ("max_file_paths", "max_file_paths")):
            assert ", ".join(got[r.keyword, name]) == r[column], (r.keyword, name)
    assert len(got["the", "paths"]) >= 10
    d = prepare_dictionary(spark.createDataFrame([("c", "the", 1), ("c", "of", 2)], "category string, keyword string, row_ord int"))
    sheet = spark.createDataFrame([("1", "it", "the of", 1), ("2", "it", "the", 2)], "request_no string, area string, sentence string, row_ord int")
    from termscope.plans.requests import request_matches
    parts = defaultdict(list)
    for r in sorted(request_lists(files, request_matches(files, hits, sheet, d, 1), size=15).collect(), key=lambda r: r.chunk):
        parts[r.row_ord, r.list].append(r["items"] + ", ")
    for r in request_report(files, hits, sheet, d, 1, lists=True).collect():
        for name in ("paths", "file_names", "index_numbers"):
            assert "".join(parts[r.row_ord, name]) == r[name]


def test_scope_index_exchanges_no_text(spark):
    """Kinds come from the path: with whole documents at hand no text is shuffled."""
    seg = spark.createDataFrame([("/r/a.txt", 1, "red")], "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", "red", 1)], "category string, keyword string, row_ord int")
    plan = reports.scope_first_hits(seg, d, seg.select("path", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_terms_meet_sentences_by_their_rarest_gram(spark):
    from termscope.plans.requests import contained
    import random
    rng = random.Random(3)
    sent = [(i, "the " + "".join(rng.choices("abc d", k=rng.randint(0, 30)))) for i in range(150)] + [(900, ""), (901, None)]
    terms = ["the", "the a", "THE b", "", "a", "ab", "abc", "bca b", "zzz", "d"] + ["".join(rng.choices("abcd ", k=5)) for _ in range(60)]
    s = spark.createDataFrame(sent, "i int, s string")
    t = spark.createDataFrame([(x,) for x in terms], "t string")
    got = {(r.i, r.t) for r in contained(s, ["i"], "s", t, "t").collect()}
    assert got == {(i, x) for i, y in sent for x in terms if y is not None and x.lower() in y}
