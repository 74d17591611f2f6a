"""Smaller sources, sinks and helpers."""

import csv
import glob


from termscope.functions.text import is_nan
from termscope.sinks.writers import export_quoted_csv, write_report
from termscope.sources.dictionary import extra_dictionary
from termscope.sources.inventory import last_file, select_prefix


def test_select_prefix(spark):
    keys = spark.createDataFrame([("g1/room/a.txt",), ("g1/room/",), ("g1/other/b.txt",), ("g1/room/x/c.csv",)], "key string")
    assert sorted(r.key for r in select_prefix(keys, "g1/room/").collect()) == ["g1/room/a.txt", "g1/room/x/c.csv"]


def test_last_file(spark):
    files = spark.createDataFrame([("/r/a.xlsx",), ("/r/b.xlsx",)], "path string")
    assert last_file(files).collect()[0].path == "/r/b.xlsx"


def test_extra_dictionary(spark):
    d = spark.createDataFrame([("IT Spend", "budget", 1)], "category string, keyword string, row_ord int")
    extra = spark.createDataFrame([("User_Input", "LAN", 10), ("Other", "x", 11)], "category string, keyword string, row_ord int")
    got = sorted((r.category, r.keyword) for r in extra_dictionary(d, extra).collect())
    assert got == [("IT Spend", "budget"), ("User_Input", "LAN")]
    # Terms without numbers, or with clashing ones, come after the dictionary.
    bare = extra_dictionary(d, extra.drop("row_ord")).orderBy("row_ord").collect()
    assert [r.keyword for r in bare] == ["budget", "LAN"] and bare[1].row_ord > bare[0].row_ord


def test_is_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in df.select(is_nan("v")).collect()] == [False, True, True]


def test_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a, b", 1)], "name string, n int")
    export_quoted_csv(df, str(tmp_path / "q"))
    lines = [l.strip() for f in sorted(glob.glob(str(tmp_path / "q" / "*.csv"))) for l in open(f) if l.strip()]
    assert lines == ['"a, b","1"']
    write_report(df, str(tmp_path / "r"), fmt="csv")
    rows = [r for f in sorted(glob.glob(str(tmp_path / "r" / "*.csv"))) for r in csv.reader(open(f)) if r]
    assert ["name", "n"] in rows                        # every part file starts with the header
    assert [r for r in rows if r != ["name", "n"]] == [["a, b", "1"]]


def test_live_patterns_against_python(spark):
    """P10b unescaped and escaped, against Python's re on random lines."""
    import random
    import re
    from termscope.operators.match import category_hits
    from termscope.plans.room_files import LIVE_TERMS
    rng = random.Random(2)
    lines = [" ".join(rng.choices(["this", "thus", "ths", "and", "an", "or", "of", "to", "é", "ee", "e.", "et", "e", "th s"], k=8)) for _ in range(200)]
    seg = spark.createDataFrame([(str(i), 1, t) for i, t in enumerate(lines)], "path string, seg_ord long, text string")
    for escape in (False, True):
        d = spark.createDataFrame([(c, k, i) for i, (c, k) in enumerate(LIVE_TERMS)], "category string, keyword string, row_ord int")
        got = {(int(r.path), r.category, r.keyword): r.hits for r in category_hits(seg, d, escape=escape).collect()}
        want = {}
        for c in ("Live", "Other"):
            terms = [re.escape(k) if escape else k for cat, k in LIVE_TERMS if cat == c]
            pattern = re.compile("|".join(rf"\b{k}\b" for k in terms), re.I)
            for i, t in enumerate(lines):
                for m in pattern.finditer(t):
                    want[i, c, m.group()] = want.get((i, c, m.group()), 0) + 1
        assert got == want, escape
