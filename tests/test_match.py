"""Keyword matching (M1-M6) against Python's re, the reference's engine."""

import re

import pytest
from pyspark.sql import functions as F

from hypothesis import given, settings, strategies as st

from termscope.operators.match import category_hits, expand_occurrences, first_hit_per_category, keyword_hits


def py_count(keyword, text):
    return len(re.compile(r"(?<!\w)%s(?!\w)" % re.escape(keyword), flags=re.I).findall(text))


def run_hits(spark, texts, keywords):
    seg = spark.createDataFrame([(f"/f{i}", 1, t) for i, t in enumerate(texts)], "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", k, i + 1) for i, k in enumerate(keywords)], "category string, keyword string, row_ord int")
    return {(r.path, r.keyword): r.hits for r in keyword_hits(seg, d).collect()}


def test_word_bounds_fixture(spark):
    text = "LAN wan LAN-LAN lan_x WLAN C++ c++x (C++) .NET"
    got = run_hits(spark, [text], ["LAN", "C++", ".NET", "wan lan"])
    assert got == {("/f0", "LAN"): 3, ("/f0", "C++"): 2, ("/f0", ".NET"): 1, ("/f0", "wan lan"): 1}


def test_nested_overlap_and_unicode(spark):
    texts = ["the the the", "Learning and Development budget", "éthe the² theß the\nthe", "on  the on the",
             "x + y", "a.b. a.b.c"]
    kws = ["the the", "Learning", "Learning and Development", "the", "on the", "+", "a.b."]
    got = run_hits(spark, texts, kws)
    for i, t in enumerate(texts):
        for k in kws:
            assert got.get((f"/f{i}", k), 0) == py_count(k, t), (t, k)


ALPHABET = list("abcdeéßüñ_-+. \n") + ["1", "²", "A", "É", "ſ", "İ", "ı", "ς", "Σ", "σ"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=6),
       st.lists(st.text(alphabet=list("abcé_+.- 1"), min_size=1, max_size=5).filter(lambda k: k.strip()),
                min_size=1, max_size=5, unique=True))
def test_property_equals_python_re(spark, texts, kws):
    got = run_hits(spark, texts, kws)
    for i, t in enumerate(texts):
        for k in kws:
            assert got.get((f"/f{i}", k), 0) == py_count(k, t), (t, k)


def test_plan_uses_equi_join(spark):
    seg = spark.createDataFrame([("/a", 1, "on the table")], "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", "on the", 1), ("c", "table", 2)], "category string, keyword string, row_ord int")
    plan = keyword_hits(seg, d)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_expand_occurrences(spark):
    seg = spark.createDataFrame([("/a", 1, "the the x the")], "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", "the", 1)], "category string, keyword string, row_ord int")
    assert expand_occurrences(keyword_hits(seg, d)).count() == 3


def test_category_mode_priority(spark):
    # Older generation: one alternation per category; earlier keywords win and
    # nested terms of the same category hide each other.
    seg = spark.createDataFrame([("/a", 1, "Learning and Development, learning")], "path string, seg_ord long, text string")
    d = spark.createDataFrame([("HR", "Learning and Development", 1), ("HR", "Learning", 2)],
                              "category string, keyword string, row_ord int")
    rows = {(r.keyword, r.hits) for r in category_hits(seg, d).collect()}
    assert rows == {("Learning and Development", 1), ("learning", 1)}
    first = first_hit_per_category(seg, d).collect()
    assert [r.first_match for r in first] == ["Learning and Development"]


def test_large_dictionary_path_equals_broadcast_path(spark):
    # Above the broadcast bound the same hits come from shuffled joins.
    texts = ["the the the", "Learning and Development budget", "C++ and .NET on the LAN", "on  the on the"]
    kws = ["the the", "Learning and Development", "the", "on the", "C++", ".NET", "LAN", "+"]
    seg = spark.createDataFrame([(f"/f{i}", 1, t) for i, t in enumerate(texts)], "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", k, i + 1) for i, k in enumerate(kws)], "category string, keyword string, row_ord int")
    small = {(r.path, r.keyword, r.hits) for r in keyword_hits(seg, d).collect()}
    large = {(r.path, r.keyword, r.hits) for r in keyword_hits(seg, d, broadcast_limit=1).collect()}
    assert small == large
    for i, t in enumerate(texts):
        for k in kws:
            want = py_count(k, t)
            assert ((f"/f{i}", k, want) in small) == (want > 0), (t, k)


def test_category_passes_give_one_result(spark, monkeypatch):
    from termscope.operators import match
    seg = spark.createDataFrame([("/a", 1, "red hot rod and a blue ring")], "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c1", "red", 1), ("c2", "hot", 2), ("c3", "blue", 3), ("c3", "ring", 4)],
                              "category string, keyword string, row_ord int")
    one = {(r.category, r.cat_ord, r.keyword, r.hits) for r in category_hits(seg, d).collect()}
    monkeypatch.setattr(match, "PASS_CHARS", 1)
    many = {(r.category, r.cat_ord, r.keyword, r.hits) for r in category_hits(seg, d).collect()}
    assert one == many == {("c1", 1, "red", 1), ("c2", 2, "hot", 1), ("c3", 3, "blue", 1), ("c3", 3, "ring", 1)}
    large = {(r.category, r.cat_ord, r.keyword, r.hits) for r in category_hits(seg, d, broadcast_limit=3).collect()}
    assert large == one


def test_repeated_keys_and_rows_are_rows_of_their_own(spark):
    seg = spark.createDataFrame([("/a", 1, "the the"), ("/a", 1, "the + on the"), ("/a", 1, "the + on the"), ("/a", 1, None), (None, 1, "on the")],
                                "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", "the", 1), ("c", "on the", 2), ("c", "+", 3), ("c", "\U0001f600", 4)], "category string, keyword string, row_ord int")
    small = sorted(map(str, keyword_hits(seg, d).collect()))
    large = sorted(map(str, keyword_hits(seg, d, broadcast_limit=0).collect()))
    assert small == large and len(small) == 1 + 3 + 3 + 2


def test_entries_with_one_number_stay_apart(spark):
    seg = spark.createDataFrame([("/a", 1, "alpha alpha gamma")], "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", "alpha", 1), ("x", "gamma", 1), ("x", "gamma", 1), (None, "beta", 1)], "category string, keyword string, row_ord int")
    for limit in (0, 100):
        assert {(r.keyword, r.hits) for r in keyword_hits(seg, d, broadcast_limit=limit).collect()} == {("alpha", 2), ("gamma", 1)}


def test_plans_have_no_shuffle_of_segments_and_no_nested_loop(spark):
    seg = spark.createDataFrame([("/a", 1, "on the + table")] * 3, "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", "on the", 1), ("c", "table", 2), ("c", "+", 3)], "category string, keyword string, row_ord int")
    small = keyword_hits(seg, d)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(path" not in small and "seg_ord#" not in "".join(x for x in small.split("\n") if "Exchange hash" in x)
    large = keyword_hits(seg, d, broadcast_limit=0)._jdf.queryExecution().executedPlan().toString()
    for plan in (small, large):
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_find_hits_modes(spark):
    from termscope import find_hits
    seg = spark.createDataFrame([("/a", 1, "Red hot rod")], "path string, seg_ord long, text string")
    d = spark.createDataFrame([("c", "red", 1), ("c", "rod", 2)], "category string, keyword string, row_ord int")
    assert find_hits(seg, d).count() == 2
    assert {r.keyword for r in find_hits(seg, d, mode="category").collect()} == {"Red", "rod"}
    assert find_hits(seg, d, mode="cell").count() == 1
    assert [r.first_match for r in find_hits(seg, d, mode="first").collect()] == ["Red"]


def test_case_equivalences_follow_python(spark):
    texts = ["İstanbul ſun ıs the end", "ΣΟΦΟΣ σοφος σοφοσ", "µm μm KELVIN Kelvin", "STRASSE straße"]
    kws = ["istanbul", "sun", "is", "σοφοσ", "σοφος", "μm", "kelvin", "straße", "strasse"]
    got = run_hits(spark, texts, kws)
    for i, t in enumerate(texts):
        for k in kws:
            assert got.get((f"/f{i}", k), 0) == py_count(k, t), (t, k)


def test_phrases_of_one_first_word_meet_few_segments(spark):
    """10,000 phrases that begin with "the": a phrase's pattern runs where its rarest word is."""
    from termscope.operators.match import matchable, word_counts
    rows = [("c", f"the w{i} house", i + 1) for i in range(10_000)] + [("c", "the common w7", 10_001), ("c", "the", 10_002)]
    d = spark.createDataFrame(rows, "category string, keyword string, row_ord int")
    seg = spark.range(400).selectExpr("concat('/f', id) as path", "1L as seg_ord",
                                      "concat('the house the w', id, ' house and the common w', id % 50, ' the the') as text")
    prepared = matchable(d)
    assert prepared.where("keyword = 'the w5 house'").first().probe == "w5"
    candidates = seg.selectExpr("explode(array_distinct(split(text, ' '))) as probe").join(prepared.where("not single"), "probe").count()
    assert candidates <= 3 * seg.count()  # the first word would give 10,000 for each segment
    hits = keyword_hits(seg, prepared, prepared=True)
    got = {(r.path, r.keyword): r.hits for r in hits.collect()}
    want = {(f"/f{i}", f"the w{i} house"): 1 for i in range(400)} | {(f"/f{i}", "the"): 5 for i in range(400)}
    assert got == want | {(f"/f{i}", "the common w7"): 1 for i in range(7, 400, 50)}
    counts = word_counts(seg, d)
    assert {r.word: r.n for r in counts.where("word in ('the', 'house', 'w60')").collect()} == {"the": 400, "house": 400, "w60": 1}
    by_corpus = matchable(d, counts=counts)
    assert by_corpus.where("keyword = 'the common w7'").first().probe == "w7"
    assert sorted(map(str, keyword_hits(seg, by_corpus, prepared=True).collect())) == sorted(map(str, hits.collect()))


def test_words_outside_the_dictionary_stay_out_of_the_shuffle(spark):
    """The Bloom filter lets every probe pass and few other words."""
    from termscope.operators.match import maybe_in
    d = spark.range(3000).selectExpr("concat('key ', id) as k")
    words = spark.range(100_000).selectExpr("concat('key ', id) as w")
    passed = {r.w for r in words.where(maybe_in(F.col("w"), d, "k")).collect()}
    assert passed >= {f"key {i}" for i in range(3000)} and len(passed) < 3000 + 0.05 * 97_000
    none = words.where(maybe_in(F.col("w"), d.where("false"), "k"))
    assert none.count() == 0


def _modes(seg, d, **kw):
    from termscope.operators.match import cell_hits
    return [sorted(map(str, fn(seg, d, **kw).collect())) for fn in (category_hits, cell_hits, first_hit_per_category)]


@pytest.mark.parametrize("escape", [False, True])
def test_category_modes_of_any_dictionary_size(spark, escape):
    """By candidates or as one alternation: equal on random texts, with nested, overlapping and symbol-edged terms."""
    import random
    rng = random.Random(escape)
    bits = ["a", "b", "ab", "c", "é", "Ab", "c++", ".x", "-", "_", "1"]
    terms = list(dict.fromkeys("".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 3))).strip() for _ in range(60)))
    terms = [t for t in terms if escape or not re.search(r"[+.]", t)]
    if not escape:
        terms += ["a.", "[bc]+", "(?:ab|1) c"]  # live in every alternation
    d = spark.createDataFrame([(f"c{i % 4}", t, i) for i, t in enumerate(terms)], "category string, keyword string, row_ord int")
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 25))) for _ in range(150)]
    seg = spark.createDataFrame([(f"/f{i % 140}", 1, t) for i, t in enumerate(texts)] + [("/n", 1, None), (None, 1, "a b"), (None, 1, "a b")],
                                "path string, seg_ord long, text string")
    if escape:
        one, many = (sorted(map(str, category_hits(seg, d, escape=True, broadcast_limit=n).collect())) for n in (1000, 3))
        assert one == many and len(one) > 100
    else:
        assert _modes(seg, d) == _modes(seg, d, broadcast_limit=10)
        with pytest.raises(ValueError, match="live"):
            category_hits(seg, d, broadcast_limit=2)


def test_category_mode_with_half_a_million_terms(spark):
    d = spark.range(500_000).selectExpr("concat('c', id % 3) as category", "concat('term', id, if(id % 2 = 0, ' x', '')) as keyword", "id as row_ord")
    seg = spark.createDataFrame([(f"/f{i}", 1, f"Term{i} x, term{i * 2} x term{i * 2 + 1} nothing term{500_000 + i}") for i in range(50)],
                                "path string, seg_ord long, text string")
    got = {(r.path, r.category, r.keyword): r.hits for r in category_hits(seg, d).collect()}
    want = {}
    for i in range(50):
        for k, text in ((i, f"Term{i}" + (" x" if i % 2 == 0 else "")), (i * 2, f"term{i * 2} x"), (i * 2 + 1, f"term{i * 2 + 1}")):
            want[f"/f{i}", f"c{k % 3}", text] = want.get((f"/f{i}", f"c{k % 3}", text), 0) + 1
    assert got == want
