"""Request reports (R4, R4b, R4c; J4, J5, A13, A14, A22, A23, P15, S19, S20).

A request is a row of the request sheet: ``request_no, area, sentence,
row_ord``. Only rows whose area is ``it`` (trimmed, any case) are reported, and
each row is judged by itself, also when two carry one number; a request number
that is not an integer is quarantined (the reference aborts the whole sheet).

Plan: requests with the same keywords are one set, and each file has its
keywords in one row (bounded by the dictionary), both in one order: the rarest
keyword first. Relevant pairs of file and set are a set-threshold join by a
prefix filter: a pair that shares ``needed`` keywords shares one among the first
``size - needed + 1`` of either side, so only those are joined; of the keywords
that a pair shares there, the first makes the pair, and only if enough may
follow it on both sides. For the weighted report a set's prefix leaves out the
keywords that even their largest counts in any file cannot lift to the score.
One plan serves sheets, dictionaries and collections of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import python_strip, yes_no
from ..operators.lists import chunked_lists, ordered_values, render
from ..operators.match import DEFAULT_BROADCAST_LIMIT, keyword_hits
from ..operators.ordering import sequential_row_number
from .materialize import materialize

IT_AREA = "it"


def request_number(value) -> "F.Column":
    """The sheet's number cell as an integer. Numeric cells arrive as
    floats (``12.0``) and are truncated as ``int()`` does; text that is not a
    number gives null (the row is quarantined)."""
    return python_strip(value.cast("string")).try_cast("double").try_cast("long").try_cast("int")


def _in_area(requests: DataFrame) -> DataFrame:
    return requests.where(F.lower(python_strip("area")) == IT_AREA)


def it_requests(requests: DataFrame) -> DataFrame:
    """Area gate and integer request number (bad numbers dropped
    here, listed by ``quarantined_requests``). ``row_ord`` tells rows apart."""
    if "row_ord" not in requests.columns:
        raise ValueError("requests need row_ord, the row's place in the sheet")
    return (_in_area(requests).withColumn("request_no", request_number(F.col("request_no")))
                              .where(F.col("request_no").isNotNull()))


def quarantined_requests(requests: DataFrame) -> DataFrame:
    return _in_area(requests).where(request_number(F.col("request_no")).isNull())


def contained(sentences: DataFrame, key: list[str], sentence: str, terms: DataFrame, term: str) -> DataFrame:
    """M6: (key, term) for every term contained in a sentence (substring, any
    case, no word bounds). An equi-join on three-character grams finds the
    candidates, ``contains`` decides; of a term's grams the one in the fewest
    sentences is its probe, so a gram that every sentence has meets only terms
    all of whose grams are as frequent. Shorter terms are their own probe."""
    s = sentences.select(*key, F.lower(sentence).alias("_s"))
    at = F.sequence(F.lit(1), F.greatest(F.length("_s"), F.lit(1)))
    grams = F.array_distinct(F.concat(*[_grams("_s", at, n) for n in (1, 2, 3)], F.array(F.lit(""))))
    held = s.withColumn("_g", F.explode(grams))
    t = terms.select(F.col(term).alias("_term"), F.lower(term).alias("_t")).distinct()
    own = F.when(F.length("_t") <= 3, F.array("_t")).otherwise(
        F.array_distinct(_grams("_t", F.sequence(F.lit(1), F.length("_t") - 2), 3)))
    t = t.withColumn("_g", F.explode(own))
    counts = held.select("_g").join(t.select("_g").distinct(), "_g").groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    # A gram that no sentence has rules its terms out.
    least = t.join(counts, "_g", "left").groupBy("_term", "_t").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("_m")).where("_m.n > 0").select("_term", "_t", "_m._g")
    return held.join(least, "_g").where(F.contains("_s", "_t")).select(*key, F.col("_term").alias(term)).distinct()


def _grams(text: str, at: Column, n: int) -> Column:
    return F.transform(at, lambda i: F.substring(F.col(text), i, F.lit(n)))


def _sets(request_keywords: DataFrame) -> DataFrame:
    """(row_ord, keyword) -> one row per distinct keyword set: ``set_id``, ``kws`` (sorted), ``rows`` (its requests)."""
    per = request_keywords.groupBy("row_ord").agg(F.array_sort(F.collect_set("keyword")).alias("kws"))
    return (per.groupBy("kws").agg(F.sort_array(F.collect_list("row_ord")).alias("rows"))
               .select(F.element_at("rows", 1).alias("set_id"), "kws", "rows"))


def _numbered(hits: DataFrame, by: str, files: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(per file: ``path``, ``kws``: its keywords as (number, hits), rarest first;
    per keyword: ``keyword``, its ``number`` and the largest ``most`` hits of a file)."""
    per = hits.groupBy("path", "keyword").agg(F.sum("hits").alias("n"))
    if by == "name":
        # A13 parity: the reference collects keywords per file *name*, so
        # same-named files in different folders pool their keywords; the
        # name's first path stands for it in the lists.
        per = per.join(files.select("path", "file_name"), "path")
        first = per.groupBy("file_name").agg(F.min("path").alias("path"))
        per = per.groupBy("file_name", "keyword").agg(F.sum("n").alias("n")).join(first, "file_name").drop("file_name")
    per = materialize(per.select("path", "keyword", "n"), "file-keywords")
    known = per.groupBy("keyword").agg(F.count(F.lit(1)).alias("df"), F.max("n").alias("most"))
    # One ordered pass over the dictionary's keywords that occur.
    known = materialize(known.select("keyword", "most", F.row_number().over(Window.orderBy("df", "keyword")).alias("number")), "keyword-numbers")
    own = per.join(known.select("keyword", "number"), "keyword").groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("number", "n"))).alias("kws"))
    return own, known


def _numbered_sets(sets: DataFrame, known: DataFrame) -> DataFrame:
    """``set_id, kws, most``: the numbers of a set's keywords that occur in any file, rarest first, and their largest counts."""
    return (sets.select("set_id", F.explode("kws").alias("keyword")).join(known, "keyword")
                .groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("number", "most"))).alias("_k"))
                .select("set_id", F.col("_k.number").alias("kws"), F.col("_k.most").alias("most")))


def _threshold_pairs(own: DataFrame, sets: DataFrame, needed: int) -> DataFrame:
    """(path, set_id, n_keywords) of the pairs that share ``needed`` keywords."""
    files = own.select("path", F.col("kws.number").alias("fkws")).where(F.size("fkws") >= needed)
    sets = sets.select("set_id", "kws").where(F.size("kws") >= needed)
    left = files.select("path", "fkws", F.posexplode(F.slice("fkws", F.lit(1), F.size("fkws") - (needed - 1))).alias("_j", "number"))
    right = sets.select("set_id", "kws", F.posexplode(F.slice("kws", F.lit(1), F.size("kws") - (needed - 1))).alias("_i", "number"))
    met = left.join(right, "number").where(F.least(F.size("kws") - F.col("_i"), F.size("fkws") - F.col("_j")) >= needed)
    met = met.where(~F.arrays_overlap(F.slice("kws", F.lit(1), F.col("_i")), F.slice("fkws", F.lit(1), F.col("_j"))))
    met = met.withColumn("n_keywords", F.size(F.array_intersect("kws", "fkws")).cast("long"))
    return met.where(F.col("n_keywords") >= needed).select("path", "set_id", "n_keywords")


def _scored_pairs(own: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(path, set_id, score) of the pairs whose hits of the set's keywords reach ``least``."""
    # Keywords by falling largest count; those after which all the rest together stay under ``least`` are no entry to the set.
    ranked = sets.select("set_id", "kws", F.sort_array(F.arrays_zip("most", "kws"), asc=False).alias("_m"))
    entries = ranked.select("set_id", "kws", F.posexplode("_m").alias("_p", "_e"), "_m")
    rest = F.aggregate(F.slice("_m", F.col("_p") + 1, F.size("_m")), F.lit(0).cast("long"), lambda acc, m: acc + m["most"])
    entries = entries.where(rest >= least).select("set_id", "kws", F.col("_e.kws").alias("number"))
    entries = entries.groupBy("set_id", "kws").agg(F.sort_array(F.collect_list("number")).alias("_in"))
    right = entries.select("set_id", "kws", F.posexplode("_in").alias("_i", "number"), "_in")
    left = own.select("path", F.col("kws.number").alias("fkws"), F.map_from_entries("kws").alias("_n"), F.explode("kws.number").alias("number"))
    met = left.join(right, "number").where(~F.arrays_overlap(F.slice("_in", F.lit(1), F.col("_i")), F.col("fkws")))
    score = F.aggregate(F.array_intersect("kws", "fkws"), F.lit(0).cast("long"), lambda acc, k: acc + F.element_at("_n", k))
    return met.withColumn("score", score).where(F.col("score") >= least).select("path", "set_id", "score")


def _request_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of sets as pairs of the sets' requests."""
    return (pairs.join(sets.select("set_id", F.explode("rows").alias("row_ord")), "set_id").drop("set_id"))


def _roll_up(reqs: DataFrame, pairs: DataFrame, sets: DataFrame, files: DataFrame, lists: bool) -> DataFrame:
    """Per request the flag, the number of relevant files and (with
    ``lists``) the three lists (trailing ``", "``); requests without a relevant
    file are kept. Requests with one keyword set share one aggregate."""
    n = F.coalesce(F.col("n_relevant_files"), F.lit(0)).cast("long")
    head = [F.col("request_no").cast("long").alias("request_no"), F.col("row_ord").cast("long").alias("row_ord"), "request",
            yes_no(n > 0).alias("relevant_files_found"), n.alias("n_relevant_files")]
    sheet = reqs.select("request_no", "row_ord", F.col("sentence").alias("request")).join(
        sets.select("set_id", F.explode("rows").alias("row_ord")), "row_ord", "left")
    if not lists:
        return sheet.join(pairs.groupBy("set_id").agg(F.count(F.lit(1)).alias("n_relevant_files")), "set_id", "left").select(*head)
    rel = pairs.join(files.select("path", "file_name", "index_number"), "path")
    # One list per set (path order), rendered three ways.
    agg = rel.groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("path", "file_name", "index_number"))).alias("_f"))

    def listed(field):
        return render(F.transform("_f", lambda x: x[field]), trailing=True).alias(f"_{field}")
    agg = agg.select("set_id", F.size("_f").alias("n_relevant_files"), listed("file_name"), listed("index_number"), listed("path"))
    return sheet.join(agg, "set_id", "left").select(
        *head, *[F.coalesce(f"_{c}", F.lit("")).alias(name) for c, name in
                 (("file_name", "file_names"), ("index_number", "index_numbers"), ("path", "paths"))])


def _keyword_pairs(files: DataFrame, hits: DataFrame, requests: DataFrame, dictionary: DataFrame, min_keywords: int,
                   broadcast_limit: int, by: str) -> tuple[DataFrame, DataFrame]:
    """(relevant pairs of file and keyword set, the sets)."""
    reqs = it_requests(requests).select("row_ord", "sentence")
    req_kw = keyword_hits(reqs, dictionary, key=("row_ord",), text="sentence",
                          broadcast_limit=broadcast_limit, prepared=True).select("row_ord", "keyword").distinct()
    sets = materialize(_sets(req_kw), "request-sets")
    own, known = _numbered(hits, by, files)
    return _threshold_pairs(own, _numbered_sets(sets, known), min_keywords), sets


def request_matches(files: DataFrame, hits: DataFrame, requests: DataFrame,
                    dictionary: DataFrame, min_keywords: int = 5,
                    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, by: str = "path") -> DataFrame:
    """Relevant (request row, file) pairs with the number of the file's
    distinct keywords found (word-bounded) in the request sentence.

    ``dictionary`` is the run's (prepared) dictionary: a keyword absent from
    every file pairs with no file, so matching requests against the whole
    dictionary gives the same pairs without a pass over the hits."""
    return _request_pairs(*_keyword_pairs(files, hits, requests, dictionary, min_keywords, broadcast_limit, by))


def request_report(files: DataFrame, hits: DataFrame, requests: DataFrame, dictionary: DataFrame,
                   min_keywords: int = 5, broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, by: str = "path",
                   lists: bool = False) -> DataFrame:
    """Per IT request row, the files with at least ``min_keywords`` distinct
    file keywords in the request (by path; the reference merges same-named
    files). The pairs themselves are :func:`request_matches`; ``lists=True``
    renders them as the spreadsheet's list columns."""
    pairs, sets = _keyword_pairs(files, hits, requests, dictionary, min_keywords, broadcast_limit, by)
    return _roll_up(it_requests(requests), pairs, sets, files, lists)


def request_lists(files: DataFrame, pairs: DataFrame, size: int = 10_000) -> DataFrame:
    """A14's lists for collections of any size: ``row_ord, list, chunk, n_values,
    items`` (``paths``, ``file_names``, ``index_numbers`` in path order) from
    ``request_matches`` or ``weighted_matches``, in chunks of at most ``size``
    files, which joined are the lists of the report."""
    numbered = sequential_row_number(files.select("path", "file_name", "index_number"), "path", "no")
    names = {"paths": "path", "file_names": "file_name", "index_numbers": "index_number"}
    values = F.explode(F.array(*[F.struct(F.lit(n).alias("list"), F.col(c).alias("value")) for n, c in names.items()])).alias("v")
    rows = pairs.select("row_ord", "path").join(numbered, "path").select("row_ord", "no", values).select("row_ord", "no", "v.*")
    return chunked_lists(rows, ["row_ord", "list"], size)


def _weighted_pairs(hits: DataFrame, requests: DataFrame, dictionary: DataFrame, min_score: int) -> tuple[DataFrame, DataFrame]:
    reqs = it_requests(requests).select("row_ord", "sentence")
    sets = materialize(_sets(contained(reqs, ["row_ord"], "sentence", dictionary.select("keyword"), "keyword")), "request-sets")
    own, known = _numbered(hits, "path", None)
    return _scored_pairs(own, _numbered_sets(sets, known), min_score), sets


def weighted_matches(hits: DataFrame, requests: DataFrame, dictionary: DataFrame, min_score: int = 5) -> DataFrame:
    """(path, row_ord, score) pairs at ``min_score``: the sum of the file's
    hits of every keyword contained (as a substring, any case) in the request."""
    return _request_pairs(*_weighted_pairs(hits, requests, dictionary, min_score))


def request_report_weighted(files: DataFrame, hits: DataFrame, requests: DataFrame,
                            dictionary: DataFrame, min_score: int = 5, lists: bool = False) -> DataFrame:
    """R4b (A22). The reference parsed the counts back from the rendered
    keyword-details text; this uses the hits themselves."""
    pairs, sets = _weighted_pairs(hits, requests, dictionary, min_score)
    return _roll_up(it_requests(requests), pairs, sets, files, lists)


def _met_files(requests: DataFrame, index_matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``path, file_name, classes`` of the index's files that a request meets; ``classes, rows``: the requests of each).

    Terms that the same request rows contain are one class, named by its least
    term. A file is known by the set of its terms' classes, of which there are
    far fewer than match lists, and each set's request rows are found once."""
    reqs = requests.where(request_number(F.col("request_no")).isNotNull()).select("row_ord", "sentence")
    rt = contained(reqs, ["row_ord"], "sentence", index_matches.select("match").distinct(), "match")
    # Structs, as collect_list() leaves nulls out.
    held = rt.groupBy("match").agg(F.sort_array(F.collect_list(F.struct("row_ord"))).alias("_r")).select("match", F.col("_r.row_ord").alias("rows"))
    classes = materialize(held.groupBy("rows").agg(F.min("match").alias("class"), F.collect_list("match").alias("matches")), "term-classes")
    class_of = classes.select("class", F.explode("matches").alias("match"))
    files = index_matches.join(_small(class_of, DEFAULT_BROADCAST_LIMIT), "match").groupBy("path", "file_name").agg(
        F.sort_array(F.collect_set("class")).alias("classes"))
    files = materialize(files, "met-files")
    sets = files.select("classes").distinct()
    rows = sets.select("classes", F.explode("classes").alias("class")).join(classes.select("class", "rows"), "class").groupBy("classes").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("rows")))).alias("rows"))
    return files, rows


def any_matches(requests: DataFrame, index_matches: DataFrame) -> DataFrame:
    """(row_ord, path, file_name) of the scope index's files whose match
    list holds any term contained in the sentence (no area gate)."""
    files, rows = _met_files(requests, index_matches)
    return files.join(rows, "classes").select(F.explode("rows").alias("row_ord"), "path", "file_name")


# Files of a cell of the name lists; pairs of row set and request row that are broadcast.
CELL_FILES, BROADCAST_PAIRS = 10_000, 1_000_000


def _small(df: DataFrame, most: int) -> DataFrame:
    """``df`` to be broadcast, if it has ``most`` rows or fewer."""
    return F.broadcast(df) if df.count() <= most else df


def request_report_any(requests: DataFrame, index_matches: DataFrame, size: int = CELL_FILES) -> DataFrame:
    """R4c (A23, M6): per request row with a match, the number of files and
    their names, space-separated in path order (the reference's one cell; the
    pairs themselves are :func:`any_matches`). ``index_matches``: ``path,
    file_name, match`` (one row per term, as S20 parses it back).

    Files that the same request rows meet are one set, request rows that meet the
    same sets are one group. The files in order are cut into cells of ``size``;
    a cell's names move as one list per set to the groups that meet it and are
    ordered and joined there, and a group's value is put together from its
    cells' texts, once for all of its requests."""
    files, rows = _met_files(requests, index_matches)
    sets = rows.groupBy("rows").agg(F.collect_list("classes").alias("_all")).withColumn("set", F.monotonically_increasing_id())
    sets = materialize(sets, "file-sets")
    met = sets.select("set", F.explode("rows").alias("row_ord")).where("row_ord is not null")
    groups = met.groupBy("row_ord").agg(F.sort_array(F.collect_list("set")).alias("sets"))
    groups = groups.groupBy("sets").agg(F.collect_list("row_ord").alias("rows")).withColumn("group", F.monotonically_increasing_id())
    groups = materialize(groups, "request-groups")
    numbered = sequential_row_number(files.select(F.struct("path", "file_name").alias("_o"), "classes"), "_o", "no")
    names = numbered.join(_small(sets.select("set", F.explode("_all").alias("classes")), DEFAULT_BROADCAST_LIMIT), "classes").groupBy(
        F.expr(f"(no - 1) div {size}").alias("_cell"), "set").agg(F.collect_list(F.struct("no", "_o.file_name")).alias("_f"))
    cells = names.join(_small(groups.select("group", F.explode("sets").alias("set")), BROADCAST_PAIRS), "set").groupBy("group", "_cell").agg(
        F.sort_array(F.flatten(F.collect_list("_f"))).alias("_f"))
    named = F.filter("_f.file_name", lambda v: v.isNotNull())
    cells = cells.select("group", "_cell", F.size("_f").alias("_n"), F.when(F.size(named) > 0, F.array_join(named, " ")).alias("_text"))
    per = cells.groupBy("group").agg(F.sum("_n").cast("long").alias("n_files"),
                                     F.array_join(ordered_values(F.col("_cell"), F.col("_text")), " ").alias("file_names"))
    sheet = requests.select("row_ord", request_number(F.col("request_no")).cast("long").alias("request_no"))
    sheet = sheet.join(groups.select("group", F.explode("rows").alias("row_ord")), "row_ord")
    return _small(sheet, BROADCAST_PAIRS).join(per, "group").select(
        "request_no", F.col("row_ord").cast("long").alias("row_ord"), "n_files", "file_names")


def parse_prior_index(index: DataFrame, notes: str = "notes") -> DataFrame:
    """``Matches: ['a', 'b']`` back into one row per term (an apostrophe or
    backslash of a term comes escaped)."""
    found = F.regexp_extract_all(F.col(notes), F.lit(r"'((?:[^'\\]|\\.)*)'"), F.lit(1))
    return (index.select("*", F.explode(found).alias("match"))
                 .withColumn("match", F.trim(F.regexp_replace("match", r"\\(.)", "$1"))))
