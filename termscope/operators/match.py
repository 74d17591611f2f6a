"""Matching segments against a keyword dictionary.

The reference loops over every text and every keyword pattern. Here the regex
theta-join becomes one equi-join on tokens:

* a segment is split into folded tokens once; its distinct tokens are exploded
  and joined to the dictionary on the keyword's probe, one of its words;
* only a token that the dictionary has is counted, inside the row. A single-word
  keyword's hits are the token's count; for a phrase or a keyword with symbols
  the exact pattern counts, on the segment's text, only where the probe occurs;
* a phrase's probe is its rarest word: by the documents that hold it where
  ``word_counts`` are given, else by the dictionary's phrases that hold it;
* a keyword without any word character is probed by its first character, and
  segments then offer their distinct non-word characters as tokens too.

Each segment row gives one row per keyword found in it; segments that share a
key stay rows of their own. A dictionary within ``broadcast_limit`` rows is
broadcast: one scan, one generator, one hash join, no shuffle. Beyond it the
same join is shuffled without the text, only the tokens that pass a Bloom filter
of the probes, and only segments with a candidate phrase meet their text again;
the result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.patterns import (NON_WORD_RUN, WORD_RUN, category_alternation, fold, is_single_word,
                                  keyword_pattern)

# Largest dictionary (rows) that is broadcast and inlined into the plan.
DEFAULT_BROADCAST_LIMIT = 200_000

# A character that is neither part of a word nor blank.
MARK = r"[^\p{L}\p{N}_\s]"

DICT_COLS = ["category", "cat_ord", "keyword", "kw_ord"]


def prepare_dictionary(dictionary: DataFrame) -> DataFrame:
    """Normalise a dictionary to ``category, cat_ord, keyword, kw_ord``.

    ``dictionary`` has ``category, keyword`` and a ``row_ord`` giving its order
    (category order = order of first appearance, as the reference iterates a
    dict built in row order). Entries are numbered anew by (``row_ord``,
    category, keyword), so ``kw_ord`` identifies an entry whatever numbers the
    sources carried; an entry repeated with all three equal counts once. Blank
    keywords are dropped (F8): an empty pattern matches zero-width.
    """
    d = (dictionary.where(F.col("keyword").isNotNull() & (F.trim("keyword") != ""))
         .select("category", "keyword", F.col("row_ord").cast("long").alias("row_ord")).distinct())
    d = d.withColumn("_first", F.min("row_ord").over(Window.partitionBy("category")))
    # A dictionary's numbers come from one ordered pass over it (its rows, not the corpus's).
    number = F.row_number().over(Window.orderBy("row_ord", "category", "keyword")).cast("long")
    cat_ord = F.dense_rank().over(Window.orderBy("_first", "category")).cast("int")
    return d.select("category", cat_ord.alias("cat_ord"), "keyword", number.alias("kw_ord"))


def _with_match_columns(d: DataFrame, counts: DataFrame | None) -> DataFrame:
    mark = F.regexp_extract(fold(F.col("keyword")), MARK, 0)
    d = (d.withColumn("_words", F.array_distinct(F.regexp_extract_all(fold(F.col("keyword")), F.lit(WORD_RUN), F.lit(0))))
          .withColumn("single", is_single_word(F.col("keyword"))).withColumn("symbolic", F.size("_words") == 0)
          .withColumn("pattern", keyword_pattern(F.col("keyword"))))
    words = d.select("*", F.explode_outer("_words").alias("_w")).drop("_words")
    words = words.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy("_w")))
    if counts is not None:
        words = words.join(counts.select(F.col("word").alias("_w"), F.col("n").alias("_n")), "_w", "left")
    else:
        words = words.withColumn("_n", F.lit(0))
    order = F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_k", (-F.length("_w")).alias("l"), "_w")
    rarest = words.groupBy(*d.drop("_words").columns).agg(F.min_by("_w", order).alias("_probe"))
    return rarest.withColumn("probe", F.coalesce("_probe", mark)).drop("_probe")


def word_counts(segments: DataFrame, dictionary: DataFrame, text: str = "text") -> DataFrame:
    """``word, n``: in how many segments each word of the dictionary's phrases
    occurs, exactly; one pass over the text, for ``matchable``."""
    words = dictionary.where(~is_single_word(F.col("keyword"))).select(
        F.explode(F.regexp_extract_all(fold(F.col("keyword")), F.lit(WORD_RUN), F.lit(0))).alias("word")).distinct()
    held = segments.select(F.explode(F.array_distinct(_tokens(F.col(text), False))).alias("word"))
    return held.join(words, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def matchable(dictionary: DataFrame, prepared: bool = False, counts: DataFrame | None = None) -> DataFrame:
    """The dictionary with its probe and pattern columns. A run prepares it
    once and passes it to every match with ``prepared=True``. ``counts``: see
    ``word_counts``."""
    if "pattern" in dictionary.columns:
        return dictionary
    d = dictionary if prepared else prepare_dictionary(dictionary)
    return _with_match_columns(d, counts).select(*DICT_COLS, "probe", "single", "symbolic", "pattern")


def _tokens(text: Column, symbols: bool) -> Column:
    """The folded words of a text, repeats included; with ``symbols`` its distinct non-word characters, too."""
    words = F.split(fold(text), NON_WORD_RUN)
    if symbols:
        # Blanks separate and are never probes.
        words = F.concat(words, F.array_distinct(F.regexp_extract_all(fold(text), F.lit(MARK), F.lit(0))))
    return words


def _local(d: DataFrame, most: int) -> tuple[DataFrame | None, bool]:
    """A dictionary of at most ``most`` rows, computed once, as rows of the plan
    (None for a larger one); and whether it has keywords without a word."""
    table = d.limit(most + 1).toArrow()
    if table.num_rows > most:
        return None, not d.where("symbolic").isEmpty()
    return d.sparkSession.createDataFrame(table, d.schema), True in table["symbolic"].to_pylist()


def _phrase_hits(text: Column, pattern: Column, edge: Column | None) -> Column:
    """Matches of a phrase's pattern. In a window of a file (``edge``, see
    ``sources.chunks``) that another one follows, a match needs a character after
    it; in an edge row it must cross from one window to the next."""
    if edge is None:
        return F.regexp_count(text, pattern).cast("long")
    beyond = F.concat(F.lit("(?s:.{"), edge + 1, F.lit("})"))
    bounded = F.when(edge.isNull(), pattern).when(edge < 0, F.concat(pattern, F.lit("(?=(?s:.))"))).otherwise(
        F.concat(F.lit("(?="), beyond, F.lit(")"), pattern, F.lit("(?!"), beyond, F.lit(")")))
    return F.regexp_count(text, bounded).cast("long")


def keyword_hits(segments: DataFrame, dictionary: DataFrame,
                 key: Sequence[str] = ("path", "seg_ord"), text: str = "text",
                 broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                 prepared: bool = False) -> DataFrame:
    """Every non-overlapping, word-bounded, case-insensitive occurrence
    of every keyword (each keyword independently), counted per segment.

    Returns ``*key, category, cat_ord, keyword, kw_ord, hits`` (hits > 0,
    BIGINT), keyword spelled as in the dictionary. Segments with a column
    ``edge`` are windows of files (``sources.chunks.text_segments``): each gives
    rows of its own, and their hits add up to the file's.
    """
    key = list(key)
    d = matchable(dictionary, prepared)
    local, symbols = _local(d, broadcast_limit)
    words = _tokens(F.col(text), symbols)
    own = ["edge"] if "edge" in segments.columns else []
    edge = F.col("edge") if own else None
    # Words end with their window: an edge row holds parts of words, and counts phrases only.
    single = F.col("single") & (edge.isNull() | (edge < 0)) if own else F.col("single")
    if local is not None:
        # Joined first, counted after: few of a text's words are in the dictionary.
        rows = (segments.select(*key, text, *own, words.alias("_words"))
                .select(*key, text, *own, "_words", F.explode(F.array_distinct("_words")).alias("probe")))
        count = (F.size("_words") - F.size(F.array_remove("_words", F.col("probe")))).cast("long")
        hits = F.when(F.col("single"), F.when(single, count).otherwise(0)).otherwise(_phrase_hits(F.col(text), F.col("pattern"), edge))
        return (rows.join(F.broadcast(local), "probe").withColumn("hits", hits).where("hits > 0")
                    .select(*key, "category", "cat_ord", "keyword", "kw_ord", "hits"))
    # Shuffled by token, without the text; a segment is known by its key and digest.
    seg = segments.select(*key, text, *own).withColumn("_digest", F.xxhash64(text, F.length(text), *own))
    ids = [*key, "_digest", *own]
    probes = seg.select(*ids, words.alias("_words")).select(*ids, "_words", F.explode(F.array_distinct("_words")).alias("probe"))
    probes = probes.where(maybe_in(F.col("probe"), d, "probe"))
    rows = probes.select(*ids, "probe", (F.size("_words") - F.size(F.array_remove("_words", F.col("probe")))).cast("long").alias("n"))
    found = rows.join(d, "probe")
    out = [*DICT_COLS, "hits"]
    singles = found.where(single).withColumn("hits", F.col("n")).select(*key, *out)
    cand = found.where("not single").select(*ids, *DICT_COLS, "pattern").distinct()
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in ids]
    on = same[0]
    for c in same[1:]:
        on = on & c
    matches = _phrase_hits(F.col(f"s.{text}"), F.col("c.pattern"), F.col("s.edge") if own else None)
    phrases = (seg.alias("s").join(cand.alias("c"), on).withColumn("hits", matches).where("hits > 0")
               .select(*[F.col(f"s.{k}").alias(k) for k in key], *[F.col(f"c.{k}").alias(k) for k in DICT_COLS], "hits"))
    return singles.unionByName(phrases)


# Bits per key of the filter before the shuffle; its size ends at MOST_BITS (8 MB), where more words pass it.
KEY_BITS, MOST_BITS = 16, 1 << 26


def maybe_in(word: Column, keys: DataFrame, key: str) -> Column:
    """A Bloom filter as a column: true for every value of ``keys.key`` and for
    few others (two bits of the value's hash are looked up in a bit table that
    is a literal of the plan). The table's size is bounded whatever the keys."""
    n = keys.select(key).distinct().count()
    bits = 64
    while bits < min(MOST_BITS, n * KEY_BITS):
        bits *= 2

    def places(c: Column) -> list[Column]:
        h = F.xxhash64(c)
        return [h.bitwiseAND(bits - 1), F.shiftrightunsigned(h, 32).bitwiseAND(bits - 1)]

    at = keys.select(F.explode(F.array(*places(F.col(key)))).alias("p"))
    cells = at.groupBy(F.shiftright("p", 6).cast("int").alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("word"))
    table = [0] * (bits // 64)
    for r in cells.collect():  # at most MOST_BITS / 64 rows
        table[r["cell"]] = r["word"]
    cell = F.lit(table)
    found = [F.get(cell, F.shiftright(p, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(63).cast("int"))) != 0
             for p in places(word)]
    return found[0] & found[1]


def expand_occurrences(hits: DataFrame) -> DataFrame:
    """One row per occurrence (``occurrence`` 1..hits)."""
    return hits.withColumn("occurrence", F.explode(F.sequence(F.lit(1), F.col("hits").cast("int"))))


def category_patterns(dictionary: DataFrame, escape: bool = False) -> DataFrame:
    """One alternation pattern per category (P10b): ``category, first,
    pattern`` where ``first`` (the category's first ``row_ord``) orders the
    categories. Blank keywords are dropped (F8)."""
    d = dictionary.where(F.col("keyword").isNotNull() & (F.trim("keyword") != ""))
    grouped = d.groupBy("category").agg(
        F.min("row_ord").alias("first"),
        F.array_sort(F.collect_list(F.struct("row_ord", "keyword"))).alias("_kws"))
    kws = F.transform("_kws", lambda s: s["keyword"])
    return grouped.select("category", "first", category_alternation(kws, escape=escape).alias("pattern"))


# Pattern characters evaluated in one pass over the text; more categories take further passes.
PASS_CHARS = 200_000


def _passes(dictionary: DataFrame, escape: bool) -> list[list]:
    """The category patterns, in order, cut into passes."""
    rows = sorted(category_patterns(dictionary, escape).collect(), key=lambda r: (r["first"], r["category"] or ""))
    passes: list[list] = []
    room = 0
    for i, r in enumerate(rows):
        if not passes or room < len(r["pattern"]):
            passes.append([])
            room = PASS_CHARS
        passes[-1].append((i + 1, r["category"], r["pattern"]))
        room -= len(r["pattern"])
    return passes


# Regex syntax: a term with any of it is live where terms are not escaped.
LIVE = r"[\\^$.|?*+()\[\]{}]"


def _by_candidates(segments: DataFrame, dictionary: DataFrame, key: list[str], text: str, escape: bool, fn,
                   broadcast_limit: int, keep_text: bool) -> DataFrame:
    """``_per_category`` for a dictionary of any size. A term can only match
    where its probe is a token, so a segment's alternation for a category needs
    the terms alone whose probes it has, in dictionary order: the leftmost match,
    and of those at one place the first term, are the same. Candidates are found
    by a join on tokens without the text and meet it again as one pattern per
    segment and category. Live terms have no probe and are in every alternation
    of their category; only they are bounded in number."""
    d = prepare_dictionary(dictionary)
    live_term = F.lit(False) if escape else F.col("keyword").rlike(LIVE)
    live = d.where(live_term).groupBy("category", "cat_ord").agg(F.collect_list(F.struct("kw_ord", "keyword")).alias("live"))
    n_live = d.where(live_term).count()
    if n_live > broadcast_limit:
        raise ValueError(f"{n_live} terms with live regex syntax exceed broadcast_limit={broadcast_limit}; escape them or raise the limit")
    plain = _with_match_columns(d.where(~live_term), None)
    words = _tokens(F.col(text), not plain.where("symbolic").isEmpty())
    seg = segments.select(*key, text).withColumn("_digest", F.xxhash64(text, F.length(text)))
    ids = [*key, "_digest"]
    tokens = seg.select(*ids, F.explode(F.array_distinct(words)).alias("probe")).distinct().where(maybe_in(F.col("probe"), plain, "probe"))
    found = tokens.join(plain.select("category", "cat_ord", "kw_ord", "keyword", "probe"), "probe").groupBy(*ids, "category", "cat_ord").agg(
        F.collect_list(F.struct("kw_ord", "keyword")).alias("terms"))
    names = [f"_i{i}" for i in range(len(ids))] + ["_cat"]
    same = lambda left: [F.col(c).eqNullSafe(F.col(n)) for c, n in zip([*ids, "category"][:left], names)]

    def all_of(conditions: list[Column]) -> Column:
        out = conditions[0]
        for c in conditions[1:]:
            out = out & c
        return out

    renamed = found.select(*[F.col(c).alias(n) for c, n in zip([*ids, "category"], names)], F.col("cat_ord").alias("_ord"), "terms")
    if n_live:
        rows = live.collect()  # at most broadcast_limit terms
        every = F.array(*[F.struct(F.lit(r["category"]).alias("category"), F.lit(r["cat_ord"]).alias("cat_ord"), F.array(*[
            F.struct(F.lit(t["kw_ord"]).alias("kw_ord"), F.lit(t["keyword"]).alias("keyword")) for t in r["live"]]).alias("live")) for r in rows])
        with_live = seg.select(*ids, F.explode(every).alias("_l")).select(*ids, "_l.*").distinct()
        both = with_live.join(renamed, all_of(same(len(ids) + 1)), "full")
        picked = both.select(*[F.coalesce(c, n).alias(n) for c, n in zip([*ids, "category"], names)], F.coalesce("cat_ord", "_ord").alias("_ord"),
                             F.concat(*[F.coalesce(c, F.array().cast("array<struct<kw_ord:bigint,keyword:string>>")) for c in ("live", "terms")]).alias("terms"))
    else:
        picked = renamed
    terms = F.transform(F.array_sort("terms"), lambda t: t["keyword"])
    patterns = picked.select(*names[:-1], F.col("_cat").alias("category"), F.col("_ord").alias("cat_ord"),
                             category_alternation(terms, escape=escape).alias("_pattern"))
    met = seg.join(patterns, all_of(same(len(ids))))
    return met.select(*key, *([text] if keep_text else []), "category", "cat_ord", fn(F.col(text), F.col("_pattern")).alias("m"))


def _per_category(segments: DataFrame, dictionary: DataFrame, key: list[str], text: str,
                  escape: bool, fn, broadcast_limit: int, keep_text: bool = False) -> DataFrame:
    """Evaluate ``fn(text, pattern)`` for every category.

    Up to ``broadcast_limit`` terms the category patterns are placed in the plan
    as literals, so each pattern is compiled once per task and each row is
    scanned once per category with neither a join nor a copy of the text. Few or
    many categories take the same plan, once per ``PASS_CHARS`` of patterns. A
    larger dictionary goes by candidates, to the same result."""
    if dictionary.count() > broadcast_limit:
        return _by_candidates(segments, dictionary, key, text, escape, fn, broadcast_limit, keep_text)
    extra = [text] if keep_text else []
    out = None
    for rows in _passes(dictionary, escape) or [[]]:
        arr = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(i).alias("cat_ord"), fn(F.col(text), F.lit(p)).alias("m"))
                        for i, c, p in rows or [(0, "", "(?!)")]])
        part = (segments.select(*key, *extra, F.explode(arr).alias("c"))
                .select(*key, *extra, "c.category", "c.cat_ord", "c.m"))
        part = part if rows else part.limit(0)
        out = part if out is None else out.unionByName(part)
    return out


def category_hits(segments: DataFrame, dictionary: DataFrame,
                  key: Sequence[str] = ("path", "seg_ord"), text: str = "text",
                  escape: bool = False,
                  broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """One alternation per category (``\\b`` bounds, dictionary order is
    priority), every non-overlapping match emitted as written in the text.

    Returns ``*key, category, cat_ord, keyword, hits`` where ``keyword`` is the
    matched text and ``hits`` its number of matches in the segment."""
    key = list(key)
    per = _per_category(segments, dictionary, key, text, escape,
                        lambda t, p: F.regexp_extract_all(t, p, F.lit(0)), broadcast_limit)
    return (per.select(*key, "category", "cat_ord", F.explode("m").alias("keyword"))
               .where(F.col("keyword") != "")
               .groupBy(*key, "category", "cat_ord", "keyword")
               .agg(F.count(F.lit(1)).alias("hits")))


def cell_hits(segments: DataFrame, dictionary: DataFrame,
              key: Sequence[str] = ("path", "seg_ord"), text: str = "text",
              broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """M3: the whole segment (cell) for every category with at least one match."""
    key = list(key)
    per = _per_category(segments, dictionary, key, text, False,
                        lambda t, p: F.regexp_like(t, p), broadcast_limit, keep_text=True)
    return per.where("m").select(*key, "category", "cat_ord", text)


def first_hit_per_category(segments: DataFrame, dictionary: DataFrame,
                           key: Sequence[str] = ("path", "seg_ord"), text: str = "text",
                           broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """M4 (and M5 when the segment is a whole document): the first match of
    each category's alternation, as written; categories without a match are
    left out."""
    key = list(key)
    per = _per_category(segments, dictionary, key, text, False,
                        lambda t, p: F.regexp_substr(t, p), broadcast_limit)
    return per.where(F.col("m").isNotNull() & (F.col("m") != "")).withColumnRenamed("m", "first_match")


def find_hits(segments: DataFrame, dictionary: DataFrame, mode: str = "keyword", **kw) -> DataFrame:
    """One entry point for the four match modes: ``keyword`` (M1), ``category``
    (M2), ``cell`` (M3) and ``first`` (M4/M5)."""
    fns = {"keyword": keyword_hits, "category": category_hits, "cell": cell_hits,
           "first": first_hit_per_category}
    if mode not in fns:
        raise ValueError(f"unknown match mode {mode!r}")
    return fns[mode](segments, dictionary, **kw)
