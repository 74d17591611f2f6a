"""Operator 2: personal data by bootstrapped contextual extraction.

Base patterns find emails, IP addresses, card numbers and phone numbers,
leftmost and without overlap per kind. They are the seeds: every mention of
something identifier-like (a token with a digit or an at sign, groups of digits
joined by blanks or the like, an email out of a longer token) is taken with
its lexical patterns: the word before it, the two words before it and the words
around it. On the
graph of patterns and mentioned strings, a pattern's confidence in a kind is
the score of its strings in that kind, as a share of all scores of its strings and
of ``UNKNOWN`` for each one whose kind is not known (yet), and a string's score
is the chance that not all of its trusted patterns err; seeds keep a score of 1
for their kind. After a few rounds, strings that trusted patterns vouch for are added wherever they occur
clear of base spans. Base spans always stay.

Only DataFrame functions. Offsets come from one pass per kind: each match is
extracted with the text that leads up to it, and lengths are summed up in the
row. Loops in the patterns are possessive, so that no text makes the matcher
recurse or retry, and rows without the kind's telling character skip it. The
text is never shuffled; the graph holds one row per pattern and string, summed
before it is shuffled, and a pattern may hold any share of the mentions.

Cases: a null text is the empty text; offsets count code points, ends
exclusive; texts are read whole; rows that share an id are told apart by the
MD5 of their text, equal rows get equal results; ties in a string's kind go to
the kind listed first; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

KINDS = ("email", "ip", "card", "phone")
LOCAL, HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
#: The kinds' patterns, with possessive loops and a start that skips retries within a run.
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TELLING = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}

SPACE, SOLID = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
#: Groups of digits, 7 to 15 in all, joined by blanks, dots, hyphens or parentheses: one mention.
GROUPS = (rf"(?<!{SOLID})(?=\(?[0-9](?:[\x20().-]{{0,3}}+[0-9]){{6,14}}+(?![0-9]))\(?[0-9]{{2,8}}+\)?"
          r"(?:[\x20.-]{0,2}+\(?[0-9]{2,8}+\)?){1,5}+(?![\x20.-]?[0-9A-Za-z@]*[0-9@])")
#: An email within a token that has more characters.
EMAIL = rf"(?<!{LOCAL}){LOCAL}++@{HOST}++(?:\.{HOST}++)++"
MENTION = (PATTERNS["phone"] + r"|(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,18}+(?![0-9])|" + GROUPS + "|" + EMAIL
           + rf"|(?<!{SOLID})(?={SOLID}*?[0-9@])(?!{SOLID}*?{EMAIL}){SOLID}++")
NEAR = 80            # characters on either side that a context may lie in
LENGTHS = (5, 200)   # of an identifier
ROUNDS = 3
MIN_SUPPORT = 3      # strings of the kind that a trusted pattern has
MIN_CONFIDENCE = 0.6
UNKNOWN = 0.25       # weight of a string of unknown kind against a pattern: a context has something to discover
MIN_SCORE = 0.8      # of a string that is added


# -- base spans -------------------------------------------------------------
def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    one = lambda i: F.substring(turned, i, F.lit(1)).cast("int") * (2 - i % 2)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0),
                        lambda acc, i: acc + F.when(one(i) > 9, one(i) - 9).otherwise(one(i)))
    return total % 10 == 0


def valid(kind: str, m: Column) -> Column:
    """Whether a match of a kind's pattern stands."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


SPAN = "array<struct<start: long, end: long>>"


def spans(kind: str, text: Column) -> Column:
    """The standing spans of a kind, in order, as an array of (start, end)."""
    lead = f"(?s)(.*?)({PATTERNS[kind]}|\\z)"
    parts = F.arrays_zip(F.regexp_extract_all(text, F.lit(lead), F.lit(1)).alias("pre"),
                         F.regexp_extract_all(text, F.lit(lead), F.lit(2)).alias("m"))
    none = F.array().cast(SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["pre"])
        end = start + F.length(x["m"])
        found = F.when((x["m"] != "") & valid(kind, x["m"]), F.concat(acc["found"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    folded = F.aggregate(parts, F.struct(F.lit(0).cast("long").alias("at"), none.alias("found")), step, lambda acc: acc["found"])
    return F.when(text.rlike(TELLING[kind]), folded).otherwise(none)


# -- mentions and their patterns --------------------------------------------
def _words(context: Column) -> Column:
    return F.filter(F.split(F.lower(context), SPACE + "+"), lambda w: w != "")


def mentions(rows: DataFrame) -> DataFrame:
    """(id, digest, start, end, string, kind, patterns) of every identifier-like mention."""
    lead = F.lit(f"(?s)(.*?)({MENTION}|\\z)")
    found = rows.filter(F.col("text").rlike("[0-9@]")).select(
        "id", "digest", F.regexp_extract_all("text", lead, F.lit(1)).alias("pre"), F.regexp_extract_all("text", lead, F.lit(2)).alias("m"))
    size = lambda i: F.length(F.get("pre", i)) + F.length(F.get("m", i))
    ends = F.aggregate(F.sequence(F.lit(0), F.size("m") - 1), F.array(F.lit(0).cast("long")),
                       lambda acc, i: F.concat(acc, F.array(F.element_at(acc, -1) + size(i))))
    found = found.withColumn("ends", ends)
    each = F.transform(F.sequence(F.lit(0), F.size("m") - 1), lambda i: F.struct(
        F.get("m", i).alias("m"), F.when(i == 0, "^").otherwise("<>").alias("edge"),
        F.substring(F.get("pre", i), -NEAR, NEAR).alias("before"),
        F.substring(F.coalesce(F.get("pre", i + 1), F.lit("")), 1, NEAR).alias("after"),
        (F.get("ends", i) + F.length(F.get("pre", i))).alias("start")))
    one = found.select("id", "digest", F.explode(F.filter(each, lambda x: x["m"] != "")).alias("x")).select("id", "digest", "x.*")
    grouped = F.col("m").rlike(f"^(?:{GROUPS})$")  # its parentheses are its own
    front = F.when(grouped, "").otherwise(F.regexp_extract("m", r"""^["'(<\[]*""", 0))
    core = F.when(grouped, F.col("m")).otherwise(
        F.regexp_replace(F.regexp_replace("m", r"""^["'(<\[]+""", ""), r"""["').,;:!?>\]]+$""", ""))
    one = one.withColumns({"string": core, "start": F.col("start") + F.length(front)}).filter(
        F.length("string").between(*LENGTHS) & F.col("string").rlike("[0-9@]"))
    kind = F.lit(None).cast("int")
    for k in reversed(range(len(KINDS))):
        whole = F.col("string").rlike(f"^(?:{PATTERNS[KINDS[k]]})$")
        kind = F.when(whole & valid(KINDS[k], F.col("string")), k).otherwise(kind)
    left = _words(F.concat_ws(" ", "edge", "before"))
    right = F.coalesce(F.get(_words(F.col("after")), F.lit(0)), F.lit("$"))
    last = F.element_at("left", -1)
    one = one.withColumns({"kind": kind, "left": left}).withColumn("patterns", F.array(
        F.concat(F.lit("one:"), last), F.concat(F.lit("around:"), last, F.lit(" | "), right),
        F.concat(F.lit("two:"), F.array_join(F.slice("left", -2, 2), " "))))
    return one.select("id", "digest", "start", (F.col("start") + F.length("string")).alias("end"), "string", "kind",
                      F.when(F.size("left") >= 2, F.col("patterns")).otherwise(F.slice("patterns", 1, 2)).alias("patterns"))


def discovered(found: DataFrame) -> DataFrame:
    """(string, kind): strings that trusted patterns vouch for, found by rounds over the pattern graph."""
    edges = written(found.select("string", "kind", F.explode("patterns").alias("pattern"))
                         .groupBy("pattern", "string").agg(F.min("kind").alias("seed")), "edges")
    scores = None
    for _ in range(ROUNDS):
        # One row per edge and kind a string may be of: its seed kind, or what the last round scored.
        told = edges.filter("seed is not null").select("pattern", F.col("seed").alias("kind"), F.lit(1.0).alias("score"))
        if scores is not None:
            told = told.unionByName(edges.filter("seed is null").join(scores, "string").select("pattern", "kind", "score"))
        support = told.groupBy("pattern", "kind").agg(F.sum("score").alias("support"))
        known = support.groupBy("pattern").agg(F.sum("support").alias("known"))
        sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
        weight = F.col("known") + UNKNOWN * F.greatest(F.col("n") - F.col("known"), F.lit(0.0))
        trusted = (support.filter(F.col("support") >= MIN_SUPPORT).join(known, "pattern").join(sizes, "pattern")
                          .withColumn("confidence", F.col("support") / weight).filter(F.col("confidence") >= MIN_CONFIDENCE))
        vouched = edges.filter("seed is null").join(trusted, "pattern")
        scores = written(vouched.groupBy("string", "kind").agg(
            F.round(1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))), 9).alias("score")), "scores")
    best = scores.filter(F.col("score") >= MIN_SCORE).groupBy("string").agg(F.min_by("kind", F.struct(-F.col("score"), F.col("kind"))).alias("kind"))
    return best


# -- the operator -----------------------------------------------------------
def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``base`` and ``added``: arrays of (kind number, start, end) of every row."""
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    of_kind = lambda k: lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.concat(*[F.transform(spans(kind, F.col("text")), of_kind(k)) for k, kind in enumerate(KINDS)])
    slim = written(rows.select("id", "digest", base.alias("base")), "base")
    found = written(mentions(rows), "mentions")
    new = (found.filter("kind is null").drop("kind").join(discovered(found), "string").select("id", "digest", "start", "end", "kind").distinct()
                .groupBy("id", "digest").agg(F.collect_list(F.struct("kind", "start", "end")).alias("new")))  # bounded by a document's mentions
    new = new.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), "new")
    met = slim.join(new, F.col("id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    none = F.array().cast("array<struct<kind: int, start: long, end: long>>")
    clear = F.filter("new", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return met.select(F.col("id").alias(id_col), "base", F.coalesce(clear, none).alias("added"))


def rendered(found: Column) -> Column:
    """kind:start:end by kind as listed, then start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: base counts, the digest of base spans, all spans; and how many spans there are and the method added."""
    found = personal_data(df, id_col, text_col)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(id_col, *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
                        F.sha2(rendered(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        rendered(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
                        (F.size("base") + F.size("added")).cast("long").alias("n_spans"))
