"""Keyword dictionaries.

A dictionary is ``category, keyword, row_ord`` (``row_ord`` = load order, it
decides category order and which duplicate wins). Optional ``team``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The category of the user's own terms.
USER_CATEGORY = "User Input"


def from_table(table: DataFrame, team: str | None = None) -> DataFrame:
    """A stored dictionary, optionally for one team (the filter is a bound
    value, pushed to the source)."""
    t = table if team is None else table.where(F.col("team") == F.lit(team))
    return t.select("category", "keyword", "row_ord")


def from_jdbc(spark: SparkSession, url: str, table: str, properties: dict, team: str | None = None) -> DataFrame:
    """S13 from a database: the dictionary table, the team filter pushed to the
    server. Credentials come from ``properties``. (Needs a database to run.)"""
    return from_table(spark.read.jdbc(url=url, table=table, properties=properties), team)


def dedup_keywords(d: DataFrame) -> DataFrame:
    """One row per keyword (case-sensitive), the first by ``row_ord`` wins.
    A partial aggregate, so a much repeated keyword is one row per task."""
    return (d.groupBy("keyword").agg(F.min_by(F.struct("category", "row_ord"), F.struct("row_ord", "category")).alias("first"))
             .select("first.category", "keyword", "first.row_ord"))


# Whole-argument spellings that mean "no user keywords".
NO_KEYWORDS = ["none", "nan"]


def user_keywords_column(arg) -> "F.Column":
    """S17 as a column: a comma list -> array of trimmed, non-blank terms.
    A whole value of ``none``/``nan`` (any case) gives no terms. Blank items
    are dropped (the reference keeps them and they match zero-width)."""
    items = F.transform(F.split(arg, ","), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    cleaned = F.filter(items, lambda s: s != "")
    return F.when(arg.isNull() | F.lower(F.trim(arg)).isin(*NO_KEYWORDS), F.array().cast("array<string>")) \
            .otherwise(cleaned)


def user_keywords(spark: SparkSession, arg: str | None, first_ord: int = 1 << 60) -> DataFrame:
    """The run argument as dictionary rows in category ``User Input``,
    numbered after any stored dictionary."""
    df = spark.createDataFrame([(arg,)], "arg string")
    return (df.select(F.posexplode(user_keywords_column(F.col("arg"))).alias("_pos", "keyword"))
              .select(F.lit(USER_CATEGORY).alias("category"), "keyword",
                      (F.col("_pos") + F.lit(first_ord)).cast("long").alias("row_ord")))


def extra_dictionary(d: DataFrame, extra: DataFrame, label: str = "User_Input") -> DataFrame:
    """Terms of a second table (``keyword, category``, with or without
    ``row_ord``) under one category label, appended after all of ``d``."""
    last = d.agg(F.coalesce(F.max("row_ord"), F.lit(0)).cast("long").alias("_last"))
    e = extra.where(F.col("category") == label)
    order = F.col("row_ord") if "row_ord" in extra.columns else F.lit(0)
    e = e.select("category", "keyword", order.cast("long").alias("_ord"))
    low = e.agg(F.coalesce(F.min("_ord"), F.lit(0)).alias("_low"))
    shift = last.select(F.col("_last")).scalar() - low.select(F.col("_low")).scalar() + 1
    return (d.select("category", "keyword", F.col("row_ord").cast("long").alias("row_ord"))
             .unionByName(e.select("category", "keyword", (F.col("_ord") + shift).alias("row_ord"))))


def unpivot_wide(sheet: DataFrame, category_cols: Sequence[str], row_col: str = "row",
                 max_row: int | None = None) -> DataFrame:
    """A wide sheet with one column per category -> long dictionary.
    Blank cells are dropped (F8); ``max_row`` keeps the first rows only, as the
    reference's row window does for some columns (O3)."""
    s = sheet if max_row is None else sheet.where(F.col(row_col) <= max_row)
    cols = [F.col(c).cast("string").alias(c) for c in category_cols]
    long = s.select(row_col, *cols).unpivot([row_col], list(category_cols), "category", "keyword")
    pos = {c: i for i, c in enumerate(category_cols)}
    cat_idx = F.create_map(*[x for c in category_cols for x in (F.lit(c), F.lit(pos[c]))])
    return (long.where(F.col("keyword").isNotNull() & (F.trim("keyword") != ""))
                .select("category", "keyword",
                        (cat_idx[F.col("category")].cast("long") * 1_000_000_000 + F.col(row_col))
                        .cast("long").alias("row_ord")))


def team_dictionary(users: DataFrame, dictionary: DataFrame, guid: str) -> DataFrame:
    """The user's team by GUID, then that team's dictionary. The
    GUID filter is a bound value pushed to the user table's scan; Spark sizes
    the join itself (the team side is one row per team of that user)."""
    team = users.where(F.col("guid") == F.lit(guid)).select("team").distinct()
    return dictionary.join(team, "team").select("team", "category", "keyword", "row_ord")
