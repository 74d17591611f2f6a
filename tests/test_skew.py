"""A hot file (a third of all segments) and a hot keyword: results stay whole
and every report aggregates partially before its first shuffle."""

from pyspark.sql import functions as F

from termscope.functions.paths import with_path_parts
from termscope.operators.match import keyword_hits
from termscope.plans import reports


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_file_and_keyword(spark):
    n = 3000
    seg = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("/room/hot.txt"))
         .otherwise(F.concat(F.lit("/room/f"), (F.col("id") % 97).cast("string"), F.lit(".txt"))).alias("path"),
        F.col("id").alias("seg_ord"),
        F.when(F.col("id") % 2 == 0, F.lit("the the of")).otherwise(F.lit("the x")).alias("text"))
    d = spark.createDataFrame([("c", "the", 1), ("c", "of", 2)], "category string, keyword string, row_ord int")
    hits = keyword_hits(seg, d).cache()
    files = with_path_parts(seg.select("path").distinct().withColumn("status", F.lit("scanned")))
    fr = reports.file_report(files, hits)
    hot = fr.where(F.col("path") == "/room/hot.txt").collect()[0]
    # ids divisible by 3: half of them even ("the the of"), half odd ("the x").
    evens, odds = 500, 500
    assert hot.n_keywords_found == evens * 3 + odds
    assert hot.keyword_details == f"of({evens}), the({evens * 2 + odds}), "
    plan = _plan(fr)
    assert "partial_sum" in plan               # pre-aggregated before the shuffle
    kr = {r.keyword: r for r in reports.keyword_report(files, hits, lists=True).collect()}
    assert kr["the"].total_hits == (n // 2) * 2 + (n // 2)
    assert kr["the"].n_files == 98
