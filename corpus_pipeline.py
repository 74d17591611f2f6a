"""The corpus pipeline: documents through five operators of ``termscope.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termscope.llm import byte_bpe, line_dedup, mixing, quality, simhash
from termscope.llm.common import release, scratch, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the rules reject go."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines of repeated three-line windows go, first occurrences stay;
    ``n_chars`` is counted anew where a text has changed."""
    return line_dedup.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near-duplicates the document of the smallest id stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token counts, and digests of the ids and of the decoded bytes, of every row of the mix."""
    import public_tokenizers
    return byte_bpe.digests(byte_bpe.encode_decode(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

ORACLE_SQL = None  # MCD, SimHash and BPE are beyond SQL; tests/llm/test_pipeline.py holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in sequence. A stage's own tables, and the output of the stage
    before it, go as soon as its output is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            done = written(stage(spark, docs, sf_dir), "stage", kept=True)
        release(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
