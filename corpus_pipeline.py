"""From raw documents to packed training windows, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and reads it back as the next stage's docs.
All stages but the last return the columns of ``documents``.  Null and empty
texts, and rows with a null id, pass or go as the operators of ``kestrel.llm``
state it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import jaccard, line_align, line_quality, packing, tiling
from kestrel.llm.queries import tokenizer_file
from kestrel.llm.tables import stored, unused
from kestrel.sources.tables import load


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the line model reject go."""
    return line_quality.keep_content(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go from the later one; a
    document of which nothing is left goes.  ``n_chars`` follows the text."""
    cut, = unused(docs.columns, "cut")
    out = line_align.without_repeated_lines(docs, removed_col=cut, every_copy=True)
    out = out.where((F.col(cut) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cut) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at five words and 80 percent, the smallest id stays."""
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover at least half of a benchmark item go."""
    return tiling.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of at most 2048 tokens."""
    return packing.digest(packing.pack(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
