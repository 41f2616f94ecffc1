"""A training corpus from ``documents``: language ID, line dedup, n-gram Jaccard
join, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm.common import WORD_PATTERN, stage
from vireo.llm.langid_gru import accepted
from vireo.llm.line_dedup import MIN_WORDS, dedup_lines
from vireo.llm.mixing import mixed_documents
from vireo.llm.ngram_join import representatives
from vireo.llm.packing import pack_documents
from vireo.llm.queries import _tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    return accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier in the corpus, but for one edit or one word, go;
    ``n_chars`` follows the text.  A document that loses its last word goes with them."""
    out = dedup_lines(docs, min_words=MIN_WORDS)
    emptied = (F.col("lines_removed") > 0) & ~F.col("text").rlike(WORD_PATTERN)
    out = out.where(~F.coalesce(emptied, F.lit(False)))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the smallest id."""
    return representatives(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences; see ``pack_documents``."""
    return pack_documents(docs, _tokenizer_file())


STAGES = [("language ID", language_id), ("line dedup", line_dedup), ("n-gram Jaccard join", ngram_join),
          ("mixing sources to target weights", mixing), ("packing", packing)]

#: trained models and tokenizers are beyond SQL; tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
