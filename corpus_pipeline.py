"""A training-corpus pipeline over the ``documents`` table.

``STAGES`` lists (name, function) in order; each function takes (spark, docs,
sf_dir), where ``docs`` is what the stage before it kept, and returns a DataFrame
with the columns of ``documents`` (the last one adds its own).  ``run`` applies
them to ``documents``; every stage's output is written as Parquet under the shared
folder and read again, so no stage depends on the work of an executor that is lost.

1. ``quality``: the classifier is learned from ``labels`` and rejects documents
   whose score is below ``QUALITY_CUT``.
2. ``line_dedup``: lines that repeat earlier ones are taken out; a document that
   loses all its text goes.  ``n_chars`` is counted anew.
3. ``ngram_join``: of documents whose sets of five-word shingles are linked by a
   Jaccard similarity of 0.8 or more, the one with the smallest id stays.  Rows
   with equal ids and texts are one document, rows with equal ids and other texts
   are several; a null id comes before all others.
4. ``decontamination``: documents that overlap with a benchmark item go.
5. ``mixing``: token weights are raked to source, language and topic shares, and
   documents are sampled by the calibrated probabilities.

Every stage returns an empty table for an empty one and accepts nulls in any
column, empty and very long texts, repeated rows and further columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import stored, table
from tidelog.llm.decontam import decontaminated
from tidelog.llm.line_dedup import dedup_lines
from tidelog.llm.mixing import mix
from tidelog.llm.ngram_join import ngram_components
from tidelog.llm.quality import keep_quality

QUALITY_CUT = 0.3
SHINGLE_WORDS = 5
SIMILARITY = (4, 5)

# learning, edit distances and components have no counterpart in one SQL statement
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels"), QUALITY_CUT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs).filter("n_removed = 0 OR text <> ''")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("of")).alias("row")
    groups = ngram_components(docs.select(name, "text"), "row", size=SHINGLE_WORDS, threshold=SIMILARITY)
    stay = groups.filter(F.col("row").eqNullSafe(F.col("component_id"))).select("row.id", "row.of").distinct()
    met = docs["doc_id"].eqNullSafe(stay["id"]) & (F.xxhash64(docs["text"]) == stay["of"])
    return docs.join(stay, met, "left_semi").dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs).filter("kept").drop("kept")


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
