"""The corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.

Every stage works on all rows its predecessor kept.  Odd rows are handled as
the operators in ``casetrace.llm`` say: null and blank texts fail the quality
rules, ties and repeated rows are judged alike, an empty table passes through
empty, and further columns of ``documents`` travel along.

No stage can be stated in SQL as a whole (ridge scores, signatures, byte-pair
tokens), so ``ORACLE_SQL`` is None and the stages are tested against plain
re-computations.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrace.llm import classifier, decontamination, divergence, near_dedup, packing
from casetrace.llm.common import held_out, table
from casetrace.session import scratch_path

ORACLE_SQL = None
NEAR_PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier scores below its threshold.  It
    learns from the labels of documents that op3 does not hold out."""
    usable = classifier.with_features(docs.where(~held_out(F.col("doc_id"), 5, 0)))
    model = classifier.fit(classifier.with_label(usable, table(spark, sf_dir, "labels"),
                                                 "quality"))
    return classifier.keep(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or diverge from their language."""
    return divergence.keep(docs, robust=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every near-duplicate group (Jaccard 0.8 or more)."""
    return near_dedup.keep(docs, NEAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what is left into power-of-two sequences; ids as their crc32."""
    pieces = packing.cut_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.bucket_sequences(pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
