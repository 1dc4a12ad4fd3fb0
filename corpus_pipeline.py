"""A corpus pipeline: language, exact copies, near copies, benchmark passages, packing.

Every stage works on all rows that the one before kept, takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again. All but the last return the columns of ``docs``, whatever they are. A document is
dropped by its doc_id; rows without one are kept by every stage that decides by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltframe.llm import decontam, exact, langid, minhash, packing
from siltframe.llm.queries import tokenizer_path
from siltframe.llm.store import prepare, stored

#: The near-copy stage takes five words and a similarity of 0.8 or more.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is not in ``dropped``; by id at every size, as neither side is bounded."""
    gone = dropped.select("doc_id").where("doc_id is not null").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; null text and text without a letter go."""
    clash = {c: f"own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    rows = langid.tagged(docs.withColumnsRenamed(clash)).where(F.col("lang_pred") != langid.UNKNOWN)
    return rows.drop("lang_pred", "score").withColumnsRenamed({v: k for k, v in clash.items()}).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of equal texts."""
    return _without(docs, exact.exact_duplicates(docs).where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of similar texts."""
    return _without(docs, minhash.near_duplicates(docs, NEAR_WIDTH, NEAR_PERCENT).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(docs, decontam.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.packed(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL: support vector machines, banding and packing are not expressible in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
