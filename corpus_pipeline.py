"""Documents to packed training sequences: the stages in order, each on all rows that the
stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import exact, packing, pii, simhash, toxicity
from changeflow.llm.common import settled, ship, table


#: Rows in a batch for Python workers: whole texts are large, and two workers share an
#: executor's memory.
BATCH_ROWS = 1000


def _ready(spark: SparkSession) -> None:
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the labels of the held-out fifth are not learned."""
    _ready(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.toxicity(docs, labels, ~toxicity.held_out(F.col("id")), carry=True, with_evidence=False)
    return scored.where("predicted = 0").select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the smallest doc_id."""
    _ready(spark)
    return exact.exact_dedup(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest doc_id: five-word
    shingles, similarity of 0.8 or more."""
    _ready(spark)
    return simhash.near_dedup(docs, words_in_shingle=5, similarity=0.8)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data replaced by its kind; n_chars follows."""
    _ready(spark)
    return pii.redact_pii(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all rows, placed in sequences of 4096."""
    _ready(spark)
    placed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return placed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("simhash", simhash_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Classifier, fingerprints and tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
