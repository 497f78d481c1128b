"""From raw documents to packed training sequences, one written table per stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that ``run`` writes to the shared folder and reads again as
the next stage's docs.  All stages but the last return the columns of documents;
benchmark and labels come from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm import decontaminate, packing, quality_mil, quality_rules, simhash
from vaultspark.llm.common import crc_mod, stored, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the log-likelihood ratio keep; trusted are those labelled quality 1."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality_rules.judge(spark, docs, trusted, prefix="_rule_").filter("_rule_kept").select(*docs.columns)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the classifier's threshold or more.  The model is learned from the
    labelled rows of the raw documents, as the stage before has taken most examples of label 0
    away; when those are not of both labels, all stay.  A whole row stands in for the
    id, so repeated and null ids stay apart."""
    raw = table(spark, sf_dir, "documents")
    model = quality_mil.fit(spark, raw, table(spark, sf_dir, "labels"), learn=crc_mod("doc_id", 4) != 2)
    if model is None:
        return docs
    whole = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    scored = quality_mil.score(whole, model, id_col="_row")
    return scored.filter(F.col("score") >= quality_mil.THRESHOLD).select("doc_id.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id."""
    return simhash.deduplicate(spark, docs, words=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, with exchanged numbers and names either."""
    return decontaminate.remove_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences of 1024 tokens, with their ids."""
    return packing.pack(spark, docs, window=1024, vocabulary="byte_bpe_50k")


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: The fingerprints, the trained model and the tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
