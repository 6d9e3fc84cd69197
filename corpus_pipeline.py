"""The corpus pipeline: from documents to packed sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next one's documents. The first four return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm.common import materialise, table
from touchline.llm.decontamination import decontaminate
from touchline.llm.packing import pack_documents
from touchline.llm.pii import find_personal_data, redacted
from touchline.llm.quality import accepted
from touchline.llm.queries import vocabulary
from touchline.llm.simhash import first_of_groups

#: Near duplicates, by the operator's own terms: words of a shingle, and bits that the
#: fingerprints of linked documents may differ in.
NEAR = {"shingle": 4, "reach": 4}


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    table(spark, sf_dir, "documents")
    return first_of_groups(docs, **NEAR)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*[f"`{c}`" for c in docs.columns])


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    found = find_personal_data(docs)
    text = redacted(F.col("text"), F.col("pii"))
    changed = found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(*[f"`{c}`" for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences of 2048."""
    table(spark, sf_dir, "documents")
    return pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_first_copies),
    ("decontamination", keep_uncontaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]
#: Learnt weights, fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
