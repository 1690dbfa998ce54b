"""The corpus pipeline: stages that each read what the one before them kept.

Every stage but the last returns the columns of documents. A stage that drops documents
keeps all others as they are; a stage that changes texts keeps `n_chars` right.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart.llm import decontaminate, minhash, pieces, pii, toxicity
from ticketmart.llm.common import stored, table
from ticketmart.llm.queries import SURROGATE_KEY

# Near-duplicates: five words a shingle, a similarity of 0.8 or more.
BANDING = minhash.Banding(words=5, percent=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that a model of all labelled documents takes for toxic."""
    model = toxicity.learned(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    # Under other names, so that the operator's columns replace none. Each text goes to Python once.
    renamed = docs.select(F.col("text").alias("_text"), F.struct(*[c for c in docs.columns if c != "text"]).alias("_doc"))
    found = toxicity.tagged(renamed, model, "_text").where("predicted = 0")
    return found.select(*[F.col("_text" if c == "text" else f"_doc.{c}").alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group, that with the least doc_id."""
    dropped = minhash.grouped(docs, BANDING).where(~F.col("kept")).select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that contain a passage of the benchmark."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    dropped = found.where("contaminated").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put surrogates in the place of personal data."""
    changed = pii.anonymised(docs, SURROGATE_KEY)
    length = F.char_length("text").cast("long")
    return changed.withColumn("n_chars", F.when(F.col("n_entities") > 0, length).otherwise(F.col("n_chars"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a sampled segmentation, from which the text can be decoded."""
    alphabet = pieces.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.encoded(docs, alphabet, ["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("pieces", encode),
]

# The stages are learned, sampled or iterative; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each on what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
