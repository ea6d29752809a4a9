"""The training-data pipeline: documents in, packed sequences out.

Every stage is written below the shared checkpoint folder and read again, so a lost executor costs the
tasks of one stage only.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from scanweave.llm import catalogue, decontaminate, line_crf, simhash_dedup
from scanweave.llm.tables import landed_alone, read_table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is trained on the stage's own documents."""
    model = line_crf.fit(docs, read_table(spark, sf_dir, "labels"))
    return line_crf.score_quality(docs, model).where("predicted = 1").select("row.*")


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of every class of SimHash near-duplicates."""
    return simhash_dedup.keep_one(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    found = decontaminate.contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select("row.*")


def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; `n_chars` follows the new text."""
    replaced = catalogue.without_personal_data(docs)
    if "n_chars" in replaced.columns:
        kind = replaced.schema["n_chars"].dataType
        replaced = replaced.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return replaced


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences that keep the mixture of sources."""
    return catalogue.pack_documents(docs)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", different_documents),
    ("decontamination", clean_documents),
    ("personal_data", private_documents),
    ("packing", packed_documents),
]

# A trained classifier, XXH64 and a tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed_alone(spark, lambda: stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
