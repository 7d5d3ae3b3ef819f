"""From raw documents to encoded training text: five stages, each written as Parquet and read by the next."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelog.llm.common import held_out, materialise, small_batches, table
from sievelog.llm.exact_dedup import drop_exact_duplicates
from sievelog.llm.language_id import accepted_rows
from sievelog.llm.minhash_dedup import drop_near_duplicates
from sievelog.llm.mixing import mixed_documents
from sievelog.llm.sentencepiece_codec import encode_documents, load_model


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin stay."""
    small_batches(spark)
    return accepted_rows(docs, ~held_out(F.col("doc_id")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    small_batches(spark)
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates stays."""
    small_batches(spark)
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents of rare or heavy sources come twice, those beyond a source's target go."""
    small_batches(spark)
    return mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix."""
    small_batches(spark)
    return encode_documents(docs, load_model(spark))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

#: SQL cannot express language identification, near-duplicates and encoding; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
