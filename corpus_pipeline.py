"""The corpus pipeline: each stage takes what the one before it kept, written as Parquet and read again.

All stages but the last return the columns of ``documents``; the last returns the packed pieces.  Each stage is judged on
its own input: models, counts and groups are made anew from what it is given.

Defined results: documents need ``doc_id`` and ``text``; further columns are kept whatever their names, and ``n_chars``
follows the text where there is one (null stays null).  Null and empty texts are equal to each other, so that exact dedup
leaves one, and are linked with no near copy; texts may have any length.  Of equal texts the row with the largest doc_id stays, of near
copies the one with the smallest (null is largest); repeated rows are copies.  An empty table gives no pieces.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewick.llm import exact_dedup, jaccard_join, packing, quality, secret_scan
from tidewick.llm.token_units import vocabulary
from tidewick.session import materialise

NEAR_WIDTH, NEAR_THRESHOLD = 5, 80  # near copies: words a shingle, percent of the union


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards those labelled good; what it rejects goes."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 of their 5-word sets the document with the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs, width=NEAR_WIDTH, threshold=NEAR_THRESHOLD)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; n_chars, where there is one, follows."""
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.withColumn("n_chars", length).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document's tokens with its sequence and offset."""
    return packing.digests(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

# model scores and randomised groups have no SQL form; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = materialise(docs, "pipeline")
    return docs
