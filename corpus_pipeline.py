"""The corpus pipeline: documents in, encoded training text out. Stages are written as Parquet and read again, one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mossgrid.llm import langid, mixing, secrets, shingles
from mossgrid.llm.common import kept
from mossgrid.llm.queries import piece_digests

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Row numbers that are broadcast: some 16 MB.
MOST_BROADCAST = 1_000_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (null text included), whose language can't be told; fills missing languages."""
    model = langid.train(docs.where(~langid.held_out()))
    told = langid.predict(docs, model).where(F.col("lang_pred") != langid.UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked rows: the one with the smallest id (none is last), then by a hash of its columns.

    Every row is a document of its own here, so different texts under one id both stay, repeated rows and copies without an
    id go. Rows without words are linked with nothing and stay. Tables may be empty.
    """
    rows = kept(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = shingles.jaccard_groups(rows, id_col="_row")
    order = rows.select(F.col("_row").alias("doc_id"), F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*COLUMNS), "_row").alias("order"))
    first = groups.join(order, "doc_id").groupBy("component_id").agg(F.min("order").alias("order")).select("order._row")
    gone = kept(groups.select(F.col("doc_id").alias("_row")).join(first, "_row", "left_anti"), "gone")
    # A copy's number is all that is needed of it; texts move only where the copies are too many to send to all.
    gone = F.broadcast(gone) if gone.count() <= MOST_BROADCAST else gone
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; every document stays."""
    masked = secrets.scan_secrets(docs, redact=True)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix: a document stands as often as it is taken. Documents of null source are a source of their own."""
    mixed = mixing.mix_documents(docs).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every row, as digests; null text is empty."""
    return piece_digests(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", mask_secrets), ("mix", mix), ("pieces", encode)]
#: Naive Bayes, A-star search and key parsing have no SQL; tests/llm compares every stage and run() with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
