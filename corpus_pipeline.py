"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import best_fit, order_minhash, source_mix, suffix_dedup, zstd_language
from gaugeflow.llm.frames import small_batches, stored


def _others(docs: DataFrame) -> Column:
    """All columns but the text, under a name of their own; the text goes along once."""
    return F.struct(F.lit(0).alias("text"), *[c for c in docs.columns if c != "text"]).alias("__doc")


def _whole(rows: DataFrame, columns: list[str], new: dict[str, Column]) -> DataFrame:
    """The columns of a document again, some of them new."""
    return rows.select(*[new.get(c, F.col("__doc")[c]).alias(c) for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells; rejected ones go."""
    model = zstd_language.learn_languages(docs)
    rows = docs.select(_others(docs), "text")
    predicted = zstd_language.predict_languages(rows, model, keep=("__doc", "text")).where("NOT rejected")
    with small_batches(spark):
        return stored(_whole(predicted, docs.columns, {"text": F.col("text")}), "known_language")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    with small_batches(spark):
        return order_minhash.one_of_each_class(docs)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without strings that stand elsewhere too."""
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    with small_batches(spark):
        cleaned = suffix_dedup.remove_repeats(docs.select(_others(docs), "text"))
        return stored(_whole(cleaned, docs.columns, new), "without_repeats")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return source_mix.mixed_documents(docs, source_mix.quality_weights(labels))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it."""
    with small_batches(spark):
        return best_fit.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_copies),
    ("suffix_dedup", remove_repeated_strings),
    ("source_mix", mix),
    ("packing", pack),
]
#: No stage but the mix's sizes can be said in SQL; see tests/llm for brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
