"""Corpus pipeline: quality filter, language filter, near-duplicate removal, removal of repeated
passages, packing. Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tectonic.llm import langid, minhash, packing, quality, substring
from tectonic.llm.common import Workspace, crc_mod, temporary_tables
from tectonic.llm.queries import END_ID, WORDS, piece_digests


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees accept; learned from the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod("doc_id", 3) != 1)
    return quality.accepted(docs, quality.fit(docs, labels))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; learned from the rows outside the held-out fold."""
    learned = docs.where(crc_mod("doc_id", 4) != 2).select("doc_id", "text", "lang")
    return langid.accepted(docs, langid.fit(learned))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8; of rows
    that repeat the kept document's id and text, one. Rows without an id are linked to nothing."""
    groups = minhash.judged(docs, shingle=5, percent=80)
    kept = groups.where("kept and doc_id is not null").select(
        F.col("doc_id").alias("kept_id"), F.col("print").alias("kept_print")).distinct()
    same = (docs["doc_id"] == kept["kept_id"]) & (F.xxhash64(docs["text"]) == kept["kept_print"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"]) \
        .unionByName(docs.where("doc_id is null"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 50 words that an earlier document holds are cut; other texts stay as they are."""
    cut = substring.remove_repeated_windows(docs, window=50)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens with the sources in proportion."""
    return piece_digests(packing.pack(docs, WORDS, END_ID, size=4096))


STAGES = [
    ("quality", keep_quality),
    ("language", keep_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("packing", pack_sequences),
]

# Learned stages and the tokenizer cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the whole documents table, each result written and read again. A stage's own
    intermediate tables, and its input if an earlier stage wrote it, go when its result is written."""
    work = Workspace(spark)
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        with temporary_tables():
            docs = work.save(stage(spark, docs, sf_dir))
        work.drop(*written)
        written = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
