"""A training corpus from raw documents: five stages, each an operator of ``millwright.llm``.

Each stage is written as Parquet and read again before the next one. All but the last return the columns
of ``documents`` (doc_id, text, lang, source, n_chars).

Defined results, for every stage: an empty table stays empty; columns of other names are not read; nulls in lang, source and
n_chars pass through, and null is a source of its own in the mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millwright.llm import byte_bpe, minhash, mixing, quality_rules, suffix_dedup
from millwright.llm.queries import RANKS, trusted_documents
from millwright.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio.

    Null and wordless texts fail the base rules; rows without an id and repeated rows are judged like any other.
    """
    judged = quality_rules.judge(docs, trusted_documents(spark, sf_dir), keep=("text", "lang", "source", "n_chars"))
    return judged.where("kept").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): that of the least id.

    Null and wordless texts are linked with nothing and stay. Of rows that repeat an id, one stays: that of the least text. Rows
    without an id have nothing to tell them apart by; they stay, all of them.
    """
    kept = minhash.link(docs.where("doc_id is not null"), width=5).where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    mine = docs.where("doc_id is not null").join(kept.hint("merge"), "doc_id").withColumn("_place", place).where("_place = 1")
    return mine.select(COLUMNS).unionByName(docs.where("doc_id is null").select(COLUMNS))


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 200 bytes that occur elsewhere; half a character at a cut goes too.

    Null texts stay null; repeated rows cut each other; rows without an id are cut like any other.
    """
    done = suffix_dedup.dedup(docs, keep=("text", "lang", "source", "n_chars"))
    rest = F.when(F.col("n_removed") > 0, whole_characters(F.col("kept"))).otherwise(F.col("text"))
    return (done.withColumn("text", rest).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(COLUMNS))


def whole_characters(raw):
    """Bytes as text, without those that are no whole character."""
    return F.regexp_replace(F.decode(F.encode(F.try_validate_utf8(raw.cast("string")), "utf-8"), "utf-8"), "�", "")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by target weights: a row for each pass over a document, with the words the mix takes.

    Null and wordless texts have nothing to take and give no row; repeated rows and rows without an id are mixed each.
    """
    return mixing.mixed_rows(docs, COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of the ids and of what they decode to, a row for each row; null texts have no ids."""
    return byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_strings),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: Stages use hashes and folds that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
