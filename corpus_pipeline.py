"""A training corpus from documents: languages, near-duplicates, repeated passages, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language, mixing, neardup, pieces, substrings
from millrace.llm.common import ship
from millrace.session import write_out

#: Documents whose likeliest language has a lower posterior, against the other learned languages and the
#: background of unlearned ones, are rejected, as are those without a letter.
LEAST_CERTAIN = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that is known from the corpus's own labels; those of others and undetermined ones go.

    Null, empty and letterless texts are undetermined. Null labels teach nothing; without any label all go.
    Repeated rows stay. Columns may have any names. Empty tables stay empty.
    """
    ship(spark)
    names = [f"c{k}" for k in range(len(docs.columns))]
    said = language.identify(docs.toDF(*names), language.train(docs), text_col=names[docs.columns.index("text")])
    known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_CERTAIN)
    return said.where(known).select(names).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id. Repeated rows are one.

    Null ids come first, equal ids by a hash of their text. Null, empty and wordless texts are in no group,
    but rows with one id and text are one. Columns may have any names. Empty tables stay empty.
    """
    ship(spark)
    key = F.struct("doc_id", F.xxhash64("text").alias("text_hash"))
    stays = neardup.groups(docs.select(key.alias("id"), "text"), id_col="id").where("kept").select(F.col("doc_id").alias("id"))
    rows = docs.select(key.alias("id"), F.struct("*").alias("row"))
    return rows.join(stays, "id", "left_semi").dropDuplicates(["id"]).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has: see ``substrings.without_repeats``."""
    ship(spark)
    return substrings.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: see ``mixing.copies``."""
    ship(spark)
    return mixing.copies(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every document: see ``pieces.encode``."""
    ship(spark)
    return pieces.encode(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: SQL cannot express the stages; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
