"""A training corpus from documents: language, quality, near-duplicates, repeats, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes
each result as Parquet and reads it again, so a lost executor costs one task, not the stages before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langcrf, ledger, packing, simhash, suffixes
from tidemark.llm.registry import public_vocabulary, table
from tidemark.llm.scratch import Scratch

#: A document whose words have less than this posterior for their own best language, in the mean, has
#: none. Several languages in one text do not lower it.
LEAST_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: a null or empty text, one without a letter, or one whose
    words no language fits. If nothing is labelled, nothing can be learned, and all documents stay.
    Null ids, ties and repeated rows are judged like any row; no rows give none; columns of any name
    pass through."""
    model = langcrf.learn_from(docs)
    if model is None:
        return docs
    rows = langcrf.label_documents(docs, model, carry=tuple(docs.columns), certainty=True)
    known = (F.col("lang_pred") != langcrf.UNKNOWN) & (F.col("certainty") >= LEAST_SCORE)
    return rows.where(known).select(*[F.col("carried")[c].alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail a rule of the standard policy; a null or empty text does. Null ids,
    ties and repeated rows are judged like any row; no rows give none; columns of any name pass
    through, those named like a measurement too."""
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    judged = ledger.apply_policy(ledger.ledger(packed), ledger.STANDARD)
    return judged.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near texts, that of the smallest id. Rows without an id stay
    only where no document of their group has one, one of them; of equal rows one stays."""
    return simhash.one_per_group(docs, Scratch(spark))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts what an earlier document has too; a document that loses all its text stays, empty."""
    along = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = suffixes.dedup_substrings(docs, Scratch(spark), carry=along, as_text=True)
    rows = cut.select("doc_id", F.col("kept").alias("text"), *[F.col("carried")[c].alias(c) for c in along])
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into training windows, one row per piece. A null or empty text is its end token;
    repeated rows and null ids are packed like any row; no rows give none."""
    return packing.pack_documents(docs, public_vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("packing", pack),
]

#: Tokens and a learned model are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stage = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, step in STAGES[:-1]:
        docs = stage.put(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
