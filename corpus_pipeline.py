"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` stores as
Parquet and hands on. All stages but the last return the columns of ``docs``: those of
``documents``, and any more that a caller's table has. Nulls in any column, empty and very
long texts, repeated rows and empty tables pass through every stage as the stage's operator
defines them; text is rewritten only where personal data is found.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.llm import jaccard_join, packing, pii, quality_classifier, quality_rules
from seedloom.llm.frames import free_name, quoted, read, stored
from seedloom.llm.queries import EXAMPLE_KEY, LEAST_SCORE, TOKENIZER


def keep_good_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep; empty ones have no words and go."""
    verdict = free_name(docs, "verdict")
    return quality_rules.judge(docs, out=verdict).where(f"{verdict}.kept").select(*quoted(docs.columns))


def keep_good_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being good reaches the threshold.

    The model learns, as in ``op8``, from the labels of all given documents: those that stage 1
    has taken out are nearly all of the bad ones.
    """
    labelled = quality_classifier.labelled_rows(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    scored = quality_classifier.score_texts(docs, quality_classifier.fit(labelled), out=score)
    return scored.where(F.col(score) >= LEAST_SCORE).select(*quoted(docs.columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, any one of equal rows with it.

    Near copies share four fifths of their five-word n-grams; ``op7`` has a contract of its own.
    """
    return jaccard_join.JaccardJoin(docs, size=5, threshold=jaccard_join.Threshold(80, 100)).representatives()


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in their texts; ``n_chars`` follows the new text."""
    hidden = pii.pseudonymize(docs, EXAMPLE_KEY, found=None)
    if "n_chars" in docs.columns:
        counted = F.coalesce(F.length("text"), F.col("n_chars"))
        hidden = hidden.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    return hidden.select(*quoted(docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their token ids."""
    return packing.pack_texts(docs, public_tokenizers.path(TOKENIZER), end_id=1).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality rules", keep_good_by_rules),
    ("quality classifier", keep_good_by_classifier),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("PII", hide_personal_data),
    ("packing", pack_sequences),
]

#: Fitted models, components and token ids are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each stored before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
    return docs
