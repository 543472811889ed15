"""A corpus pipeline: stages over ``documents``, each written and read again.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and, but for the last, returns the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.llm import decontamination, forest, language, packing, secrets
from paritas.llm.common import free_name, saved, table
from paritas.llm.queries import END_ID, tokenizer_path

#: A text of this many characters whose best cosine is under this is in none of the languages.
LEAST_SCORE, SCORED_CHARS = 0.1, 200
#: Words of the runs that near copies share; a similarity of 0.8 or more counts.
WORDS = 5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and long ones that no learned language resembles."""
    profiles = language.learn(docs, F.lit(True))
    into = free_name(docs, "language")
    found = language.predict(docs, profiles, into)
    if profiles.languages:
        rejected = (F.col(into).lang_pred == language.UNDETERMINED) | (
            (F.col(into).score < LEAST_SCORE) & (F.length("text") >= SCORED_CHARS))
    else:  # no row names a language: only a letter is asked for
        rejected = ~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return found.where(~rejected).drop(into)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word runs) keeps the smallest doc_id."""
    found = forest.groups(docs, k=WORDS)
    copies = found.where("NOT kept").select("doc_id").distinct()
    # as many as the corpus has: never broadcast
    return docs.join(copies.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    into = free_name(docs, "leaks")
    found = decontamination.scan(docs, table(spark, sf_dir, "benchmark"), into=into)
    return found.where(F.size(into) == 0).drop(into)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; each secret in a text gives way to its kind in brackets."""
    into = free_name(docs, "secrets")
    redacted = F.col(into).redacted
    text = F.coalesce(redacted, F.col("text"))
    found = secrets.scan(docs, redact=True, into=into)
    return found.select(*[
        (text if c == "text" else
         F.when(redacted.isNull(), F.col(c)).otherwise(F.length(text))
         if c == "n_chars" else F.col(c)).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces with their sequences and places there."""
    return packing.pack(docs, tokenizer_path(), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: The stages bundle vectors, link near copies and pack by a fitted plan: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
