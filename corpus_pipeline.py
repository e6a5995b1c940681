"""The corpus pipeline: quality, near duplicates, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and works on all rows the one before has kept; its result is
written as Parquet and read again. All but the last return the columns of ``documents``.

Every stage takes null and empty texts, very long ones, repeated rows, null ids and empty tables; columns beyond those of
``documents`` are dropped by the stages that return its columns, whatever their names. An empty table of labels,
benchmark items or documents leaves nothing to learn, to find or to do: the stage then gives back all its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarline.llm import jaccard, leaks, mixing, quality, tokens
from bazaarline.llm.queries import END_ID, byte_bpe, scratch, table
from bazaarline.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MAX_REPEATS = 1.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (trained on ``labels`` outside the held-out fold) accepts.

    Null and empty texts are scored like others, repeated rows each. Without labels of both classes all rows have the prior as score.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by a shingle overlap of 3/4.

    Texts without words are in no group and stay, and so do rows without an id. All rows of an id that stays remain.
    """
    return jaccard.one_per_component(docs).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``: null and empty texts have none. Repeated rows are judged each."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weighted towards each other: every document once at least, small sources repeated up to
    ``MAX_REPEATS`` passes. A repeated document is a repeated row.

    Null sources are one source. Texts without words weigh nothing and pass as they are.
    """
    mixed, _ = mixing.mix_sources(docs, max_repeats=MAX_REPEATS, cover=True)
    return mixing.schedule(mixed).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left; a row per document as read back from them. A null text is an empty one
    and has the end id alone."""
    manifest = tokens.write_tokens(docs, byte_bpe(), scratch(spark, "pipeline-tokens"), END_ID)
    return tokens.read_tokens(manifest)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("token_output", token_stage),
]

# trained scores, edit distances and tokenizers are beyond SQL: tests/llm/test_pipeline.py compares with plain versions
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}-{uuid.uuid4().hex[:8]}")
    return docs
