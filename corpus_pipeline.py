"""A training corpus from raw documents: five stages, each stored and read again.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents, but for
the last, which returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, line_templates, near_duplicates, packing, toxicity
from ledgerline.llm.queries import PACKING_TOKENIZER, benchmark, documents, labels
from ledgerline.workspace import freeze

#: Some stages have no SQL counterpart; the pipeline is tested stage by stage.
ORACLE_SQL = None


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose id is not among ``ids`` (a column ``doc_id`` without nulls)."""
    return docs.join(ids.select(F.col("doc_id").alias("_gone")), F.col("doc_id") == F.col("_gone"), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. Null and empty texts follow the bias.

    Rows that repeat an id go if any of them is rejected; null ids stay.
    """
    scored = toxicity.score_toxicity(docs, labels(spark, sf_dir))
    return _without(docs, scored.where("predicted = 1 AND doc_id IS NOT NULL").select("doc_id").distinct())


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; one that has nothing else goes.

    ``n_chars`` follows the text. Texts that were blank or null before stay.
    """
    cleaned = line_templates.drop_recurring_lines(docs)
    emptied = (F.col("n_dropped") > 0) & (F.btrim("text", F.lit(" \t\r\n\f\x0b")) == "")
    return (
        cleaned.where(~F.coalesce(emptied, F.lit(False)))
        .withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars")))
        .select(*docs.columns)
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows that repeat an id are one document and stay or go together.
    """
    groups = near_duplicates.near_duplicate_groups(docs, shingle_words=5, percent=80)
    return _without(docs, groups.where(~F.col("kept")).select("doc_id").distinct())


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    leaks = decontamination.find_leaks(docs, benchmark(spark, sf_dir))
    return _without(docs, leaks.select("doc_id").distinct())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed in sequences of at most 2048 tokens."""
    packed = packing.pack_documents(docs, public_tokenizers.path(PACKING_TOKENIZER), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = freeze(docs, name)
    return docs
