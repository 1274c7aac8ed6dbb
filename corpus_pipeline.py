"""A corpus for training, from `documents`: language, near copies, personal
data, packing. Every stage reads what the one before has written.

The stages have the operators' own parameters. Rows whose language is
rejected go; of each group of near copies the smallest doc_id stays; personal
data is replaced in the texts; the last stage gives the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm.common import save, table
from cinerank.llm.jaccard_join import jaccard_join
from cinerank.llm.langid import identify
from cinerank.llm.packing import pack
from cinerank.llm.pii import sanitise

# Near copies: five words, a similarity of 0.8.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; `lang` is left as it came."""
    return identify(docs).where(~F.col("rejected")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near copies; one
    of repeated rows. Rows without a doc_id belong to no group and stay."""
    groups = jaccard_join(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns).dropDuplicates(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in the texts."""
    return sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_copies", near_copies), ("personal_data", personal_data), ("packed", packed)]

# Trained classification, spans by position and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
