"""A corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm.common import spare_name
from platewise.llm.exactdedup import drop_copies
from platewise.llm.mixing import in_written_order, mixed
from platewise.llm.pieces import encode_texts
from platewise.llm.quality import keep_good
from platewise.llm.queries import OTHER, TARGETS
from platewise.llm.simhash import drop_near_copies
from platewise.session import materialize

# No SQL labels lines with a fitted field or hashes shingles.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line labels, learnt from ``labels``, do not reject."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that of the largest id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in an order that keeps the sources at their target weights."""
    return mixed(docs, TARGETS, OTHER)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, segmented with seeded dropout, in the order of the files given.

    ``position`` is the document's place in that order, from 0; rows are sorted by it.
    """
    place = spare_name(docs, "position")
    placed = in_written_order(docs, place)
    tokens = encode_texts(placed, public_tokenizers.path("piece_bpe_32k.model"), place_col=place)
    return tokens.withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixing", mixing),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns lies in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
