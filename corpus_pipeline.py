"""From raw documents to packed training sequences, as five stages.

Every stage takes what the one before kept. Documents that are of low quality or toxic go, one of
each group of near duplicates stays, personal data is replaced by its kind in brackets, and what is
left is cut into pieces of training sequences. Each stage but the last returns the columns of its
input; rows pass as a whole, so further columns, whatever their names, stay as they are.

Null text counts as empty. An empty table passes through every stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.llm import neardup, packing, pii, quality, toxicity  # noqa: E402
from millrace.llm.common import fresh, staged, table  # noqa: E402

QUALITY_AT = 0.5
TOXIC_AT = 0.3
WORDS = 5
# The input's columns as one value, under a name that no operator uses.
ROW = fresh("row")


def _whole_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct("*").alias(ROW))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches one half."""
    field = quality.fit(docs, table(spark, sf_dir, "labels"), ~quality.held_out())
    scored = quality.score(_whole_rows(docs), field, (ROW,))
    return scored.where(F.col("score") >= QUALITY_AT).select(f"{ROW}.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.score(_whole_rows(docs), model, (ROW,))
    return scored.where(F.col("score") < TOXIC_AT).select(f"{ROW}.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on five-word shingles."""
    found = neardup.near_duplicates(_whole_rows(docs), WORDS, carry=(ROW,))
    return found.where("single").select(f"{ROW}.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the new text."""
    trees = pii.fit(docs)
    found = pii.find(_whole_rows(docs), trees, (ROW,)).withColumn("old", F.col(f"{ROW}.text"))
    found = found.withColumn("new", F.when(F.col("old").isNotNull(), pii.redacted("old", "spans")))
    changed = {"text": F.col("new"), "n_chars": F.char_length("new").cast("long")}
    return found.select(*[
        (F.when(F.size("spans") > 0, changed[c]).otherwise(F.col(f"{ROW}.`{c}`")).alias(c)
         if c in changed else F.col(f"{ROW}.`{c}`"))
        for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact),
    ("packing", pack),
]

# The first two stages score with trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
