"""Training-data pipeline over ``documents``: every stage reads what the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillflow.llm import bpe, decontaminate, langid, linededup, minhash  # noqa: E402
from tillflow.llm.common import boxed, table  # noqa: E402
from tillflow.session import file_system, scratch_path  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no text, no letters, or text that no learned language
    codes in fewer bits than its raw bytes have. The others stay, and where ``lang`` is null
    it becomes the predicted one. If no row has a label there is no language to tell, and
    every text with letters stays as it is."""
    model = langid.learn(docs.where("doc_id IS NOT NULL"))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = langid.predict(boxed(docs, F.col("text"), adds=("text",)), model)
    left = judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("bits_per_byte") < 8))
    own = {"text": F.col("text"), "lang": F.coalesce("box.lang", "lang_pred")}
    return left.select(*[own.get(c, F.col("box").getField(c)).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove chunks of lines that occur before. A document of which nothing is left goes;
    ``n_chars`` follows the text where it is shortened."""
    rows = boxed(docs, F.col("doc_id"), F.col("text"), adds=("doc_id", "text"))
    left = linededup.deduplicate(rows).where("n_removed = 0 OR text <> ''")
    own = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("box.n_chars")).cast("long")
    return left.select(*[own.get(c, F.col("box").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    return minhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and what they decode to."""
    return bpe.round_trip(docs).select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encode", bpe_encode),
]

#: No DuckDB equivalent: code lengths under a learned model are not expressible there.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again.

    A stage's table is deleted once the next one is written; the last one goes with the session.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            fs, p = file_system(spark, before)
            fs.delete(p, True)
        before = path
    return docs
