"""The corpus queries, one for each operator, and their DuckDB equivalents where SQL can say the same."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import (
    bpe,
    chat,
    decontaminate,
    embeddedup,
    fingerprint,
    hardnegatives,
    langid,
    linededup,
    minhash,
    periodicruns,
    secrets,
    tokencount,
    urlfilter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": minhash.query,
    "op2_language_id": langid.query,
    "op3_secrets": secrets.query,
    "op4_fingerprints": fingerprint.query,
    "op5_bpe": bpe.query,
    "op6_line_dedup": linededup.query,
    "op7_token_counts": tokencount.query,
    "op8_decontamination": decontaminate.query,
    "op9_url_filter": urlfilter.query,
    "op10_chat_format": chat.query,
    "op11_hard_negatives": hardnegatives.query,
    "op12_periodic_runs": periodicruns.query,
    "op13_embedding_duplicates": embeddedup.query,
}

ORACLE_SQL: dict[str, str] = {
    "op1_near_duplicates": minhash.ORACLE,
    "op3_secrets": secrets.oracle(),
    "op6_line_dedup": linededup.ORACLE,
    "op9_url_filter": urlfilter.oracle(),
    "op10_chat_format": chat.ORACLE,
    "op11_hard_negatives": hardnegatives.ORACLE,
    "op13_embedding_duplicates": embeddedup.ORACLE,
}
