"""One load: receipts -> four tables and two reject tables -> insert-if-absent into the targets.

Shared by the batch command and by each streaming micro-batch. The typed
receipts are persisted once (memory, spilling to disk) so the outputs do not
each rescan and re-hash the input; a lost executor only means its blocks are
recomputed from the source files.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.clean import receipt_rejects
from tillflow.functions.hashing import SHA256, IdScheme
from tillflow.operators.normalize import item_rejects, normalize
from tillflow.schemas import KEYS, TABLES
from tillflow.sinks.tables import load_if_absent, read_target


def load_receipts(typed: DataFrame, target_dir: str, spark: SparkSession | None = None, ids: IdScheme = SHA256,
                  by_file: bool = True) -> dict[str, int]:
    """Typed receipts (``functions.clean.type_receipts`` or the fixture) -> targets; rows added by table.

    Receipts and items that cannot be loaded go to ``receipt_rejects`` and
    ``item_rejects`` with reason and file, each once however often it is sent.
    """
    spark = spark or typed.sparkSession
    typed = typed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if by_file and "file_path" in typed.columns:  # what comes from one file needs no choice between files
            path = typed.agg(F.min("file_path"), F.max("file_path"), F.count_if(F.col("file_path").isNull())).first()
            by_file = path[0] != path[1] or path[2] > 0
        else:
            by_file = False
        n = normalize(typed, ids, by_file=by_file)
        tables = {t: n.staged(t) for t in KEYS}
        if "_reject" in typed.columns:
            tables["receipt_rejects"] = receipt_rejects(typed)
        tables["item_rejects"] = item_rejects(n.items)
        return load_if_absent(tables, target_dir, spark)
    finally:
        typed.unpersist()


def targets(spark: SparkSession, target_dir: str) -> dict[str, DataFrame]:
    """The loaded tables with their declared columns."""
    return {t: read_target(spark, target_dir, t).select(*[f.name for f in TABLES[t].fields]) for t in KEYS}


def reject_report(spark: SparkSession, target_dir: str) -> DataFrame:
    """(kind, reason, n): how many receipts and items the loads so far have turned away."""
    kinds = [read_target(spark, target_dir, t).select(F.lit(t).alias("kind"), "reason", "n") for t in ("receipt_rejects", "item_rejects")]
    return kinds[0].unionByName(kinds[1]).groupBy("kind", "reason").agg(F.sum("n").alias("n"))
