"""Raw text receipt to typed receipt (S1 typing, T2, T6, T21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.timeparse import ISO_FORMATS, parse_ntz
from tillflow.schemas import RAW_COLUMNS, RECORD

# The texts that read_csv of pandas 1.3 reads as missing by default.
PANDAS_NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]


def na_to_null(c: Column, na_values=PANDAS_NA_VALUES) -> Column:
    return F.when(c.isin(*na_values), F.lit(None).cast("string")).otherwise(c)


def type_receipts(raw_text: DataFrame, formats=ISO_FORMATS, na_values=PANDAS_NA_VALUES) -> DataFrame:
    """Typed receipt columns plus ``_reject`` (null when the row is usable) and ``_record`` (its text if not).

    Extra columns (file lineage) pass through unchanged.
    """
    cols = {c: na_to_null(F.col(c), na_values) for c in RAW_COLUMNS}
    ts = parse_ntz(cols["timestamp"], formats)
    total = cols["total_price"].try_cast("double")
    record = F.col(RECORD) if RECORD in raw_text.columns else F.lit(None).cast("string")
    reject = (
        F.when(record.isNotNull(), F.lit("wrong number of fields"))
        .when(cols["timestamp"].isNull(), F.lit("timestamp missing"))
        .when(ts.isNull(), F.lit("timestamp unparsed"))
        .when(cols["total_price"].isNotNull() & total.isNull(), F.lit("total not a number"))
    )
    written = F.to_csv(F.struct(*RAW_COLUMNS))
    extra = [c for c in raw_text.columns if c not in (*RAW_COLUMNS, RECORD)]
    return raw_text.select(
        ts.alias("timestamp"),
        cols["store_name"].alias("store_name"),
        cols["customer_name"].alias("customer_name"),
        cols["basket_items"].alias("basket_items"),
        total.alias("total_price"),
        cols["payment_type"].alias("payment_type"),
        cols["card_number"].alias("card_number"),
        *extra,
        reject.alias("_reject"),
        F.when(reject.isNotNull(), F.coalesce(record, written)).alias(RECORD),
    )


def receipt_rejects(typed: DataFrame) -> DataFrame:
    """The receipts turned away: reason, text and file, equal ones of a file counted."""
    file = F.col("file_path") if "file_path" in typed.columns else F.lit(None).cast("string")
    bad = typed.where("_reject IS NOT NULL").select(F.col("_reject").alias("reason"), F.col(RECORD).alias("record"), file.alias("file_path"))
    return counted_rejects(bad)


def counted_rejects(bad: DataFrame) -> DataFrame:
    """Equal rows counted, under an id that digests all their columns: the id alone is grouped by, so the key is settled in that shuffle."""
    columns = bad.columns
    least = F.min(F.struct(*columns)).alias("_row")
    counted = bad.withColumn("reject_id", reject_id(*columns)).groupBy("reject_id").agg(least, F.count("*").alias("n"))
    return counted.select("reject_id", "_row.*", "n")


def reject_id(*columns: str) -> Column:
    """Digest of the columns' texts, null told from empty; a replayed file gives the same ids."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
