"""Content-hash ids.

``sha256``: built-in ``sha2`` (whole-stage codegen), 64 hex characters, the
notebook variant of the ids. ``shake256``: the id the deployed job writes
(SHAKE-256 cut to 8 bytes, 5 for stores, as hex); Spark has no built-in for it,
so it runs as an Arrow-batched pandas UDF over ``hashlib``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.functions.canonical import card_text_sql, double_text_sql, ref, string_text_sql, timestamp_text_sql


@lru_cache(maxsize=None)
def _shake_udf(nbytes: int):
    @F.pandas_udf("string")
    def shake(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: None if s is None else hashlib.shake_256(s.encode("utf-8")).hexdigest(nbytes))

    return shake


def shake256_hex(text: Column, nbytes: int) -> Column:
    return _shake_udf(nbytes)(text)


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def packed(text: Column) -> Column:
    """A text as bytes, half as many for lower-case hex (every id here): what a shuffle of keys moves. Distinct texts stay distinct."""
    raw = F.unhex(text)
    lower_hex = (F.octet_length(text) == 2 * F.octet_length(raw)) & (F.lower(text) == text)
    return F.when(lower_hex, F.concat(F.lit(bytearray([1])), raw)).otherwise(
        F.concat(F.lit(bytearray([0])), text.cast("binary"))
    )


def unpacked(data: Column) -> Column:
    """The text that ``packed`` made these bytes from."""
    rest = data.substr(F.lit(2), F.length(data))
    return F.when(data.substr(1, 1) == F.lit(bytearray([1])), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


@dataclass(frozen=True)
class IdScheme:
    """How ids are derived. ``kind`` is ``sha256`` (default) or ``shake256``."""

    kind: str = "sha256"
    order_bytes: int = 8
    store_bytes: int = 5
    product_bytes: int = 8
    card_style: str = "string"

    @property
    def jvm_only(self) -> bool:
        return self.kind == "sha256"

    def id_length(self, column: str) -> int:
        """Characters of an id column's values."""
        if self.kind == "sha256":
            return 64
        return 2 * {"order_id": self.order_bytes, "store_id": self.store_bytes, "product_id": self.product_bytes}[column]

    def digest(self, text: Column, nbytes: int) -> Column:
        if self.kind == "sha256":
            return sha256_hex(text)
        if self.kind == "shake256":
            return shake256_hex(text, nbytes)
        raise ValueError(f"unknown id hash: {self.kind}")

    def order_text_sql(self) -> str:
        """Text of a raw receipt: its seven columns in file order, no separator."""
        parts = [
            timestamp_text_sql(ref("timestamp")),
            string_text_sql(ref("store_name")),
            string_text_sql(ref("customer_name")),
            string_text_sql(ref("basket_items")),
            double_text_sql(ref("total_price")),
            string_text_sql(ref("payment_type")),
            card_text_sql(ref("card_number"), self.card_style),
        ]
        return "concat(" + ", ".join(parts) + ")"

    def order_id(self) -> Column:
        """Id of a receipt row; reads the seven raw columns by name."""
        return self.digest(F.expr(self.order_text_sql()), self.order_bytes)

    def store_id(self, store_name: str = "store_name") -> Column:
        return self.digest(F.expr(string_text_sql(ref(store_name))), self.store_bytes)

    def product_id(self, item_name: str = "item_name", item_size: str = "item_size", item_price: str = "item_price") -> Column:
        """Name, size, price text in that order; the price is hashed as text."""
        text = "concat(" + ", ".join(string_text_sql(ref(c)) for c in (item_name, item_size, item_price)) + ")"
        return self.digest(F.expr(text), self.product_bytes)

    def pseudonym(self, name: str, nbytes: int = 8) -> Column:
        """Replace a personal value by the hash of its text."""
        return self.digest(F.expr(string_text_sql(ref(name))), nbytes)


SHA256 = IdScheme("sha256")
SHAKE256 = IdScheme("shake256")
