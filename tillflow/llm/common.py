"""Helpers that the corpus operators share."""

from __future__ import annotations

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import ensure_checkpoint_dir, file_system, scratch_path

#: Bits of a bitmap of the keys of parts of texts (8 MB in 2048 rows), and of one of documents (2 MB).
BITS, DOC_BITS = 1 << 26, 1 << 24

_LETTER = regex.compile(r"\p{L}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a copy in the shared checkpoint folder, which outlives executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Tables:
    """Intermediate tables in the session's folder under the shared checkpoint location.

    Calling it writes a DataFrame, with options of the writer if any, and returns what
    reads it back, cut from its lineage. ``drop`` deletes one of them, leaving the ``with`` block the rest,
    so only what the block returns through ``durable`` or ``result`` stays. What
    nobody deletes goes with the session.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._made: list[tuple[DataFrame, str]] = []

    def __call__(self, df: DataFrame, **options: str) -> DataFrame:
        out, path = self._written(df, **options)
        self._made.append((out, path))
        return out

    def _written(self, df: DataFrame, **options: str) -> tuple[DataFrame, str]:
        # executors delete the shuffle files of earlier steps once the driver's JVM has collected those steps
        self.spark._jvm.System.gc()
        path = scratch_path(self.spark, "step")
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def result(self, df: DataFrame) -> DataFrame:
        """``df`` in a table that outlives the ``with`` block."""
        return self._written(df)[0]

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for _, path in [m for m in self._made if any(m[0] is t for t in tables)]:
            fs, p = file_system(self.spark, path)
            fs.delete(p, True)
        self._made = [m for m in self._made if not any(m[0] is t for t in tables)]

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*[t for t, _ in self._made])


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def boxed(df: DataFrame, *uses: Column, adds: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as one column ``box`` that holds all its columns but those in ``adds``, next to the columns it ``uses``.

    An operator can then name its own columns as it likes, whatever ``df`` has.
    """
    taken = {n.lower() for n in adds}
    kept = [F.col(quoted(c)) for c in df.columns if c.lower() not in taken]
    return df.select(F.struct(*kept).alias("box"), *uses)


def unboxed(df: DataFrame, *added: Column, replaced: dict[str, Column] | None = None) -> DataFrame:
    """The columns in the box, some of them replaced, and then those ``added``."""
    names = df.schema["box"].dataType.names
    new = {k.lower(): v for k, v in (replaced or {}).items()}
    return df.select(*[new.get(n.lower(), F.col("box").getField(n)).alias(n) for n in names], *added)


def maybe_in(rows: DataFrame, keys: DataFrame, key: str, n_bits: int = BITS) -> DataFrame:
    """``rows`` and ``maybe``: false if ``key`` is null or not among ``keys``, true if it is, and for few others.

    A bitmap of ``n_bits`` bits, whatever the number of keys, is broadcast. Rows that are
    told apart by it need an inner or outer join after it: Spark moves a semi or anti
    join to where the bitmap has not been looked at yet.
    """
    bit = F.pmod(F.xxhash64(F.col(key)), F.lit(n_bits))
    # rows are dealt out by bitmap before they are set, so that no partial bitmaps are shuffled
    bits = keys.where(F.col(key).isNotNull()).select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("at"))
    maps = bits.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("map"))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("map", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    hit = F.coalesce(F.col(key).isNotNull() & (F.getbit(byte, (at % 8).cast("int")) == 1), F.lit(False))
    told = rows.withColumn("bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(maps), "bucket", "left")
    return told.withColumn("maybe", hit).drop("bucket", "map")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
