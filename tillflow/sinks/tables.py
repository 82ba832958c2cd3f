"""Target tables on the shared store (K2, K4-K6, K9).

Targets are parquet folders. A load appends only the rows whose key is absent
(``operators.upsert``), in the order stores, products, orders, orders_products
so every foreign key holds at each commit. Each append is one Spark job with
the file commit protocol, so a failed task or a lost executor leaves no partial
table; the four tables are four commits, and a load that stopped between two is
completed by running it again, which adds nothing twice.

One writer at a time is assumed: two loads that run at once on one folder can
both find a key absent. A table format with commits would lift that.
"""

from __future__ import annotations

import functools
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators.upsert import anti_join, one_per_key
from tillflow.functions.hashing import packed, unpacked
from tillflow.schemas import DEAL, KEYS, LOAD_ORDER, PARTITION_COLUMN, REJECTS, TABLES, Staged
from tillflow.session import file_system

#: Tasks that share the months of a small load between them.
MONTH_WRITERS = 16
#: Rows of one written file, about, and files of a partition from which ``compact`` rewrites it.
ROWS_PER_FILE = 1_000_000
COMPACT_FROM = 8
#: Staged keys up to this many are broadcast to reduce the target before the anti join (64-byte keys: 64 MB).
BROADCAST_KEYS = 500_000


def conform(df: DataFrame, table: str, keep_partition: bool = False) -> DataFrame:
    """Column order, types and comments of the target (K6, P10).

    Values that do not fit have been rejected before (``normalize.valid_items``,
    ``clean.type_receipts``); one that still arrives becomes null, which the
    not-null check reports, instead of failing the whole batch.
    """
    cols = []
    for f in TABLES[table].fields:
        c = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name, metadata=f.metadata))
    part = PARTITION_COLUMN.get(table)
    if keep_partition and part:
        cols += [F.col(c) for c in (part, DEAL) if c == part or c in df.columns]
    return df.select(*cols)


def _stored_schema(table: str) -> T.StructType:
    schema = (TABLES | REJECTS)[table]
    if table in PARTITION_COLUMN:
        schema = T.StructType(schema.fields + [T.StructField(PARTITION_COLUMN[table], T.DateType(), True)])
    return schema


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def month_folders(spark: SparkSession, root: str, part: str, months: list) -> list[str]:
    """The folders of these months that exist; others are not looked at."""
    named = [f"{root}/{part}={m.isoformat() if m else '__HIVE_DEFAULT_PARTITION__'}" for m in months]
    return [p for p in named if _exists(spark, p)]


def stored(spark: SparkSession, base: str, table: str, months: list | None = None) -> DataFrame | None:
    """A target as stored, or None if there is none yet; with ``months``, only of these."""
    root, part = f"{base.rstrip('/')}/{table}", PARTITION_COLUMN.get(table)
    reader = spark.read.schema(_stored_schema(table))
    if part and months is not None:
        paths = month_folders(spark, root, part, months)
        return reader.option("basePath", root).parquet(*paths) if paths else None
    return reader.parquet(root) if _exists(spark, root) else None


def read_target(spark: SparkSession, base: str, table: str, months: list | None = None) -> DataFrame:
    """A target as stored (month-partitioned tables include ``order_month``); empty if there is none yet.

    With ``months`` only their folders are listed and read, so the cost does
    not grow with the months that a load does not touch.
    """
    found = stored(spark, base, table, months)
    return spark.createDataFrame([], _stored_schema(table)) if found is None else found


def batch_months(staging: DataFrame, table: str) -> list:
    """The months of a batch: bounded by the calendar, not by the data."""
    return [r[0] for r in staging.select(PARTITION_COLUMN[table]).distinct().collect()]


def known_keys(staged: DataFrame, n: int, target: DataFrame, keys: list[str]) -> DataFrame:
    """The staged keys that the target holds; ``n`` is how many keys are staged.

    Up to ``BROADCAST_KEYS`` of them go to where the target's files are, so the
    target is scanned and not shuffled, and what is found is no more than was
    staged. More keys meet the target in a sort-merge join.
    """
    return target.join(F.broadcast(staged) if n <= BROADCAST_KEYS else staged, keys, "left_semi").distinct()


def _write(rows: DataFrame, n: int, base: str, table: str) -> int:
    """Write ``rows``, at most ``n``, in files of about ``ROWS_PER_FILE``; the rows written, as the write observed them."""
    part = PARTITION_COLUMN.get(table)
    order = [*([part] if part else []), *KEYS.get(table, ["reject_id"])]
    files = -(-n // ROWS_PER_FILE)
    if files > 1:
        dealt = rows.repartitionByRange(files, *order)
    else:  # a month is one file either way; opening them takes longer than filling them
        dealt = rows.repartition(MONTH_WRITERS, part) if part else rows.repartition(1)
    return _append(dealt.sortWithinPartitions(*order), base, table)


def _append(rows: DataFrame, base: str, table: str) -> int:
    """Append rows as they are dealt; how many, as the write observed them. Ids are hex digits, which only an entropy coder shortens."""
    part = PARTITION_COLUMN.get(table)
    written = Observation()
    writer = rows.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append").option("compression", "zstd")
    (writer.partitionBy(part) if part else writer).parquet(f"{base.rstrip('/')}/{table}")
    return written.get["n"]


@contextmanager
def _set(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _kept_in_place(spark: SparkSession):
    """A join whose one side is dealt by some of its keys leaves that side where it is, for the actions inside."""
    return _set(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def _kept(rows: DataFrame) -> DataFrame:
    """Persisted in as many parts as its size asks for: with one per shuffle partition, each later shuffle of few rows writes their square in files."""
    with _set(rows.sparkSession, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true"):
        return rows.persist(StorageLevel.MEMORY_AND_DISK)


def _deal(part: str, sizes: dict) -> Column:
    """The task of a row: its month, or of a month of more than ``ROWS_PER_FILE`` rows a part of its orders."""
    parts = [x for m, n in sizes.items() if m and n > ROWS_PER_FILE for x in (F.lit(m), F.lit(-(-n // ROWS_PER_FILE)))]
    n_parts = F.coalesce(F.element_at(F.create_map(*parts), F.col(part)), F.lit(1)) if parts else F.lit(1)
    return F.coalesce(F.unix_date(part), F.lit(-1)) * F.lit(65536).cast("long") + F.pmod(F.xxhash64("order_id"), n_parts)


def insert_dated(staged: Staged, spark: SparkSession, base: str, table: str) -> int:
    """Insert one load's new rows of a dated table; the rows added.

    The rows of each month are counted first, at most, if they are not given. A load of more than
    ``BROADCAST_KEYS`` moves what it was given once, to the task that makes,
    compares, sorts and writes it; of the target, the keys of its months move
    there too. So nothing is kept between, and no row of the table is shuffled.
    Smaller loads go by ``insert_new``.
    """
    part, keys = PARTITION_COLUMN[table], KEYS[table]
    sizes = staged.sizes  # as many as the calendar has
    if sizes is None:
        sizes = {r[0]: r[1] for r in staged.rows.groupBy(part).agg(F.sum(staged.size)).collect()}
    n = sum(sizes.values())
    if not n:
        return 0
    if n <= BROADCAST_KEYS:
        rows = _kept(conform(staged.finish(staged.rows), table, keep_partition=True))
        try:
            return insert_new(rows, spark, base, table, list(sizes))
        finally:
            rows.unpersist()
    ids = [c for c in keys if c in staged.rows.columns]
    moved = staged.rows.select(_deal(part, sizes).alias(DEAL), *[packed(F.col(c)).alias(c) if c in ids else c for c in staged.rows.columns])
    dealt = moved.repartition(DEAL).select(*[unpacked(F.col(c)).alias(c) if c in ids else c for c in moved.columns])
    rows = conform(staged.finish(dealt), table, keep_partition=True)
    if not staged.unique:
        rows = one_per_key(rows, [*keys, DEAL])
    target = stored(spark, base, table, list(sizes))
    if target is not None:
        # Packed before the join, not in its condition: there a sort works them out for every comparison.
        rows = rows.select("*", *[packed(F.col(k)).alias(f"_new_{k}") for k in keys])
        known = target.select(*[packed(F.col(k)).alias(f"_{k}") for k in keys], _deal(part, sizes).alias("_of"))
        same = functools.reduce(Column.__and__, [F.col(f"_new_{k}") == F.col(f"_{k}") for k in keys]) & (F.col(DEAL) == F.col("_of"))
        rows = rows.join(known, same, "left_anti").drop(*[f"_new_{k}" for k in keys])
    with _kept_in_place(spark):
        return _append(rows.drop(DEAL).sortWithinPartitions(part, *keys), base, table)


def _batch_months(staging: DataFrame, table: str, months: list | None) -> list | None:
    return batch_months(staging, table) if months is None and table in PARTITION_COLUMN else months


def _without(staging: DataFrame, known: DataFrame | None, n: int, keys: list[str]) -> DataFrame:
    """One row of each of the ``n`` staged keys but for the known ones."""
    rows = one_per_key(staging, keys)
    if known is None:
        return rows
    return anti_join(rows, F.broadcast(known) if n <= BROADCAST_KEYS else known, keys)


def new_rows(staging: DataFrame, spark: SparkSession, base: str, table: str, months: list | None = None) -> DataFrame:
    """The rows of one load that are not in the target yet; of a month-partitioned one only the batch's months are read."""
    keys = KEYS.get(table, ["reject_id"])
    target = stored(spark, base, table, _batch_months(staging, table, months))
    staged = staging.select(*keys).distinct()
    n = staged.count()
    known = None if target is None else known_keys(staged, n, target.select(*keys), keys)
    return _without(staging, known, n, keys)


def insert_new(staging: DataFrame, spark: SparkSession, base: str, table: str, months: list | None = None) -> int:
    """Insert the rows of one load whose key is not in the target yet; the rows added.

    The staged keys are counted, then those that the target holds already. If
    that leaves none, nothing is written; else one job writes the rest. A batch
    of up to ``BROADCAST_KEYS`` keys is joined without a shuffle of the target.
    """
    keys = KEYS.get(table, ["reject_id"])
    staged = staging.select(*keys).distinct()
    n = staged.count()
    target = stored(spark, base, table, _batch_months(staging, table, months)) if n else None
    if target is None:
        return _write(_without(staging, None, n, keys), n, base, table) if n else 0
    known = _kept(known_keys(staged, n, target.select(*keys), keys))
    try:
        left = n - known.count()
        return _write(_without(staging, known, n, keys), left, base, table) if left else 0
    finally:
        known.unpersist()


def _first_rejects(staging: DataFrame, spark: SparkSession, base: str, table: str) -> int:
    """Write the rejects of a load where there are none yet, from the shuffle that counted them; the rows added."""
    n = _append(one_per_key(staging, ["reject_id"]).sortWithinPartitions("reject_id"), base, table)
    if not n:  # an empty file is no table
        fs, p = file_system(spark, f"{base.rstrip('/')}/{table}")
        fs.delete(p, True)
    return n


def load_if_absent(tables: dict[str, DataFrame | Staged], base: str, spark: SparkSession, months: list | None = None) -> dict[str, int]:
    """Insert-if-absent of each table into its target folder (K4, K5); rows added by table.

    Fact tables must carry ``order_month`` (``Normalized.dated``). ``months``
    may be given (a superset is fine: it only widens the partitions read);
    otherwise it is taken from each staging table.
    """
    added = {}
    for name in (*LOAD_ORDER, *REJECTS):
        if name not in tables:
            continue
        recover(spark, base, name)
        if isinstance(tables[name], Staged):
            added[name] = insert_dated(tables[name], spark, base, name)
            continue
        if name in REJECTS and not _exists(spark, f"{base.rstrip('/')}/{name}"):
            added[name] = _first_rejects(tables[name], spark, base, name)
            continue
        staging = tables[name] if name in REJECTS else conform(tables[name], name, keep_partition=True)
        staging = _kept(staging)
        try:
            added[name] = insert_new(staging, spark, base, name, months)
        finally:
            staging.unpersist()
    return added


def append_rows(df: DataFrame, base: str, table: str) -> int:
    """Blind append, no key check (K2); fact tables must carry ``order_month``."""
    rows = _kept(conform(df, table, keep_partition=True))
    try:
        n = rows.count()
        return _write(rows, n, base, table) if n else 0
    finally:
        rows.unpersist()


def compact(spark: SparkSession, base: str, table: str) -> int:
    """Rewrite the folders of a target that hold many small files; returns how many were rewritten.

    Maintenance, while no load runs. A folder is first copied next to the
    target in files of ``ROWS_PER_FILE`` rows; then it steps aside and the copy
    takes its place. If a run stops in between, ``recover`` (which this and
    every load call first) puts the copy in place, or the folder back.
    """
    recover(spark, base, table)
    root, part = f"{base.rstrip('/')}/{table}", PARTITION_COLUMN.get(table)
    fs, p = file_system(spark, root)
    if not fs.exists(p):
        return 0
    folders = [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()] if part else [root]
    done = 0
    for folder in folders:
        status = fs.listStatus(file_system(spark, folder)[1])
        files = [s for s in status if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        if len(files) < COMPACT_FROM:
            continue
        rows = spark.read.schema((TABLES | REJECTS)[table]).parquet(folder)
        copy, aside = _compact_paths(base, table, folder if part else "")
        rows.repartitionByRange(-(-max(rows.count(), 1) // ROWS_PER_FILE), *KEYS.get(table, ["reject_id"])).write.parquet(copy)
        _rename(spark, folder, aside)
        _rename(spark, copy, folder)
        fs.delete(file_system(spark, aside)[1], True)
        done += 1
    fs.delete(file_system(spark, f"{base.rstrip('/')}/_compact-{table}")[1], True)
    return done


def _compact_paths(base: str, table: str, folder: str) -> tuple[str, str]:
    """Where the copy of a folder is made, and where the folder waits meanwhile."""
    name = f"{base.rstrip('/')}/_compact-{table}/{folder.rstrip('/').rsplit('/', 1)[-1] or 'all'}"
    return f"{name}.copy", f"{name}.old"


def _rename(spark: SparkSession, source: str, dest: str) -> None:
    fs, p = file_system(spark, dest)
    fs.mkdirs(p.getParent())
    if not fs.rename(file_system(spark, source)[1], p):
        raise OSError(f"{source} could not be renamed to {dest}")


def recover(spark: SparkSession, base: str, table: str) -> int:
    """Finish or undo compactions that stopped halfway; returns how many folders were put in place.

    A copy without ``_SUCCESS`` is unfinished and goes. Where a folder had
    stepped aside, its finished copy takes its place, or else it comes back.
    """
    root, part = f"{base.rstrip('/')}/{table}", PARTITION_COLUMN.get(table)
    fs, p = file_system(spark, f"{base.rstrip('/')}/_compact-{table}")
    if not fs.exists(p):
        return 0
    left = {s.getPath().getName() for s in fs.listStatus(p)}
    done = 0
    for name in sorted({n.rsplit(".", 1)[0] for n in left}):
        copy, aside = _compact_paths(base, table, name)
        folder = f"{root}/{name}" if part else root
        whole = f"{name}.copy" in left and _exists(spark, f"{copy}/_SUCCESS")
        if f"{name}.old" in left and not _exists(spark, folder):
            _rename(spark, copy if whole else aside, folder)
            done += 1
        for path in (copy, aside):
            fs.delete(file_system(spark, path)[1], True)
    fs.delete(p, True)
    return done


def land_raw(spark: SparkSession, source: str, landing: str) -> None:
    """Keep every line of the files under ``source`` as it is, before any transform (K9).

    One partition for each file (a digest of its path), below the day the file
    was written (UTC). A file that is landed again replaces its own partition.
    """
    lines = spark.read.text(source).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.date_from_unix_date(F.floor(F.unix_seconds("_metadata.file_modification_time") / 86400).cast("int")).alias("landing_date"),
    )
    (
        lines.withColumn("file_key", F.sha2("file_path", 256))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("landing_date", "file_key")
        .parquet(landing)
    )
