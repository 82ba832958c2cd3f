"""Loads that arrival events start.

The stream is one of small event texts, one event to a line; each names the
objects that have arrived. A micro-batch reads exactly the files its events name
and loads them, so nothing lists the inbox and nothing remembers the names of
the receipt files: loads are idempotent by key, so an event that comes twice, or
a batch that is run again, adds nothing.

The event files themselves are remembered for ``EVENT_MEMORY`` only, and moved
to the archive, if one is given, once their batch is done; receipt files may be
of any age.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.hashing import SHA256, IdScheme
from tillflow.functions.jsonfields import event_objects
from tillflow.functions.timeparse import ISO_FORMATS
from tillflow.operators.load import load_receipts
from tillflow.session import file_system
from tillflow.sources.csv import read_receipts

log = logging.getLogger(__name__)

#: How much older than the newest event file one may be and still count as new.
EVENT_MEMORY = "7d"


def event_stream(spark: SparkSession, events_dir: str, archive_dir: str | None = None) -> DataFrame:
    """Event texts as they arrive, one row for each line."""
    reader = spark.readStream.format("text").option("maxFileAge", EVENT_MEMORY)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(events_dir)


class EventLoader:
    """``foreachBatch`` body: the objects named by a batch of events are read and loaded.

    ``root`` is the folder or store URL in which buckets lie. ``added`` sums up
    the rows added by table; ``files``, ``missing`` and ``unreadable`` count the
    files loaded, those named that are not there (any more) and the texts that
    are no events. A missing file does not stop the others.
    """

    def __init__(self, root: str, target_dir: str, ids: IdScheme = SHA256, formats=ISO_FORMATS, multi_line: bool = False):
        self.root, self.target_dir = root.rstrip("/"), target_dir
        self.ids, self.formats, self.multi_line = ids, formats, multi_line
        self.added: dict[str, int] = {}
        self.files = self.missing = self.unreadable = 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        told = batch.where("trim(value) <> ''").select(event_objects(F.col("value")).alias("objects"))
        self.unreadable += told.where("objects IS NULL").count()
        objects = told.select(F.explode("objects").alias("o")).select("o.bucket", "o.key").distinct()
        names = [f"{self.root}/{r.bucket}/{r.key}" for r in objects.orderBy("bucket", "key").collect()]  # names of one batch
        paths = []
        for name in names:
            fs, p = file_system(spark, name)
            paths += [str(p)] if fs.exists(p) else []
        self.files += len(paths)
        self.missing += len(names) - len(paths)
        added = {}
        if paths:
            exact = [re.sub(r"([\[\]{}*?\\,])", r"\\\1", p) for p in paths]  # a name is no pattern
            typed = read_receipts(spark, exact, formats=self.formats, multi_line=self.multi_line)
            added = load_receipts(typed, self.target_dir, spark, self.ids)
        self.added = {t: self.added.get(t, 0) + added.get(t, 0) for t in self.added | added}
        log.info("events of batch %s: %s files, rows added %s", batch_id, len(paths), added)


def run_available(spark: SparkSession, events_dir: str, root: str, target_dir: str, checkpoint_dir: str, archive_dir: str | None = None,
                  ids: IdScheme = SHA256, formats=ISO_FORMATS, multi_line: bool = False) -> EventLoader:
    """Process every event not yet seen, then stop; the loader tells what was loaded."""
    loader = EventLoader(root, target_dir, ids, formats, multi_line)
    query = (
        event_stream(spark, events_dir, archive_dir)
        .writeStream.foreachBatch(loader)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return loader
