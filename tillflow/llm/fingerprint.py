"""Document fingerprints by a threshold-scaled sketch.

A text's shingles (``SHINGLE`` code points) are hashed to 64 bits, and every
distinct hash below ``2**64 / SCALE`` is kept. The sketch grows with the text,
so the sketch of a union is the union of the sketches, and what share of a
short text lies inside a long one can be read off their sketches (``merged``,
``containment``), which sketches of equal size cannot tell.

A text none of whose hashes is below the threshold keeps its least one, so
that only a text without characters has an empty sketch. A fingerprint is the
sketch in ascending order, 16 hexadecimal digits each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points of a shingle (a power of two) and the inverse of the share that is kept.
SHINGLE, SCALE = 8, 32
#: Code points hashed at once.
BLOCK = 1 << 20
#: Share of a text that the edit of ``with_edits`` replaces: its last quarter.
EDIT = 4

_BELOW = np.uint64((1 << 64) // SCALE)
_FOLDS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(points: np.ndarray) -> np.ndarray:
    """One hash for each run of ``SHINGLE`` code points; a shorter text is one shingle, filled up."""
    if 0 < len(points) < SHINGLE:
        points = np.concatenate([points, np.full(SHINGLE - len(points), 0xFFFFFFFF, np.uint32)])
    h = points.astype(np.uint64)
    h += np.uint64(1)
    width = 1
    for fold in _FOLDS:
        h = h[: max(len(h) - width, 0)] * fold + h[width:]
        width *= 2
    h ^= h >> np.uint64(30)
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def _kept(points: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes, from ``start`` on, that are below the threshold."""
    where, what = [], []
    last = max(len(points) - SHINGLE + 1, min(len(points), 1))
    for at in range(start, last, BLOCK):
        h = _hashes(points[at : at + BLOCK + SHINGLE - 1])
        low = np.flatnonzero(h < _BELOW)
        where.append(low + at)
        what.append(h[low])
    if not where:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(where), np.concatenate(what)


def _sketch(points: np.ndarray, low: np.ndarray) -> np.ndarray:
    if len(low):
        return np.unique(low)
    least = [_hashes(points[at : at + BLOCK + SHINGLE - 1]).min() for at in range(0, len(points), BLOCK) if at == 0 or len(points) - at >= SHINGLE]
    return np.array([min(least)] if least else [], np.uint64)


def sketch(text: str | None) -> np.ndarray:
    """The kept hashes of a text, ascending."""
    points = code_points(text)
    return _sketch(points, _kept(points)[1])


def written(sk: np.ndarray) -> str:
    return sk.astype(">u8").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both texts together. A least hash kept for want of another gives way."""
    both = np.union1d(a, b)
    low = both[both < _BELOW]
    return low if len(low) else both[:1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; 1 for two empty sketches, 0 if one is empty."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of ``a`` that lies in ``b``; an empty ``a`` lies in everything."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


class _Text:
    """A text with what its own fingerprint and that of its edited form share."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.points = code_points(text)
        self.where, self.low = _kept(self.points)
        self.sketch = _sketch(self.points, self.low)

    def edited(self, after: _Text) -> tuple[str, np.ndarray]:
        n = len(self.points)
        cut = n - n // EDIT
        text = self.text[:cut] + after.text[: n // EDIT]
        points = np.concatenate([self.points[:cut], after.points[: n // EDIT]])
        whole = max(cut - SHINGLE + 1, 0)  # shingles before this are the same
        low = np.concatenate([self.low[self.where < whole], _kept(points, whole)[1]])
        return text, _sketch(points, low)


_COLUMNS = {
    "doc_id": "long",
    "n_chars": "long",
    "edited_sha256": "string",
    "fingerprint": "string",
    "edited_fingerprint": "string",
    "near_edited": "double",
    "near_next": "double",
    "inside_next": "double",
}


def _row(doc_id, this: _Text, after: _Text) -> tuple:
    text, edited = this.edited(after)
    return (
        doc_id,
        len(this.points),
        hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
        written(this.sketch),
        written(edited),
        likeness(this.sketch, edited),
        likeness(this.sketch, after.sketch),
        containment(this.sketch, after.sketch),
    )


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row of a run with the row after it; a run is followed by the first row of the next, marked as a guest."""

    def rows():
        for b in batches:
            yield from zip(b["run"].tolist(), b["guest"].tolist(), b["doc_id"].astype(object).tolist(), b["text"].tolist(), strict=True)

    out, size = [], 0
    for _, run in groupby(rows(), key=lambda r: r[0]):
        first = before = None
        for _, guest, doc_id, text in run:
            this = _Text(text)
            if before:
                out.append(_row(before[0], before[1], this))
            first = first or this
            before = None if guest else (doc_id, this)
            size += len(this.text)
            if size > BLOCK or len(out) >= 1000:
                yield pd.DataFrame(out, columns=list(_COLUMNS)).astype({"doc_id": "Int64"})
                out, size = [], 0
            if guest:
                break
        if before:  # the only run, where no row has an id
            out.append(_row(before[0], before[1], first))
    yield pd.DataFrame(out, columns=list(_COLUMNS)).astype({"doc_id": "Int64"})


def in_runs(docs: DataFrame) -> DataFrame:
    """(run, guest, doc_id, text): runs of neighbouring ids, one partition each, in order.

    The bounds are ids of the table, so every run starts with a row that has
    its bound for id; that row also goes to the run before, as its guest, and
    the first row of all to the last run. Texts are shuffled once, there is no
    global sort and no window over all rows; the bounds are as many as there
    are shuffle partitions.
    """
    spark = docs.sparkSession
    runs = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / runs for k in range(1, runs)]
    got = docs.agg(
        F.min("doc_id").alias("least"), F.percentile_approx("doc_id", shares or [0.5], max(10_000, 20 * runs)).alias("bounds")
    ).first()
    starts = np.unique(np.array([got["least"], *(got["bounds"] if shares else [])], np.int64)) if got["least"] is not None else np.zeros(0, np.int64)
    last = max(len(starts) - 1, 0)
    bounds = spark.sparkContext.broadcast(starts)

    @F.pandas_udf("array<int>")
    def placed(doc_id: pd.Series) -> pd.Series:
        """The row's run, and for the first row of a run the one before it."""
        starts = bounds.value
        out = []
        for x in doc_id.astype(object):
            if x is None or x != x or not len(starts):
                out.append([last])  # rows without an id come last
                continue
            run = int(np.searchsorted(starts, x, "right")) - 1
            out.append([run, (run or last + 1) - 1] if x == starts[run] else [run])
        return pd.Series(out)

    ids = F.col("doc_id")
    return (
        docs.select("doc_id", "text", placed(ids).alias("runs"))
        .select("doc_id", "text", F.posexplode("runs").alias("pos", "run"))
        .select("run", (F.col("pos") == 1).alias("guest"), "doc_id", "text")
        .repartitionById(last + 1, F.col("run"))
        .sortWithinPartitions("run", "guest", F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first())
    )


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like they and the next text's are.

    The edited text has its last floor(n_chars / 4) code points replaced by the
    first as many of the next document by ascending doc_id (after the last: the
    first). Reads ``doc_id`` and ``text``; a null text counts as empty, a null
    doc_id comes after all others, rows that share a doc_id are ordered by
    text, and a lone document is its own next. An empty table gives no rows.
    """
    ids = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return in_runs(ids).mapInPandas(_walk, ", ".join(f"{k} {v}" for k, v in _COLUMNS.items()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
