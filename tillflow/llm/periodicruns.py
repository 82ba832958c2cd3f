"""Periodic runs of words, found by string synchronising sets.

A run is a maximal stretch of words in which words q apart are equal, q being
the smallest such distance, and that is at least four times as long as q. Scales
are dyadic; scale t = 1, 2, 4, ... finds the runs with t <= q < 2t:

* Every stretch of t words has a name, equal stretches the same one (names of
  double length are made from pairs of names, so no hash can collide).
* Position i is in the synchronising set if, among the scrambled names of the
  stretches that begin at i, ..., i + t, the least one begins at i or at i + t.
  So membership depends on 2t words only: equal contexts agree on it.
* Stretches with a period of at most t / 4 do not compete. They lie in runs that
  smaller scales have found already, and would fill the set with neighbours.
* Any t neighbouring positions hold a member unless the 3t - 1 words there have
  such a small period. In a run of this scale that is impossible, so it has a
  member i among its first t positions, and i + q is the next member with the
  same 2t words. Neighbouring members with equal contexts thus propose every
  period of the scale; a proposal is extended to both sides word by word.

Per text that is O(n log^2 n), with the names of two scales in memory.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import boxed, table, unboxed

#: A run has at least so many words, and so many periods.
WORDS, PERIODS = 6, 4

_RUNS = "array<struct<start:long,length:long,period:long>>"


def words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, in UTF-8."""
    return text.encode("utf-8", "replace").split() if text else []


def _scrambled(names: np.ndarray) -> np.ndarray:
    """A pseudorandom order of the names; all below the largest uint64."""
    x = names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(1)


def synchronising_set(names: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """The members at scale t, in order. ``names`` are of the stretches of t words; those ``periodic`` do not compete."""
    none = np.uint64(2**64 - 1)
    ids = np.where(periodic, none, _scrambled(names))
    if len(ids) <= t:
        return np.zeros(0, np.int64)
    least, width = ids, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])  # of t + 1 neighbours
    first, last = ids[: len(least)], ids[t : t + len(least)]
    return np.flatnonzero((least != none) & ((least == first) | (least == last)))


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix; it takes time in proportion to that."""
    at, step, n = 0, 64, min(len(a), len(b))
    while at < n:
        differ = np.flatnonzero(a[at : min(at + step, n)] != b[at : min(at + step, n)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, 2 * step
    return n


def _extended(w: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The stretch around i in which words q apart are equal: its bounds."""
    return i - _matching(w[:i][::-1], w[q : i + q][::-1]), i + q + _matching(w[i:], w[i + q :])


def find_runs(w: np.ndarray, least: int = WORDS, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the numbers ``w``, by start and then period; ``periods`` is 4 or more."""
    n, found = len(w), []
    t, names = 1, np.unique(w, return_inverse=True)[1].reshape(-1).astype(np.int64) if n else w
    while n >= 4 * t:
        pairs = names[:-t] * (int(names.max()) + 1) + names[t:]
        kinds, doubled = np.unique(pairs, return_inverse=True)
        if len(kinds) == len(pairs):
            break  # no 2t words occur twice
        doubled = doubled.reshape(-1)
        change = np.zeros(len(names) + 1, np.int64)
        for start, end, q in found:
            if 4 * q <= t <= end - start:
                change[start] += 1
                change[end - t + 1] -= 1
        at = synchronising_set(names, t, np.cumsum(change[:-1]) > 0)
        order = np.argsort(doubled[at], kind="stable")
        here, after = at[order][:-1], at[order][1:]
        apart = after - here
        near = (doubled[here] == doubled[after]) & (apart >= t) & (apart < 2 * t)
        reached: dict[int, int] = {}
        for i, q in sorted(zip(here[near].tolist(), apart[near].tolist())):
            if reached.get(q, -1) >= i + q + 2 * t:
                continue
            start, end = _extended(w, i, q)
            reached[q] = end
            if end - start >= 4 * q:
                found.append((start, end, q))
        names, t = doubled, 2 * t
    return sorted((s, e - s, q) for s, e, q in found if e - s >= max(least, periods * q))


def collapsed(parts: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what follows the first period of any run."""
    if not runs:
        return parts
    change = np.zeros(len(parts) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return [w for w, g in zip(parts, gone.tolist()) if not g]


def _numbers(parts: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in parts), np.int64, len(parts))


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (start, length, period; by start, then period) and ``collapsed``,
    the text's words without those that a run holds after its first period, joined by blanks.

    Start is the number of the run's first word, from 0. A null, empty or blank
    text has no runs and an empty collapsed text. Every row gets its own result,
    repeated ones too; doc_id is not used. Input columns named runs or collapsed
    are replaced, all others stay. An empty table gives an empty result.
    """

    def made(value: str | None):
        parts = words(value)
        runs = find_runs(_numbers(parts)) if len(parts) >= WORDS else []
        left = b" ".join(collapsed(parts, runs)).decode("utf-8")
        return [dict(zip(("start", "length", "period"), r)) for r in runs], left

    found = F.udf(made, f"struct<runs:{_RUNS},collapsed:string>", useArrow=True)(F.col(text).cast("string"))
    box = boxed(docs, found.alias("found"), adds=("runs", "collapsed"))
    return unboxed(box, F.col("found.runs").alias("runs"), F.col("found.collapsed").alias("collapsed"))


def planted(doc_id: int | None, text: str | None) -> str | None:
    """The text in which, for a tenth of all ids, everything from some word on repeats one stretch."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    parts = words(text) if h % 10 == 0 else []
    if not parts:
        return text
    n, g = len(parts), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join([*parts[:a], *(parts[a + (i - a) % p] for i in range(a, n))]).decode("utf-8")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, the tenth with a planted repetition included."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    plant = F.udf(planted, "string", useArrow=True)
    tenth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    edited = docs.where(tenth).select("doc_id", plant("doc_id", "text").alias("text")).unionByName(docs.where(~F.coalesce(tenth, F.lit(False))))
    out = periodic_runs(edited)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    key = lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period"))
    told = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return out.withColumn("best", F.array_min(F.transform("runs", key))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.short")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.short") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
