"""Near-duplicate groups by circulant MinHash.

A document is its set of word shingles. Two permutations serve all signature
coordinates: the first places a shingle in a universe of ``UNIVERSE`` slots,
the second is read from that slot on, so coordinate k sees it shifted by k
places. Every shingle thus adds ``COORDINATES`` neighbouring values, and the
signature is their minimum, coordinate by coordinate.

Signatures are cut into bands; documents that agree on a band are candidates,
and a candidate pair becomes a link only if the Jaccard similarity of the two
full shingle sets is high enough. No pair of a large group is made just
because both are in it:

1. Documents with equal sets are one class from the start.
2. A shingle of one class alone is private: it is in no intersection. A class
   with too many of them can have no link and goes, and so does a bucket left
   with one class.
3. In each bucket, every class is compared with one pivot, the one that shares
   most buckets with others, so a group of near copies meets its common origin.
4. Buckets whose members all are in one component by then are done. In the
   others, classes outside the largest component are held against all others,
   but only where a link is still possible: what two classes share with the same
   pivot, and what each has alone, bounds what they can share with each other.
   That is a range join on the overlap with the pivot, sharpened by 64-bit masks
   of the differences.

No step loses a link. Texts that drift apart by replaced words have private
shingles, so a group of them makes few pairs even if its origin is not there.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import DOC_BITS, Tables, boxed, maybe_in, unboxed
from tillflow.llm.components import components

#: Bands and rows of each. A pair at similarity 0.8 shares no band with chance (1 - 0.8**5)**32 = 3e-6.
BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
#: Slots of the permuted universe.
UNIVERSE = 1 << 20
#: Words of a shingle, and the least similarity of a link in percent.
WORDS, PERCENT = 5, 80
#: Cells that the overlaps with a pivot are cut into, for the range join.
CELLS = 16
#: Shingles folded into a signature at once.
BLOCK = 1024

_SEED = 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_tables: dict[str, np.ndarray] = {}


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and the second laid out so that row s holds its values from slot s on."""
    if not _tables:
        rng = np.random.default_rng(_SEED)
        _tables["first"] = rng.permutation(UNIVERSE).astype(np.uint32)
        ring = rng.permutation(UNIVERSE).astype(np.uint32)
        _tables["second"] = np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[: COORDINATES - 1]]), COORDINATES)
    return _tables["first"], _tables["second"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text.

    Letters A-Z are lower-cased and words are runs without ASCII white space. A
    text with fewer words than a shingle is one shingle as a whole; one without
    words has none.
    """
    parts = text.encode("utf-8", "replace").lower().split() if text else []
    if not parts:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = min(words, len(parts))
    out = np.full(len(parts) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mix(out * _FOLD + hashes[k : k + len(out)])
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Circulant MinHash coordinates of a non-empty set."""
    first, second = _permutations()
    slots = first[(hashes & np.uint64(UNIVERSE - 1)).astype(np.int64)]
    out = np.full(COORDINATES, UNIVERSE, np.uint32)
    for at in range(0, len(slots), BLOCK):
        np.minimum(out, second[slots[at : at + BLOCK]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        out = _mix(out * _FOLD + rows[:, k])
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the whole set; null if empty) and band keys of each row."""

    def run(batches):
        for b in _slices(batches):
            sets = [shingles(t, words) for t in b.column(1).to_pylist()]
            none = np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    _lists([band_keys(signature(s)) if len(s) else none for s in sets]),
                ],
                ["doc_id", "n_shingles", "digest", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, bands array<long>"
    )


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and its whole shingle set, ``hashes``."""

    def run(batches):
        for b in _slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _lists([shingles(t, words) for t in b.column(1).to_pylist()])], ["id", "hashes"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "id long, hashes array<long>")


def _mask(hashes: Column) -> Column:
    """64 bits: which remainders modulo 64 the hashes have."""
    one = F.lit(1).cast("long")
    bit = lambda h: F.call_function("shiftleft", one, F.pmod(h, F.lit(64)).cast("int"))
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda m, h: m.bitwiseOR(bit(h)))


def private_shingles(sets: DataFrame) -> DataFrame:
    """(part, hash) of every shingle that one set alone has."""
    each = sets.select("part", F.explode("hashes").alias("hash"))
    return each.groupBy("hash").agg(F.min("part").alias("part"), F.max("part").alias("last")).where("part = last").select("part", "hash")


def linkable(sets: DataFrame, private: DataFrame, percent: int) -> DataFrame:
    """The sets that may have a link: id, n (all shingles), own (the private ones) and the others, ``hashes``.

    A partner has at most 100 * n / percent shingles, and lacks all private ones.
    """
    counts = private.groupBy("part").agg(F.count("*").alias("own"))
    few = (
        sets.join(counts, "part", "left")
        .withColumns({"n": F.size("hashes").cast("long"), "own": F.coalesce("own", F.lit(0))})
        .where(F.col("own") * percent <= (100 - percent) * F.col("n"))
    )
    gone = private.groupBy("part").agg(F.collect_list("hash").alias("gone"))  # part of one set
    left = F.array_except("hashes", F.coalesce("gone", F.array().cast("array<long>")))
    return few.join(gone, "part", "left").select("id", "n", "own", left.alias("hashes"))


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b), once each, with the sizes n and m of their full sets, that of the intersection,
    ``common``, and masks of the shingles, private ones left out, that only the one and only the other has."""
    left = sets.select(F.col("id").alias("a"), "n", F.col("hashes").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("hashes").alias("right"))
    both = pairs.distinct().join(left, "a").join(right, "b").withColumn("both", F.array_intersect("left", "right"))
    masks = [_mask(F.array_except(c, "both")).alias(x) for c, x in (("left", "only_a"), ("right", "only_b"))]
    return both.select("a", "b", "n", "m", F.size("both").cast("long").alias("common"), *masks)


def _linked(common, total, percent: int) -> Column:
    """Jaccard similarity from the intersection and the sum of both sizes."""
    return 100 * common >= percent * (total - common)


def _pivots(shared: DataFrame) -> DataFrame:
    """(key, pivot, weight): the member with most bucket mates over all buckets; the least of several."""
    sizes = shared.groupBy("key").agg(F.count("*").alias("mates"))
    weight = shared.join(sizes, "key").groupBy("rep").agg(F.sum("mates").alias("weight"))
    best = F.max_by(F.struct(F.col("rep").alias("pivot"), "weight"), F.struct("weight", -F.col("rep")))
    return shared.join(weight, "rep").groupBy("key").agg(best.alias("best")).select("key", "best.*")


def _open(shared: DataFrame, pivots: DataFrame, seen: DataFrame, percent: int, keep: Tables) -> DataFrame:
    """Members (key, rep, n, own, comp, most, ref, and near and far) of the buckets that hold more than one component.

    ``most`` is the component with most members and ``ref`` the weightiest
    pivot of all the member's buckets. ``near`` (for the bucket's pivot) and
    ``far`` (for ref) hold the overlap p with that class, and masks of the
    shingles that are extra and that lack.
    """
    comp = components(seen.where(_linked(F.col("common"), F.col("n") + F.col("m"), percent)).select("a", "b"), keep)
    comp = comp.select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    named = shared.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    mixed = (
        named.groupBy("key", "comp")
        .agg(F.count("*").alias("k"))
        .groupBy("key")
        .agg(F.count("*").alias("comps"), F.max_by("comp", F.struct("k", "comp")).alias("most"))
        .where("comps > 1")
    )
    refs = shared.join(pivots, "key").groupBy("rep").agg(F.max_by("pivot", F.struct("weight", -F.col("pivot"))).alias("ref"))
    ways = [("a", "b"), ("b", "a")]
    known = functools.reduce(
        DataFrame.unionByName,
        [seen.select(F.col(x).alias("rep"), F.col(y).alias("other"), "common", F.col(f"only_{x}").alias("extra"), F.col(f"only_{y}").alias("lack")) for x, y in ways],
    )
    none = F.lit(0).cast("long")

    def compared(members: DataFrame, other: str, name: str) -> DataFrame:
        itself = F.struct((F.col("n") - F.col("own")).alias("p"), none.alias("extra"), none.alias("lack"))
        told = members.join(known.withColumnRenamed("other", other), ["rep", other], "left")
        by = F.when(F.col("rep") == F.col(other), itself).otherwise(F.struct(F.col("common").alias("p"), "extra", "lack"))
        return told.withColumn(name, by).drop("common", "extra", "lack")

    members = named.join(mixed, "key").join(pivots.select("key", "pivot"), "key").join(refs, "rep")
    members = compared(compared(members, "pivot", "near"), "ref", "far")
    return members.select("key", "rep", "n", "own", "comp", "most", "ref", "near", "far")


def _possible_pairs(members: DataFrame, percent: int) -> DataFrame:
    """The pairs of a bucket that lie in different components and may be linked for all that is known."""
    same = _within_reach(members.withColumn("group", F.struct("key", "ref")).withColumn("by", F.col("far")), percent, F.lit(True))
    others = _within_reach(members.withColumn("group", F.col("key")).withColumn("by", F.col("near")), percent, F.col("ref") != F.col("ref_"))
    return same.unionByName(others).distinct()


def _within_reach(members: DataFrame, percent: int, also: Column) -> DataFrame:
    """Pairs (a, b) of a group whose overlaps with the same class, in ``by``, allow a link.

    Two classes of n and n' shingles that share p and p' with that class have at
    most min(p, p') of them in common from it and min(n - p, n' - p') beside it.
    So they are linked only if (100 + percent) * |p - p'| <= (100 - percent) * (n + n'),
    which is a range join on p. Within the range, private shingles are no common
    ones, and the masks sharpen the bound: a bit that is set for one class only
    stands for a shingle that lacks, or is extra, there alone.
    """
    told = members.withColumns({"p": F.col("by.p"), "extra": F.col("by.extra"), "lack": F.col("by.lack")})
    group = told.groupBy("group").agg(F.max("n").alias("top"), F.greatest(F.max("n") / CELLS, F.lit(1)).cast("long").alias("width"))
    told = told.join(group, "group")
    reach = ((100 - percent) * (F.col("n") + F.col("top")) / (100 + percent)).cast("long")
    cell = lambda c: F.floor(c / F.col("width"))
    kept = ("rep", "n", "own", "p", "extra", "lack", "comp", "ref")
    few = told.where("comp <> most").withColumn("cell", F.explode(F.sequence(cell(F.col("p") - reach), cell(F.col("p") + reach))))
    other = told.select("group", cell(F.col("p")).alias("cell"), *[F.col(c).alias(f"{c}_") for c in kept])
    alone = lambda x, y: F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(F.col(y))))
    from_it = F.least(F.col("p") - alone("lack_", "lack"), F.col("p_") - alone("lack", "lack_"))
    rest = lambda s: F.col(f"n{s}") - F.col(f"own{s}") - F.col(f"p{s}")
    beside = F.least(rest("") - alone("extra", "extra_"), rest("_") - alone("extra_", "extra"))
    return (
        few.select("group", "cell", *kept)
        .join(other, ["group", "cell"])
        .where((F.col("comp") != F.col("comp_")) & also & _linked(from_it + beside, F.col("n") + F.col("n_"), percent))
        .select(F.least("rep", "rep_").alias("a"), F.greatest("rep", "rep_").alias("b"))
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Documents are linked when 100 * common shingles >= percent * shingles of
    either; component_id is the least doc_id reachable and kept says that it is
    the row's own. A null, empty or blank text has no shingles and no links.
    Rows that share a doc_id are one document: a link of any of them holds for
    all, and each gets a row. A null doc_id is linked with nothing; its
    component_id is null and it is kept. An empty table gives an empty result.
    """
    with Tables(docs.sparkSession) as keep:
        return keep.result(_groups(docs, words, percent, keep))


def _several(members: DataFrame) -> DataFrame:
    """Without the buckets of one class only."""
    crowded = members.groupBy("key").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y").select("key")
    return members.join(crowded, "key")


def _groups(docs: DataFrame, words: int, percent: int, keep: Tables) -> DataFrame:
    rows = keep(sketches(docs, words))
    real = rows.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = real.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    copies = real.select("digest", "doc_id").join(classes.where("copies > 1"), "digest").where("doc_id <> rep")
    links = keep(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct())

    reps = real.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"])
    crowded = keep(_several(reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("rep"))).distinct())
    wanted = crowded.select(F.col("rep").alias("doc_id")).distinct()
    whole = shingle_sets(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), words)
    whole = keep(whole.withColumn("part", F.monotonically_increasing_id()))
    private = keep(private_shingles(whole))
    sets = keep(linkable(whole, private, percent))
    keep.drop(whole, private)
    shared = keep(_several(crowded.join(sets.select(F.col("id").alias("rep"), "n", "own"), "rep").select("key", "rep", "n", "own").distinct()))
    keep.drop(crowded)

    pivots = keep(_pivots(shared))
    star = shared.join(pivots.select("key", "pivot"), "key").where("rep <> pivot")
    seen = keep(overlaps(star.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")), sets))
    members = keep(_open(shared, pivots, seen, percent, keep))
    pairs = keep(_possible_pairs(members, percent).join(seen, ["a", "b"], "left_anti"))
    keep.drop(shared, pivots, members)
    found = keep(seen.unionByName(overlaps(pairs, sets)).where(_linked(F.col("common"), F.col("n") + F.col("m"), percent)).select("a", "b"))
    keep.drop(sets, seen, pairs)

    comp = components(links.unionByName(found), keep)
    return rows.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def deduplicate(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller doc_id in their group."""
    gone = near_duplicates(docs, words, percent).where("NOT kept").select(F.col("doc_id").alias("_doc")).distinct()
    # few texts are shuffled: those that a bitmap takes for gone
    told = maybe_in(boxed(docs, F.col("doc_id").cast("long").alias("_doc")), gone, "_doc", DOC_BITS)
    near = told.where("maybe").join(gone.withColumn("gone", F.lit(True)), "_doc", "left").where("gone IS NULL")
    return unboxed(told.where("NOT maybe").select("box").unionByName(near.select("box")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents, on two-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), words=2)


#: Links by counting common shingles of every pair that shares one; components by recursion.
ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM docs
), sized AS (SELECT doc_id, coalesce(len(s), 0) AS n, s FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
rare AS (SELECT i.*, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS k
  FROM items i JOIN (SELECT g, count(*) AS df FROM items GROUP BY g) USING (g)),
prefix AS (SELECT doc_id, n, g FROM rare WHERE k <= n - (80 * n + 99) // 100 + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefix a JOIN prefix b USING (g)
  WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
links AS (
  SELECT a, b FROM (SELECT a, b, x.n + y.n AS total, len(list_intersect(x.s, y.s)) AS common
    FROM cand JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b)
  WHERE 100 * common >= 80 * (total - common)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS v, doc_id AS c FROM sized UNION SELECT e.b, r.c FROM reach r JOIN edges e ON e.a = r.v)
SELECT s.doc_id, s.n AS n_shingles, m.c AS component_id, s.doc_id = m.c AS kept
FROM sized s JOIN (SELECT v, min(c) AS c FROM reach GROUP BY v) m ON m.v = s.doc_id
"""
