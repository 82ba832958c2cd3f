"""Line dedup by content-defined chunks of lines. DataFrame functions only.

A passage that repeats is often a few sentences inside long lines, so lines are
first split into pieces: a piece ends with its line, with a sentence, with a word
that ends in one of a few letters, or after ``WORDS`` words. Each piece is hashed,
and a hash rolls over every ``WINDOW`` piece hashes. A chunk ends after a piece
whose rolling hash is greater than that of its two neighbours. So a boundary
depends on a few pieces around it alone, a passage is cut alike wherever it
stands, and no chunk of several pieces is a single one. Chunks that occur again
anywhere are removed but for their first occurrence, after their bytes have been
compared; the blanks and line ends after a chunk go with it and are not compared.

Texts are cut once, and what may be removed of a text is kept as a row for each chunk.
Chunks whose digest occurs again, by a bitmap of fixed size, are shuffled to meet.
Texts that lose chunks are shuffled to take these out, and so are few others, which
another bitmap takes for such.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import DOC_BITS, Tables, boxed, maybe_in

#: Pieces under a rolling hash, its multiplier and its modulus.
WINDOW, FACTOR, MODULUS = 2, 31, 1_000_003
#: Most words of a piece.
WORDS = 16
#: Sentence ends without a blank behind them.
STOPS = "。！？"


def _piece(stops: str) -> str:
    within = rf"[^ \n{stops}]"
    return rf"(?:{within}*[^ \n{stops}.!?;:sdn] ){{0,{WORDS - 1}}}(?:{within}*[ \n{stops}]|{within}+)"


def _java_piece(stops: str) -> str:
    """The same pieces, but a word is read once: Java does not go back into it when its last letter ends a piece."""
    within = rf"[^ \n{stops}]"
    return rf"(?:{within}++(?<![.!?;:sdn]) ){{0,{WORDS - 1}}}(?:{within}*+[ \n{stops}]|{within}++)"


#: A piece with the blank or line end behind it; the pieces of a text joined are the text. RE2 and Java read it alike.
PIECE = _piece(STOPS)
#: To be removed a chunk must have so many pieces that are not blank, and so many code points unless it is a whole text.
MIN_PIECES, MIN_CHARS = 2, 40
#: What may differ behind a piece or a chunk.
BEHIND = " \n"

#: Rows that hold texts are written out after a few megabytes, not gathered in memory until the task ends.
SMALL_GROUPS = {"parquet.block.size": str(8 << 20)}

_ROW = ["_doc", "_hash", "_size"]


def _row_key() -> list[Column]:
    """What tells rows apart: the id and the text. Rows equal in both are one document listed twice."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.col("doc_id").cast("long").alias("_doc"), F.xxhash64(text).alias("_hash"), F.octet_length(text).alias("_size")]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _bare(value: Column) -> Column:
    """``value`` without what ``BEHIND`` lists at its end; blanks alone go at once, a set of characters takes a slow way."""
    return _let(F.rtrim(value), lambda off: F.when(F.endswith(off, F.lit("\n")), F.rtrim(off, F.lit(BEHIND))).otherwise(off))


def piece_hash(piece: Column) -> Column:
    # a line end is the last character of its piece
    bare = F.when(F.endswith(piece, F.lit("\n")), F.rtrim(piece, F.lit(BEHIND))).otherwise(F.rtrim(piece))
    return F.conv(F.substring(F.md5(bare.cast("binary")), 1, 8), 16, 10).cast("long")


def _digest(bare: Column) -> Column:
    """Tells which chunks may be equal; their bytes are compared before any goes."""
    return F.xxhash64(bare)


def pieces(text: Column) -> Column:
    """The pieces of a text, in order; none of a null or empty text."""
    given = F.coalesce(text, F.lit(""))
    stops = reduce(operator.or_, [F.contains(given, F.lit(c)) for c in STOPS])
    split = lambda pattern: F.regexp_extract_all(given, F.lit(pattern), F.lit(0))
    # without these stops both patterns find the same, and Java is ten times as fast with classes of ASCII letters
    return F.when(stops, split(_java_piece(STOPS))).otherwise(split(_java_piece("")))


def _range(start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), (end - start).alias("n"))


def _part(of: Column, chunk: Column) -> Column:
    """The pieces of a chunk, given as where it starts and how many it has, among those ``of`` its text."""
    return F.slice(of, chunk["start"] + 1, chunk["n"])


def chunks(of: Column) -> Column:
    """The chunks of a text with the pieces ``of``, in order: the number of pieces before each and in it."""

    def ends(rolled: Column) -> Column:
        n = F.size(rolled)
        peak = lambda i: (F.get(rolled, i - 1) > F.get(rolled, i - 2)) & (F.get(rolled, i - 1) > F.get(rolled, i))
        inner = F.filter(F.sequence(F.lit(2), n - 2), peak)
        return F.concat(F.array(F.lit(0)), inner, F.array(n))

    def rolled(hashes: Column) -> Column:
        def at(h, i):
            older = [F.get(hashes, i - k) * FACTOR**k for k in range(1, WINDOW)]
            return reduce(operator.add, older, h) % MODULUS  # null before the window is full

        return F.transform(hashes, at)

    between = lambda e: F.zip_with(F.slice(e, F.lit(1), F.size(e) - 1), F.slice(e, F.lit(2), F.size(e) - 1), _range)
    several = _let(_let(_let(F.transform(of, piece_hash), rolled), ends), between)
    return F.when(F.size(of) > 3, several).when(F.size(of) > 0, F.array(_range(F.lit(0), F.size(of)))).otherwise(F.array())


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def _several(parts: Column, blanks: Column) -> Column:
    """Whether enough of the pieces are not blank; ``blanks`` says that their text has blank ones."""
    full = F.when(blanks, F.array_remove(F.array_remove(parts, " "), "\n")).otherwise(parts)  # a blank piece is one character
    return F.size(full) >= MIN_PIECES


def _spots(docs: DataFrame) -> DataFrame:
    """Row key, place among the pieces, digest and bare text of each chunk that may be removed."""

    def told(of: Column, found: Column, blanks: Column) -> Column:
        whole = F.size(found) == 1

        def spot(chunk: Column) -> Column:
            made = lambda bare: F.struct(*[chunk[c].alias(c) for c in ("start", "n")], _digest(bare).alias("digest"), bare.alias("chunk"))
            long = lambda bare: F.when(whole | (F.length(bare) >= MIN_CHARS), made(bare))
            several = lambda parts: F.when(_several(parts, blanks), _let(_bare(_joined(parts)), long))
            return F.when(chunk["n"] >= MIN_PIECES, _let(_part(of, chunk), several))

        return F.transform(found, spot)

    def of_text(of: Column) -> Column:
        blanks = F.array_contains(of, " ") | F.array_contains(of, "\n")
        return _let(blanks, lambda b: _let(chunks(of), lambda found: told(of, found, b)))

    # the key is worked out before there is a row for each chunk, so that no text is copied into these; "outer", as a
    # filter on the length of the array would be pushed down to the texts and cut all of them once more
    rows = docs.where(F.octet_length("text") > 1).select(*_row_key(), _let(pieces(F.col("text")), of_text).alias("told"))
    return rows.select(*_ROW, F.explode_outer("told").alias("spot")).where("spot IS NOT NULL").select(*_ROW, "spot.*")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Row key and ``gone``: the chunks to remove, as ``start`` and ``n`` among the pieces, in order.

    The first occurrence, by doc_id (nulls last), text hash and position, stays.
    Chunks of one digest have one text but for chance, which their least and
    greatest tell; the others are told apart by their texts.
    """
    here = F.struct(F.col("_doc").isNull().alias("null"), "_doc", "_hash", "_size", "start")
    with Tables(docs.sparkSession) as keep:
        spots = keep(_spots(docs), **SMALL_GROUPS)
        often = keep(spots.groupBy("digest").count().where("count > 1").select("digest"))
        candidates = maybe_in(spots, often, "digest").where("maybe").drop("maybe")
        one = (F.min("chunk") == F.max("chunk")).alias("one")
        first = keep(candidates.groupBy("digest").agg(F.min(here).alias("first"), one, F.count("*").alias("times")).where("times > 1").drop("times"))
        clash = keep(first.where("NOT one").select("digest"))  # a small table of its own, so that no text is shuffled for it
        clashing = candidates.join(clash, "digest")
        told = clashing.join(clashing.groupBy("digest", "chunk").agg(F.min(here).alias("first")), ["digest", "chunk"])
        same = candidates.drop("chunk").join(first.where("one"), "digest").drop("one").unionByName(told.drop("chunk"))
        gone = same.where(here != F.col("first")).groupBy(*_ROW)
        return keep.result(gone.agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("gone")))


def _with_row(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join on the row key, null ids included. ``other`` has one row for each key and no texts, so it is hashed and the texts are not sorted."""
    there = other.select(*[F.col(c).alias(f"r{c}") for c in _ROW], *[c for c in other.columns if c not in _ROW]).hint("shuffle_hash")
    on = rows["_hash"] == there["r_hash"]
    for c in ("_doc", "_size"):
        on = on & rows[c].eqNullSafe(there[f"r{c}"])
    return rows.join(there, on, how).drop(*[f"r{c}" for c in _ROW])


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with the remaining pieces as ``text``, and ``n_lines`` (lines) and ``n_removed`` (pieces) added.

    A text without repeated chunks stays as it is, null included (no lines); one
    whose chunks are all repeated becomes empty. Rows that share doc_id and text
    are one document listed twice: they get the same result, and neither is a
    repetition of the other. Columns named n_lines or n_removed are replaced,
    other columns pass through.
    """
    gone = repeated_chunks(docs)
    docs.sparkSession._jvm.System.gc()  # see Tables
    rows = maybe_in(boxed(docs, F.col("text"), *_row_key(), adds=("text", "n_lines", "n_removed")), gone.select("_hash").distinct(), "_hash", DOC_BITS)
    whole = rows.where("NOT maybe").withColumn("gone", F.lit(None).cast(gone.schema["gone"].dataType))
    joined = _with_row(rows.where("maybe"), gone, "left").unionByName(whole)

    def rest(of: Column) -> Column:
        """The pieces between one chunk that goes and the next."""
        starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda g: g["start"] + g["n"]))
        ends = F.concat(F.col("gone.start"), F.array(F.size(of)))
        return F.zip_with(starts, ends, lambda a, b: _joined(_part(of, _range(a, b))))

    left = F.struct(
        F.array_join(_let(pieces(F.col("text")), rest), "").alias("text"),
        F.aggregate("gone", F.lit(0), lambda n, g: n + g["n"]).alias("removed"),
    )
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    told = joined.withColumns({"left": F.when(F.col("gone").isNotNull(), left), "lines": n_lines})
    replaced = {"text": F.coalesce("left.text", "text")}
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    return told.select(
        *[replaced.get(c.lower(), F.col("box").getField(c)).alias(c) for c in names],
        F.col("lines").cast("long").alias("n_lines"),
        F.coalesce("left.removed", F.lit(0)).cast("long").alias("n_removed"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and removed pieces of every document, and a digest of what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicate(docs).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_left"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )


#: Whole texts are compared where the operator compares digests first.
ORACLE = f"""
WITH pieces AS (SELECT doc_id, text, regexp_extract_all(text, '{PIECE}') AS l FROM documents),
hashed AS (SELECT *, list_transform(l, lambda x: ('0x' || substr(md5(rtrim(x, ' ' || chr(10))), 1, 8))::BIGINT) AS h FROM pieces),
rolled AS (SELECT *, list_transform(range(1, len(h) + 1), lambda i: CASE WHEN i >= {WINDOW} THEN
  ({" + ".join(f"h[greatest(i - {k}, 1)] * {FACTOR**k}" for k in range(WINDOW))}) % {MODULUS} END) AS r FROM hashed),
cuts AS (SELECT doc_id, l, list_concat(list_concat([0], list_filter(range(2, len(l) - 1), lambda i: r[i] > r[i - 1] AND r[i] > r[i + 1])), [len(l)]) AS e
  FROM rolled WHERE len(l) > 0),
parts AS (SELECT doc_id, k - 1 AS pos, l[e[k] + 1 : e[k + 1]] AS c, len(e) = 2 AS whole FROM (SELECT *, unnest(range(1, len(e))) AS k FROM cuts)),
told AS (SELECT doc_id, pos, len(c) AS n, whole, array_to_string(c, '') AS chunk, rtrim(array_to_string(c, ''), ' ' || chr(10)) AS bare,
  len(list_filter(c, lambda x: rtrim(x, ' ' || chr(10)) <> '')) AS n_full FROM parts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bare, n_full >= {MIN_PIECES} AND (whole OR length(bare) >= {MIN_CHARS}) ORDER BY doc_id, pos) > 1
  AND n_full >= {MIN_PIECES} AND (whole OR length(bare) >= {MIN_CHARS}) AS gone FROM told),
kept AS (SELECT doc_id, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed,
  coalesce(string_agg(chunk, '' ORDER BY pos) FILTER (NOT gone), '') AS left_ FROM ranked GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines, coalesce(n_removed, 0) AS n_removed,
  length(coalesce(left_, d.text)) AS n_chars_left, sha256(coalesce(left_, d.text)) AS text_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id IS NOT DISTINCT FROM d.doc_id
"""
