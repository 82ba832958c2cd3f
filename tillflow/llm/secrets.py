"""Secret scans that link the parts of a credential. DataFrame functions only.

Strong findings (the base kinds) stand alone. Weak ones, of little meaning by
themselves, are candidates: identifiers, high-variety strings that may be
secrets, and endpoints. The candidates and all findings of a document are
interval-joined: two parts belong to one scope when at most ``SCOPE`` code
points lie between them, however long they are. A weak identifier is reported if its scope holds a
secret, a weak secret if it holds an identifier, an endpoint if it holds both.

Positions come from lengths alone: a text is cut at the matches of a kind, and
running sums over the lengths of pieces and matches give starts and ends. Only
documents in which something can be found are cut, where they are read, and
only lengths are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.llm.common import durable

#: Most code points between the end of one part of a credential and the start of another.
SCOPE = 400


def _any_case(*words: str) -> str:
    """Pattern for the words with letters A-Z in either case and nothing more; ``_?`` stays."""
    return "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words) + ")"


_GAP = r"""["']?\x20*[:=]\x20*["']?"""
_KEYWORD = _any_case("password", "passwd", "secret", "token", "api_?key")
_LABEL = _any_case("client_?id", "access_?key_?id", "user_?name", "login")
_CODE = "A(?:KIA|SIA|IDA|ROA)[A-Z0-9]+"

#: kind: (pattern, group whose length counts, least length, role)
BASE = {
    "assign": (_KEYWORD + _GAP + "([A-Za-z0-9+/_.=-]+)", 1, 12, "secret"),
    "access": ("AKIA[A-Z0-9]+", 0, 18, "identifier"),
    "hex": ("[0-9a-f]{16,}", 0, 16, "secret"),
}
WEAK = {
    "identifier": (f"{_CODE}|{_LABEL}{_GAP}[A-Za-z0-9@._+-]+", 0, 12, "identifier"),
    "secret": ("[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20, "secret"),
    "endpoint": (r"""[A-Za-z][A-Za-z0-9+.-]{0,30}://[^\x20\x09-\x0D"'<>]+|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?""", 0, 7, "endpoint"),
}
KINDS = BASE | WEAK
#: A weak secret mixes these.
VARIETY = ("[0-9]", "[a-z]", "[A-Z]")
#: A document without a match of this has nothing to report: weak parts need an identifier near.
POSSIBLE = f"{_KEYWORD}{_GAP}[A-Za-z0-9+/_.=-]|[0-9a-f]{{16}}|A(?:KIA|SIA|IDA|ROA)[A-Z0-9]{{8}}|{_LABEL}{_GAP}[A-Za-z0-9@._+-]"

_ROW = ["_doc", "_hash", "_size"]


def _row_key(docs: DataFrame) -> list[Column]:
    """What tells rows apart: the id and the text. Rows equal in both get equal results."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.col("doc_id").cast("long").alias("_doc"), F.xxhash64(text).alias("_hash"), F.length(text).alias("_size")]


def _cut(kind: str) -> Column:
    """Array of (before, size, valid): length of the piece before a match and of the match."""
    pattern, group, least, _ = KINDS[kind]
    text = F.col("text")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern, -1)

    def valid(m: Column, g: Column) -> Column:
        ok = F.length(g) >= least
        if kind == "secret":
            for pattern_ in VARIETY:
                ok = ok & m.rlike(pattern_)
        return ok

    matches = F.zip_with(whole, counted, lambda m, g: F.struct(F.length(m).alias("size"), valid(m, g).alias("valid")))
    return F.zip_with(
        F.slice(pieces, 1, F.size(whole)),
        matches,
        lambda p, m: F.struct(F.length(p).alias("before"), m["size"].alias("size"), m["valid"].alias("valid")),
    )


def parts(docs: DataFrame) -> DataFrame:
    """Every valid match of every kind: row key, order (of the kind), kind, role, strong, start, end (exclusive)."""
    texts = docs.select(*_row_key(docs), F.col("text").cast("string").alias("text")).where(F.col("text").rlike(POSSIBLE))
    cut = texts.select(*_ROW, F.posexplode(F.array(*map(_cut, KINDS))).alias("order", "found")).where(F.size("found") > 0)
    once = cut.dropDuplicates([*_ROW, "order"])
    rows = once.select(*_ROW, "order", F.posexplode("found").alias("at", "m")).select(*_ROW, "order", "at", "m.*")
    before = Window.partitionBy(*_ROW, "order").orderBy("at")
    names = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (i, k)])
    roles = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (i, KINDS[k][3])])
    return (
        rows.withColumn("end", F.sum(F.col("before") + F.col("size")).over(before))
        .where("valid")
        .select(
            *_ROW,
            "order",
            names[F.col("order")].alias("kind"),
            roles[F.col("order")].alias("role"),
            (F.col("order") < len(BASE)).alias("strong"),
            (F.col("end") - F.col("size")).alias("start"),
            "end",
        )
    )


def apart(found: DataFrame) -> DataFrame:
    """Without the weak parts that overlap a strong one."""
    earlier = Window.partitionBy(*_ROW).orderBy("start", "order").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*_ROW).orderBy(F.col("start").desc(), "order").rowsBetween(Window.unboundedPreceding, -1)
    strong = lambda c: F.when(F.col("strong"), F.col(c))
    return (
        found.withColumn("_left", F.max(strong("end")).over(earlier))
        .withColumn("_right", F.min(strong("start")).over(later))
        .where("strong OR (coalesce(_left <= start, true) AND coalesce(_right >= end, true))")
        .drop("_left", "_right")
    )


def linked(found: DataFrame) -> DataFrame:
    """The weak parts whose scope holds what completes them, by an interval join on blocks of ``SCOPE`` code points."""
    blocks = lambda more: F.explode(F.expr(f"sequence(start div {SCOPE} - {more}, end div {SCOPE} + {more})"))
    weak = found.where("NOT strong").withColumn("_block", blocks(1))
    near = found.where("role <> 'endpoint'").select(
        *[F.col(c).alias(f"n{c}") for c in _ROW], blocks(0).alias("_nblock"), F.col("start").alias("_nstart"), F.col("end").alias("_nend"), F.col("role").alias("_nrole")
    )
    gap = F.greatest("start", "_nstart") - F.least("end", "_nend")
    same = (F.col("_block") == F.col("_nblock")) & (gap <= SCOPE) & (F.col("role") != F.col("_nrole"))
    for c in _ROW:
        same = same & F.col(c).eqNullSafe(F.col(f"n{c}"))
    columns = [c for c in found.columns]
    return (
        weak.join(near, same)
        .groupBy(*columns)
        .agg(F.count_distinct("_nrole").alias("_roles"))
        .where(F.col("_roles") >= F.when(F.col("role") == "endpoint", 2).otherwise(1))
        .select(*columns)
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access, n_hex, base_spans, spans.

    Spans are ``kind:start:end`` in code points, by start and then kind. A null
    or empty text has none (zeros and empty strings). Rows that share a doc_id
    are judged each by its text, null ids as well; other columns are ignored.
    """
    found = durable(apart(parts(docs)))
    all_ = found.where("strong").unionByName(linked(found))
    said = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))

    def listed(only: Column) -> Column:
        found = F.sort_array(F.collect_list(F.when(only, F.struct("start", "order", "end", said.alias("said")))))
        return F.array_join(F.transform(found, lambda s: s["said"]), ",")

    by_row = all_.groupBy(*_ROW).agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        listed(F.col("strong")).alias("base_spans"),
        listed(F.lit(True)).alias("spans"),
    )
    here = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_row_key(docs))
    there = by_row.select(*[F.col(c).alias(f"r{c}") for c in _ROW], *[c for c in by_row.columns if c not in _ROW])
    same = F.col("_hash") == F.col("r_hash")
    for c in ("_doc", "_size"):
        same = same & F.col(c).eqNullSafe(F.col(f"r{c}"))
    return here.join(there, same, "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in BASE],
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")],
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of every document; the base spans as a digest."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        "doc_id", *[f"n_{k}" for k in BASE], F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans"
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def oracle() -> str:
    """The same findings in DuckDB."""
    cuts = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS ord, '{kind}' AS kind, '{role}' AS role, string_split_regex(text, {_quoted(p)}) AS pieces, "
        f"regexp_extract_all(text, {_quoted(p)}) AS whole, regexp_extract_all(text, {_quoted(p)}, {group}) AS counted, {least} AS least FROM documents"
        for i, (kind, (p, group, least, role)) in enumerate(KINDS.items())
    )
    variety = " AND ".join(f"regexp_matches(m, '{v}')" for v in VARIETY)
    return f"""
WITH cuts AS ({cuts}),
rows_ AS (SELECT doc_id, ord, kind, role, least, unnest(range(1, len(whole) + 1)) AS i, pieces, whole, counted FROM cuts),
ends AS (SELECT doc_id, ord, kind, role, whole[i] AS m, length(whole[i]) AS size, length(counted[i]) >= least AS ok,
  sum(length(pieces[i]) + length(whole[i])) OVER (PARTITION BY doc_id, ord ORDER BY i) AS fin FROM rows_),
found AS (SELECT doc_id, ord, kind, role, ord < {len(BASE)} AS strong, fin - size AS start, fin FROM ends
  WHERE ok AND (kind <> 'secret' OR ({variety}))),
apart AS (SELECT * FROM found f WHERE strong OR NOT EXISTS (SELECT 1 FROM found s WHERE s.strong AND s.doc_id = f.doc_id AND s.start < f.fin AND f.start < s.fin)),
weak AS (SELECT w.doc_id, w.ord, w.kind, w.strong, w.start, w.fin FROM apart w JOIN apart n
  ON n.doc_id = w.doc_id AND greatest(n.start, w.start) - least(n.fin, w.fin) <= {SCOPE} AND n.role <> w.role AND n.role <> 'endpoint'
  WHERE NOT w.strong GROUP BY w.doc_id, w.ord, w.kind, w.strong, w.start, w.fin, w.role HAVING count(DISTINCT n.role) >= CASE WHEN w.role = 'endpoint' THEN 2 ELSE 1 END),
all_ AS (SELECT doc_id, ord, kind, strong, start, fin, kind || ':' || start::BIGINT || ':' || fin::BIGINT AS said
  FROM (SELECT doc_id, ord, kind, strong, start, fin FROM apart WHERE strong UNION ALL SELECT * FROM weak))
SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
  sha256(coalesce(string_agg(said, ',' ORDER BY start, ord) FILTER (strong), '')) AS base_sha256,
  coalesce(string_agg(said, ',' ORDER BY start, ord), '') AS spans
FROM documents d LEFT JOIN all_ a ON a.doc_id = d.doc_id GROUP BY d.doc_id
"""
