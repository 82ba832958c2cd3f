"""URL filtering by rules and by a tree of path templates.

Rules name a host and a path prefix and decide first. All other URLs are judged
by their template. The paths of a host form a tree, built level by level:
digits become ``#``; where a node's segments are too many for the shapes below
them, they become the wildcard ``*``, however often each is visited; then, from the leaves up, branches with the same
templates below them and a statistically equal share of good pages are merged.
A template is rejected when its labelled purity, the share of good pages among
the labelled ones, is too low after smoothing. A template without labels of its
own host has the purity of the prior, and passes.

The tree is a table of distinct path shapes with counts, aggregated before
anything else, so a host with a large share of all rows is a few rows of it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import boxed, durable, table, unboxed

#: Levels of the tree; what lies deeper in a path is one last segment.
LEVELS = 8
#: A node's segments are variable if there are more kinds than this, and more than this share of the shapes below it.
KINDS, SHARE = 10, 0.05
#: Of such a node's segments, those with so large a share of its rows stay as they are.
FREQUENT = 0.1
#: Error rate of the test that keeps two branches apart.
ALPHA = 0.05
#: Purity and weight (in labelled pages) of the prior, and the purity below which a template is rejected.
PRIOR, WEIGHT, REJECT = 0.7, 4.0, 0.5

#: Verdict and rule (host, then path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (letters A-Z lower-cased) and path; both are empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule whose host is the URL's or one above it and whose path the URL's starts with."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape(path: Column) -> Column:
    """Segments of a path with numbers as ``#``; at most ``LEVELS``, the last one holding what is deeper."""
    parts = F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""), lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    deep = F.concat(F.slice(parts, 1, LEVELS - 1), F.array(F.array_join(F.slice(parts, LEVELS, F.greatest(F.size(parts), F.lit(1))), "/")))
    return F.when(F.size(parts) > LEVELS, deep).otherwise(parts)


def _written(segments: Column) -> Column:
    return F.array_join(segments, "/")


def _with_level(tree: DataFrame, level: int) -> DataFrame:
    """``tree`` with ``_above`` (template before the level), ``_here`` and ``_below``; _here is null where the path is shorter."""
    now = F.col("segments")
    return tree.withColumns(
        {
            "_above": _written(F.slice(now, 1, level)),
            "_here": F.get(now, F.lit(level)),
            "_below": F.when(F.size(now) > level, _written(F.slice(now, level + 2, LEVELS))),
        }
    )


def _replaced(segments: Column, level: int, by: Column) -> Column:
    """``segments`` with the one at the level replaced where ``by`` is not null."""
    return F.transform(segments, lambda s, i: F.when(i == level, F.coalesce(by, s)).otherwise(s))


def generalise(tree: DataFrame, level: int) -> DataFrame:
    """Wildcards for the segments of this level under nodes where they vary."""
    here = _with_level(tree, level)
    kinds = here.where("_here IS NOT NULL").groupBy("host", "_above", "_here").agg(F.sum("n").alias("n"), F.count("*").alias("shapes"))
    nodes = (
        kinds.groupBy("host", "_above")
        .agg(F.count("*").alias("kinds"), F.sum("n").alias("rows"), F.sum("shapes").alias("shapes"))
        .where((F.col("kinds") > KINDS) & (F.col("kinds") > SHARE * F.col("shapes")))
    )
    rare = kinds.join(nodes, ["host", "_above"]).where(F.col("n") < FREQUENT * F.col("rows"))
    wild = rare.select("host", "_above", "_here", F.lit("*").alias("_by"))
    return here.join(wild, ["host", "_above", "_here"], "left").select(
        "host", "shape", _replaced(F.col("segments"), level, F.col("_by")).alias("segments"), "n", "labelled", "good"
    )


def merge(tree: DataFrame, level: int) -> DataFrame:
    """One name for the branches of a node that have equal templates below and compatible shares of good pages.

    A branch is compared with all such branches of its node taken together, not
    with each other one, by Hoeffding's bound. Branches without labels are
    merged among themselves only: nothing is known of their share.
    """
    here = _with_level(tree, level)
    branches = (
        here.where("_here IS NOT NULL")
        .groupBy("host", "_above", "_here", "_below")
        .agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "good")])
        .groupBy("host", "_above", "_here")
        .agg(F.sum(F.xxhash64("_below").cast("decimal(38,0)")).alias("sign"), *[F.sum(c).alias(c) for c in ("n", "labelled", "good")])
        .withColumn("known", F.col("labelled") > 0)
    )
    key = ["host", "_above", "sign", "known"]
    pool = branches.groupBy(*key).agg(
        F.count("*").alias("branches"), F.sum("labelled").alias("all_labelled"), F.sum("good").alias("all_good"), F.min("_here").alias("name")
    )
    bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / F.sqrt("labelled") + 1 / F.sqrt("all_labelled"))
    alike = ~F.col("known") | (F.abs(F.col("good") / F.col("labelled") - F.col("all_good") / F.col("all_labelled")) < bound)
    merged = (
        branches.join(pool.where("branches > 1"), key)
        .where(alike)
        .select("host", "_above", "_here", F.concat(F.lit("{"), "name", F.when(F.col("known"), "}").otherwise("?}")).alias("_by"))
    )
    return here.join(merged, ["host", "_above", "_here"], "left").select(
        "host", "shape", _replaced(F.col("segments"), level, F.col("_by")).alias("segments"), "n", "labelled", "good"
    )


def templates(pages: DataFrame) -> DataFrame:
    """(host, shape, template, purity) of every distinct shape; ``pages`` has host, segments and good (null: no label)."""
    tree = durable(
        pages.groupBy("host", "segments")
        .agg(F.count("*").alias("n"), F.count("good").alias("labelled"), F.sum(F.coalesce(F.col("good").cast("long"), F.lit(0))).alias("good"))
        .select("host", _written(F.col("segments")).alias("shape"), "segments", "n", "labelled", "good")
    )
    depth = tree.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(depth):
        tree = durable(generalise(tree, level))
    for level in reversed(range(depth)):
        tree = durable(merge(tree, level))
    named = tree.select("host", "shape", _written(F.col("segments")).alias("template"), "labelled", "good")
    purity = named.groupBy("host", "template").agg(
        ((F.sum("good") + WEIGHT * PRIOR) / (F.sum("labelled") + WEIGHT)).alias("purity")
    )
    return named.join(purity, ["host", "template"]).select("host", "shape", "template", "purity")


def judge(pages: DataFrame, labels: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` (page_id, url, ...) with host, path, rule, template, purity and verdict.

    ``labels`` (page_id, good: boolean, one row per page) teaches the purity of
    templates; without it, the pages that a rule decides do (allowed: good). A
    null url, or one without ``://``, has empty host and path and is judged like
    any other host's. Columns of the names added are replaced, others pass
    through; rows are judged one by one, whatever their page_id.
    """
    added = ("host", "path", "rule", "template", "purity", "verdict")
    url = F.coalesce(F.col("url"), F.lit(""))
    split = boxed(pages, F.col("page_id"), *[c.alias(n) for c, n in zip(host_and_path(url), ("host", "path"), strict=True)], adds=added)
    split = split.withColumns({"ruled": rule_of(F.col("host"), F.col("path"), rules), "segments": shape(F.col("path"))})
    if labels is None:
        taught = split.withColumn("good", F.col("ruled.verdict") == "allow")
    else:
        taught = split.join(labels.select("page_id", "good"), "page_id", "left")
    found = templates(taught.select("host", "segments", "good"))
    out = split.withColumn("shape", _written(F.col("segments"))).join(found, ["host", "shape"], "left")
    own = F.when(F.col("purity") < REJECT, "block").otherwise("allow")
    return unboxed(
        out, "host", "path", F.col("ruled.rule").alias("rule"), "template", "purity", F.coalesce("ruled.verdict", own).alias("verdict")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page; templates learn from the pages that the rules decide."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def oracle() -> str:
    """The same judgement in DuckDB, one group of subqueries for each level and step."""
    rule = " ".join(
        f"WHEN (host = '{r[: r.index('/')]}' OR host LIKE '%.{r[: r.index('/')]}') AND starts_with(path, '{r[r.index('/') :]}') THEN '{r}'"
        for _, r in sorted(RULES, key=lambda r: -len(r[1]))
    )
    verdict = " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in RULES)
    parts = [
        """rests AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)""",
        """hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM rests)""",
        f"""parsed AS (SELECT page_id, translate(h, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM hosts)""",
        f"""ruled AS (SELECT *, CASE {rule} END AS rule FROM parsed)""",
        f"""cut AS (SELECT *, CASE rule {verdict} END AS ruling,
          list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: regexp_replace(s, '[0-9]+', '#', 'g')) AS s FROM ruled)""",
        f"""shaped AS MATERIALIZED (SELECT * EXCLUDE (s), CASE WHEN len(s) > {LEVELS}
          THEN list_append(s[1:{LEVELS - 1}], array_to_string(s[{LEVELS}:], '/')) ELSE s END AS segments FROM cut)""",
        """tree AS MATERIALIZED (SELECT host, array_to_string(segments, '/') AS shape, segments, count(*) AS n, count(ruling) AS labelled,
          count(*) FILTER (ruling = 'allow') AS good FROM shaped GROUP BY host, segments)""",
    ]
    tree = "tree"

    def level(d: int, name: str, found: list[str], by: str) -> None:
        nonlocal tree
        parts.append(
            f"""{name}h AS MATERIALIZED (SELECT *, array_to_string(segments[1:{d}], '/') AS above, segments[{d + 1}] AS here,
              array_to_string(segments[{d + 2}:], '/') AS below FROM {tree})"""
        )
        parts.extend(found)
        parts.append(
            f"""{name} AS MATERIALIZED (SELECT host, shape, CASE WHEN {by} IS NULL THEN segments
              ELSE list_concat(list_append(segments[1:{d}], {by}), segments[{d + 2}:]) END AS segments, n, labelled, good
              FROM {name}h LEFT JOIN {name}f USING (host, above, here))"""
        )
        tree = name

    for d in range(LEVELS):
        g = f"g{d}"
        level(
            d,
            g,
            [
                f"{g}k AS MATERIALIZED (SELECT host, above, here, sum(n) AS k, count(*) AS c FROM {g}h WHERE here IS NOT NULL GROUP BY ALL)",
                f"""{g}n AS (SELECT host, above, sum(k) AS r FROM {g}k GROUP BY ALL
                  HAVING count(*) > {KINDS} AND count(*) > {SHARE} * sum(c))""",
                f"{g}f AS (SELECT host, above, here, '*' AS name FROM {g}k JOIN {g}n USING (host, above) WHERE k < {FREQUENT} * r)",
            ],
            "name",
        )
    bound = math.sqrt(0.5 * math.log(2 / ALPHA))
    for d in reversed(range(LEVELS)):
        m = f"m{d}"
        level(
            d,
            m,
            [
                f"{m}b AS (SELECT host, above, here, below, sum(labelled) AS l, sum(good) AS g FROM {m}h WHERE here IS NOT NULL GROUP BY ALL)",
                f"""{m}s AS MATERIALIZED (SELECT host, above, here, string_agg(below, chr(1) ORDER BY below) AS sign, sum(l) AS l, sum(g) AS g,
                  sum(l) > 0 AS known FROM {m}b GROUP BY ALL)""",
                f"""{m}p AS (SELECT host, above, sign, known, sum(l) AS al, sum(g) AS ag, min(here) AS first FROM {m}s GROUP BY ALL HAVING count(*) > 1)""",
                f"""{m}f AS (SELECT host, above, here, '{{' || first || CASE WHEN known THEN '}}' ELSE '?}}' END AS name
                  FROM {m}s JOIN {m}p USING (host, above, sign, known)
                  WHERE NOT known OR abs(g / l - ag / al) < {bound!r} * (1 / sqrt(l) + 1 / sqrt(al)))""",
            ],
            "name",
        )
    parts.append(f"named AS MATERIALIZED (SELECT host, shape, array_to_string(segments, '/') AS template, labelled, good FROM {tree})")
    parts.append(f"pure AS (SELECT host, template, (sum(good) + {WEIGHT * PRIOR!r}) / (sum(labelled) + {WEIGHT!r}) AS purity FROM named GROUP BY ALL)")
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT page_id, s.host, path, rule, n.template, purity,
  coalesce(ruling, CASE WHEN purity < {REJECT} THEN 'block' ELSE 'allow' END) AS verdict
FROM shaped s JOIN named n ON n.host = s.host AND n.shape = array_to_string(s.segments, '/') JOIN pure p ON p.host = n.host AND p.template = n.template"""
    )
