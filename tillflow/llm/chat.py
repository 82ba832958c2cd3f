"""Chat formatting with typed content parts.

A turn holds parts of several types. A visitor flattens them in order: text is
written out, an image, audio or document part becomes a placeholder, and its
reference is recorded with the number of tokens that the placeholder stands for.
A turn reads

    <|im_start|>ROLE
    CONTENT<|im_end|>

and a conversation is the concatenation of its turns. Control strings of this
and of other common templates are escaped inside texts: a backslash goes after
their first character, and one more where some already stand there, so the
escape can be undone exactly and ordinary text stays as it is.

Turns are formatted one row each, so a conversation of any length is never
gathered; ``read_back`` walks through sorted turns and holds one at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>\n"
#: What a control string may look like: after the first character, with the backslashes of earlier escapes.
ANGLE = r"<(\\*)(\||/?s>|</?SYS>>)"
SQUARE = r"\[(\\*)(/?INST\])"
#: Role whose texts are trained on.
TRAINED = "assistant"
#: Tokens that one unit of an attachment expands to: a patch of an image, a second of audio, a page of a document.
TOKENS = {"image": 1, "audio": 25, "document": 600}

PART = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("units", T.LongType()),
    ]
)


def escape(text: Column) -> Column:
    """Null counts as empty."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), ANGLE, r"<$1\\$2")
    return F.regexp_replace(text, SQUARE, r"[$1\\$2")


def unescape(text: str) -> str:
    text = re.sub(r"<(\\*)\\(\||/?s>|</?SYS>>)", r"<\1\2", text)
    return re.sub(r"\[(\\*)\\(/?INST\])", r"[\1\2", text)


def escape_role(role: Column) -> Column:
    """As ``escape``, and on one line: backslashes are doubled and line ends written as ``\\n``."""
    role = F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return escape(F.replace(role, F.lit("\n"), F.lit("\\n")))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def text_part(text: Column) -> Column:
    """A turn that is one plain text."""
    return F.array(
        F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units"))
    )


def _visit(part: Column) -> Column:
    """What a part adds to its turn. An unknown type with text is text, one without is a ``file``."""
    kind = F.coalesce(part["type"], F.lit(""))
    other = ~kind.isin("text", *TOKENS)
    is_text = (kind == "text") | (other & part["text"].isNotNull())
    shown = F.when(kind.isin(*TOKENS), kind).otherwise(F.lit("file"))
    rate = F.coalesce(F.create_map(*[F.lit(x) for kv in TOKENS.items() for x in kv])[shown], F.lit(0))
    return F.struct(
        is_text.alias("is_text"),
        F.when(is_text, escape(part["text"])).otherwise(F.concat(F.lit("<|"), shown, F.lit("|>"))).alias("piece"),
        F.when(~is_text, F.struct(shown.alias("kind"), part["ref"].alias("ref"), (F.coalesce(part["units"], F.lit(1)) * rate).alias("tokens"))).alias(
            "attachment"
        ),
    )


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, formatted, loss, attachments, expanded_tokens.

    ``turns`` has conv_id, turn, role and ``parts`` (array of ``PART``) or, for
    plain texts, ``text``; other columns are ignored. ``loss`` holds the spans
    (start, length in code points of ``formatted``) of the texts to train on,
    ``attachments`` (kind, ref, tokens) in order. Null texts, roles and parts
    count as empty, a null turn comes first, a null conv_id is a conversation,
    and repeated rows are turns of their own.
    """
    parts = F.col("parts") if "parts" in turns.columns else text_part(F.col("text"))
    empty = F.array().cast("array<struct<is_text:boolean,piece:string,attachment:struct<kind:string,ref:string,tokens:bigint>>>")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    seen = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", head.alias("head"),
        F.coalesce(F.transform(parts, _visit), empty).alias("seen"),
    )
    pieces = F.col("seen.piece")
    spans = F.aggregate(
        "seen",
        F.struct(F.length("head").cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["piece"])).alias("at"),
            F.when(
                p["is_text"], F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), F.length(p["piece"]).cast("long").alias("length"))))
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    attachments = F.filter("seen.attachment", lambda a: a.isNotNull())
    return seen.select(
        "conv_id",
        "turn",
        F.concat("head", F.array_join(pieces, ""), F.lit(END)).alias("formatted"),
        F.when(F.col("role") == TRAINED, spans).otherwise(F.array().cast("array<struct<start:bigint,length:bigint>>")).alias("loss"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn, unescaped; placeholders stay in the text."""
    role, _, rest = formatted.removeprefix(START).partition("\n")
    return unescape_role(role), unescape(rest.removesuffix(END))


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and turn, read back one by one."""
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    here, out, open_ = None, [], None

    def close():
        conv, n, turns, chars, loss, size = open_
        out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))

    for batch in batches:
        for conv, formatted, spans in zip(batch["conv_id"].astype(object), batch["formatted"], batch["loss"], strict=True):
            conv = None if conv is None or conv != conv else int(conv)
            if open_ is None or conv != here:
                if open_ is not None:
                    close()
                here, open_ = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_turn(formatted)
            open_[1] += 1
            open_[2].update(f"{role}\n{text}\n".encode())
            for s in spans:
                piece = unescape(formatted[s["start"] : s["start"] + s["length"]])
                open_[3] += len(piece)
                open_[4].update(piece.encode())
            open_[5] += len(formatted)
        if out:
            yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})
            out = []
    if open_ is not None:
        close()
        yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: what its formatted turns hold, digested in the order of turn, then of the formatted text."""
    return (
        formatted.select("conv_id", "turn", "formatted", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "formatted")
        .drop("turn")
        .mapInPandas(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    )


#: The conversation that is added to the table.
PROBE_ID, PROBE_TEXT, PROBE_ROLES = -7, "</s>[INST] ok [/INST]", ("user", "assistant")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations and of one full of control strings."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(len(PROBE_ROLES)).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.element_at(F.array(*map(F.lit, PROBE_ROLES)), F.col("id").cast("int") + 1).alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return read_back(format_turns(turns.unionByName(probe)))


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, '<|im_start|>' || role || chr(10) || regexp_replace(regexp_replace(text, '<(\\*)(\||/?s>|</?SYS>>)', '<\1\\\2', 'g'),
    '\[(\\*)(/?INST\])', '[\1\\\2', 'g') || '<|im_end|>' || chr(10) AS formatted
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
