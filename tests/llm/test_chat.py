import hashlib
import random

from pyspark.sql import functions as F

from tests.conftest import SMOKE_DIR
from tillflow.llm import chat as C

BITS = ["<|", "im_start", "|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<", "[", "\\", "\n", "é🙂", "text", "<\\|", "[\\\\INST]", "<|im_end|>\n"]


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")


def digest(rows):
    """Per conversation by hand, rows in order."""
    out = {}
    for conv, _, role, text in rows:
        out.setdefault(conv, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {
        c: (len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), sum(len(x) for r, x in t if r == "assistant"), sha("".join(x for r, x in t if r == "assistant")))
        for c, t in out.items()
    }


def test_texts_come_back(spark):
    rnd = random.Random(1)
    rows = [(k // 4, k % 4, rnd.choice(["user", "assistant", "a\nb\\n<|c"]), "".join(rnd.choices(BITS, k=rnd.randrange(12)))) for k in range(600)]
    formatted = C.format_turns(turns(spark, rows)).collect()
    texts = {(r.conv_id, r.turn): r for r in formatted}
    for conv, turn, role, text in rows:
        r = texts[conv, turn]
        assert C.parse_turn(r.formatted) == (role, text)
        body = r.formatted.removeprefix(C.START).removesuffix(C.END)
        assert not any(x in body for x in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))
        assert [C.unescape(r.formatted[s.start : s.start + s.length]) for s in r.loss] == ([text] if role == "assistant" else [])
    got = {r.conv_id: tuple(r)[1:5] for r in C.read_back(C.format_turns(turns(spark, rows))).collect()}
    assert got == digest(rows)


def test_query_adds_the_probe(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMOKE_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").orderBy("conv_id", "turn").collect()]
    rows += [(C.PROBE_ID, k, r, C.PROBE_TEXT) for k, r in enumerate(C.PROBE_ROLES)]
    got = C.query(spark, SMOKE_DIR).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == digest(rows)


def test_typed_parts(spark):
    parts = [
        ("text", "see <|this|>", None, None), ("image", None, "s://img/1", 576), ("text", " and ", None, None), ("audio", None, "s://a/2", 3),
        ("document", None, "s://d/3", None), ("video", None, "s://v/4", 7), ("note", "kept", None, None), (None, None, None, None), ("text", None, None, None),
    ]
    rows = [(1, 0, "assistant", parts), (1, 1, "user", []), (1, 2, None, None)]
    df = spark.createDataFrame([], "conv_id long, turn long, role string").sparkSession.createDataFrame(
        rows, "conv_id long, turn long, role string, parts array<struct<type:string,text:string,ref:string,units:bigint>>"
    )
    got = {r.turn: r for r in C.format_turns(df).collect()}
    r = got[0]
    assert r.formatted == "<|im_start|>assistant\nsee <\\|this|><|image|> and <|audio|><|document|><|file|>kept<|file|><|im_end|>\n"
    assert [tuple(a) for a in r.attachments] == [("image", "s://img/1", 576), ("audio", "s://a/2", 75), ("document", "s://d/3", 600), ("file", "s://v/4", 0), ("file", None, 0)]
    assert r.expanded_tokens == 576 + 75 + 600
    assert [C.unescape(r.formatted[s.start : s.start + s.length]) for s in r.loss] == ["see <|this|>", " and ", "kept", ""]
    assert got[1].formatted == "<|im_start|>user\n<|im_end|>\n" and got[2].formatted == "<|im_start|>\n<|im_end|>\n"


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "a"), (None, 1, "assistant", None), (1, None, "user", "first"), (1, 0, None, None), (1, 1, "assistant", "x" * 300_000),
        (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (3, 0, "user", ""),
    ]
    got = {r.conv_id: tuple(r)[1:5] for r in C.read_back(C.format_turns(turns(spark, rows))).collect()}
    assert got == digest(rows)
    assert C.read_back(C.format_turns(turns(spark, []).limit(0))).count() == 0


def test_a_long_conversation_streams(spark):
    df = spark.range(20_000).select(F.lit(5).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    got = C.read_back(C.format_turns(df)).first()
    rows = [(5, k, "assistant" if k % 2 else "user", str(k)) for k in range(20_000)]
    assert tuple(got)[1:5] == digest(rows)[5]
