import math
import zlib

import numpy as np
import pandas as pd
import pytest

from tests.conftest import SMOKE_DIR
from tillflow.llm import langid as L


def model_of(texts: dict[str, list[str]]) -> L.Model:
    batch = pd.DataFrame([(k, t) for k, v in texts.items() for t in v], columns=["lang", "text"])
    grams = pd.concat(list(L._count([batch])))
    return L.build(grams.groupby(["lang", "gram"], as_index=False)["n"].sum())


TEXTS = {"x": ["the cat and the hat. " * 6, "a thing there"], "y": ["die katze und der hut. " * 6, "ein ding für öl"]}


def slow_bits(texts: list[str], everything: list[str], text: str) -> float:
    """Code length by walking the contexts of one language byte by byte."""
    counts: dict[bytes, dict[int, int]] = {}
    often: dict[bytes, int] = {}
    for t in everything:
        data = L.START + t.lower().encode()
        for i in range(L.ORDER, len(data)):
            often[data[i - L.ORDER : i]] = often.get(data[i - L.ORDER : i], 0) + 1
    for t in texts:
        data = L.START + t.lower().encode()
        for i in range(L.ORDER, len(data)):
            for k in range(L.ORDER + 1):
                c = counts.setdefault(data[i - k : i], {})
                c[data[i]] = c.get(data[i], 0) + 1
    total = 0.0
    data = L.START + text.lower().encode()
    for i in range(L.ORDER, len(data)):
        gone: set[int] = set()
        for k in range(L.ORDER, -1, -1):
            ctx = data[i - k : i]
            if k == L.ORDER and often.get(ctx, 0) < L.MIN_CONTEXT:
                continue
            c = {b: n for b, n in counts.get(ctx, {}).items() if b not in gone}
            if not c:
                continue
            whole = sum(c.values()) + len(c)
            if data[i] in c:
                total -= math.log2(c[data[i]] / whole)
                break
            total -= math.log2(len(c) / whole)
            gone |= set(c)
        else:
            total += math.log2(256 - len(gone))
    return total


def test_code_lengths_are_exact():
    m = model_of(TEXTS)
    everything = [t for v in TEXTS.values() for t in v]
    for text in ["the hut", "zq~7 öäü", "d", everything[0], everything[1] + "9", "für die katze"]:
        got = sum(L._total(m, [b])[0] for b in L._blocks(L._bytes(text)))
        want = [slow_bits(TEXTS[x], everything, text) for x in m.langs]
        assert np.allclose(got, want, rtol=1e-5)


def test_code_is_complete():
    """In every context the 256 bytes share one code space, except what escapes to bytes that cannot follow."""
    m = model_of(TEXTS)
    p = np.exp2(-m.cost.reshape(-1, m.symbols, len(m.langs)).astype(float))
    unseen = 256 - (m.symbols - 1)
    total = p[:, :-1].sum(1) + unseen * p[:, -1]
    assert np.allclose(total, 1, atol=1e-4)


def test_blocks_do_not_change_a_score(monkeypatch):
    m = model_of(TEXTS)
    text = "the katze " * 300
    whole = L.score_texts(m, [text, None, "the", "12"])
    monkeypatch.setattr(L, "BLOCK", 64)
    parts = L.score_texts(m, [text, None, "the", "12"])
    assert whole[0] == parts[0] and whole[0][1] == whole[0][3] == "und"
    assert L.score_texts(m, ["½ ² Ⅷ 12", "ª"])[0][0] == "und" != L.score_texts(m, ["ª"])[0][0]
    assert np.allclose(whole[1], parts[1]) and np.allclose(whole[2], parts[2], rtol=1e-5)


def test_held_out_accuracy(spark):
    got = L.query(spark, SMOKE_DIR).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").toPandas().set_index("doc_id")
    held = {i for i in docs.index if zlib.crc32(str(i).encode()) % 5 == 0}
    assert set(got.index[got.held_out]) == held and len(got) == len(docs)
    assert (got.lang_pred == docs.lang)[sorted(held)].mean() > 0.95
    assert got.score.between(0, 1).all()


def test_odd_rows(spark):
    train = spark.createDataFrame(
        [(i, t, k) for k, v in TEXTS.items() for i, t in enumerate(v)] + [(9, None, "x"), (10, "text", None), (None, "the", "x")],
        "doc_id long, text string, lang string",
    )
    m = L.learn(train)
    docs = spark.createDataFrame(
        [(1, None, "q"), (2, "", "q"), (3, "123 !?", "q"), (4, "the cat", "q"), (4, "the cat", "q"), (None, "und der hut", None), (5, "x" * 300_000, "q")],
        "doc_id long, text string, SCORE string",
    )
    got = L.predict(docs, m)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "bits_per_byte"]
    by = {(r.doc_id, (r.text or "")[:9]): r for r in got.collect()}
    assert got.count() == 7
    assert [by[k].lang_pred for k in [(1, ""), (2, ""), (3, "123 !?")]] == ["und"] * 3
    assert by[4, "the cat"].lang_pred == "x" and by[None, "und der h"].lang_pred == "y"
    assert L.predict(docs.limit(0), m).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, "hello", None)]])
def test_nothing_to_learn_from(spark, rows):
    m = L.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert m.langs == ()
    got = L.predict(spark.createDataFrame([(1, "hello")], "doc_id long, text string"), m).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


def test_training_sample_is_bounded(spark):
    docs = spark.range(4000).selectExpr("id doc_id", "'a' text", "if(id < 3000, 'x', 'y') lang")
    n = {r["lang"]: r["count"] for r in L.sample(docs, 500).groupBy("lang").count().collect()}
    assert 400 < n["x"] < 600 and 400 < n["y"] < 600
