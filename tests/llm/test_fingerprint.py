import hashlib
import random

import numpy as np

from tests.conftest import SMOKE_DIR
from tillflow.llm import fingerprint as P


def shingles(text):
    n = P.SHINGLE
    return {text[i : i + n] for i in range(len(text) - n + 1)} if len(text) >= n else {text} - {""}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def by_hand(rows):
    """doc_id, n_chars, edited text and fingerprints, one document after the other."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        f, e, a = P.sketch(t), P.sketch(edited), P.sketch(after)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), P.written(f), P.written(e), P.likeness(f, e), P.likeness(f, a), P.containment(f, a)))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, run string")
    got = [tuple(r) for r in P.with_edits(df).collect()]
    assert sorted(got, key=str) == sorted(by_hand(rows), key=str)


def test_all_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, docs)
    got = P.query(spark, SMOKE_DIR).toPandas()
    texts = dict(docs)
    ids = sorted(texts)
    after = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    off = [abs(r.near_next - jaccard(shingles(texts[r.doc_id]), shingles(texts[after[r.doc_id]]))) for r in got.itertuples()]
    assert np.mean(off) < 0.03
    assert got.near_edited.mean() > 0.45 > 0.1 > got.near_next.mean()


def test_odd_rows(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(-500, 500), "".join(rnd.choice("abé🙂 ") for _ in range(rnd.randrange(40)))) for _ in range(120)]
    check(spark, rows + [(None, "z"), (None, None), (None, ""), (7, "y" * 300_000), (7, "y" * 300_000), (2**60, "last"), (-(2**60), "first")])
    check(spark, [(5, "lonely text")])
    check(spark, [(None, "abcd"), (None, "efgh")])
    assert P.with_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def hash_by_hand(shingle):
    """The hash of one shingle in whole numbers, without the module's arrays; fixed values: multipliers and shifts."""
    points = [ord(c) for c in shingle] + [0xFFFFFFFF] * (8 - len(shingle))
    h = [p + 1 for p in points]
    for fold, width in ((0x9E3779B97F4A7C15, 1), (0xC2B2AE3D27D4EB4F, 2), (0x165667B19E3779F9, 4)):
        h = [(h[i] * fold + h[i + width]) % 2**64 for i in range(len(h) - width)]
    (x,) = h
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def test_sketches_against_hashes_by_hand():
    rnd = random.Random(6)
    for n in (0, 1, 5, 8, 9, 40, 300, 3000):
        text = "".join(rnd.choice("abcdeé🙂 \n") for _ in range(n))
        hashes = sorted({hash_by_hand(s) for s in shingles(text)})
        want = [h for h in hashes if h < 2**64 // 32] or hashes[:1]
        assert P.sketch(text).tolist() == want, n


def test_error_by_length():
    """The figures of the README: mean error of the likeness of a text to itself with its last quarter replaced."""
    rnd = random.Random(8)
    for n, most in ((60, 0.5), (200, 0.3), (600, 0.13), (2000, 0.07), (10_000, 0.035)):
        off = []
        for _ in range(60):
            a, b = ("".join(rnd.choice("abcdefghij ") for _ in range(n)) for _ in range(2))
            edited = a[: n - n // 4] + b[: n // 4]
            off.append(abs(P.likeness(P.sketch(a), P.sketch(edited)) - jaccard(shingles(a), shingles(edited))))
        print(n, np.mean(off))
        assert np.mean(off) <= most


def test_sketches():
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(60_000))
    part = long[20_000:26_000]
    a, b = P.sketch(part), P.sketch(long)
    assert P.containment(a, b) == 1.0 and P.likeness(a, b) < 0.2
    other = "".join(rnd.choice("abcdefgh ") for _ in range(20_000))
    c = P.sketch(other)
    assert set(P.merged(b, c)) == set(b) | set(c)
    assert abs(len(b) - len(shingles(long)) / P.SCALE) < 5 * (len(b) ** 0.5)
    assert np.array_equal(P.read(P.written(b)), b)
    assert P.likeness(P.sketch(""), P.sketch(None)) == 1.0 and P.likeness(P.sketch("a"), P.sketch("")) == 0.0
    assert len(P.sketch("ab")) == 1 and P.likeness(P.sketch("ab"), P.sketch("ab")) == 1.0


def test_blocks_do_not_change_a_sketch(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog " * 40
    whole = P.sketch(text), P.sketch("tiny"), P.sketch("ninechars")
    monkeypatch.setattr(P, "BLOCK", 16)
    assert all(np.array_equal(x, y) for x, y in zip(whole, (P.sketch(text), P.sketch("tiny"), P.sketch("ninechars")), strict=True))
