import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMOKE_DIR
from tillflow.llm import periodicruns as P


def brute(w):
    """Runs by trying every distance: maximal stretches of equal words q apart whose smallest period is q."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            start, end = i, j + q
            if end - start >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(start, end - p)) for p in range(1, q)):
                out.append((start, end - start, q))
            i = j + 1
    return sorted(out)


def numbers(w):
    return np.array(w, np.int64)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70))
def test_small_alphabets(w):
    assert P.find_runs(numbers(w)) == brute(w)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=14), st.integers(1, 9), st.integers(0, 13)), max_size=5))
def test_repeated_stretches(pieces):
    w = [x for part, times, rest in pieces for x in part * times + part[:rest]]
    assert P.find_runs(numbers(w)) == brute(w)


def test_nested_and_long_runs():
    inner = [1] * 9 + [2]
    for w in ([*inner] * 5, ([*inner] * 5 + [3]) * 5, [7] * 5, [7] * 6, list(range(50)) * 4, list(range(50)) * 4 + [0], [1, 2] * 3 + [9] + [1, 2] * 4):
        assert P.find_runs(numbers(w)) == brute(w)
    rnd = random.Random(1)
    part = [rnd.randrange(1000) for _ in range(777)]
    w = [rnd.randrange(10**6) for _ in range(5000)] + part * 6 + [rnd.randrange(10**6) for _ in range(5000)]
    assert P.find_runs(numbers(w)) == [(5000, 777 * 6, 777)]
    assert P.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]


def test_the_set_is_consistent_and_dense():
    rnd = random.Random(2)
    t, w = 8, [rnd.randrange(3) for _ in range(400)]
    w = numbers(w + w)
    names = np.unique(np.lib.stride_tricks.sliding_window_view(w, t), axis=0, return_inverse=True)[1].reshape(-1)
    at = set(P.synchronising_set(names, t, np.zeros(len(names), bool)).tolist())
    for i in range(400 - 2 * t):
        assert (i in at) == (i + 400 in at)
    assert all(at & set(range(i, i + t)) for i in range(800 - 3 * t))


def by_hand(doc_id, text):
    """The query's row, step by step."""
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_query_against_brute_force(spark):
    got = sorted(tuple(r) for r in P.query(spark, SMOKE_DIR).collect())
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id for r in docs if len((r.text or "").split()) <= 900}
    want = {r.doc_id: by_hand(*r) for r in docs if r.doc_id in short}
    assert len(short) > 100 and sum(w[1] > 0 for w in want.values()) > 10
    assert len(got) == len(docs)
    for r in got:
        if r[0] in short:
            assert r == want[r[0]]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a a b"), (5, "x"), (5, "x"), (6, "é é é é é é"), (7, "k " * 40_000)]
    df = spark.createDataFrame([(i, t, 4, "old") for i, t in rows], "doc_id long, text string, runs int, collapsed string")
    got = P.periodic_runs(df)
    assert got.columns == ["doc_id", "text", "runs", "collapsed"]
    told = {(r.doc_id, (r.text or "")[:3]): ([tuple(x) for x in r.runs], r.collapsed) for r in got.collect()}
    assert told[1, ""] == told[2, ""] == told[3, " \t\n"] == ([], "")
    assert told[None, "a a"] == ([(0, 7, 1)], "a b")
    assert told[5, "x"] == ([], "x") and told[6, "é é"] == ([(0, 6, 1)], "é") and told[7, "k k"] == ([(0, 40_000, 1)], "k")
    assert got.count() == len(rows) and P.periodic_runs(df.limit(0)).count() == 0


@pytest.mark.parametrize("doc_id,text", [(None, "a b"), (3, None), (3, ""), (3, "  ")])
def test_nothing_to_plant(doc_id, text):
    assert P.planted(doc_id, text) == text
