import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm import hardnegatives as H


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 4), (64, 64, 64), (33, 65, 130), (100, 64, 257), (0, 4, 3)])
def test_strassen(shape):
    rng = np.random.default_rng(1)
    m, k, n = shape
    for top in (3, 10**6, 2**28):
        a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
        assert (H.strassen(a, b, leaf=4) == a @ b).all()
        assert (H.strassen(a, b) == a @ b).all()


def brute(rows, is_anchor):
    """By hand with Python's integers; rows are (vec_id, label, vector)."""
    import math

    taken = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if None not in (i, lab, v) and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    anchors = {}
    for i, lab, v in sorted(taken):
        if is_anchor(i):
            anchors.setdefault(i, (lab, v))
    for a, (lab, v) in anchors.items():
        scored = sorted((-score(v, c), i, other == lab) for i, other, c in taken if i != a)
        for s, p, _ in [x for x in scored if x[2]][:5]:
            near = [(-ns, n) for ns, n, same in scored if not same and 30 * -s <= 100 * -ns <= 90 * -s][:10]
            out += [(a, p, k, n, -s, ns) for k, (ns, n) in enumerate(near, 1)]
    return sorted(out)


def vectors(seed, n, width=7, kinds=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rnd.choice([rnd.gauss(0.3, 0.5), round(rnd.gauss(0.2, 0.4), 1)]) for _ in range(width)]
        rows.append((i, rnd.randrange(kinds), v))
    rnd.shuffle(rows)
    return rows


SCHEMA = "vec_id long, label int, embedding array<double>"


def mined(spark, rows, **changes):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", score int, q string").repartition(3)
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 10 == 0, **changes).collect())


def test_against_brute_force(spark, monkeypatch):
    rows = vectors(3, 300)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    assert mined(spark, rows) == want
    monkeypatch.setattr(H, "BLOCK_VALUES", 60)  # several blocks
    assert mined(spark, rows) == want


def test_ties_and_a_common_label(spark):
    rows = [(i, 0 if i % 3 else 1, [0.5, float(i % 2)]) for i in range(200)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = vectors(5, 40, width=3)
    odd = [(100, None, [1.0, 1.0, 1.0]), (110, 1, None), (120, 1, [nan, 1.0, 1.0]), (130, 1, [inf, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (140, 1, [None, 1.0, 1.0])]
    odd += [(150, 1, []), (151, 2, [1.0]), (152, 1, [0.5, 0.5, 0.5, 9.0]), (10, 1, [0.7, 0.7, 0.7]), (good[0][0], good[0][1], good[0][2])]
    got = mined(spark, good + odd)
    assert got == brute(good + odd, lambda i: i % 10 == 0)
    assert got == [r for r in mined(spark, [*good, *odd, (160, 1, [1e300, 1.0, 1.0])]) if 160 not in (r[0], r[1], r[3])]
    df = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(df, F.col("vec_id") % 10 == 0).count() == 0
    assert mined(spark, [(10, 1, [1.0]), (11, 2, [1.0])]) == []


def test_rows_of_any_size_are_exact(spark):
    top = (H.largest_component(3) - 2) // 256
    rows = [(0, 1, [float(top)] * 3), (1, 1, [float(top)] * 3), (2, 2, [float(top // 2)] * 3), (3, 2, [float(top), -1.0, 5.0])]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0) and got
