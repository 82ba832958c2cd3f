import numpy as np

from tillflow.llm import embeddedup as E

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, threshold=0.95):
    """n_links and component of each row by all pairs; vec_ids are unique."""
    ids = [i for i, _ in rows]
    x = [None if v is None or not len(v) or any(c is None for c in v) or not np.isfinite(v).all() or not np.any(v) else np.array(v, float) for _, v in rows]
    links = {i: set() for i in ids}
    for a in range(len(rows)):
        for b in range(a):
            if x[a] is not None and x[b] is not None and len(x[a]) == len(x[b]):
                if x[a] @ x[b] / (np.linalg.norm(x[a]) * np.linalg.norm(x[b])) >= threshold:
                    links[ids[a]].add(ids[b])
                    links[ids[b]].add(ids[a])
    comp = {i: i for i in ids}
    while True:
        after = {i: min([comp[i], *(comp[j] for j in links[i])]) for i in ids}
        if after == comp:
            return {i: (len(links[i]), comp[i], comp[i] == i) for i in ids}
        comp = after


def found(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA + ", digest int, rep string").repartition(3)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect()}


def families(seed, n, width):
    """Vectors around some origins, many of them at a cosine close to the threshold, and copies."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.8:
            v = np.array(rows[rng.integers(len(rows))][1])
            if rng.random() < 0.8:
                away = rng.normal(size=width)
                away -= away @ v / (v @ v) * v
                c = rng.choice([0.95 + rng.normal() * 0.004, 0.98])
                v = c * v / np.linalg.norm(v) + np.sqrt(1 - c * c) * away / np.linalg.norm(away)
        else:
            v = rng.normal(size=width)
        rows.append((i * 3 + 1, (v * rng.choice([1.0, 1.0, 2.0, 1e-3])).tolist()))
    rng.shuffle(rows)
    return [(int(i), v) for i, v in rows]


def test_against_all_pairs(spark, monkeypatch):
    rows = families(1, 260, 20)
    want = brute(rows)
    assert len({c for _, c, _ in want.values()}) < 200
    assert found(spark, rows) == want
    monkeypatch.setattr(E, "BLOCK_VALUES", 20 * 30)  # nine blocks in several waves
    monkeypatch.setattr(E, "WAVE", 2)
    monkeypatch.setattr(E, "TILE", 16)
    assert found(spark, rows) == want


def test_bounds_hold_and_spare_work():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(300, 64)), rng.normal(size=(2, 64)) * [[1e200], [1e-200]], np.eye(64)[:5]])
    x = np.concatenate([x, x[:100] + 0.25 * rng.normal(size=(100, 64))])
    q = E.Quantised(x)
    every = slice(0, len(x))
    dot, bound = q.rough(every, q, every)
    exact = q.unit @ q.unit.T
    assert (np.abs(dot - exact) <= bound).all()
    links, again = E.linked(q, every, q, every)
    assert (links == (exact >= 0.95)).all()
    assert again < 0.01 * len(x) ** 2
    long = E.Quantised(rng.normal(size=(6, 5000)))
    dot, bound = long.rough(slice(0, 6), long, slice(0, 6))
    assert (np.abs(dot - long.unit @ long.unit.T) <= bound).all()


def test_a_large_group_returns_its_members_only(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=32) + 0.01 * rng.normal(size=(3000, 32))
    count, root = E.compared(E.Quantised(x), None, np.ones(3000, np.int64))
    assert (count == 2999).all() and (root == 0).all()
    rows = [(i, x[i].tolist()) for i in range(300)] + [(1000 + i, x[0].tolist()) for i in range(300)]
    got = found(spark, rows)
    assert set(got.values()) == {(599, 0, True), (599, 0, False)} and got[0][2]


def test_chains(spark):
    angles = np.arange(12) * np.arccos(0.96)
    rows = [(100 - k, [float(np.cos(a)), float(np.sin(a))]) for k, a in enumerate(angles)]
    got = found(spark, rows)
    assert got == brute(rows) and got[100][1] == 89


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [-0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, inf]), (7, [1.0, None]), (8, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [3.0, 0.0]), (11, [-1.0, 0.0]), (12, [1e-320, 0.0])]
    assert found(spark, rows) == brute(rows[:-1]) | {8: (2, 8, True), 10: (2, 8, False), 12: (2, 8, False)}
    df = spark.createDataFrame([*rows[7:9], (8, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (None, [5.0, 5.0])], SCHEMA)
    got = sorted(map(tuple, E.near_duplicates(df).collect()), key=str)
    assert got == sorted([(8, 1, 8, True), (8, 1, 8, True), (8, 1, 8, True), (9, 1, 8, False), (None, 0, None, True), (None, 0, None, True)], key=str)
    assert E.near_duplicates(df.limit(0)).count() == 0
