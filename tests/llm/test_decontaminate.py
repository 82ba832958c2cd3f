import random

from tests.conftest import SMOKE_DIR
from tillflow.llm import decontaminate as D


def slow_edits(item, text):
    best = len(item)
    row = list(range(len(item) + 1))
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_edit_distance():
    rnd = random.Random(1)
    for _ in range(1500):
        a = "".join(rnd.choices("abc", k=rnd.randrange(1, 12)))
        b = "".join(rnd.choices("abc", k=rnd.randrange(25)))
        assert D.edits(a, b) == slow_edits(a, b)


def changed(rnd, text, rate):
    out = []
    for c in text:
        x = rnd.random()
        out += [] if x < rate / 3 else [rnd.choice("abcdefgh")] if x < 2 * rate / 3 else [c, rnd.choice("abcdefgh")] if x < rate else [c]
    return "".join(out)


def planted(spark, rate, seed):
    """Items written into documents with random edits, (item_id, text) and whether they are still within reach."""
    rnd = random.Random(seed)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    docs = [r.text for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").orderBy("doc_id").collect() if len(r.text) > 400]
    texts, near = [], []
    for k, (_, item) in enumerate(items * 3):
        w = docs[k % len(docs)].split(" ")
        p = rnd.randrange(len(w))
        new = changed(rnd, item, rate)
        texts.append(" ".join([*w[:p], new, *w[p:]]))
        near.append(D.edits(D.normal(item), D.normal(new)) <= int(D.EDITS * len(D.normal(item))))
    return items, texts, near


def test_recall(spark):
    for rate, least in ((0, 1.0), (0.02, 0.97), (0.05, 0.9)):
        items, texts, near = planted(spark, rate, 7)
        found = D.Index(items).search(texts)
        hits = [items[k % len(items)][0] in f for k, f in enumerate(found)]
        assert sum(h for h, n in zip(hits, near, strict=True) if n) >= least * sum(near)


def test_documents_match_brute_force(spark):
    items = [(r.item_id, D.normal(r.text)) for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    docs = [(r.doc_id, D.normal(r.text)) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()]
    want = set()
    for d, text in docs:
        grams = D._grams(text)
        for i, item in items:
            allowed = int(D.EDITS * len(item))
            own = D._grams(item)
            if len(own & grams) >= len(own) - D.GRAM * allowed and (e := D.edits(item, text)) <= allowed:
                want.add((d, i, e))
    assert {tuple(r) for r in D.query(spark, SMOKE_DIR).collect()} == want and want


def test_blocks_and_pieces_do_not_change_the_result(spark, monkeypatch):
    items, texts, _ = planted(spark, 0.01, 3)
    whole = D.Index(items).search(texts)
    monkeypatch.setattr(D, "BYTES", 1500)
    monkeypatch.setattr(D, "TOGETHER", 16)
    assert [set(f) for f in D.Index(items).search(texts)] == [set(f) for f in whole]
    monkeypatch.setattr(D, "ITEMS", 7)
    df = spark.createDataFrame(list(enumerate(texts[:40])), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: {x.item_id for x in r.leaks} for r in D.find_leaks(df, bench).collect()}
    assert got == {k: set(f) for k, f in enumerate(whole[:40])}


LONG = "the quick brown fox jumps over the lazy dog and runs away from all the hunters of the dark forest"


def test_odd_rows(spark):
    bench = spark.createDataFrame(
        [(1, None), (2, ""), (3, "Tiny one"), (4, LONG), (4, LONG), (None, LONG.replace("fox", "cat"))], "item_id long, text string"
    )
    rows = [(1, None), (2, ""), (None, "a tiny\n ONE"), (5, "tinyone"), (6, f"So {LONG.title()}!"), (6, f"So {LONG.title()}!")]
    rows += [(7, "word " * 60_000 + LONG), (8, "z" * 500_000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, LEAKS int")
    got = D.find_leaks(df, bench)
    assert got.columns == ["doc_id", "text", "leaks"]
    by = {(r.doc_id, (r.text or "")[:4]): [tuple(x) for x in r.leaks] for r in got.collect()}
    assert by[1, ""] == by[2, ""] == by[5, "tiny"] == by[8, "zzzz"] == []
    assert by[None, "a ti"] == [(3, 0)] and (4, 0) in by[6, "So T"] and (4, 0) in by[7, "word"]
    assert got.count() == len(rows)
    left = D.clean(df, bench)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 5, 8] and "leaks" not in left.columns
    assert D.find_leaks(df, bench.limit(0)).where("size(leaks) > 0").count() == 0
    assert D.find_leaks(df.limit(0), bench).count() == 0


def test_long_items_are_found_with_edits():
    """Items of 1 to 10 KB, beyond four times the largest window, with a comma after them, one typo or random edits."""
    rnd = random.Random(11)
    words = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randrange(2, 9))) for _ in range(3000)]
    items = [(k, " ".join(rnd.choices(words, k=n))) for k, n in enumerate((180, 200, 400, 800, 1700))]
    index = D.Index(items)
    assert len(items[0][1]) > 4 * D.SIZES[-1] and len(items[-1][1]) > 9000 and not index.short.own
    around = " ".join(rnd.choices(words, k=300))
    for k, text in items:
        middle = len(text) // 2
        for new, edits in ((text, 0), (f'"{text},', 0), (text[:middle] + "#" + text[middle + 1 :], 1)):
            assert index.search([f"{around} {new} {around}"]) == [{k: edits}]
        assert list(index.search([f"{around} {changed(rnd, text, 0.05)} {around}"])[0]) == [k]
        assert index.search([f"{around} {text[: len(text) * 8 // 10]} {around}"]) == [{}]
    # a block does not grow with the length of its items
    many = [(0, items[-1][1])] * 300
    assert max(map(len, _blocks_of(many))) * len(items[-1][1]) <= D.LETTERS + len(items[-1][1])


def _blocks_of(items):
    class Benchmark:
        def select(self, *_):
            return self

        def toLocalIterator(self):
            return iter({"item_id": i, "text": t} for i, t in items)

    return list(D._blocks(Benchmark()))


def test_short_items_match_brute_force():
    """Items of up to SHORT letters, and longer ones without blanks, are found wherever the edit distance allows."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices("etaoins", k=rnd.randrange(1, 9))) for _ in range(300)] + ["naïve", "é", "straße"]
    items = [(k, " ".join(rnd.choices(words, k=rnd.randrange(2, 12)))) for k in range(60)]
    items += [(60 + k, "".join(chr(rnd.randrange(0x4E00, 0x4F00)) for _ in range(n))) for k, n in enumerate((3, 12, 40, 90, 400))]
    items += [(70, "https://example.com/" + "a1b2/" * 30), (71, "x" * 64), (72, "")]
    texts = []
    for k in range(250):
        _, item = items[k % len(items)]
        new = changed(rnd, item, rnd.choice((0, 0.03, 0.08)))
        texts.append(" ".join([*rnd.choices(words, k=rnd.randrange(30)), rnd.choice(("", '"')) + new + rnd.choice(("", ",", "?")), *rnd.choices(words, k=9)]))
    texts += [None, "", "a", items[60][1], "x" * 70]
    found = D.Index(items).search(texts)
    hits = 0
    for text, got in zip(texts, found, strict=True):
        text = D.normal(text)
        for k, item in items:
            item = D.normal(item)
            allowed = int(D.EDITS * len(item))
            if not item or len(item) > D.SHORT and " " in item:
                continue
            if allowed:
                e = D.edits(item, text)
                want = e if e <= allowed else None
            else:
                at = [p for p in range(len(text)) if text.startswith(item, p) and D.bounded(text, p, p + len(item))]
                want = 0 if at else None
            assert got.get(k) == want, (item, text, got.get(k), want)
            hits += want is not None
    assert hits > 200


def test_short_items_beside_marks_and_in_pieces(monkeypatch):
    index = D.Index([(1, "Who wrote it?"), (2, "seven"), (3, "東京"), (4, "What is the capital of France in Europe?")])
    texts = ['"Who wrote it?"', "who wrotte it?", "(seven)", "seventy", "私は東京都に住む", "so: what is the capitol of france in europe?!", "sevén"]
    want = [{1: 0}, {1: 1}, {2: 0}, {}, {3: 0}, {4: 1}, {}]
    assert index.search(texts) == want
    monkeypatch.setattr(D, "BYTES", 7)
    monkeypatch.setattr(D, "POSITIONS", 5)
    assert index.search(texts) == want
