import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tillflow.llm import linededup as D


def pieces(text):
    """Pieces of a text by looking at its characters one after the other."""
    out, start, words, after = [], 0, 0, ""
    for at, c in enumerate(text):
        if c not in " \n。！？":
            after = c
            continue
        words += 1
        if c != " " or after == "" or after in ".!?;:sdn" or words == D.WORDS or at + 1 == len(text):
            out.append(text[start : at + 1])
            start, words = at + 1, 0
        after = ""
    return out + [text[start:]] * (start < len(text))


def cut(text):
    """Chunks of a text by looking at its pieces one after the other."""
    parts = pieces(text)
    h = [int(hashlib.md5(x.rstrip(D.BEHIND).encode()).hexdigest()[:8], 16) for x in parts]
    r = [sum(h[i - k] * D.FACTOR**k for k in range(D.WINDOW)) % D.MODULUS if i + 1 >= D.WINDOW else None for i in range(len(parts))]
    out, start = [], 0
    for i in range(1, len(parts) + 1):
        if i == len(parts) or D.WINDOW < i <= len(parts) - 2 and r[i - 2] < r[i - 1] > r[i]:
            out.append(parts[start:i])
            start = i
    return out


def by_hand(rows):
    """(id, text) in, (id, text, lines, removed pieces) out; rows are distinct."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if text is None:
            out.append((i, None, 0, 0))
            continue
        kept, removed, chunks = [], 0, cut(text)
        for c in chunks:
            bare = "".join(c).rstrip(D.BEHIND)
            removable = sum(x.rstrip(D.BEHIND) != "" for x in c) >= D.MIN_PIECES and (len(chunks) == 1 or len(bare) >= D.MIN_CHARS)
            if removable and bare in seen:
                removed += len(c)
            else:
                kept.append("".join(c))
            if removable:
                seen.add(bare)
        out.append((i, "".join(kept), text.count("\n") + 1, removed))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n_lines int, gone string")
    got = D.deduplicate(df)
    assert got.columns == ["doc_id", "text", "gone", "n_lines", "n_removed"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()]
    assert sorted(got, key=str) == sorted(by_hand(rows), key=str)
    return got


def passage(rnd, n):
    return [f"line {rnd.randrange(10**9)} of some words" for _ in range(n)]


def test_repeated_passages(spark):
    rnd = random.Random(1)
    shared = [passage(rnd, 12) for _ in range(3)]
    rows = []
    for i in range(40):
        lines = passage(rnd, rnd.randrange(0, 8))
        lines[len(lines) // 2 : len(lines) // 2] = rnd.choice(shared) if rnd.random() < 0.7 else []
        rows.append((i * 7 - 50, "\n".join(lines)))
    got = check(spark, rows)
    assert sum(r[3] for r in got) > 100


def test_boundaries_resist_shifts():
    """A passage is cut alike wherever it stands, but for its first and last lines."""
    rnd = random.Random(2)
    shared = passage(rnd, 200)
    a = {"".join(c) for c in cut("\n".join(shared))}
    b = {"".join(c) for c in cut("\n".join(passage(rnd, 3) + shared + passage(rnd, 2)))}
    assert len(a & b) >= len(a) - 2


def words(rnd, n, sentence=9):
    """Running text: words of two to nine letters, a full stop after one in ``sentence``; none if that is 0."""
    made = ["".join(rnd.choice("etaoinsrhldcum") for _ in range(rnd.randrange(2, 10))) for _ in range(n)]
    return " ".join(w + "." * (sentence > 0 and rnd.random() < 1 / sentence) for w in made)


@pytest.mark.parametrize("n, sentence, least", [(51, 9, 0.9), (51, 0, 0.8), (75, 0, 0.95), (100, 9, 0.99)])
def test_share_of_passages_removed(n, sentence, least):
    """Passages of over 50 words inside long lines, in differing surroundings; what is around them stays."""
    rnd = random.Random(5)
    hits = 0
    for _ in range(400):
        shared = words(rnd, n, sentence)
        around = [(words(rnd, 40, sentence), words(rnd, 40, sentence)) for _ in range(2)]
        first, second = by_hand([(i, f"{a} {shared} {z}") for i, (a, z) in enumerate(around)])
        assert first[3] == 0 and first[1] == f"{around[0][0]} {shared} {around[0][1]}"
        assert second[1].startswith(around[1][0][:-30]) and second[1].endswith(around[1][1][30:])
        hits += second[3] > 0
    assert hits / 400 >= least


def test_share_of_short_passages_of_lines_removed():
    """Whole lines of a few words each: the figures of the README."""
    rnd = random.Random(5)
    for n, least in ((4, 0.15), (6, 0.5), (10, 0.9), (20, 1)):
        hits = 0
        for _ in range(400):
            shared = passage(rnd, n)
            first, second = by_hand([(i, "\n".join(passage(rnd, 6) + shared + passage(rnd, 6))) for i in (1, 2)])
            assert first[3] == 0 and second[3] <= n
            hits += second[3] > 0
        assert hits / 400 >= least, (n, hits)


@given(st.text("ab s.。\n\tä😀", max_size=60))
def test_pieces_make_up_the_text(text):
    import re

    assert "".join(pieces(text)) == text and re.findall(D.PIECE, text) == pieces(text)


def test_odd_rows(spark):
    rnd = random.Random(3)
    text = "\n".join(passage(rnd, 6))
    blank = "\n" * 9
    rows = [
        (1, None), (2, ""), (3, "one line"), (4, "one line"), (5, "a\nb"), (6, "a\nb"), (7, blank), (8, blank), (9, text), (None, text), (10, text + "\n"),
        (11, "x y\n" * 20_000), (12, " \n\t\n"), (13, "ä\nß\n"), (14, "ä\nß\n"),
    ]
    got = {r[0]: r for r in check(spark, rows)}
    assert got[6][1:] == ("", 2, 2) and got[5][1] == "a\nb" and got[4][1] == "one line" and got[8][1] == blank
    assert got[None][1] == "" and got[14][1] == ""
    assert D.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_row_listed_twice_is_no_repetition_of_itself(spark):
    df = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (2, "a\nb"), (2, "a\nb")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in D.deduplicate(df).collect())
    assert got == [(1, "a\nb"), (1, "a\nb"), (2, ""), (2, "")]


def test_bytes_are_compared(spark, monkeypatch):
    """Equal digests are not enough."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(D.F, "unhex", lambda c: F.lit(b"\0"))
    df = spark.createDataFrame([(1, "a\nb"), (2, "c\nd"), (3, "a\nb")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in D.deduplicate(df).collect()} == {1: "a\nb", 2: "c\nd", 3: ""}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "a\nb")], "doc_id long, text string")
    plan = D.deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chunks_with_one_digest_are_told_apart(spark, monkeypatch):
    """Whatever the digests, every repetition of every chunk is found, not only of the first one."""
    monkeypatch.setattr(D, "_digest", lambda bare: bare.isNull().cast("long"), raising=False)
    monkeypatch.setattr(D.F, "unhex", lambda c: D.F.lit(b"\0"))
    df = spark.createDataFrame([(1, "a\nb"), (2, "c\nd"), (3, "a\nb"), (4, "c\nd")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in D.deduplicate(df).collect()} == {1: "a\nb", 2: "c\nd", 3: "", 4: ""}


def test_texts_are_cut_once_and_not_copied_into_the_rows_of_their_chunks(spark, tmp_path):
    import re

    spark.createDataFrame([(1, "a\nb")], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    plan = D._spots(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "regexp_extract_all" in line]) == 1
    generate = next(line for line in plan.splitlines() if "Generate" in line)
    assert re.search(r"\[_doc#\d+L, _hash#\d+L, _size#\d+\]", generate) and "text#" not in generate


def written_plans(monkeypatch):
    """The optimized plans of the tables that are written from now on."""
    from tillflow.llm.common import Tables

    plans, write = [], Tables._written
    monkeypatch.setattr(Tables, "_written", lambda self, df, **o: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(self, df, **o))
    return plans


def test_the_bitmap_is_looked_at_before_rows_are_shuffled(spark, monkeypatch):
    """Spark moves a semi join on a broadcast bitmap to below it, so all chunks would be shuffled; and texts without repeated chunks stay where they are."""
    plans = written_plans(monkeypatch)
    df = spark.createDataFrame([(1, "a\nb"), (2, "c\nd"), (3, "a\nb")], "doc_id long, text string")
    out = D.deduplicate(df)
    assert sum("bitmap_construct_agg" in p for p in plans) > 0
    assert not any("bitmap_construct_agg" in p and ("LeftSemi" in p or "LeftAnti" in p) for p in plans)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("bitmap_construct_agg") >= 2


def test_texts_are_read_once_for_their_chunks(spark, monkeypatch):
    """No second pass over the texts of documents with repeated chunks."""
    plans = written_plans(monkeypatch)
    D.repeated_chunks(spark.createDataFrame([(1, "a\nb"), (2, "a\nb")], "doc_id long, text string"))
    assert sum("regexp_extract_all" in p for p in plans) == 1


def test_lines_and_columns_that_bear_names_of_steps(spark):
    rows = [(1, "a\nb\n", "x", 5), (2, "\n", "y", 6), (3, "", None, 7), (4, None, "z", 8), (5, "a\nb", "w", 9)]
    df = spark.createDataFrame(rows, "doc_id long, Text string, box string, maybe long")
    got = D.deduplicate(df)
    assert got.columns == ["doc_id", "Text", "box", "maybe", "n_lines", "n_removed"]
    want = [(1, "a\nb\n", "x", 5, 3, 0), (2, "\n", "y", 6, 2, 0), (3, "", None, 7, 1, 0), (4, None, "z", 8, 0, 0), (5, "", "w", 9, 2, 2)]
    assert sorted(map(tuple, got.collect())) == want
