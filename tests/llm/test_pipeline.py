"""The pipeline against the same steps done by hand, document by document."""

import numpy as np
import pytest

import corpus_pipeline as P
from tests.conftest import SMOKE_DIR
from tests.llm.test_linededup import by_hand as line_dedup_by_hand
from tests.llm.test_minhash import brute as groups_by_hand
from tillflow.llm import decontaminate as D
from tillflow.llm import vocabulary as V

STAGES = dict(P.STAGES)


def leaks(text, items):
    text = D.normal(text)
    grams = D._grams(text)
    for item in items:
        allowed = int(len(item) * D.EDITS)
        own = D._grams(item)
        if len(own & grams) >= len(own) - D.GRAM * allowed and D.edits(item, text) <= allowed:
            return True
    return False


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").orderBy("doc_id").collect()]


def test_run_matches_the_steps_by_hand(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(V.default_path())
    items = [D.normal(r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in documents if t and any(c.isalpha() for c in t)]
    rows = [(i, t) for i, t, _, removed in line_dedup_by_hand(rows) if t or not removed]
    component = groups_by_hand(rows, 5)
    rows = [(i, t) for i, t in rows if component[i] == i]
    rows = [(i, t) for i, t in rows if not leaks(t, items)]
    want = {}
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        want[i] = (len(t), len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False))
    got = P.run(spark, SMOKE_DIR).collect()
    assert len(got) == len(want) < len(documents)
    assert {r.doc_id: (r.n_chars, r.n_tokens, bytes(r.ids), r.decoded) for r in got} == want


ODD = [
    (1, "Plain English words in a row, the cat and the dog.", "en", "a", 50),
    (2, None, "en", "a", None),
    (3, "", "en", "a", 0),
    (4, "123 456 !!", None, "a", 10),
    (None, "Another text without an id, but with words and letters.", "en", None, 55),
    (5, "word " * 40_000, "en", "a", 200_000),
    (6, "Plain English words in a row, the cat and the dog.", "en", "b", 50),
    (6, "Plain English words in a row, the cat and the dog.", "en", "b", 50),
    (7, "first line here\nsecond line here\nthird line", "en", "c", 43),
    (8, "first line here\nsecond line here\nthird line", "en", "c", 43),
]


def test_odd_rows_in_every_stage(spark, scratch):
    def step(name, docs):
        """A stage as the pipeline runs it: written and read again."""
        path = scratch(name)
        STAGES[name](spark, docs, SMOKE_DIR).write.parquet(path)
        return spark.read.parquet(path)

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(ODD, schema)
    bench = spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").first().text
    leak = spark.createDataFrame([(9, f"Some words before. {bench.upper()} And after.", "en", "d", 1)], schema)
    docs = docs.unionByName(leak)

    kept = step("language_id", docs)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 5, 6, 6, 7, 8, 9]
    lined = step("line_dedup", kept)
    assert sorted(r.doc_id or 0 for r in lined.collect()) == [0, 1, 5, 6, 6, 7, 9]  # nothing is left of 8
    single = step("near_dedup", lined)
    assert sorted(r.doc_id or 0 for r in single.collect()) == [0, 1, 5, 7, 9]
    clean = step("decontamination", single)
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [0, 1, 5, 7]
    for stage in (kept, lined, single, clean):
        assert stage.columns == docs.columns
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SMOKE_DIR).count() == 0, name


def test_clean_documents_pass_unchanged(spark, documents):
    """Texts that share nothing with others go through the filters as they are."""
    rows = [(i, " ".join(f"{t.split()[k % 7]}{i}" for k in range(60)), "en", "s", 1) for i, t in documents[:30] if len(t.split()) > 7]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES[:-1]:
        assert sorted(map(tuple, stage(spark, docs, SMOKE_DIR).collect())) == sorted(rows), name


def test_language_id_uses_the_prediction(spark):
    """A text without a label gets the predicted one; labels that are there stay."""
    import random

    rnd = random.Random(4)
    kinds = {"en": "the and was of that with her not they from this".split(), "fr": "les des une dans est pour qui sur avec été plus".split()}
    say = lambda lang, n: " ".join(rnd.choices(kinds[lang], k=n))
    rows = [(i, say(lang, 60), lang, "s", 1) for i, lang in enumerate(["en", "fr"] * 60)]
    rows += [(1000 + i, say(lang, 40), None, "s", 1) for i, lang in enumerate(["en", "fr"] * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.lang for r in STAGES["language_id"](spark, docs, SMOKE_DIR).collect()}
    assert got == {i: lang or ["en", "fr"][i % 2] for i, _, lang, _, _ in rows}


def test_columns_with_the_operators_names_pass(spark):
    names = "lang_pred score bits_per_byte n_lines n_removed kept component_id box gone key left".split()
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in ODD], ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *[f"{n} int" for n in names]]))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SMOKE_DIR)
        assert out.columns == docs.columns, name
        assert {tuple(r[n] for n in names) for r in out.collect()} == {tuple(range(len(names)))}, name


def test_without_labels_every_text_with_letters_stays(spark):
    docs = spark.createDataFrame([(i, t, None, s, n) for i, t, _, s, n in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    kept = STAGES["language_id"](spark, docs, SMOKE_DIR)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 5, 6, 6, 7, 8]
