"""BPE and token counts."""

import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SMOKE_DIR
from tillflow.llm import bpe, tokencount
from tillflow.llm import vocabulary as V

ODD = "aAbB 'sS'tT'RE'lL\t\n\x1c\x85\xa0.,!?123½²ΣσςÀéßẞİıǅ中文日本語한국어🙂👍🏽é́å‍​﻿-_/\\"


@pytest.fixture(scope="module")
def vocabulary():
    return V.load()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(V.default_path())


def test_encoding_is_the_librarys(vocabulary, library):
    rnd = random.Random(1)
    codec = bpe.Codec(vocabulary)
    texts = ["", "a", "'s", "<|endoftext|>", "x<|startoftext|><|endoftext|> <|endoftext|", "a" * 3000, "".join(rnd.choice("abcde") for _ in range(4000))]
    texts += ["".join(rnd.choice(ODD) if rnd.random() < 0.9 else "<|endoftext|>" for _ in range(rnd.randrange(60))) for _ in range(3000)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == want, repr(t)
        assert codec.decode(codec.encode(t)) == library.decode(want, skip_special_tokens=False)


def test_long_words_merge_alike(vocabulary):
    rnd = random.Random(3)
    codec = bpe.Codec(vocabulary)
    for _ in range(300):
        parts = [codec._first[ord(rnd.choice("abcdeinrst"))] for _ in range(rnd.randrange(1, 60))]
        assert codec._merge_long(list(parts)) == codec._merge_short(list(parts))


def test_query_digests(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()}
    got = bpe.query(spark, SMOKE_DIR).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def odd_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (None, "hello", "k"), (3, "hello", "k"), (3, "hello", "k"), (4, "é" * 150_000, None), (5, "w " * 200_000, "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, N_Tokens string")


def test_odd_rows_encode(spark):
    df = odd_rows(spark)
    got = bpe.round_trip(df)
    assert got.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == 7
    assert (by[1].n_tokens, bytes(by[1].ids), by[1].decoded) == (0, b"", "") == (by[2].n_tokens, bytes(by[2].ids), by[2].decoded)
    assert by[None].decoded == by[3].decoded == "hello</w>"
    assert by[5].n_tokens == 200_000
    assert bpe.round_trip(df.limit(0)).count() == 0


def brute(word: bytes, pieces: set) -> int:
    symbols, at, n = (*word, tokencount._END), 0, 0
    while at < len(word):
        end = next((j for j in range(len(symbols), at, -1) if symbols[at:j] in pieces), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_automaton_is_greedy_longest_match():
    rnd = random.Random(3)
    for _ in range(1500):
        pieces = {tuple(rnd.choices(b"abcd", k=rnd.randrange(1, 5))) + ((tokencount._END,) if rnd.random() < 0.3 else ()) for _ in range(rnd.randrange(1, 12))}
        automaton = tokencount.Automaton(list(pieces))
        for _ in range(15):
            word = bytes(rnd.choices(b"abcd", k=rnd.randrange(1, 12)))
            assert automaton.count(word) == brute(word, pieces)


def test_counts_of_documents(spark, vocabulary):
    pieces = set(tokencount.pieces_of(vocabulary))
    split = V.Splitter(vocabulary)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in tokencount.query(spark, SMOKE_DIR).collect()}
    known: dict[str, int] = {}
    for i, t in docs.items():
        words = split.plain(t)
        for w in words:
            if w not in known:
                known[w] = brute(w.encode(), pieces)
        assert got[i] == (len(words), sum(known[w] for w in words))


def test_odd_rows_count(spark):
    got = tokencount.token_counts(odd_rows(spark))
    assert got.columns == ["doc_id", "text", "n_words", "n_tokens"]
    by = {r.doc_id: (r.n_words, r.n_tokens) for r in got.collect()}
    assert by[1] == by[2] == (0, 0) and by[None] == by[3] == (1, 1) and by[5] == (200_000, 200_000) and by[4][0] == 1
    assert tokencount.token_counts(odd_rows(spark).limit(0)).count() == 0
