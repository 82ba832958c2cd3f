"""Language identification by prediction by partial matching (PPM).

For each language a variable-order tree of byte contexts (orders 0 to
``ORDER``) is learned from labelled text. Statistics are frozen afterwards, so
the code length of a byte depends only on the ``ORDER`` bytes before it: the
tree is flattened into one table of exact code lengths (method C escape
probabilities with symbol exclusion), indexed by context and byte, with one
column per language. A text costs the sum of its bytes' code lengths; the
language with the shortest code wins.

Learning reads a bounded sample: about ``ROWS_PER_LANG`` labelled rows per
language (chosen by a hash of the id). That bound is also what limits the
size of the broadcast table. Scoring reads every byte of every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import boxed, has_letter, unboxed

#: Longest context, in bytes.
ORDER = 3
#: Labelled rows that a language is learned from, about (each is taken with the same chance).
ROWS_PER_LANG = 1500
#: A context of full order gets a row of its own when it was seen this often in the sample.
MIN_CONTEXT = 4
#: What a text gets that has no language.
UNKNOWN = "und"
#: Bytes scored at once.
BLOCK = 1 << 18
#: What stands before a text.
START = b" " * ORDER


@dataclass(frozen=True)
class Model:
    """``cost[row * symbols + symbol, language]`` in bits; ``row_of[context]`` finds the row."""

    langs: tuple[str, ...]
    symbol_of: np.ndarray  # byte -> symbol; unseen bytes share the last symbol
    symbols: int
    row_of: np.ndarray  # (symbols ** ORDER,) -> row of the longest known context
    cost: np.ndarray  # (rows * symbols, languages) float32


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def _codes(buf: np.ndarray) -> np.ndarray:
    """The byte n-grams of length ``ORDER + 1`` as integers, one for each byte after the first ``ORDER``."""
    n = len(buf) - ORDER
    out = np.zeros(n, np.uint32)
    for k in range(ORDER + 1):
        out = (out << np.uint32(8)) | buf[k : k + n]
    return out


def _blocks(data: bytes):
    """A text in pieces of at most ``BLOCK`` bytes, each after its ``ORDER`` bytes of context."""
    data = START + data
    for at in range(ORDER, len(data), BLOCK):
        yield np.frombuffer(data[at - ORDER : at + BLOCK], np.uint8)


def sample(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> DataFrame:
    """About ``rows_per_lang`` rows of each language, whole texts, by a hash of the id."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    if not counts:
        return known.limit(0)
    chance = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, rows_per_lang / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    return known.where(draw < chance[F.col("lang")])


def _count(batches):
    """Partial counts of the n-grams of each language; one row for each that a task has seen."""
    seen: dict[str, list[np.ndarray]] = {}
    sums: dict[str, dict] = {}

    def fold(lang):
        grams, n = np.unique(np.concatenate(seen.pop(lang)), return_counts=True)
        if lang in sums:
            old, m = sums[lang]
            grams, inv = np.unique(np.concatenate([old, grams]), return_inverse=True)
            n = np.bincount(inv, np.concatenate([m, n])).astype(np.int64)
        sums[lang] = (grams, n)

    held = 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            for buf in _blocks(_bytes(text)):
                if len(buf) > ORDER:
                    seen.setdefault(lang, []).append(_codes(buf))
                    held += len(buf)
            if held > 4 * BLOCK:
                for x in list(seen):
                    fold(x)
                held = 0
    for x in list(seen):
        fold(x)
    for lang, (grams, n) in sums.items():
        yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": n.astype(np.int64)})


def learn(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> Model:
    """Learn from rows that have ``doc_id``, ``lang`` and ``text``; rows without a label or text teach nothing."""
    grams = (
        sample(docs, rows_per_lang)
        .select("lang", "text")
        .mapInPandas(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    return build(grams)


def build(grams: pd.DataFrame) -> Model:
    """The table of code lengths from n-gram counts (columns lang, gram, n)."""
    langs = tuple(sorted(grams["lang"].unique()))
    if not langs:
        return Model((), np.zeros(256, np.int64), 1, np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    grams = grams.sort_values(["lang", "gram"])
    code, n = grams["gram"].to_numpy(np.int64), grams["n"].to_numpy(np.int64)
    which = np.searchsorted(np.array(langs, object).astype(str), grams["lang"].to_numpy().astype(str))
    parts = np.stack([(code >> (8 * (ORDER - k))) & 255 for k in range(ORDER + 1)])
    seen = np.unique(parts)
    symbols = len(seen) + 1
    symbol_of = np.full(256, symbols - 1, np.int64)
    symbol_of[seen] = np.arange(len(seen))
    parts = symbol_of[parts]

    # contexts of each order k: the k symbols before the byte, as one integer in base `symbols`
    keys, counts = [], []
    for k in range(ORDER + 1):
        ctx = np.zeros(len(code), np.int64)
        for j in range(ORDER - k, ORDER):
            ctx = ctx * symbols + parts[j]
        known, inv = np.unique(ctx, return_inverse=True)
        c = np.zeros((len(langs), len(known), symbols), np.int64)
        np.add.at(c, (which, inv, parts[ORDER]), n)
        if k == ORDER:
            often = c.sum(axis=(0, 2)) >= MIN_CONTEXT
            known, c = known[often], c[:, often]
        keys.append(known)
        counts.append(c)

    rows, cost = 0, []
    row_of = np.zeros(symbols**ORDER, np.int32)
    every = np.arange(symbols**ORDER)
    for k in range(ORDER + 1):
        known = keys[k]
        table = np.empty((len(known), symbols, len(langs)), np.float32)
        for at in range(0, len(known), 4096):
            own = known[at : at + 4096]
            chain = [np.searchsorted(keys[j], own % symbols**j) for j in range(k, -1, -1)]
            for x in range(len(langs)):
                table[at : at + 4096, :, x] = _lengths([counts[j][x][i] for j, i in zip(range(k, -1, -1), chain, strict=True)])
        tail = every % symbols**k
        at = np.minimum(np.searchsorted(known, tail), max(len(known) - 1, 0))
        if len(known):
            hit = known[at] == tail
            row_of[hit] = rows + at[hit]
        rows += len(known)
        cost.append(table.reshape(-1, len(langs)))
    return Model(langs, symbol_of, symbols, row_of, np.concatenate(cost))


def _lengths(levels: list[np.ndarray]) -> np.ndarray:
    """Code length in bits of every symbol, from the counts of ever shorter contexts.

    Where a context predicts the symbol its share is count / (total + distinct);
    otherwise the escape, distinct / (total + distinct), is paid and the symbols
    it knows are excluded below. Last comes a uniform choice among the bytes left.
    """
    rows, symbols = levels[0].shape
    out = np.zeros((rows, symbols))
    paid = np.zeros((rows, 1))
    left = np.ones((rows, symbols), bool)
    for c in levels:
        c = np.where(left, c, 0)
        total, distinct = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True)
        known, whole = c > 0, np.maximum(total + distinct, 1)
        out = np.where(known, paid - np.log2(np.maximum(c, 1) / whole), out)
        paid = paid - np.where(distinct > 0, np.log2(np.maximum(distinct, 1) / whole), 0.0)
        left &= ~known
    # the last symbol stands for all bytes that no language has seen
    rest = 256 - (symbols - left.sum(1, keepdims=True))
    return np.where(left, paid + np.log2(np.maximum(rest, 1)), out)


def _total(model: Model, bufs: list[np.ndarray]) -> np.ndarray:
    """Code length of each buffer under each language; a buffer starts with its context."""
    sizes = np.array([len(b) - ORDER for b in bufs])
    buf = model.symbol_of[np.concatenate(bufs)]
    row = np.zeros(len(buf) - ORDER, np.int64)
    for k in range(ORDER):
        row *= model.symbols
        row += buf[k : k + len(row)]
    at = model.row_of[row].astype(np.int64)
    at *= model.symbols
    at += buf[ORDER:]
    # positions whose context crosses from one buffer to the next are left out
    starts = np.concatenate([[0], np.cumsum(sizes + ORDER)[:-1]])
    ends = starts + sizes
    bits = model.cost[at]
    cuts = np.stack([starts, ends], 1).ravel()
    if cuts[-1] >= len(bits):
        cuts = cuts[:-1]
    return np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)[::2]


def score_texts(model: Model, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, share of the best code (0 to 1) and bits per byte of each text."""
    langs = [UNKNOWN] * len(texts)
    share, bits = np.zeros(len(texts)), np.zeros(len(texts))
    todo: list[tuple[int, np.ndarray]] = []
    lengths: dict[int, np.ndarray] = {}
    size: dict[int, int] = {}

    def flush():
        if todo:
            for (i, b), cost in zip(todo, _total(model, [b for _, b in todo]), strict=True):
                lengths[i] = lengths.get(i, 0) + cost
                size[i] = size.get(i, 0) + len(b) - ORDER
            todo.clear()

    held = 0
    for i, text in enumerate(texts):
        if model.langs and has_letter(text):
            for b in _blocks(_bytes(text)):
                todo.append((i, b))
                held += len(b)
                if held > BLOCK:
                    flush()
                    held = 0
    flush()
    for i, cost in lengths.items():
        best = int(cost.argmin())
        langs[i] = model.langs[best]
        share[i] = 1.0 / float(np.exp2(np.maximum(cost[best] - cost, -1000.0)).sum())
        bits[i] = cost[best] / size[i]
    return langs, share, bits


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte``; reads the ``text`` column only.

    A null text, a text without letters and any text under an empty model get
    ``und``, score 0 and 0 bits. Ties go to the language first in order.
    Columns of those names in ``docs`` are replaced, all others pass through;
    repeated rows are judged one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, bits_per_byte double")
    def judge(text: pd.Series) -> pd.DataFrame:
        lang, share, bits = score_texts(shared.value, text.tolist())
        return pd.DataFrame({"lang_pred": lang, "score": share, "bits_per_byte": bits})

    judge = judge.asNondeterministic()  # so that a filter on its result is not evaluated apart, with a second call
    names = ("lang_pred", "score", "bits_per_byte")
    return unboxed(boxed(docs, judge(F.col("text")).alias("judged"), adds=names), *[F.col(f"judged.{n}").alias(n) for n in names])


def is_held_out(doc_id) -> F.Column:
    """Documents kept out of learning: crc32 of the id's text divisible by five. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    taught = docs.where(~is_held_out("doc_id") & F.col("doc_id").isNotNull())
    model = learn(taught)
    return predict(docs.select("doc_id", "text", is_held_out("doc_id").alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )
