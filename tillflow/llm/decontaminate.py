"""Benchmark decontamination: edit-distance search with CGK embeddings and bit-sampling LSH.

A CGK walk reads a string with one pointer: at step j it writes the byte under
the pointer and moves on if a random bit of (j, byte) says so. Two strings that
differ by few edits are written alike at most steps, since the pointers fall
into line again after an edit, so edit distance becomes Hamming distance. A
repetition samples a few steps of a walk of its own; windows of a document that
agree with a window of an item on all sampled steps are candidates, and each
candidate is decided by the exact edit distance between the whole item and the
text around it.

Windows start at anchors: of each ``RUN`` neighbouring words, the one whose
first bytes hash least. They depend on the words alone, so an item and a text
that share a run of that many words share an anchor. Windows are sized by the
item: from a quarter of its length to all of it, in powers of two; an item of
over four times the largest size has windows of that size at all its anchors.

Items of at most ``SHORT`` letters, and those without an anchor, such as texts
without blanks, have no windows: they are cut into one part more than edits are
allowed, so that one part at least is left whole, and the parts are looked up at
every position. That misses none.

The items are the stated query set. They are taken in blocks of bounded size,
each broadcast and held against all documents; the documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import boxed, table, unboxed

#: Edits allowed, as a share of the item's length.
EDITS = 0.1
#: Walks; each samples its own steps. Eight find all unedited items and more than 95 % at 5 % random edits.
REPETITIONS = 8
#: Words that an anchor is the least of.
RUN = 6
#: Window lengths in bytes.
SIZES = (32, 64, 128, 256)
#: Sampled steps: those that all sizes share, by their 32 steps, and so many more for each size. They
#: are denser at the start, where a start whose steps no item shares is dropped.
SHARED, MORE = (4, 2), 3
#: Items of a block, letters after which it takes no further item, bytes of text searched at once, and starts that walk together.
ITEMS, LETTERS, BYTES, TOGETHER = 2000, 1 << 20, 1 << 21, 1 << 14
#: Items of so many letters at most are searched for by their parts; one bit of a word stands for each of their first letters.
SHORT, HEAD = 128, 64
#: Positions looked up at once.
POSITIONS = 1 << 14
#: Letters of the grams that are counted before an edit distance is worked out.
GRAM = 4

_SEED = 8
_P = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xBF58476D1CE4E5B9)


def normal(text: str | None) -> str:
    """Lower case, words with one blank between."""
    return " ".join(text.lower().split()) if text else ""


def _grams(text: str) -> set[str]:
    return {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}


def edits(item: str, text: str) -> int:
    """Least edit distance between ``item`` and any part of ``text`` (bit-parallel dynamic programming)."""
    if item in text:
        return 0
    n = len(item)
    if not n:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best = n
    for c in text:
        eq = where.get(c, 0)
        x = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(x | plus))
        down = plus & x
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            best = min(best, score)
        up = up << 1 & full
        down = down << 1 & full
        plus = down | (full & ~((eq | minus) | up))
        minus = up & (eq | minus)
    return best


def anchors(buf: np.ndarray) -> np.ndarray:
    """Starts of the words that hash least among some ``RUN`` neighbours; ``buf`` starts and ends with blanks."""
    start = np.flatnonzero((buf[1:-8] != 32) & (buf[:-9] == 32)) + 1
    if len(start) < RUN:
        return np.zeros(0, np.int64)
    eight = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    h = eight[start].astype(np.uint64) * _P
    h = (h ^ (h >> np.uint64(29))) * _M
    h ^= h >> np.uint64(32)

    def slide(x: np.ndarray, pick) -> np.ndarray:
        out, width = x, 1
        while 2 * width <= RUN:
            out = pick(out[:-width], out[width:])
            width *= 2
        rest = RUN - width
        return pick(out[: len(x) - RUN + 1], out[rest : rest + len(x) - RUN + 1])

    least = slide(h, np.minimum)
    pad = np.zeros(RUN - 1, np.uint64)
    return start[slide(np.concatenate([pad, least, pad]), np.maximum) == h]


#: Two letters of one word; in scripts that set no blanks any letter may begin a word.
_JOINED = regex.compile(r"(?V1)[\w--[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]]{2}")


def bounded(text: str, a: int, b: int) -> bool:
    """Whether ``text[a:b]`` neither begins nor ends inside a word."""
    return not any(0 < p < len(text) and _JOINED.match(text, p - 1, p + 1) for p in (a, b))


class Short:
    """The items ``own`` of a block, found by parts that edits leave whole."""

    END = 0x110000

    def __init__(self, texts: list[str], allowed: list[int], own: list[int]):
        self.texts, self.allowed, self.own = [texts[k] for k in own], [allowed[k] for k in own], own
        self.grams = [_grams(t) for t in self.texts]
        self.n = np.array([len(t) for t in self.texts], np.int64)
        self.slack = np.array(self.allowed, np.int64)
        self.longest = int(self.n.max(initial=0))
        parts: dict[int, list[tuple[int, int, int]]] = {}
        for i, t in enumerate(self.texts):
            of = self.allowed[i] + 1
            cuts = [len(t) * j // of for j in range(of + 1)]
            codes = self._codes(t)
            for a, b in zip(cuts, cuts[1:]):
                parts.setdefault(b - a, []).append((int(self._hashes(codes[a:b], [b - a])[b - a][0]), i, a))
        #: by length: which leading bits occur, and hash, item and offset of the parts by hash
        self.parts = {}
        for size, rows in parts.items():
            rows.sort()
            h = np.array([r[0] for r in rows], np.uint64)
            seen = np.zeros(1 << 18, bool)
            seen[h >> np.uint64(46)] = True
            self.parts[size] = (seen, h, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        #: where each class of letters stands in an item
        self.where = np.zeros((len(own), 256), np.uint64)
        for i, t in enumerate(self.texts):
            if len(t) <= SHORT:
                for j, c in enumerate(self._codes(t[:HEAD]).tolist()):
                    self.where[i, c % 255] |= np.uint64(1 << j)

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")

    @staticmethod
    def _hashes(codes: np.ndarray, sizes) -> dict[int, np.ndarray]:
        """For each size the hashes of all parts of that size."""
        codes = codes.astype(np.uint64) + np.uint64(1)
        out, h, factor = {}, np.zeros(len(codes) + 1, np.uint64), 1
        for size in range(1, max(sizes) + 1):
            factor = factor * int(_P) % (1 << 64)
            if size > len(codes):
                break
            h = h[:-1] + codes[size - 1 :] * np.uint64(factor)
            if size in sizes:
                out[size] = h
        return out

    def _near(self, codes: np.ndarray, begin: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Which candidates may be within reach: :func:`edits` of their first letters for all at once, by classes of letters."""
        slack, n = self.slack[item], np.minimum(self.n[item], HEAD)
        one = np.uint64(1)
        top = one << (n - 1).astype(np.uint64)
        plus, minus = np.full(len(item), ~np.uint64(0)), np.zeros(len(item), np.uint64)
        score = n.copy()
        best = n.copy()
        for j in range(int((n + 2 * slack).max(initial=0))):
            c = codes.take(begin - slack + j, mode="clip")
            eq = self.where[item, np.where(c == self.END, 255, c % 255)]
            x = (((eq & plus) + plus) ^ plus) | eq | minus
            up, down = minus | ~(x | plus), plus & x
            score += ((up & top) != 0).astype(np.int64) - ((down & top) != 0)
            best = np.minimum(best, score)
            up, down = up << one, down << one
            plus, minus = down | ~(eq | minus | up), up & (eq | minus)
        return best <= slack

    def _candidates(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(begin, item) of the places where some part occurs and the rest may be within reach."""
        longest = max(self.parts)
        begins, items, held = [], [], 0
        for at in range(0, len(codes), POSITIONS):
            for size, h in self._hashes(codes[at : at + POSITIONS + longest - 1], self.parts).items():
                seen, known, item, offset = self.parts[size]
                hit = np.flatnonzero(seen.take((h >> np.uint64(46)).view(np.int64)))
                lo, hi = np.searchsorted(known, h[hit]), np.searchsorted(known, h[hit], "right")
                times = hi - lo
                row = np.repeat(lo - np.cumsum(times) + times, times) + np.arange(times.sum())
                begins.append(np.repeat(hit, times) + at - offset[row])
                items.append(item[row])
                held += len(row)
            if held < POSITIONS and at + POSITIONS < len(codes) or not begins:
                continue
            begin, item = np.concatenate(begins), np.concatenate(items)
            begins, items, held = [], [], 0
            # items that are not looked at by their first letters are tried once for begins that lie within one reach
            step = np.where(self.n[item] <= SHORT, 1, self.slack[item] + 1)
            begin = begin // step * step
            order = np.lexsort((begin, item))
            begin, item = begin[order], item[order]
            new = np.ones(len(item), bool)
            new[1:] = (begin[1:] != begin[:-1]) | (item[1:] != item[:-1])
            begin, item = begin[new], item[new]
            for a in range(0, len(item), POSITIONS):
                i, b = item[a : a + POSITIONS], begin[a : a + POSITIONS]
                on = self.n[i] > SHORT
                on[~on] = self._near(codes, b[~on], i[~on])
                yield from zip(b[on].tolist(), i[on].tolist())

    def search(self, held: list[tuple[int, str, int, str]], found: list[dict[int, int]], ids: list[int]) -> None:
        """Adds what occurs in ``held``: number of the text, the text, and a piece of it with its offset."""
        if not held or not self.parts:
            return
        codes = [np.array([self.END], "<u4")]
        for _, _, _, piece in held:
            codes += [self._codes(piece), codes[0]]
        starts = np.cumsum([1, *(len(piece) + 1 for _, _, _, piece in held)])
        for begin, k in self._candidates(np.concatenate(codes)):
            item, slack, n = self.texts[k], self.allowed[k], len(self.texts[k])
            late = 2 * slack if n > SHORT else slack  # an occurrence begins so far behind at most, and ends later
            at = min(max(int(np.searchsorted(starts, begin + late, "right")) - 1, 0), len(held) - 1)
            i, text, offset, _ = held[at]
            key, own = ids[self.own[k]], found[i]
            a = begin - int(starts[at]) + offset
            if own.get(key) == 0:
                continue
            if not slack:
                if a >= 0 and text[a : a + n] == item and bounded(text, a, a + n):
                    own[key] = 0
                continue
            near = text[max(a - slack, 0) : max(a + n + late + slack, 0)]
            if n > SHORT and len(self.grams[k] & _grams(near)) < len(self.grams[k]) - GRAM * slack:
                continue
            distance = edits(item, near)
            if distance <= slack and distance < own.get(key, slack + 1):
                own[key] = distance


class Index:
    """Keys of the windows of a block of items, for every repetition."""

    def __init__(self, items: Sequence[tuple[int, str | None]]):
        rng = np.random.default_rng(_SEED)
        steps = 2 * SIZES[-1]
        #: a random word for each repetition, 64 steps and byte; its bits move the pointer, its value names the byte
        self.words = rng.integers(0, 1 << 64, (REPETITIONS, steps // 64, 256), np.uint64)
        self.shared = [{32 * i + j for i, n in enumerate(SHARED) for j in rng.choice(32, n, False).tolist()} for _ in range(REPETITIONS)]
        self.more = [
            {s: set(rng.choice(sorted({*range(64 if s > 32 else 32, 2 * s)} - shared), MORE, False).tolist()) for s in SIZES}
            for shared in self.shared
        ]
        self.ids = [i for i, _ in items]
        self.texts = [normal(t) for _, t in items]
        self.sizes = [len(t.encode("utf-8", "replace")) for t in self.texts]
        self.grams = [_grams(t) for t in self.texts]
        self.allowed = [int(len(t) * EDITS) for t in self.texts]
        self.windows: list[tuple[int, int]] = []  # item, byte offset of the anchor
        plain: list[int] = []  # items that are too short for a window are searched for by their parts
        sizes: list[list[int]] = []
        bufs = []
        for k, t in enumerate(self.texts):
            data = t.encode("utf-8", "replace")
            buf = np.frombuffer(b" " + data + b" " * 9, np.uint8)
            least = min(len(data) / 4, SIZES[-1])
            own = [(a - 1, [s for s in SIZES if least <= s <= len(data) - (a - 1)]) for a in anchors(buf).tolist()]
            own = [(a, s) for a, s in own if s]
            if len(t) <= SHORT or not own:
                if data:
                    plain.append(k)
                continue
            for a, s in own:
                self.windows.append((k, a))
                sizes.append(s)
                bufs.append(data[a : a + 2 * SIZES[-1]].ljust(2 * SIZES[-1] + 8, b"\0"))  # a walk is no longer
        self.longest = max(self.sizes, default=0)
        self.short = Short(self.texts, self.allowed, plain)
        self.filters, self.keys = [], []
        if not bufs:
            return
        buf = np.frombuffer(b"".join(bufs), np.uint8)
        pos = np.cumsum([0, *map(len, bufs)])[:-1].astype(np.int64)
        for r in range(REPETITIONS):
            self.filters.append([])
            found = self._walk(r, buf, pos, learn=True)
            keys = {}
            for s, (_, key) in found.items():
                own = np.array([w for w in range(len(pos)) if s in sizes[w]], np.int64)
                order = np.argsort(key[own], kind="stable")
                keys[s] = (key[own][order], own[order])
            self.keys.append(keys)

    def _walk(self, r: int, buf: np.ndarray, pos: np.ndarray, learn: bool = False) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each size the starts that are left of ``pos`` and their keys.

        After each 32 steps with shared samples a start goes on only if some item
        may have its key so far; with ``learn`` all go on, as they are the items'.
        """
        shared, more = self.shared[r], self.more[r]
        left = np.arange(len(pos))
        key = np.zeros(len(pos), np.uint64)
        keys: dict[int, np.ndarray] = {}
        named = self.words[r, 0].take(buf)
        for j in range(2 * SIZES[-1]):
            w = named.take(pos) if j < 32 else self.words[r, j // 64].take(buf.take(pos, mode="clip"))
            if j in shared:
                key = (key + w) * _P
                key ^= key >> np.uint64(31)
            for s in SIZES:
                if j in more[s]:
                    keys[s] = (keys.get(s, key) + w) * _M
                    keys[s] ^= keys[s] >> np.uint64(31)
            w >>= np.uint64(j % 64)
            w &= np.uint64(1)
            pos = pos + w.view(np.int64)
            if j % 32 == 31 and j // 32 < len(SHARED):
                if learn:
                    seen = np.zeros(1 << 16, bool)
                    seen[key >> np.uint64(48)] = True
                    self.filters[r].append(seen)
                    continue
                on = np.flatnonzero(self.filters[r][j // 32][key >> np.uint64(48)])
                left, key, pos = left[on], key[on], pos[on]
                keys = {s: k[on] for s, k in keys.items()}
                if not len(left):
                    return {}
        return {s: (left, k * _P ^ key) for s, k in keys.items()}

    def candidates(self, buf: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start of an anchor in ``buf``, window of an item) that agree on all sampled steps of a repetition."""
        start = anchors(buf)
        for at in range(0, len(start), TOGETHER):
            pos = start[at : at + TOGETHER]
            here = buf[pos[0] : pos[-1] + 2 * SIZES[-1] + 8]
            for r in range(len(self.keys)):
                for s, (left, key) in self._walk(r, here, pos - pos[0]).items():
                    known, window = self.keys[r][s]
                    if not len(known) or not len(left):
                        continue
                    lo, hi = np.searchsorted(known, key), np.searchsorted(known, key, "right")
                    for i in np.flatnonzero(hi > lo).tolist():
                        for w in window[lo[i] : hi[i]].tolist():
                            yield int(pos[left[i]]), w

    def search(self, texts: Sequence[str | None]) -> list[dict[int, int]]:
        """For each text, the items found and their edit distances."""
        found: list[dict[int, int]] = [{} for _ in texts]
        held: list[tuple[int, bytes]] = []
        size = 0
        margin = 2 * self.longest + 2 * SIZES[-1]
        whole: list[tuple[int, str, int, str]] = []
        letters, beside = 0, 2 * self.short.longest
        for i, t in enumerate(texts):
            t = normal(t)
            for at in range(0, max(len(t) - beside, 1), BYTES) if self.short.own else ():
                whole.append((i, t, at, t[at : at + BYTES + beside]))
                letters += len(whole[-1][3])
                if letters >= BYTES:
                    self.short.search(whole, found, self.ids)
                    whole, letters = [], 0
            data = t.encode("utf-8", "replace")
            for at in range(0, max(len(data) - margin, 1), BYTES):
                piece = data[at : at + BYTES + margin]
                held.append((i, piece))
                size += len(piece)
                if size >= BYTES:
                    self._search(held, found)
                    held, size = [], 0
        self._search(held, found)
        self.short.search(whole, found, self.ids)
        return found

    def _search(self, held: list[tuple[int, bytes]], found: list[dict[int, int]]) -> None:
        if not held or not self.keys:
            return
        data = b" " + b" \0 ".join(p for _, p in held) + b" " * (2 * SIZES[-1] + 16)
        starts = np.cumsum([1, *(len(p) + 3 for _, p in held)])
        tried: set[tuple[int, int, int]] = set()
        for pos, w in self.candidates(np.frombuffer(data, np.uint8)):
            k, offset = self.windows[w]
            at = int(np.searchsorted(starts, pos, "right")) - 1
            own = found[held[at][0]]
            slack = self.allowed[k]
            # an edit is at most four bytes long; begins that lie so close together are tried as one
            reach = 4 * slack
            begin = (pos - offset) // (reach + 1) * (reach + 1)
            if own.get(self.ids[k]) == 0 or (at, k, begin) in tried:
                continue
            tried.add((at, k, begin))
            a, b = max(begin - reach, int(starts[at])), min(begin + reach + self.sizes[k] + reach, int(starts[at + 1]) - 3)
            text = data[a:b].decode("utf-8", "ignore")
            # an edit changes at most GRAM grams, so a text within reach has the others
            if len(self.grams[k] & _grams(text)) < len(self.grams[k]) - GRAM * slack:
                continue
            distance = edits(self.texts[k], text)
            if distance <= slack and distance < own.get(self.ids[k], slack + 1):
                own[self.ids[k]] = distance


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    block: list[tuple[int, str | None]] = []
    letters = 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        letters += len(row["text"] or "")
        if len(block) == ITEMS or letters >= LETTERS:
            yield block
            block, letters = [], 0
    if block:
        yield block


def _search_for(index):
    @F.pandas_udf("array<struct<item_id:bigint,edits:bigint>>")
    def search(text: pd.Series) -> pd.Series:
        found = index.value.search(text.tolist())
        return pd.Series([[{"item_id": i, "edits": d} for i, d in one.items()] for one in found])

    return search


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``leaks``: an array of (item_id, edits), by item_id, of the items that a text contains.

    ``benchmark`` has item_id and text. An item is contained when some part of
    the text is within ``EDITS`` of its length in edit distance, after lower-casing
    and with white space as one blank. Items of under ten letters, which allow no
    edit, count where they begin and end no word in the middle; in scripts without
    blanks any letter may begin a word. Items without text never occur, and
    neither does anything in a null or empty text. Items with one id count as
    one; a null id is listed as null. Other columns of ``docs`` pass through, a
    column named leaks is replaced, repeated rows are searched one by one.
    """
    out = boxed(docs, F.col("text"), F.array().cast("array<struct<item_id:bigint,edits:bigint>>").alias("found"), adds=("leaks",))
    for block in _blocks(benchmark):
        search = _search_for(docs.sparkSession.sparkContext.broadcast(Index(block)))
        out = out.withColumn("found", F.concat("found", search(F.col("text"))))
    return unboxed(out, F.array_sort("found").alias("leaks"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, unchanged."""
    return find_leaks(docs, benchmark).where(F.size("leaks") == 0).drop("leaks")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item found in it: doc_id, item_id, edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id", F.inline("leaks"))
