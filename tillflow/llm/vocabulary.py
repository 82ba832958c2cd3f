"""A public word-level BPE vocabulary, and how it cuts text into words.

The file (tokenizers JSON with word-end marks) is read on the driver from a
path that is a parameter; what the executors need of it is broadcast. Its size
is that of the file, whatever the corpus.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass

import regex

#: Name of the vocabulary among the installed public tokenizers.
DEFAULT = "word_bpe_49k.json"
END = "</w>"

_LONG_SIGMA = str.maketrans("Σ", "σ")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


@dataclass(frozen=True)
class Vocabulary:
    tokens: tuple[str, ...]  # by id
    merges: tuple[tuple[int, int, int], ...]  # left, right and merged id, by rank
    special: tuple[str, ...]
    word: str  # pattern of a word
    byte_of: dict[str, int]  # character that stands for a byte in a token

    @property
    def id_of(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.tokens)}


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as U+0100 onwards, in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def load(path: str | None = None) -> Vocabulary:
    with open(path or default_path(), encoding="utf-8") as f:
        spec = json.load(f)
    ids = dict(spec["model"]["vocab"])
    ids |= {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max(ids.values()) + 1)
    for t, i in ids.items():
        tokens[i] = t
    merges = tuple((ids[a], ids[b], ids[a + b]) for a, b in spec["model"]["merges"])
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    special = tuple(t["content"] for t in spec["added_tokens"])
    return Vocabulary(tuple(tokens), merges, special, pattern, _byte_letters())


class Splitter:
    """Words of a text: NFC, lower case letter by letter, then the vocabulary's word pattern; special tokens stay whole."""

    def __init__(self, vocabulary: Vocabulary):
        self._find = regex.compile(vocabulary.word).findall
        self._special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self._mark = vocabulary.special[0][:2] if vocabulary.special else ""

    def plain(self, text: str) -> list[str]:
        # lower() writes a capital sigma that ends a word as a final one; letter by letter there is only one
        return self._find(unicodedata.normalize("NFC", text).translate(_LONG_SIGMA).lower() if "Σ" in text else unicodedata.normalize("NFC", text).lower())

    def parts(self, text: str) -> list[tuple[bool, list[str]]]:
        """(special, words) in order; a special part has the token as its only word."""
        if self._special is None or self._mark not in text:
            return [(False, self.plain(text))]
        return [(k % 2 == 1, [x] if k % 2 else self.plain(x)) for k, x in enumerate(self._special.split(text))]
