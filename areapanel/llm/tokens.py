"""Token ids of whole texts under a public tokenizer file."""

from __future__ import annotations

import json
import os
import re
import string
import unicodedata
from array import array
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker per core already

import tiktoken  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

#: The published pre-tokenizer pattern of byte-level BPE.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with these are always left to the tokenizers library: marks of special tokens, characters that
#: Python alone counts as white space, and a letter whose lower case depends on its place.
WHOLE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f", "Σ")
#: So many blanks in a row are left to the tokenizers library: tiktoken's regex keeps a state for each and
#: its stack ends at a million.
BLANKS = 100_000
LONG_BLANKS = re.compile(rf"(?<!\s)\s{{{BLANKS},}}")
MEMO_ENTRIES = 600_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the files."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def left_whole(text: str) -> bool:
    return any(x in text for x in WHOLE)


def long_blanks(text: str) -> bool:
    return len(text) >= BLANKS and LONG_BLANKS.search(text) is not None


class Memo(dict):
    """What a function has returned, by its argument."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        value = self[key] = self.function(key)
        return value


class ByteEncoder:
    """Byte-level BPE.

    The library tiktoken applies the file's own merges several times faster
    than the tokenizers library, with the same ids (the tests compare them).
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        back = {c: b for b, c in enumerate(byte_alphabet())}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(map(back.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        return [packed(self.tokenizer.encode(x, add_special_tokens=False).ids if left_whole(x) or long_blanks(x) else self.fast.encode_ordinary(x)) for x in (x or "" for x in texts)]


class WordEncoder:
    """BPE over lower-cased words whose tokenizer drops white space.

    White space separates words whatever stands around it, so each different
    word is encoded once by the tokenizers library and kept in a memo, which is
    emptied when it is full.  Words of letters, with or without punctuation
    after them, go straight to the library's BPE model.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.shown = {b: c for b, c in enumerate(byte_alphabet())}
        self.memo = Memo(self._word)

    def _piece(self, text: str) -> list[int]:
        shown = text if text.isascii() else text.encode().decode("latin-1").translate(self.shown)
        return [x.id for x in self.model.tokenize(shown)]

    def _word(self, word: str) -> bytes:
        base = word.rstrip(string.punctuation)
        low = base.lower()
        if base.isalpha() and (base.isascii() or (low.isalpha() and unicodedata.is_normalized("NFC", base))):
            tail = word[len(base) :]
            return packed(self._piece(low) + (self._piece(tail) if tail else []))
        return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        ids_of = self.memo.__getitem__
        return [packed(self.tokenizer.encode(x, add_special_tokens=False).ids) if left_whole(x) else b"".join(map(ids_of, x.split())) for x in (x or "" for x in texts)]


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> ByteEncoder:
    """One encoder for each worker process and file."""
    return ByteEncoder(path)


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def slices(texts: list, most: int = 1 << 20):
    """Index ranges of about ``most`` characters, so that a batch of long texts is not taken at once."""
    start = size = 0
    for k, x in enumerate(texts):
        size += len(x or "")
        if size >= most:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)
