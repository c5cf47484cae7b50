"""Encoding whole texts with a public tokenizer file, with a cache of word encodings.

Both tokenizer files split a text into pre-tokens before merging, and a run of
Latin letters is always a pre-token of its own (with a space before it).  A
text of ASCII, Latin letters and plain punctuation is cut at such borders;
each distinct word is encoded once per worker by the ``tokenizers`` library
and the encodings are joined.  A text with any other character, or with an
apostrophe outside a word, goes to the library whole.  ``tests/llm`` holds the
joined ids against the library's ids of whole texts.
"""

from __future__ import annotations

import ctypes
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

# What a worker's two caches hold before they start anew (about 200 bytes each): words
# that the library has encoded, and pieces put together from them.  A dict of up to
# 699,050 keys (two thirds of 2^20) takes half the table of a larger one.
CACHE_WORDS, CACHE_PIECES = 690_000, 690_000

_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_SPACE = r" \t\n\r"
_PLAIN = r"!-&(-@\[-`{-~‐-―‘-„…"  # punctuation and digits, without the apostrophe
_WORD = rf"[{_LETTER}]+(?:'[{_LETTER}]+)*"
_pieces = re.compile(rf"[{_SPACE}]?{_WORD}[{_PLAIN}]*|(?:[{_PLAIN}]|[{_SPACE}](?![{_LETTER}]))+").findall
_PLAIN_CHARACTERS = "".join(chr(c) for c in range(0x2030) if re.match(f"[{_PLAIN}]", chr(c)))


class _Cache(dict):
    """Key -> ids as bytes, made by ``make`` where the key is missing."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self.make(key)
        return value


class PieceEncoder:
    """Token ids of texts as unsigned 32-bit bytes in the machine's (little-endian) order."""

    def __init__(self, file: str, cache_words: int = CACHE_WORDS, cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.limits = cache_words, cache_pieces
        self.words, self.pieces = _Cache(self._word), _Cache(self._piece)
        # A word of letters is one pre-token, so it can go to the merges directly, in the
        # byte-level alphabet; the normalizer of the lower-casing file is NFC and lower case.
        kinds = type(self.tokenizer.pre_tokenizer).__name__, type(self.tokenizer.normalizer).__name__
        self.direct = {("ByteLevel", "NoneType"): str, ("Sequence", "Sequence"): _lower_word}.get(kinds)
        self.merges, self.alphabet = self.tokenizer.model, _byte_alphabet()

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        if self.direct is None or not word[-1].isalpha() or "'" in word:
            return self.library(word)
        letters = self.direct(word).encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.merges.tokenize(letters)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        word = piece.rstrip(_PLAIN_CHARACTERS)
        if not word[-1:].isalpha():  # no letters in it
            return self.words[piece]
        rest, head = piece[len(word) :], word[0] if word[0] in "\t\n\r" else ""
        ids = self.words[word[len(head) :]]
        return (self.words[head] if head else b"") + ids + (self.words[rest] if rest else b"")

    def encode(self, text: str) -> bytes:
        pieces = _pieces(text)
        if sum(map(len, pieces)) != len(text):
            return self.library(text)
        if len(self.words) > self.limits[0]:
            self.words.clear()
        if len(self.pieces) > self.limits[1]:
            self.pieces.clear()
        return b"".join(map(self.pieces.__getitem__, pieces))


def _lower_word(word: str) -> str:
    return unicodedata.normalize("NFC", word).lower().lstrip(" ")


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes are themselves, the others the code points from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)}


def release_memory() -> None:
    """Give freed memory back to the system, where the C library can (a worker outlives its stages)."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(file: str) -> PieceEncoder:
    """The worker's encoder of a tokenizer file; its cache outlives the task."""
    if file not in _ENCODERS:
        release_memory()  # what earlier stages have freed in this worker
        _ENCODERS[file] = PieceEncoder(file)
    return _ENCODERS[file]


def rows_of(batches: Iterable, *columns: str) -> Iterator[tuple]:
    """The named columns of Arrow batches as Python tuples, a few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)
