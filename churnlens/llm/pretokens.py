"""Splitting texts into the pieces that BPE merges never cross.

The files name their patterns; ``regex`` applies them exactly. Texts of
common Latin letters and plain white space take an equivalent pattern of
the standard library, which is some times faster.
"""

from __future__ import annotations

import re
import unicodedata

import regex

#: Patterns of the byte-level files (which name none) and of word_bpe_49k.json.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LETTERS = "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "L")
_PLAIN = _LETTERS + "".join(c for c in map(chr, range(0x250))
                            if c in "0123456789 \t\n\r" or unicodedata.category(c)[0] in "PS")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 for itself, the others from U+100 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def _set(chars: str) -> str:
    return "".join(map(re.escape, chars))


class WordLevel:
    """Splits a normalised text as WORD_LEVEL does."""

    def __init__(self) -> None:
        letters = _set(_LETTERS)
        self.exact = regex.compile(WORD_LEVEL).findall
        self.fast = re.compile(f"[{letters}]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^ \\t\\n\\r0-9{letters}]+").findall
        self.odd = re.compile(f"[^{_set(_PLAIN)}]").search

    def __call__(self, text: str) -> list[str]:
        return self.exact(text) if self.odd(text) else self.fast(text)
