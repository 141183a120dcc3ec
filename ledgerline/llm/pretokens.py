"""Pre-token splitting and the cache that tokenizing workers keep between batches."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence

import regex

_BLANK = "\t\n\x0b\x0c\r \x85\xa0"
_LATIN = 0x250


def _ranges(test: Callable[[str], bool]) -> str:
    points = [c for c in range(_LATIN) if test(chr(c))]
    return "".join(f"\\u{c:04x}" for c in points)


# The classes below _LATIN, for the quick pattern; texts with other characters take the general one.
_CLASSES = {
    r"\p{L}": _ranges(lambda c: unicodedata.category(c)[0] == "L"),
    r"\p{N}": _ranges(lambda c: unicodedata.category(c)[0] == "N"),
    r"\s": _ranges(_BLANK.__contains__),
}
_beyond_latin = re.compile(f"[^\\u0000-\\u{_LATIN - 1:04x}]").search
# A space before a visible character and after one always starts a pre-token.
_cut = re.compile(r"\S (?=\S)")


class Splitter:
    """``findall`` of a pattern made of \\p{L}, \\p{N} and \\s classes, with a faster form for Latin texts."""

    def __init__(self, quick: str, general: str):
        for name, members in _CLASSES.items():
            quick = quick.replace(name, members)
        self.quick, self.general = re.compile(quick).findall, regex.compile(general).findall

    def __call__(self, text: str) -> list[str]:
        return self.general(text) if _beyond_latin(text) else self.quick(text)


# The split patterns of the two public tokenizers.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

split_bytes = Splitter(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|[\s]+(?![^\s])|[\s]+",
    BYTE_PATTERN.replace(r"\s", r"[\p{White_Space}]").replace(r"\S", r"[^\p{White_Space}]").replace(r"[^[\p{White_Space}]", r"[^\p{White_Space}"),
)
split_words = Splitter(WORD_PATTERN, WORD_PATTERN.replace(r"\s", r"\p{White_Space}"))


def pieces(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A very long text in parts that split into the same pre-tokens as the whole."""
    start = 0
    while len(text) - start > size:
        found = _cut.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start() + 1]
        start = found.start() + 1
    yield text[start:] if start else text


class WordCache:
    """Values of pre-tokens, kept for as long as the worker lives.

    Two generations bound the memory: when the young one is full it becomes the
    old one, from which words still in use move on. ``fixed`` never leaves.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable], limit: int = 500_000, fixed: dict | None = None):
        self.encode, self.limit, self.fixed = encode, limit, fixed or {}
        self.young: dict = dict(self.fixed)
        self.old: dict = {}

    def ready(self, splits: Sequence[list[str]]) -> Callable:
        """The lookup function, once it knows every pre-token of ``splits``."""
        need = set().union(*splits).difference(self.young)
        if len(self.young) + len(need) > self.limit + len(self.fixed):
            self.old, self.young = self.young, dict(self.fixed)
            need = set().union(*splits).difference(self.young)
        old = self.old
        miss = []
        for word in need:
            value = old.get(word)
            if value is None:
                miss.append(word)
            else:
                self.young[word] = value
        if miss:
            self.young.update(zip(miss, self.encode(miss)))
        return self.young.__getitem__
