"""Splitting texts into pre-tokens inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import regex

_ASCII_SPACE = [chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x20))]
_OTHER_SPACE = [c for c in map(chr, range(0x80, 0x3001)) if c.isspace()]


class Splitter:
    """Pre-tokens of a text, by a pattern that never looks back.

    A space between two characters that are no white space always begins a
    pre-token. A text whose spaces are all of this kind is *plain*: it may be
    cut at its spaces, and each word split by itself, once for all its
    occurrences. Other texts are split as a whole.
    """

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall

    def plain(self, text: str) -> bool:
        if text[:1] == " " or text[-1:] == " " or "  " in text:
            return False
        spaces = _ASCII_SPACE if text.isascii() else _ASCII_SPACE + _OTHER_SPACE
        return not any(c in text and (c + " " in text or " " + c in text) for c in spaces)

    def words(self, text: str) -> tuple[str, list[str]] | None:
        """The first word, and the later ones without the space before each; None unless plain."""
        if not self.plain(text):
            return None
        first, *rest = text.split(" ")
        return first, rest

    def spaced(self, words: list[str]) -> tuple[list[str], list[int]]:
        """The pre-tokens of words of plain texts, each with a space before it, and where each word's begin.

        All are split at once, as one plain text: a pre-token that begins with
        a space begins a word.
        """
        found = self.find(" " + " ".join(words)) if words else []
        return found, [i for i, p in enumerate(found) if p[0] == " "]

    def after_space(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Each word of plain texts with its pre-tokens when a space stands before it."""
        words = list(words)
        found, starts = self.spaced(words)
        for w, start, end in zip(words, starts, [*starts[1:], len(found)]):
            yield w, found[start:end]


@lru_cache(maxsize=4)
def splitter(pattern: str) -> Splitter:
    """One splitter for each worker process and pattern."""
    return Splitter(pattern)


def slices(texts: list[str], chars: int) -> Iterator[slice]:
    """Consecutive slices of about ``chars`` characters, one text at least."""
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > chars:
            yield slice(start, i)
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield slice(start, len(texts))
