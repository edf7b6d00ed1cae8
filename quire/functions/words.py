"""Joining text across line breaks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from .vocabulary import SOLID_PREFIXES

#: Tells whether a lower-case word is in the dictionary.
Dictionary = Callable[[str], bool]


def no_words(word: str) -> bool:
    """The empty dictionary: only prefixes and letter case decide."""
    return False


def dictionary(words: Iterable[str]) -> Dictionary:
    """A dictionary of the given words, such as a corpus's frequent ones."""
    known = frozenset(w.lower() for w in words)
    return known.__contains__


def keeps_hyphen(left: str, right: str, known: Dictionary = no_words) -> bool:
    """Whether the hyphen between two halves belongs to the word."""
    if not left or not right:
        return True
    solid = known((left + right).lower()) or (left.lower() in SOLID_PREFIXES and right[0].islower())
    if solid:
        return False
    compound = known(left.lower()) and known(right.lower())
    return compound or not (left[-1].islower() and right[0].islower())


def join_lines(left: str, right: str, known: Dictionary = no_words) -> str:
    """Two fragments as one: a space between them, or the halves of a word that
    a line break cut, with or without its hyphen."""
    right = right.lstrip()
    cut = re.search(r"-\s*$", left)
    if not cut:
        return f"{left.rstrip()} {right}"
    stem = left[: cut.start()]
    halves = (re.search(r"[A-Za-z]*$", stem)[0], re.match(r"[A-Za-z]*", right)[0])
    return stem + ("-" if keeps_hyphen(*halves, known) else "") + right
