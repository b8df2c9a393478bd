"""Texts cut at blanks, for tokenizers whose tokens never go on after a blank.

A text is cut before each single blank that stands between two characters other than
white space. Words repeat within a batch far more often than texts, so a tokenizer is
asked for the distinct chunks of a batch and its answers are gathered by number.
"""

from __future__ import annotations

import re

import numpy as np

BREAK = re.compile(r"(?<=\S) (?=\S)")
TWO = re.compile(r"\s\s")


class Numbers(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class Recent:
    """Memory of two generations: what was not used for a whole generation is forgotten."""

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.entries:
            self.young, self.old = {}, self.young
        self.young[key] = value


def cut(text: str) -> list[str]:
    """The chunks without the blanks between them."""
    if not text:
        return []
    if text[0].isspace() or text[-1].isspace() or TWO.search(text):
        return BREAK.split(text)
    return text.split(" ")


def distinct_chunks(texts: list[str | None]) -> tuple[list[str], list[str], list[np.ndarray]]:
    """Distinct chunks that follow a blank, distinct first chunks, and for every text the
    numbers of its chunks, first chunks numbered after the others. Null counts as empty."""
    rest, heads = Numbers(), Numbers()
    number, found = rest.__getitem__, []
    for text in texts:
        first, *others = cut(text or "") or [None]
        if first is None:
            found.append(np.zeros(0, np.int64))
            continue
        codes = np.empty(len(others) + 1, np.int64)
        codes[0] = -1 - heads[first]
        codes[1:] = list(map(number, others))
        found.append(codes)
    for codes in found:
        if len(codes):
            codes[0] = len(rest) - 1 - codes[0]
    return list(rest), list(heads), found


def gather(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the values of the slices that ``codes`` name, one slice after another."""
    sizes = lengths[codes]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts[codes] - (ends - sizes), sizes)
