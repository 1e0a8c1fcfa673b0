"""Splitting texts into pre-tokens and numbering the distinct ones of a task."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import regex


def splitter(pattern: str, specials: Iterable[str] = ()):
    """A function from a text to its pre-tokens; special strings stay whole."""
    find = regex.compile(pattern).findall
    specials = sorted(specials, key=len, reverse=True)
    if not specials:
        return find
    cut = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")")

    def split(text: str) -> list[str]:
        if not any(x in text for x in specials):
            return find(text)
        out = []
        for k, part in enumerate(cut.split(text)):
            if k % 2:
                out.append(part)
            else:
                out.extend(find(part))
        return out

    return split


class Numbering(dict):
    """Numbers for strings in order of first sight; ``fresh`` holds those not yet encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        self.fresh.append(key)
        return number

    def numbers(self, tokens: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))

    def take_fresh(self) -> list:
        fresh, self.fresh = self.fresh, []
        return fresh


class RaggedTable:
    """Rows of varying length in one growing array."""

    def __init__(self, kind: type) -> None:
        self.values = np.zeros(1024, kind)
        self.starts = np.zeros(1025, np.int64)
        self.rows = 0

    def append(self, values: np.ndarray, lengths: np.ndarray) -> None:
        used, rows = int(self.starts[self.rows]), self.rows + len(lengths)
        while len(self.values) < used + len(values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while len(self.starts) <= rows:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.values[used : used + len(values)] = values
        self.starts[self.rows + 1 : rows + 1] = used + np.cumsum(lengths)
        self.rows = rows

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        return self.starts[rows + 1] - self.starts[rows]

    def gather(self, rows: np.ndarray) -> np.ndarray:
        """The values of the given rows, one row after another."""
        from cropweave.llm.texts import ragged

        return self.values[ragged(self.starts[rows], self.lengths(rows))]
