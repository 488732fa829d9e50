"""Counts over the words and lines of one text."""

from __future__ import annotations

import numpy as np

SPACES = " \t\n\v\f\r"
"""What parts words: a space and the characters 9 to 13."""
SYMBOLS = "#*$%&|<>"
SENTENCE_ENDS = (".", "?", "!", "…", "。")


def words_of(text: str) -> list[bytes]:
    """Runs of other characters than ``SPACES``, in UTF-8; bytes part at exactly those."""
    return text.encode("utf-8", "surrogatepass").split()


def lines_of(text: str) -> list[str]:
    """The lines that hold a word."""
    return [line for line in text.split("\n") if line.strip(SPACES)]


def duplicate_lines(lines: list[str]) -> int:
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that stand twice or more in the text."""
    windows = len(words) - width + 1
    if windows < 2:
        return 0
    numbers: dict[bytes, int] = {}
    of = [numbers.setdefault(w, len(numbers)) for w in words]
    if len(numbers) == len(words):
        return 0
    ids = np.array(of, np.int64)
    code, base = ids[:windows], len(numbers)
    for k in range(1, width):
        code = code * base + ids[k : k + windows]
        if k < width - 1:
            code = np.unique(code, return_inverse=True)[1] if base ** (k + 2) >= 2**62 else code
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:windows] += again
    edge[width : width + windows] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def count_of(text: str, characters: str) -> int:
    return sum(map(text.count, characters))


def upper_share(text: str) -> float:
    """Share of capitals among letters that have case."""
    upper = sum(map(str.isupper, text))
    lower = sum(map(str.islower, text))
    return upper / max(1, upper + lower)
