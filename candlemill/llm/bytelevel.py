"""What the byte-level tokenizers share: their alphabet, agreed characters, a bounded memo."""

from __future__ import annotations

import re

# Characters on whose classes Python's patterns and the library's agree (checked by a test); anything
# with another character is cut by the library itself.
AGREED = re.compile(r"[^\t-\r\x20-\x7e\xa0-ɏ‐-‧‰-⁞]")


LONGEST_KEPT = 64
"""Longer words are worked out each time."""


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Memo(dict):
    """Values of a function in two generations: frequent ones stay, at most twice ``most`` are kept."""

    def __init__(self, most: int, make):
        super().__init__()
        self.most, self.make = most, make
        self.old: dict = {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
