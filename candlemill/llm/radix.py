"""An adaptive radix tree over byte strings: node layouts that grow, compressed paths, ordered walk."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Few:
    """Up to ``most`` children (4, then 16): sorted bytes beside the children."""

    __slots__ = ("most", "keys", "kids")

    def __init__(self, most: int = 4):
        self.most, self.keys, self.kids = most, bytearray(), []

    def find(self, byte: int):
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def add(self, byte: int, kid):
        """The layout that holds the child too: this one, or the next larger."""
        if len(self.kids) == self.most:
            return (Few(16) if self.most == 4 else Indexed()).take(self).add(byte, kid)
        at = bisect_left(self.keys, byte)
        self.keys.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def take(self, other):
        for byte, kid in other.pairs():
            self.add(byte, kid)
        return self

    def pairs(self) -> Iterator[tuple]:
        return zip(self.keys, self.kids, strict=True)


class Indexed:
    """Up to 48 children behind an index of 256 bytes; 255 marks a free one."""

    __slots__ = ("index", "kids")

    def __init__(self):
        self.index, self.kids = bytearray(b"\xff" * 256), []

    def find(self, byte: int):
        at = self.index[byte]
        return self.kids[at] if at != 255 else None

    def add(self, byte: int, kid):
        if len(self.kids) == 48:
            return Full().take(self).add(byte, kid)
        self.index[byte] = len(self.kids)
        self.kids.append(kid)
        return self

    take = Few.take

    def pairs(self) -> Iterator[tuple]:
        return ((byte, self.kids[at]) for byte, at in enumerate(self.index) if at != 255)


class Full:
    """One place for each of the 256 bytes."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids = [None] * 256

    def find(self, byte: int):
        return self.kids[byte]

    def add(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    take = Few.take

    def pairs(self) -> Iterator[tuple]:
        return ((byte, kid) for byte, kid in enumerate(self.kids) if kid is not None)


class Node:
    """``path`` are the bytes after the one that leads here; ``row`` is set where a key ends."""

    __slots__ = ("path", "row", "links")

    def __init__(self, path: bytes, row=None, links=None):
        self.path, self.row, self.links = path, row, links

    def kids(self) -> list:
        return [kid for _, kid in self.links.pairs()] if self.links else []

    def cut(self, at: int) -> None:
        """Split the compressed path: what follows byte ``at`` moves into a child."""
        below = Node(self.path[at + 1 :], self.row, self.links)
        self.links = Few().add(self.path[at], below)
        self.path, self.row = self.path[:at], None


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Bytes that a, and b from a start on, have in common at their front."""
    low, high = 0, min(len(a), len(b) - start)
    if a[:high] == b[start : start + high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[start + low : start + middle]:
            low = middle
        else:
            high = middle
    return low


class Tree:
    """Keys of any length; a key may be the front of another. The root's path stays empty."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, row) -> None:
        node, at = self.root, 0
        while True:
            same = common(node.path, key, at)
            if same < len(node.path):
                node.cut(same)
            at += same
            if at == len(key):
                node.row = row
                return
            kid = node.links.find(key[at]) if node.links else None
            if kid is None:
                node.links = (node.links or Few()).add(key[at], Node(key[at + 1 :], row))
                return
            node, at = kid, at + 1
