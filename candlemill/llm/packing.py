"""Best-fit packing of documents into sequences, mended by a swap-based local search.

Documents become pieces of at most ``limit`` tokens. Pieces are dealt evenly over blocks of bounded
size; every block is packed best-fit decreasing and then searched: between its underfull sequences,
one piece is exchanged for one, one for two, or a piece is moved, wherever this raises the sum of
squared fills, until no exchange does. Mass so runs from emptier into fuller sequences and the
emptiest run dry. Sequences that stay underfull are dealt into new blocks and searched again
together, so no block keeps leftovers for itself.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.bytelevel import AGREED, Memo, byte_alphabet
from candlemill.llm.shared import fields, give_back, map_rows, staged, text_rows

BLOCK = 16_384
"""Pieces packed together in one task."""
ROUNDS = 2
"""How often underfull sequences meet those of other blocks."""
MEMO = 400_000
"""Words remembered in a worker, and as many pre-tokens, older ones included; about 110 MB together."""
# Fixed value: the pre-token pattern of the word tokenizer.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# Control characters that Python takes for white space and the library doesn't.
ODD = re.compile("[\x1c-\x1f]")

PIECES = fields(
    "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
)
PLACED = fields(
    "doc_id long, piece int, start long, length long, ids_crc32 long, salt long, "
    "sequence_id long, offset long, fill long"
)


class WordIds:
    """Ids of white-space separated text; each distinct word of a call is looked up once.

    Two memos: of the pre-tokens that words are cut into, and of the words that are not one pre-token
    themselves. Words with special strings or with characters outside the agreed classes
    go to the library whole, and so do texts with odd control characters.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.alphabet = byte_alphabet()
        self.words = Memo(MEMO // 2, self._cut)
        self.parts = Memo(MEMO // 2, self._part)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        odd = {i: self._odd(t) for i, t in enumerate(texts) if "<|" in t or AGREED.search(t)}
        plain = iter(self._plain([t for i, t in enumerate(texts) if i not in odd]))
        return [odd[i] if i in odd else next(plain) for i in range(len(texts))]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Texts of agreed characters: their words are numbered, and ids put in for the numbers."""
        # The one agreed white space beyond ASCII; lower case of agreed characters depends on no neighbour.
        texts = [t.replace("\xa0", " ").lower() for t in texts]
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(map(self._word, distinct), pa.large_binary())
        parts = pa.ListArray.from_arrays(split.offsets, ids.take(words.indices))
        return pc.binary_join(parts, pa.scalar(b"", pa.large_binary())).to_pylist()

    def _word(self, word: str) -> bytes:
        """Letters alone are one pre-token; the word is in lower case and of agreed characters."""
        return self.parts[word] if word.isalpha() else self.words[word]

    def _odd(self, text: str) -> bytes:
        return self._whole(text) if ODD.search(text) else b"".join(map(self._odd_word, text.split()))

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _odd_word(self, word: str) -> bytes:
        return self._whole(word) if "<|" in word or AGREED.search(word) else self._word(word.lower())

    def _cut(self, word: str) -> bytes:
        """For agreed characters the library's normal form is just lower case; letters alone are one pre-token."""
        word = word.lower()
        if word.isascii() and word.isalpha():
            return self.parts[word]
        return b"".join(map(self.parts.__getitem__, PRE_TOKEN.findall(word)))

    def _part(self, part: str) -> bytes:
        # Printable ASCII stands for itself.
        plain = part.isascii() and part.isprintable()
        mapped = part if plain else "".join([self.alphabet[b] for b in part.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped)])


@cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _forget_words() -> None:
    """Workers are used again: memos and tokenizer make room once all pieces are cut."""
    if _word_ids.cache_info().currsize:
        _word_ids.cache_clear()
        give_back()


def _cut(columns: dict, path: str, limit: int) -> Iterator[tuple]:
    texts = [t or "" for t in columns["text"]]
    row = 0
    for doc_id, ids in zip(columns["doc_id"], _word_ids(path).encode(texts), strict=True):
        ids += b"\0\0\0\0"
        for piece, start in enumerate(range(0, len(ids), 4 * limit)):
            part = ids[start : start + 4 * limit]
            crc = zlib.crc32(part)
            row += 1
            yield doc_id, piece, start // 4, len(part) // 4, crc, crc + row


def pieces(docs: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    """Token pieces of every whole text: ids of the text, then id 0, cut only beyond ``limit``."""
    return map_rows(text_rows(docs), _cut, PIECES, tokenizer, limit)


@dataclass
class Pairs:
    """Pairs of pieces by their joint length, with where pieces are and how full sequences are by now."""

    total: np.ndarray
    where: np.ndarray
    one: np.ndarray
    other: np.ndarray
    home: np.ndarray
    fill: np.ndarray

    def best(self, b: int, filled: int, base: int, gap: int, least: int) -> tuple[int, list[int]] | None:
        """The longest pair of another sequence, emptier than ``b`` will be, that gives more than ``least``."""
        low, high = np.searchsorted(self.total, (base + least + 1, base + gap + 1))
        if low >= high:
            return None
        where, one, other = self.where[low:high], self.one[low:high], self.other[low:high]
        gain = self.total[low:high] - base
        fits = (where != b) & (self.home[one] == where) & (self.home[other] == where) & (self.fill[where] < filled + gain)
        at = np.flatnonzero(fits)
        if not len(at):
            return None
        last = at[-1]
        return int(gain[last]), [int(one[last]), int(other[last])]

    def moved(self, pieces: list[int], b: int, filled: int) -> None:
        self.home[pieces] = b
        self.fill[b] = filled


class Bins:
    """Sequences of one block, as lists of piece numbers, with the search on them."""

    def __init__(self, lengths: list[int], limit: int):
        self.lengths, self.limit = lengths, limit
        self.bins: list[list[int]] = []
        self.fill: list[int] = []

    def add(self, members: list[int]) -> None:
        self.bins.append(members)
        self.fill.append(sum(self.lengths[i] for i in members))

    def best_fit(self, items: list[int]) -> None:
        """Longest first, each into the fullest sequence that has room."""
        room: dict[int, list[int]] = {}
        rooms: list[int] = []
        for i in sorted(items, key=lambda i: -self.lengths[i]):
            need = self.lengths[i]
            at = bisect.bisect_left(rooms, need)
            if at == len(rooms):
                self.add([i])
                b, left = len(self.bins) - 1, self.limit - need
            else:
                left = rooms[at]
                b = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
                self.bins[b].append(i)
                self.fill[b] += need
                left -= need
            if left:
                if left not in room:
                    room[left] = []
                    bisect.insort(rooms, left)
                room[left].append(b)

    def search(self) -> None:
        """Exchange pieces between underfull sequences until no exchange raises squared fill.

        Most exchanges are found by looking for two pieces in the emptiest sequences only; before the search
        ends, all pairs of all sequences are looked up by their joint length. It also ends where the
        sequences are as few as the pieces' total length allows.
        """
        open_bins = [b for b, f in enumerate(self.fill) if f < self.limit]
        self.at: dict[int, set[int]] = {}
        self.home: dict[int, int] = {}
        for b in open_bins:
            for i in self.bins[b]:
                self._index(i, b)
        while not self.fewest():
            better = False
            self._pairs = None
            for b in sorted(open_bins, key=lambda b: -self.fill[b]):
                better |= self._filled(b)
            open_bins = [b for b in open_bins if 0 < self.fill[b] < self.limit]
            if not better:
                self._pairs = self._all_pairs(open_bins)
                for b in sorted(open_bins, key=lambda b: -self.fill[b]):
                    better |= self._filled(b)
                open_bins = [b for b in open_bins if 0 < self.fill[b] < self.limit]
                if not better:
                    return

    def fewest(self) -> bool:
        """No packing has fewer sequences."""
        return sum(1 for f in self.fill if f) <= -(-sum(self.fill) // self.limit)

    def _filled(self, b: int) -> bool:
        """Improve one sequence as far as it goes; was there anything to improve?"""
        better = False
        while 0 < self.fill[b] < self.limit and self._improve(b):
            better = True
        if self.fill[b] == self.limit:
            for i in self.bins[b]:
                self._forget(i)
        return better

    def _all_pairs(self, open_bins: list[int]) -> Pairs:
        """All pairs of lengths that a sequence holds; in arrays, as they may be a million."""
        rows: list[np.ndarray] = []
        for b in open_bins:
            items = np.array(self._two_of_each_length(b), np.int32)
            one, other = np.triu_indices(len(items), 1)
            rows.append(np.stack([np.full(len(one), b, np.int32), items[one], items[other]]))
        where, one, other = np.concatenate(rows, axis=1) if rows else np.empty((3, 0), np.int32)
        lengths = np.array(self.lengths, np.int32)
        total = lengths[one] + lengths[other]
        order = np.argsort(total, kind="stable")
        home = np.full(len(self.lengths), -1, np.int32)
        for i, b in self.home.items():
            home[i] = b
        return Pairs(total[order], where[order], one[order], other[order], home, np.array(self.fill, np.int32))

    def _two_of_each_length(self, b: int) -> list[int]:
        kept: dict[int, list[int]] = {}
        for i in self.bins[b]:
            same = kept.setdefault(self.lengths[i], [])
            if len(same) < 2:
                same.append(i)
        return [i for same in kept.values() for i in same]

    def _index(self, i: int, b: int) -> None:
        self.home[i] = b
        size = self.lengths[i]
        if size not in self.at:
            self.at[size] = set()
        self.at[size].add(i)

    def _forget(self, i: int) -> None:
        size = self.lengths[i]
        self.at[size].discard(i)
        if not self.at[size]:
            del self.at[size]
        self.home.pop(i, None)

    def _improve(self, b: int) -> bool:
        """The exchange that gives sequence ``b`` most; False if none raises squared fill."""
        gap = self.limit - self.fill[b]
        sizes = sorted(self.at)
        best: tuple[int, list[int], list[int]] | None = None
        for out in [None, *self._one_of_each_length(b)]:
            base = 0 if out is None else self.lengths[out]
            gone = [] if out is None else [out]
            top = bisect.bisect_right(sizes, base + gap)
            for k in range(top - 1, -1, -1):
                gain = sizes[k] - base
                if gain <= (best[0] if best else 0):
                    break
                donor = self._donor(sizes[k], b, gain)
                if donor is not None:
                    best = gain, gone, [donor]
                    break
            if best and best[0] == gap:
                break
            pair = self._pair(b, base, gap, sizes, best[0] if best else 0)
            if pair:
                best = pair[0], gone, pair[1]
                if best[0] == gap:
                    break
        if best is None:
            best = self._two_out(b, gap, sizes)
        if best is None:
            return False
        gain, gone, came = best
        donor = self.home[came[0]]
        for i in came:
            self.bins[donor].remove(i)
            self.bins[b].append(i)
            self.home[i] = b
        for i in gone:
            self.bins[b].remove(i)
            self.bins[donor].append(i)
            self.home[i] = donor
        self.fill[b] += gain
        self.fill[donor] -= gain
        if self._pairs is not None:
            self._pairs.moved(came, b, self.fill[b])
            self._pairs.moved(gone, donor, self.fill[donor])
        return True

    def _one_of_each_length(self, b: int) -> list[int]:
        return list({self.lengths[i]: i for i in self.bins[b]}.values())

    def _donor(self, size: int, b: int, gain: int) -> int | None:
        """A piece of that size in another sequence, emptier than ``b`` will be."""
        for i in self.at.get(size, ()):
            home = self.home[i]
            if home != b and self.fill[home] < self.fill[b] + gain:
                return i
        return None

    def _pair(
        self, b: int, base: int, gap: int, sizes: list[int], least: int
    ) -> tuple[int, list[int]] | None:
        """Two pieces of one other sequence that together give more than ``least``."""
        if self._pairs is not None:
            return self._listed_pair(b, base, gap, least)
        found = None
        for other in self._emptiest:
            if other == b or len(self.bins[other]) < 2:
                continue
            items = sorted(self.bins[other], key=self.lengths.__getitem__)
            low, high = 0, len(items) - 1
            while low < high:
                gain = self.lengths[items[low]] + self.lengths[items[high]] - base
                if gain > gap:
                    high -= 1
                    continue
                if gain > least and self.fill[other] < self.fill[b] + gain:
                    found, least = (gain, [items[low], items[high]]), gain
                low += 1
        return found

    def _listed_pair(self, b: int, base: int, gap: int, least: int) -> tuple[int, list[int]] | None:
        """The same over all sequences; a pair that has been parted since it was listed is passed over."""
        return self._pairs.best(b, self.fill[b], base, gap, least)

    def _two_out(self, b: int, gap: int, sizes: list[int]):
        """Two pieces of ``b``, of any two lengths that it holds, against one longer one."""
        best = None
        own = sorted(self._one_of_each_length(b), key=self.lengths.__getitem__)
        for x, i in enumerate(own):
            for j in own[x + 1 :]:
                base = self.lengths[i] + self.lengths[j]
                for k in range(bisect.bisect_right(sizes, base + gap) - 1, -1, -1):
                    gain = sizes[k] - base
                    if gain <= (best[0] if best else 0):
                        break
                    donor = self._donor(sizes[k], b, gain)
                    if donor is not None:
                        best = gain, [i, j], [donor]
                        break
        return best

    @property
    def _emptiest(self) -> list[int]:
        if not hasattr(self, "_few") or self._age <= 0:
            live = {self.home[i] for s in self.at.values() for i in s}
            self._few = sorted(live, key=lambda b: self.fill[b])[:8]
            self._age = 64
        self._age -= 1
        return [b for b in self._few if self.fill[b]]


def _pack(block: pd.DataFrame, limit: int, base: int) -> pd.DataFrame:
    """Pack one block; rows that already have a sequence start from it."""
    _forget_words()
    block = block.sort_values(["salt", "doc_id", "piece"], kind="stable").reset_index(drop=True)
    lengths = block["length"].astype(int).tolist()
    bins = Bins(lengths, limit)
    if "sequence_id" in block and block["sequence_id"].notna().all():
        for members in block.groupby("sequence_id", sort=True).indices.values():
            bins.add(members.tolist())
    else:
        bins.best_fit(list(range(len(lengths))))
    bins.search()
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    fill = np.zeros(len(lengths), np.int64)
    first = base + (int(block["block"].iloc[0]) << 24)
    for number, members in enumerate(m for m in bins.bins if m):
        at = 0
        for i in members:
            sequence[i], offset[i] = first + number, at
            at += lengths[i]
        fill[members] = at
    out = block.assign(sequence_id=sequence, offset=offset, fill=fill)
    return out[PLACED.names]


def _packed_blocks(rows: DataFrame, limit: int, number: int) -> DataFrame:
    return rows.groupBy("block").applyInPandas(
        lambda block: _pack(block, limit, number << 56), PLACED
    )


def pack(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the single end id. Repeated rows and null ids are packed each. An empty
    table gives none, further columns are ignored. A block holds at most about ``BLOCK`` pieces, so
    no task grows with the input; pieces are dealt by their content's checksum and place.
    """
    loose = staged(pieces(docs, tokenizer, limit), "pieces")
    blocks = _blocks(loose.count())
    placed = staged(
        _packed_blocks(
            loose.withColumn("block", F.pmod(F.xxhash64("salt", "doc_id", "piece"), F.lit(blocks))),
            limit, 1,
        ), "packed",
    )
    done = []
    for number in range(2, 2 + ROUNDS):
        underfull = placed.where(F.col("fill") < limit)
        left = underfull.count()
        done.append(placed.where(F.col("fill") == limit))
        again = _packed_blocks(
            underfull.withColumn(
                "block", F.pmod(F.xxhash64("sequence_id"), F.lit(_blocks(left)))
            ), limit, number,
        )
        placed = staged(again, "packed")
    done.append(placed)
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    return rows.drop("salt", "fill")


def _blocks(count: int) -> int:
    return max(1, -(-count // BLOCK))
