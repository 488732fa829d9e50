"""Benchmark passages in documents: q-gram lemma filter, then banded alignment.

Texts are compared in a plain form: lower case, every run of characters that are no letter or digit
as one space. A document holds an item if some stretch of it is within ``edits`` insertions, deletions
and substitutions of the item's plain form.

An item of ``m`` characters within ``k`` edits of a stretch shares at least ``m + 1 - q - k * q`` of
its q-grams with it, all of them on diagonals (place in the document minus place in the item) that
lie within ``k`` of each other. So shared q-grams are counted in overlapping bands of diagonals, each
``2 * (k + 1)`` wide and half of that apart; every band that reaches the bound is verified.

Items are looked for by length class, from one power of two to the next, each with a sieve, a bound and
a window of its own: a short item widens the search for no longer one. An item with fewer characters
than a gram has no edits to spend and is found as it is, as whole words of the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.setsketch import mix
from candlemill.llm.shared import fields, map_rows, staged

Q = 12
"""Characters of a gram; shorter items are found as whole words."""
EDIT_SHARE = 0.04
"""Edits granted per character of an item."""
MOST_BITS = 27
"""The sieves that are sent to all executors have at most 2**27 bits (16 MiB) a length class."""
OWN, OWN_KEY = "decontaminate_doc_id", "decontaminate_key"
"""Columns that a join adds for a while."""
OTHER = re.compile(r"[\W_]+")

ITEMS = fields("item_id long, item long, plain string, length int, class int")
GRAMS = fields("item long, length int, class int, place int, gram long")
HITS = fields("doc_id long, row long, class int, start int, stretch string, places ints, grams longs")
SHORT = fields("doc_id long, row long, plain string, start int")
PASSAGES = ("doc_id", "item_id", "edits", "start", "finish", "row")
FOUND = fields("doc_id long, row long, item_id long, edits int, start int, finish int")


def plain(text: str) -> str:
    return OTHER.sub(" ", text.lower()).strip()


def edits_of(length: int) -> int:
    """The budget of an item with that many characters."""
    return int(EDIT_SHARE * length)


def least_shared(length: int) -> int:
    """The lemma's bound for an item within its budget; positive from ``Q`` characters on."""
    return length + 1 - Q - edits_of(length) * Q


_POWERS = mix(np.arange(101, 101 + Q, dtype=np.uint64)) | np.uint64(1)


def gram_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for every run of ``Q`` characters, at its place."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(codes) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = codes[:n] * _POWERS[0]
    for k in range(1, Q):
        total += codes[k : k + n] * _POWERS[k]
    return mix(total)


def _items(columns: dict) -> Iterator[tuple]:
    for item_id, text in zip(columns["item_id"], columns["text"], strict=True):
        form = plain(text or "")
        if form:
            key = int(np.int64(hash_of(form) ^ np.int64(0 if item_id is None else item_id)))
            yield item_id, key, form, len(form), class_of(len(form))


def class_of(length: int) -> int:
    """The length class of an item; 0 for those shorter than a gram."""
    return length.bit_length() if length >= Q else 0


def hash_of(text: str) -> np.int64:
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))).view(np.int64)


def _grams(columns: dict) -> Iterator[tuple]:
    for item, form, length, kind in zip(
        *(columns[c] for c in ("item", "plain", "length", "class")), strict=True
    ):
        grams = gram_hashes(form).view(np.int64).tolist() if kind else [int(hash_of(form))]
        for place, gram in enumerate(grams):
            yield item, length, kind, place, gram


@dataclass(frozen=True)
class Sieve:
    """Which grams a class of items may hold (bits by a gram's leading bits), and its search window.

    Of items shorter than a gram it holds whole items; ``counts`` are their numbers of words.
    """

    kind: int
    bits: int
    words: object
    least: int
    longest: int
    counts: tuple[int, ...]

    def hits(self, grams: np.ndarray, words: np.ndarray) -> np.ndarray:
        slot = grams >> np.uint64(64 - self.bits)
        word = words[(slot >> np.uint64(6)).astype(np.int64)]
        return np.flatnonzero((word >> (slot & np.uint64(63))) & np.uint64(1))


def build_sieves(items: DataFrame, grams: DataFrame) -> list[Sieve]:
    """One per length class; none for a benchmark without items.

    Classes are as many as the longest item has binary digits, at most.
    """
    sizes = items.groupBy("class").agg(
        F.sum("length").alias("all"), F.max("length").alias("most"), F.min(
            F.col("length") + 1 - Q - F.floor(F.col("length") * EDIT_SHARE).cast("int") * Q
        ).alias("least"),
    ).orderBy("class").collect()
    return [_sieve(items.where(F.col("class") == size["class"]), grams.where(F.col("class") == size["class"]), size)
            for size in sizes]


def _sieve(items: DataFrame, grams: DataFrame, size) -> Sieve:
    """The bits reach the driver in words, at most 2**21."""
    bits = min(MOST_BITS, max(16, int(size["all"]).bit_length() + 4))
    rows = (
        grams.select(F.shiftrightunsigned("gram", 64 - bits).alias("slot"))
        .groupBy(F.expr("slot div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(pmod(slot, 64) AS int)))").alias("bits"))
        .toPandas()
    )
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    longest = int(size["most"])
    counts: tuple[int, ...] = ()
    if not size["class"]:
        # Fewer characters than a gram: a handful of word counts.
        told = items.select(F.size(F.split("plain", " ")).alias("n")).distinct().collect()
        counts = tuple(sorted(r["n"] for r in told))
    return Sieve(
        size["class"], bits, items.sparkSession.sparkContext.broadcast(words.tobytes()),
        int(size["least"]), longest + edits_of(longest), counts,
    )


def _hits(columns: dict, sieves: list[Sieve]) -> Iterator[tuple]:
    bits = [np.frombuffer(sieve.words.value, np.uint64) for sieve in sieves]
    for doc_id, row, text in zip(columns["doc_id"], columns["row"], columns["text"], strict=True):
        form = plain(text or "")
        grams = gram_hashes(form)
        for sieve, words in zip(sieves, bits, strict=True):
            at = sieve.hits(grams, words)
            for first, last in dense(at, sieve.least, sieve.longest):
                start = max(0, first - sieve.longest)
                end = min(len(form), last + Q + sieve.longest)
                inside = at[(at >= start) & (at <= end - Q)]
                yield (
                    doc_id, row, sieve.kind, start, form[start:end], (inside - start).tolist(),
                    grams[inside].view(np.int64).tolist(),
                )


def _short_hits(columns: dict, sieve: Sieve) -> Iterator[tuple]:
    """Runs of whole words that may be an item, each once, at its first place."""
    words = np.frombuffer(sieve.words.value, np.uint64)
    for doc_id, row, text in zip(columns["doc_id"], columns["row"], columns["text"], strict=True):
        parts = plain(text or "").split()
        starts = [0, *accumulate(len(part) + 1 for part in parts)]
        runs: dict[str, int] = {}
        for n in sieve.counts:
            for i in range(len(parts) - n + 1):
                if starts[i + n] - starts[i] <= Q:
                    runs.setdefault(" ".join(parts[i : i + n]), starts[i])
        if runs:
            hashes = np.array([hash_of(run) for run in runs]).view(np.uint64)
            listed = list(runs.items())
            for k in sieve.hits(hashes, words).tolist():
                yield doc_id, row, *listed[k]


def dense(at: np.ndarray, need: int, span: int) -> list[tuple[int, int]]:
    """Stretches (first, last hit) covered by runs of ``need`` hits within ``span`` characters.

    Stretches closer than ``span`` are one, so that no passage is cut between two.
    """
    if len(at) < need:
        return []
    firsts, lasts = at[: len(at) - need + 1], at[need - 1 :]
    close = np.flatnonzero(lasts - firsts <= span)
    out: list[tuple[int, int]] = []
    for a, b in zip(firsts[close].tolist(), lasts[close].tolist(), strict=True):
        if out and a - out[-1][1] <= span:
            out[-1] = out[-1][0], b
        else:
            out.append((a, b))
    return out


def align(item: str, text: str, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best stretch for the item, alignments kept within a band.

    The band holds the diagonals ``low`` to ``high`` (place in text minus place in item). Among
    equals the leftmost end counts. None if every alignment in the band takes more than ``budget``.
    """
    at = text.find(item, max(0, low), max(0, high) + len(item))
    if at >= 0:
        return 0, at, at + len(item)
    width = high - low + 1
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    own = np.frombuffer(item.encode("utf-32-le", "surrogatepass"), "<u4")
    far = 1 << 20
    step = np.arange(width)
    places = low + step
    cost = np.where((places >= 0) & (places <= len(letters)), 0, far)
    begin = places.copy()
    padded = np.full(len(letters) + 1, 0xFFFFFFFF, np.uint64)
    padded[: len(letters)] = letters
    for i in range(len(own)):
        # Column c of row i + 1 stands after place low + i + 1 + c of the text.
        ends = low + i + 1 + step
        inside = (ends >= 0) & (ends <= len(letters))
        same = padded[np.clip(ends - 1, 0, len(letters))] == own[i]
        take = np.where(ends >= 1, cost + ~same, far)
        skip = np.append(cost[1:], far) + 1
        first = np.append(begin[1:], 0)
        new = np.minimum(take, skip)
        origin = np.where(take <= skip, begin, first)
        slid = np.minimum.accumulate(new - step)
        source = np.maximum.accumulate(np.where(new - step == slid, step, 0))
        cost = np.where(inside, slid + step, far)
        begin = origin[source]
        if cost.min() > budget:
            return None
    best = int(cost.argmin())
    return int(cost[best]), int(begin[best]), low + len(own) + best


def _verified(columns: dict) -> Iterator[tuple]:
    for doc_id, row, item_id, form, stretch, start, band in zip(
        *(columns[c] for c in ("doc_id", "row", "item_id", "plain", "stretch", "start", "band")),
        strict=True,
    ):
        budget = edits_of(len(form))
        low = band * (budget + 1) - budget
        found = align(form, stretch, low, low + 2 * (budget + 1) + 2 * budget, budget)
        if found and found[0] <= budget:
            yield doc_id, row, item_id, found[0], start + found[1], start + found[2]


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, edits, start, finish, row.

    The places are in the document's plain form, of the match with fewest edits, the leftmost of
    equals. ``row`` is the key of (doc_id, text), so rows that repeat give one result and rows
    without id are told apart. Null or empty texts and items, and those of punctuation only, hold
    nothing; an item with fewer than ``Q`` characters counts as whole words without an edit; empty
    tables give none; other columns are ignored.
    """
    spark = docs.sparkSession
    items = staged(
        map_rows(
            benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")),
            _items, ITEMS,
        ).distinct(), "items",
    )
    grams = staged(map_rows(items.select("item", "plain", "length", "class"), _grams, GRAMS), "grams")
    sieves = build_sieves(items, grams)
    found = [_short(docs, items, s) for s in sieves if not s.kind]
    if long := [s for s in sieves if s.kind]:
        found.append(_long(docs, items, grams, long))
    if not found:
        return spark.createDataFrame([], FOUND).select(*PASSAGES)
    return reduce(DataFrame.unionByName, found)


def _short(docs: DataFrame, items: DataFrame, sieve: Sieve) -> DataFrame:
    hits = map_rows(keyed(docs), _short_hits, SHORT, sieve).dropDuplicates(["doc_id", "row", "plain"])
    short = items.where(F.col("class") == 0).select("item_id", "plain", "length").distinct()
    return hits.join(short, "plain").select(
        "doc_id", "item_id", F.lit(0).alias("edits"), "start", (F.col("start") + F.col("length")).alias("finish"), "row"
    )


def _long(docs: DataFrame, items: DataFrame, grams: DataFrame, sieves: list[Sieve]) -> DataFrame:
    hits = staged(map_rows(keyed(docs), _hits, HITS, sieves, rows=256), "hits")
    keys = ("doc_id", "row", "class", "start")
    hits = hits.withColumn("hit", F.xxhash64(*keys)).dropDuplicates(keys)
    each = hits.select(
        "hit", "class", F.explode(F.arrays_zip("places", "grams")).alias("one")
    ).select("hit", "class", F.col("one.places").alias("at"), F.col("one.grams").alias("gram"))
    budget = F.floor(F.col("length") * EDIT_SHARE).cast("int")
    bound = F.col("length") + 1 - Q - budget * Q
    diagonal = F.floor((F.col("at") - F.col("place")) / (budget + 1)).cast("int")
    candidates = (
        each.join(grams, ["gram", "class"])
        .select("hit", "item", "length", F.explode(F.array(diagonal - 1, diagonal)).alias("band"))
        .groupBy("hit", "item", "length", "band").count()
        .where(F.col("count") >= bound).select("hit", "item", "band")
    )
    ready = candidates.join(hits.drop("places", "grams", "class"), "hit").join(items.drop("length", "class"), "item")
    best = F.min(F.struct("edits", "start", "finish")).alias("best")
    return (
        map_rows(ready, _verified, FOUND).groupBy("doc_id", "row", "item_id").agg(best)
        .select("doc_id", "item_id", "best.edits", "best.start", "best.finish", "row").select(*PASSAGES)
    )


def keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("row"),
        text.alias("text"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents that hold no item, with all their columns.

    Null and empty texts hold nothing and stay, as do all rows of an empty benchmark; rows that repeat stay
    or go together; rows without doc_id are judged by their text.
    """
    gone = passages(docs, benchmark).select("doc_id", "row").distinct().hint("merge")
    doc_id = F.col("doc_id").cast("long")
    key = F.xxhash64(doc_id, F.col("text").cast("string"))
    left = docs.select("*", doc_id.alias(OWN), key.alias(OWN_KEY))
    on = (left[OWN_KEY] == gone["row"]) & left[OWN].eqNullSafe(gone["doc_id"])
    return left.join(gone, on, "left_anti").drop(OWN, OWN_KEY)
