"""Near duplicates by SimHash fingerprints and a hierarchical index in Gray order.

1. Every text becomes a 64-bit fingerprint; equal fingerprints are one code, named by its smallest
   doc_id, so copies are gone before any search.
2. The codes are sorted by Gray rank over all machines and cut into blocks of bounded size. A block
   keeps the bits that all its codes share; upper nodes, one per sixteen below, what their blocks share,
   up to a single one.
3. Pairs of nodes go down this hierarchy, level by level, as joins; a pair goes when its certain
   differences exceed the budget. What is left are pairs of blocks, whose codes one task compares by
   the same hierarchy inside the blocks.
4. Each pair of blocks gives one link per code and component, not all links, and components follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlemill.llm import gray_index as G
from candlemill.llm.graph import components
from candlemill.llm.shared import fields, map_parts, map_rows, parts_of, staged, text_rows

WIDTH = 3
SEED = 42
BLOCK = 4096
"""Codes of a block."""
FAN = 16
"""Nodes under an upper node."""
FLAT = 1 << 16
"""Shingles whose bits are counted together."""

CODES = fields("doc_id long, code long")
BLOCKS = fields("part long, place long, n long, ones long, some long, codes binary, names binary")
LINKS = fields("a long, b long")


def fingerprint(text: str) -> int:
    """Bits set in more than half of the hashes of the text's runs of ``WIDTH`` lower-cased words.

    Only A-Z are lower-cased. Fewer words are one run; a text without words has fingerprint zero.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    span = min(WIDTH, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - span + 1].tolist()
    ends = (ends[span - 1 :] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), FLAT):
        cut = [hashed(joined[s:e], SEED) for s, e in zip(starts[i : i + FLAT], ends[i : i + FLAT], strict=True)]
        bytes_ = np.array(cut, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bytes_, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _coded(columns: dict) -> Iterator[tuple]:
    for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
        code = fingerprint(text or "")
        yield doc_id, code - (1 << 64) if code >> 63 else code


def rank_order(code: Column) -> Column:
    """A signed number in the order of the codes' unsigned Gray ranks."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def _blocks(parts: Iterator[dict]) -> Iterator[tuple]:
    codes: list[int] = []
    names: list[int] = []
    place, part = 0, TaskContext.get().partitionId()
    for columns in parts:
        codes += columns["code"]
        names += columns["name"]
        while len(codes) >= BLOCK:
            yield _block(part, place, codes[:BLOCK], names[:BLOCK])
            codes, names, place = codes[BLOCK:], names[BLOCK:], place + 1
    if codes:
        yield _block(part, place, codes, names)


def _block(part: int, place: int, codes: list[int], names: list[int]) -> tuple:
    array = np.array(codes, "<i8")
    ones, some = int(np.bitwise_and.reduce(array)), int(np.bitwise_or.reduce(array))
    return part, place, len(codes), ones, some, array.tobytes(), np.array(names, "<i8").tobytes()


def _certain(one: str, other: str) -> Column:
    """Bits in which everything under two nodes differs."""
    ones, some = F.col(f"ones_{one}"), F.col(f"some_{one}")
    return (ones.bitwiseAND(F.bitwise_not(F.col(f"some_{other}")))).bitwiseOR(
        F.col(f"ones_{other}").bitwiseAND(F.bitwise_not(some))
    )


def _linked(columns: dict, most: int) -> Iterator[tuple]:
    for a, b, codes_a, codes_b, names_a, names_b in zip(
        *(columns[c] for c in ("a", "b", "codes_a", "codes_b", "names_a", "names_b")), strict=True
    ):
        left = G.Index(np.frombuffer(codes_a, "<u8"))
        right = left if a == b else G.Index(np.frombuffer(codes_b, "<u8"))
        i, j = G.within(left, right, most, same=a == b)
        if not len(i):
            continue
        names = np.frombuffer(names_a, "<i8")
        if a != b:
            j = j + len(names)
            names = np.concatenate((names, np.frombuffer(names_b, "<i8")))
        low, at = G.stars(i, j, len(names))
        yield from zip(names[low].tolist(), names[at].tolist(), strict=True)


class _Hierarchy:
    """Blocks of codes in Gray order under nodes of shared bits; all of it stays in tables."""

    def __init__(self, codes: DataFrame):
        spark = codes.sparkSession
        ranged = codes.withColumn("rank", rank_order(F.col("code"))).repartitionByRange(
            parts_of(spark), "rank"
        ).sortWithinPartitions("rank").select("code", "name")
        blocks = staged(map_parts(ranged, _blocks, BLOCKS, rows=16), "blocks")
        # Numbers without holes, in order: one row per partition says where its blocks begin.
        begin = blocks.groupBy("part").agg(F.count("*").alias("blocks")).select(
            "part",
            (F.sum("blocks").over(Window.orderBy("part")) - F.col("blocks")).alias("begin"),
        )
        self.blocks = staged(
            blocks.join(begin, "part").withColumn("no", F.col("begin") + F.col("place"))
            .select("no", "n", "ones", "some", "codes", "names"), "blocks",
        )
        self.levels = [self.blocks.select("no", "ones", "some")]
        count = self.blocks.count()
        while count > 1:
            upper = self.levels[-1].groupBy(F.floor(F.col("no") / FAN).alias("no")).agg(
                F.bit_and("ones").alias("ones"), F.bit_or("some").alias("some")
            )
            self.levels.append(staged(upper, "upper"))
            count = -(-count // FAN)

    def pairs(self, most: int) -> DataFrame:
        """(a, b), a <= b, of blocks that may hold codes at most ``most`` bits apart."""

        def side(level: DataFrame, name: str) -> DataFrame:
            own = level.select(*(F.col(c).alias(f"{c}_{name}") for c in ("no", "ones", "some")))
            return own.withColumn(f"up_{name}", F.floor(F.col(f"no_{name}") / FAN))

        # From the one node at the top, paired with itself.
        open_ = self.levels[-1].select(
            F.col("no").alias("up_a"), F.col("no").alias("up_b"), F.lit(0).cast("long").alias("counted"),
            F.lit(0).alias("apart"),
        )
        for level in self.levels[-2::-1]:
            fresh = F.bit_count(_certain("a", "b").bitwiseAND(F.bitwise_not(F.col("counted"))))
            open_ = staged(
                open_.join(side(level, "a"), "up_a").join(side(level, "b"), "up_b")
                .where(F.col("no_a") <= F.col("no_b")).withColumn("now", F.col("apart") + fresh)
                .where(F.col("now") <= most).select(
                    F.col("no_a").alias("up_a"), F.col("no_b").alias("up_b"),
                    _certain("a", "b").alias("counted"), F.col("now").alias("apart"),
                ), "pairs",
            )
        return open_.select(F.col("up_a").alias("a"), F.col("up_b").alias("b"))

    def links(self, most: int) -> DataFrame:
        """Links between names that give the components of all codes at most ``most`` bits apart."""
        named = [
            self.blocks.select(F.col("no").alias(s), F.col("codes").alias(f"codes_{s}"), F.col("names").alias(f"names_{s}"))
            for s in ("a", "b")
        ]
        ready = self.pairs(most).join(named[1], "b").join(named[0], "a")
        return staged(map_rows(ready, _linked, LINKS, most, most_chars=4 << 20), "links")


def near_duplicates(docs: DataFrame, most: int = 2) -> DataFrame:
    """Per input row: doc_id, fingerprint (16 hex digits), component_id.

    Documents are linked when their fingerprints differ in at most ``most`` bits; component_id is the
    smallest doc_id reachable, the document itself included. Null and empty texts have fingerprint
    zero, which is linked like any other. A row without doc_id gets the component of its fingerprint,
    null where no document has one near; rows that repeat a doc_id with other texts each keep theirs.
    An empty table gives none; further columns are ignored.
    """
    coded = staged(map_rows(text_rows(docs), _coded, CODES, rows=4096), "coded")
    codes = staged(
        coded.groupBy("code").agg(F.min("doc_id").alias("name")).where("name IS NOT NULL"), "codes"
    )
    # Two texts of one doc_id may have given a name to two codes; these are one document.
    found = components(_Hierarchy(codes).links(most))
    labels = staged(
        codes.join(found.toDF("name", "found"), "name", "left")
        .select("code", F.coalesce("found", "name").alias("component_id")), "labels",
    )
    return coded.join(labels, "code", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )
