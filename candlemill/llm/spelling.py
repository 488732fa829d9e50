"""Spelling variants: words one code point apart, by pairs of trie nodes.

1. Words are counted where they lie, then summed.
2. The dictionary is sorted by range; a walk over the sorted words numbers the nodes of the forward trie
   (all fronts of words), a second sort of the reversed words those of the backward trie (all ends).
   A front that two partitions share has two numbers; one row per partition settles which holds.
3. A word of n code points gives n + 1 pairs (front node, end node) that meet, and n that skip a position.
   Equal skipping pairs are words with one code point replaced; a skipping pair that equals a meeting
   pair is a word with one code point more. Groups hold at most one word per letter of the alphabet
   and the shorter word, and are counted as they are: no pair is written out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.shared import fields, map_parts, map_rows, parts_of, staged, text_rows

LEAST = 7
"""Code points of a word."""
RUN = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % LEAST)
SPOILED = 31
"""One run in so many loses a code point."""

COUNTS = fields("word string, n long")
FRONTS = fields("no long, word string, n long, nodes longs, part long, first string, last string")
ENDS = fields("no long, nodes longs, part long, first string, last string")
PAIRS = fields("front long, end long, no long, n long, kind int")

INNER, SKIP, MEET = 0, 1, 2
"""Kinds of pairs: skipping inside a run of equal letters, at the first of a run, meeting."""


def words_of(doc_id: int | None, text: str) -> Iterator[str]:
    """The runs of letters in a text, A-Z lower-cased, some short of a code point (see module contract).

    With h = crc32 of ``<doc_id>:<run>``, a run loses code point h % length where 31 divides h. A null doc_id
    counts as empty.
    """
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run in RUN.findall(text):
        low = run.encode().lower()
        h = zlib.crc32(low, start)
        word = low.decode()
        if h % SPOILED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < LEAST:
                continue
        yield word


def _counted(columns: dict) -> Iterator[tuple]:
    counts: Counter[str] = Counter()
    for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
        counts.update(words_of(doc_id, text or ""))
    yield from counts.items()


def _shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _numbered(parts: Iterator[dict], key: str, keep: tuple[str, ...]) -> Iterator[tuple]:
    """Sorted words in, each with the numbers of the trie nodes on its path; last a row of the ends.

    Node 0 is the root. Other numbers hold the partition above bit 40, so no two partitions give the same.
    """
    part = TaskContext.get().partitionId()
    base = (part + 1) << 40
    nodes, before, first, count = [0], None, None, 0
    place = 0
    for columns in parts:
        for word, *rest in zip(columns[key], *(columns[c] for c in keep), strict=True):
            same = _shared(word, before) if before is not None else 0
            fresh = range(base + count + 1, base + count + 1 + len(word) - same)
            nodes = nodes[: same + 1] + list(fresh)
            count += len(fresh)
            if keep == ("n",):
                yield base + place, word, rest[0], nodes, None, None, None
                place += 1
            else:
                yield rest[0], nodes, None, None, None
            first = word if first is None else first
            before = word
    if before is not None:
        if keep == ("n",):
            yield None, None, None, nodes, part, first, before
        else:
            yield None, nodes, part, first, before


def renames(edges: list) -> dict[int, int]:
    """Numbers of nodes that an earlier partition has numbered too, and that number.

    ``edges`` are (part, first word, last word, nodes of the last word): one per partition. A partition's
    first word has the numbers 1, 2, ... of its own, so a front shared with the word before is known.
    """
    same: dict[int, int] = {}
    before = None
    for part, first, last, nodes in sorted(edges):
        if before is not None:
            base = (part + 1) << 40
            for depth in range(1, _shared(before[0], first) + 1):
                old = before[1][depth]
                same[base + depth] = same.get(old, old)
        before = (last, nodes)
    return same


def _paired(columns: dict, fronts: dict[int, int], ends: dict[int, int]) -> Iterator[tuple]:
    for no, word, n, front, end in zip(
        *(columns[c] for c in ("no", "word", "n", "fronts", "ends")), strict=True
    ):
        front = [fronts.get(x, x) for x in front]
        end = [ends.get(x, x) for x in end][::-1]
        yield front[-1], end[-1], no, n, MEET
        before = ""
        for p, e, after, letter in zip(front, end, end[1:], word, strict=False):
            yield p, e, no, n, MEET
            yield p, after, no, n, INNER if letter == before else SKIP
            before = letter


def _edges(numbered: DataFrame) -> dict[int, int]:
    """One row per partition comes to the driver: its first and last word."""
    return renames([tuple(r) for r in numbered.where("part IS NOT NULL").select(
        "part", "first", "last", "nodes").collect()])


def _share(members: Column, own: Column) -> Column:
    """What a group of pairs tells one of its members: near words, and the most frequent of them."""

    def others(y: Column) -> Column:
        meets = own.kind == MEET
        return F.when(meets, y.kind == SKIP).otherwise(
            ((y.kind < MEET) & (y.no != own.no)) | ((y.kind == MEET) & (own.kind == SKIP))
        )

    near = F.filter(members, others)
    best = F.array_max(F.transform(near, lambda y: F.struct(y.n.alias("n"), (-y.no).alias("low"))))
    return F.struct(own.no.alias("no"), F.size(near).cast("long").alias("near"), best.alias("best"))


def variants(docs: DataFrame, least_n: int = 2, times: int = 10) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Words are those of ``words_of`` with at least ``least_n`` occurrences. Near words differ by exactly
    one inserted, deleted or replaced code point; the form is the most frequent near word (ties: smallest
    in code-point order) where it is at least ``times`` as frequent; root is where following forms ends.
    Null and empty texts have no words, repeated rows count each time, further columns are ignored.
    """
    spark = docs.sparkSession
    parts = parts_of(spark)
    counted = map_rows(text_rows(docs), _counted, COUNTS, rows=1 << 14)
    words = staged(
        counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n), "words"
    )
    # In code-point order, so that smaller numbers are smaller words.
    forward = staged(map_parts(
        words.repartitionByRange(parts, "word").sortWithinPartitions("word"),
        _numbered, FRONTS, "word", ("n",), rows=1 << 13,
    ), "fronts")
    listed = forward.where("part IS NULL").select("no", "word", "n")
    backward = staged(map_parts(
        listed.select("no", F.reverse("word").alias("back"))
        .repartitionByRange(parts, "back").sortWithinPartitions("back").select("back", "no"),
        _numbered, ENDS, "back", ("no",), rows=1 << 13,
    ), "ends")
    both = forward.where("part IS NULL").select("no", "word", "n", F.col("nodes").alias("fronts")).join(
        backward.where("part IS NULL").select("no", F.col("nodes").alias("ends")), "no"
    )
    pairs = map_rows(both, _paired, PAIRS, _edges(forward), _edges(backward), rows=1 << 15)
    groups = pairs.groupBy("front", "end").agg(
        F.collect_list(F.struct("no", "n", "kind")).alias("members")
    ).where(F.size("members") > 1)
    told = groups.select(
        F.explode(F.transform("members", lambda x: _share(F.col("members"), x))).alias("told")
    ).where("told.near > 0")
    near = staged(
        told.groupBy(F.col("told.no").alias("no")).agg(
            F.sum("told.near").alias("n_near"), F.max("told.best").alias("best")
        ), "near",
    )
    judged = staged(
        listed.join(near, "no", "left").withColumn("up", F.col("best.n") >= times * F.col("n")).select(
            "no", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("up"), -F.col("best.low")).alias("form_no"),
            F.when(F.col("up"), F.col("best.n")).alias("form_n"),
        ), "judged",
    )
    steps = judged.where("form_no IS NOT NULL").select("no", "form_no")
    names = judged.select("no", "word")
    return (
        judged.join(_followed(steps), "no", "left")
        .join(names.toDF("form_no", "form"), "form_no", "left")
        .join(names.toDF("root_no", "root_word"), "root_no", "left")
        .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
    )


def _followed(steps: DataFrame) -> DataFrame:
    """(no, root_no): where the steps from a word end. Every step is to a more frequent word.

    A round doubles the length that is followed, and a chain is as long as the logarithm of the
    largest count, so few rounds do.
    """
    reached = steps.toDF("no", "root_no")
    while True:
        further = staged(
            reached.join(reached.toDF("root_no", "beyond"), "root_no", "left")
            .select("no", F.coalesce("beyond", "root_no").alias("root_no"), "beyond"), "roots",
        )
        reached = further.select("no", "root_no")
        if further.where("beyond IS NOT NULL").isEmpty():
            return reached
