"""Near duplicates by SetSketch bands, joint likelihood and confirmation on full shingle sets.

1. Every text becomes its set of five-word shingles, a digest of the set, and registers.
2. Texts with equal sets are one class with a number of its own; from here on only classes count. A class
   is read again by one of its rows, that of the smallest doc_id.
3. Classes that share the registers of a band stand in one bucket. In every bucket the member that
   meets most others is the hub and is paired with the rest: pairs grow with members, not squares.
4. Pairs whose registers make the similarity implausible go; the others are confirmed on full sets.
5. A bucket whose members are then one component can hide no link. In every other bucket those
   outside its largest component are held against all of it. In buckets of up to ``FEW`` members
   these are few pairs per member, which take the way of step 4. Larger ones are cut into blocks of
   bounded size that carry the full sets: pairs are estimated and confirmed inside a block, and one
   link per outsider and component leaves it. So no link of a bucket is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm import setsketch as S
from candlemill.llm.graph import components
from candlemill.llm.shared import fields, map_rows, staged, text_rows

WIDTH = 5
FEW = 64
"""Members of a bucket whose pairs are written out; larger buckets are compared in blocks."""
BLOCK = 512
"""Members and outsiders of a large bucket that one task compares at a time."""
FLAT = 1 << 17
"""Shingles sketched at a time."""

SKETCHES = fields("doc_id long, text_key long, n_shingles long, digest binary, registers binary")
SETS = fields("rep long, members binary")
PLAUSIBLE = fields("a long, b long")

_TURNS = S.mix(np.arange(11, 11 + WIDTH, dtype=np.uint64)) | np.uint64(1)


def shingles(text: str) -> np.ndarray:
    """The text's set: sorted distinct 64-bit hashes of runs of ``WIDTH`` lower-cased words.

    Only A-Z are lower-cased; a shorter text is one shingle, a text without words has none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    span = min(WIDTH, len(words))
    runs = len(words) - span + 1
    code = np.full(runs, span, np.uint64)
    for k in range(span):
        code = code + S.mix(hashed[k : k + runs] ^ _TURNS[k]) * _TURNS[k]
    return np.unique(S.mix(code))


def _sketched(columns: dict) -> Iterator[tuple]:
    waiting: list[tuple] = []
    size = 0
    for doc_id, key, text in zip(columns["doc_id"], columns["text_key"], columns["text"], strict=True):
        found = shingles(text or "")
        if not len(found):
            yield doc_id, key, 0, None, None
            continue
        waiting.append((doc_id, key, found))
        size += len(found)
        if size >= FLAT:
            yield from _rows(waiting)
            waiting, size = [], 0
    if waiting:
        yield from _rows(waiting)


def _rows(waiting: list[tuple]) -> Iterator[tuple]:
    sizes = [len(found) for *_, found in waiting]
    starts = np.cumsum([0, *sizes[:-1]])
    registers = S.sketch(np.concatenate([found for *_, found in waiting]), starts)
    for (doc_id, key, found), row in zip(waiting, registers, strict=True):
        yield doc_id, key, len(found), xxhash.xxh3_128_digest(found.tobytes()), row.tobytes()


def _banded(columns: dict) -> Iterator[tuple]:
    for rep, registers in zip(columns["rep"], columns["registers"], strict=True):
        for band, key in enumerate(np.frombuffer(registers, "<i8").tolist()):
            yield band, key, rep


def _estimated(columns: dict, least: float) -> Iterator[tuple]:
    if not columns["a"]:
        return
    one, other = (_matrix(columns[c]) for c in ("registers_a", "registers_b"))
    n_a, n_b = (np.array(columns[c], np.float64) for c in ("n_a", "n_b"))
    ok = S.plausible((one > other).sum(1), (one < other).sum(1), n_a, n_b, least)
    for i in np.flatnonzero(ok).tolist():
        yield columns["a"][i], columns["b"][i]


def _matrix(rows) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<u2").reshape(len(rows), S.REGISTERS)


def _sets(columns: dict) -> Iterator[tuple]:
    for rep, text in zip(columns["rep"], columns["text"], strict=True):
        yield rep, shingles(text or "").tobytes()


def _confirmed(columns: dict, percent: int) -> Iterator[tuple]:
    for a, b, x, y in zip(
        columns["a"], columns["b"], columns["set_a"], columns["set_b"], strict=True
    ):
        one, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(one, other, assume_unique=True))
        if both and 100 * both >= percent * (len(one) + len(other) - both):
            yield a, b


def _block_links(percent: int):
    least = percent / 100
    # Fewer equal registers than this are beyond all doubt (nine standard deviations).
    floor = S.REGISTERS * least - 9 * (S.REGISTERS * least * (1 - least)) ** 0.5

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        inside, outside = block[~block["outer"]], block[block["outer"]]
        found: list[tuple] = []
        if len(inside) and len(outside):
            registers = _matrix(inside["registers"].tolist())
            keys = S.band_keys(registers)
            ids, parts = inside["rep"].to_numpy(), inside["component"].to_numpy().copy()
            sizes = inside["n_shingles"].to_numpy(np.float64)
            sets = [np.frombuffer(x, np.uint64) for x in inside["members"]]
            band = int(block["band"].iloc[0])
            joined: dict[int, int] = {}
            for row in outside.itertuples(index=False):
                own = np.frombuffer(row.registers, "<u2")
                n = float(row.n_shingles)
                part = joined.get(row.component, row.component)
                fits = (parts != part) & (np.minimum(sizes, n) >= least * np.maximum(sizes, n) - 1e-9)
                fits &= (registers == own).sum(1) >= floor
                if band and fits.any():
                    # Pairs that met in an earlier band are compared there.
                    fits &= ~(keys[:, :band] == S.band_keys(own)[:band]).any(1)
                at = np.flatnonzero(fits)
                if not len(at):
                    continue
                other = registers[at]
                at = at[S.plausible(
                    (own > other).sum(1), (own < other).sum(1), np.full(len(at), n), sizes[at], least
                )]
                if not len(at):
                    continue
                members = np.frombuffer(row.members, np.uint64)
                both = common(members, [sets[i] for i in at])
                for i in at[100 * both >= percent * (n + sizes[at] - both)].tolist():
                    if parts[i] != part:
                        found.append((min(row.rep, int(ids[i])), max(row.rep, int(ids[i]))))
                        joined = {k: part if v == parts[i] else v for k, v in joined.items()}
                        joined[int(parts[i])] = part
                        parts[parts == parts[i]] = part
        return pd.DataFrame(sorted(set(found)), columns=["a", "b"], dtype="int64")

    return compare


def common(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members each of the other sets shares with one; all sets are sorted."""
    flat = np.concatenate(others)
    place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    return np.add.reduceat((own[place] == flat).astype(np.int64), np.cumsum([0, *map(len, others[:-1])]))


class _Job:
    """The steps over one collection; everything between them is staged."""

    def __init__(self, docs: DataFrame, percent: int):
        self.texts, self.percent = text_rows(docs).withColumn("text_key", text_key(F.col("text"))), percent
        # Rows without id name no document: they are linked with nothing.
        raw = staged(map_rows(self.texts, _sketched, SKETCHES, rows=4096), "sketches")
        # Aggregates are staged before they are joined: a join on two plain shuffles splits hot keys.
        self.classes = staged(
            raw.where("digest IS NOT NULL AND doc_id IS NOT NULL")
            .groupBy("digest").agg(F.min(F.struct("doc_id", "text_key")).alias("low"))
            .select("digest", F.monotonically_increasing_id().alias("rep"), "low.doc_id", "low.text_key"), "named",
        )
        named = self.classes.select("digest", "rep", F.col("doc_id").alias("low"), F.col("text_key").alias("low_key"))
        first = (F.col("doc_id") == F.col("low")) & (F.col("text_key") == F.col("low_key"))
        # Rows of no class get a number that no class has.
        joined = raw.join(named, "digest", "left").select(
            "doc_id", "text_key", "n_shingles", F.coalesce("rep", -1 - F.abs("doc_id")).alias("rep"),
            F.when(first, F.col("registers")).alias("registers"),
        )
        self.rows = staged(joined, "classes")
        self.reps = (
            self.rows.where("registers IS NOT NULL")
            .select("rep", "n_shingles", "registers").dropDuplicates(["rep", "n_shingles", "registers"])
        )

    def buckets(self) -> DataFrame:
        """(band, key, rep, score) where at least two classes share a band."""
        banded = map_rows(
            self.reps.select("rep", "registers"), _banded, fields("band int, key long, rep long"),
            rows=1 << 15,
        )
        ends = F.min("rep").alias("low"), F.max("rep").alias("high")
        shared = staged(
            banded.groupBy("band", "key").agg(F.count("*").alias("n"), *ends)
            .where("low < high").select("band", "key", "n"), "shared",
        )
        met = staged(banded.join(shared, ["band", "key"]), "met")
        scores = met.groupBy("rep").agg(F.sum("n").alias("score"))
        return staged(met.join(scores, "rep").select("band", "key", "rep", "score"), "buckets")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose registers and sizes leave the similarity plausible."""
        named = [
            self.reps.toDF(side, f"n_{side}", f"registers_{side}") for side in ("a", "b")
        ]
        return map_rows(
            pairs.join(named[0], "a").join(named[1], "b"), _estimated, PLAUSIBLE,
            self.percent / 100, most_chars=4 << 20,
        )

    def full_sets(self, buckets: DataFrame) -> DataFrame:
        """The full sets of all that stand in a bucket, by the one pass that moves texts."""
        # By merge at every size: a side that fits a broadcast today is no measure of tomorrow's.
        met = buckets.select("rep").distinct()
        wanted = staged(self.classes.join(met, "rep").select("rep", "doc_id", "text_key"), "wanted").hint("merge")
        keys = ["doc_id", "text_key"]
        texts = self.texts.join(wanted, keys).dropDuplicates(keys).select("rep", "text")
        return staged(map_rows(texts, _sets, SETS, rows=256), "sets")

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs whose full sets reach the similarity, staged."""
        ready = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        return staged(
            map_rows(ready, _confirmed, PLAUSIBLE, self.percent, most_chars=8 << 20).distinct(), "links"
        )

    def hub_pairs(self, buckets: DataFrame) -> DataFrame:
        hubs = staged(
            buckets.groupBy("band", "key").agg(
                F.max(F.struct("score", (-F.col("rep")).alias("low"))).alias("hub")
            ).select("band", "key", (-F.col("hub.low")).alias("hub")), "hubs",
        )
        met = buckets.join(hubs, ["band", "key"]).where("rep <> hub")
        return met.select(
            F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")
        ).distinct()

    def missed_links(self, buckets: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between different components of a bucket."""
        parted = staged(
            buckets.join(labels.toDF("rep", "found"), "rep", "left")
            .select("band", "key", "rep", F.coalesce("found", "rep").alias("component")), "parted",
        )
        by_part = parted.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
        open_ = staged(
            by_part.groupBy("band", "key").agg(
                F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("main"),
                F.count("*").alias("parts"),
            ).where("parts > 1").select(
                "band", "key", "all", (F.col("all") - F.col("main.n")).alias("outside"),
                F.col("main.component").alias("main"),
            ), "mixed",
        )
        rows = staged(parted.join(open_, ["band", "key"]), "open")
        few = rows.where(F.col("all") <= FEW)
        inner = few.select("band", "key", F.col("rep").alias("b"), F.col("component").alias("theirs"))
        pairs = few.where("component <> main").join(inner, ["band", "key"]).where(
            "component <> theirs"
        ).select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct()
        return self.confirmed(self.estimated(pairs), sets).union(self._large(rows, sets))

    def _large(self, rows: DataFrame, sets: DataFrame) -> DataFrame:
        rows = rows.where(F.col("all") > FEW)
        if rows.isEmpty():
            return rows.select(F.col("rep").alias("a"), F.col("rep").alias("b"))
        full = rows.join(self.reps, "rep").join(sets, "rep").withColumn(
            "wide", F.ceil(F.col("all") / BLOCK).cast("int")
        ).withColumn("high", F.ceil(F.col("outside") / BLOCK).cast("int"))
        column = F.pmod(F.xxhash64("rep"), F.col("wide")).cast("int")
        line = F.pmod(F.xxhash64("rep"), F.col("high")).cast("int")
        kept = ("band", "key", "rep", "component", "n_shingles", "registers", "members")
        inside = full.select(
            *kept, F.lit(False).alias("outer"), column.alias("x"),
            F.explode(F.sequence(F.lit(0), F.col("high") - 1)).alias("y"),
        )
        outside = full.where("component <> main").select(
            *kept, F.lit(True).alias("outer"),
            F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("x"), line.alias("y"),
        )
        return staged(
            inside.unionByName(outside).groupBy("band", "key", "x", "y")
            .applyInPandas(_block_links(self.percent), PLAUSIBLE), "links",
        )


def text_key(text: Column) -> Column:
    """Tells the texts of one doc_id apart; never used without the doc_id."""
    return F.xxhash64(text)


def _judged(docs: DataFrame, percent: int) -> DataFrame:
    """Per input row: doc_id, text_key, n_shingles, component_id, and whether its class is its component's first."""
    job = _Job(docs, percent)
    buckets = job.buckets()
    sets = job.full_sets(buckets)
    links = job.confirmed(job.estimated(job.hub_pairs(buckets)), sets)
    missed = job.missed_links(buckets, components(links), sets)
    labels = components(links.union(missed))
    classed = staged(
        job.classes.join(labels.toDF("rep", "found"), "rep", "left")
        .select("rep", "doc_id", F.coalesce("found", "rep").alias("part")), "classed",
    )
    parts = staged(classed.groupBy("part").agg(F.min(F.struct("doc_id", "rep")).alias("first")), "parts")
    told = staged(classed.join(parts, "part").select(
        "rep", F.col("first.doc_id").alias("component_id"), (F.col("first.rep") == F.col("rep")).alias("first")
    ), "told")
    return job.rows.join(told, "rep", "left").select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce("first", F.lit(True)).alias("first"),
    )


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked when ``100 * common >= percent * united`` shingles; component_id is the
    smallest doc_id reachable, kept marks that document. Null and empty texts have no shingles and
    are linked with nothing; rows without id have no component and are kept. Rows that repeat a doc_id with
    another text are documents of their own: each has the component of its text. An empty table gives none,
    further columns are ignored.
    """
    return _judged(docs, percent).select("doc_id", "n_shingles", "component_id").withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of every group, with all its columns.

    It is the one with the group's smallest doc_id. Of rows that repeat both doc_id and text one stays, whatever
    their other columns; a repeated doc_id with a text of another group stays. Rows without id stay, and
    so do null and empty texts, one per doc_id. An empty table gives none.
    """
    keys = ["doc_id", "text_key"]
    mine = F.col("first") & (F.col("doc_id") == F.col("component_id"))
    verdicts = staged(
        _judged(docs, percent).where("doc_id IS NOT NULL").select(*keys, mine.alias("chosen")), "verdicts"
    )
    gone = verdicts.where("NOT chosen").select(*keys).distinct().hint("merge")
    def rows_without(frame: DataFrame, other: DataFrame, how: str) -> DataFrame:
        given = frame.select(*(F.col(f"`{c}`") for c in docs.columns))
        on = (other["doc_id"] == given["doc_id"].cast("long")) & (other["text_key"] == text_key(given["text"].cast("string")))
        return given.join(other, on, how)

    left = rows_without(docs, gone, "left_anti")
    twice = staged(
        verdicts.where("chosen").groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys), "twice"
    )
    if twice.isEmpty():
        return left
    again = rows_without(left, twice, "left_semi")
    single = rows_without(left, twice, "left_anti")
    return single.unionByName(_one_each(again, docs.columns))


def _one_each(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per doc_id and text."""
    return rows.dropDuplicates(["doc_id", "text"]).select(*columns)
