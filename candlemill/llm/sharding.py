"""Balanced label propagation: documents move to their neighbours' shards, within quotas.

Documents that share a link value (here: equal texts) are neighbours. Every document starts in a
shard by hash. In each round a join gives every linked document the shard where most of its
neighbours are and room is left, if that is better than its own; as many follow as that shard's quota admits, whole groups first.
At the end documents beyond a shard's quota, unlinked ones first, fill the places others lack, so
sizes are exactly even. Nodes carry their shard themselves; joins and sums go by link value, with
copies combined before the shuffle, and no edge is ever written out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.shared import staged, utf8_bytes

ROUNDS = 8
LAW = "rows"
GRAIN = 1 << 30
"""Hash steps that a quota is measured in."""


def documents_as_nodes(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, link: the digest of the text; a null text has size 1 and no link."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (utf8_bytes(text) + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("link"),
    )


def shard_nodes(nodes: DataFrame, shards: int = 8, rounds: int = ROUNDS) -> DataFrame:
    """The nodes (any columns, with ``doc_id`` and a nullable ``link``) with shard and slot.

    Shard counts differ by at most one; slots are 0, 1, ... in every shard. Repeated rows are nodes
    of their own. An empty table gives none.
    """
    nodes = staged(nodes, "nodes")
    # Staged, so that the join below stands on two plain shuffles and a hot link can be split.
    counted = nodes.where("link IS NOT NULL").groupBy("link").agg(F.count("*").alias("members"))
    groups = staged(counted.where("members > 1"), "groups")
    begun = nodes.join(groups, "link", "left").withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", F.lit("begin")), F.lit(shards)).cast("int")
    )
    begun = staged(begun, "begun")
    total = begun.count()
    quota = [total // shards + (j < total % shards) for j in range(shards)]
    loose = begun.where("members IS NULL")
    linked = begun.where("members IS NOT NULL")
    for number in range(rounds):
        moved = _round(linked, shards, quota, number)
        if moved is None:
            break
        linked = moved
    return _even(linked.unionByName(loose), shards, quota, total)


def _round(linked: DataFrame, shards: int, quota: list[int], number: int) -> DataFrame | None:
    """One round of moves; None if nobody wants to move."""
    votes = staged(linked.groupBy("link", "shard").agg(F.count("*").alias("votes")), "votes")
    load = {r.shard: r.load for r in votes.groupBy("shard").agg(F.sum("votes").alias("load")).collect()}
    room = [max(0, quota[j] - load.get(j, 0)) for j in range(shards)]
    # A full shard draws nobody: members elsewhere gather at the group's next best one, and between
    # equals those in the full one come over.
    tie = F.pmod(F.xxhash64("link", "shard"), F.lit(1 << 30))
    open_ = _by_shard(F.col("shard"), [int(16 * r > q) for r, q in zip(room, quota, strict=True)]) > 0
    rated = votes.withColumn("here", F.struct("votes", open_.alias("open"), tie.alias("tie"), "shard"))
    best = rated.where(open_).groupBy("link").agg(F.max("here").alias("best"))
    moves = staged(
        rated.join(best, "link").where(F.col("here") < F.col("best"))
        .select("link", "shard", "votes", F.col("best.shard").alias("target")), "moves",
    )
    demand = {r.target: r.n for r in moves.groupBy("target").agg(F.sum("votes").alias("n")).collect()}
    if not demand:
        return None
    admitted = [
        GRAIN if demand.get(j, 0) <= room[j] else GRAIN * room[j] // demand[j] for j in range(shards)
    ]
    # Small groups follow as a whole, members of large ones one by one.
    large = F.col("members") > max(1, min(quota) // 64)
    chance = F.pmod(
        F.when(large, F.xxhash64("link", "doc_id", F.lit(number))).otherwise(F.xxhash64("link", F.lit(number))),
        F.lit(GRAIN),
    )
    follows = F.col("target").isNotNull() & (chance < _by_shard(F.col("target"), admitted))
    return staged(
        linked.join(moves.drop("votes"), ["link", "shard"], "left").withColumn(
            "shard", F.when(follows, F.col("target")).otherwise(F.col("shard"))
        ).drop("target"), "moved",
    )


def _even(nodes: DataFrame, shards: int, quota: list[int], total: int) -> DataFrame:
    """Exact sizes and gapless slots, by ranks counted in buckets and added up over buckets.

    Buckets number about the root of the rows; linked documents come first, groups together, and
    large groups are dealt over all buckets.
    """
    buckets = max(1, math.isqrt(total))
    large = F.col("members") > max(1, buckets)
    deal = F.when(F.col("members").isNull() | large, F.xxhash64("doc_id", F.lit("deal"))).otherwise(
        F.xxhash64("link", F.lit("deal"))
    )
    spread = F.pmod(deal, F.lit(buckets)) + F.when(F.col("members").isNull(), buckets).otherwise(0)
    dealt = staged(nodes.withColumn("bucket", spread.cast("long")), "dealt")
    sums = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("link", "doc_id")
    ranked = (
        dealt.withColumn("nth", F.row_number().over(inside) - 1).join(before, ["shard", "bucket"])
        .withColumn("rank", F.col("before") + F.col("nth"))
    )
    load = {r["shard"]: r["n"] for r in sums.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    over = [max(0, load.get(j, 0) - quota[j]) for j in range(shards)]
    gaps = [max(0, quota[j] - load.get(j, 0)) for j in range(shards)]
    given = [sum(over[:j]) for j in range(shards)]
    surplus = F.col("rank") - _by_shard(F.col("shard"), quota) + _by_shard(F.col("shard"), given)
    stays = F.col("rank") < _by_shard(F.col("shard"), quota)
    # The surplus, numbered over all shards, fills the gaps in order of shards.
    new_shard = F.lit(None).cast("int")
    new_slot = F.lit(None).cast("long")
    for j in reversed(range(shards)):
        until = sum(gaps[: j + 1])
        here = surplus < until
        new_shard = F.when(here, F.lit(j)).otherwise(new_shard)
        new_slot = F.when(here, surplus - (until - gaps[j]) + load.get(j, 0)).otherwise(new_slot)
    return ranked.select(
        *[c for c in nodes.columns if c not in ("shard", "members", "link")],
        F.when(stays, F.col("shard")).otherwise(new_shard).alias("shard"),
        F.when(stays, F.col("rank")).otherwise(new_slot).cast("long").alias("slot"),
    )


def _by_shard(shard: Column, values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), shard + 1)


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``rows``: shard counts are at most one apart. Documents of equal text are linked; a null
    text has no link, an empty one is linked with others. grown_shard is null under this law.
    """
    return shard_nodes(documents_as_nodes(docs), shards).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
