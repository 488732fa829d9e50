"""The prefix trie of conversations, by adaptive radix trees over fixed-width turn ids.

1. Every distinct turn (role, text) gets a number; a conversation is the string of its turns' numbers,
   eight big-endian bytes each. Texts stay behind: from here on only these keys move.
2. Equal keys are one row with a count. The rows are sorted by range over all machines; each stretch
   of a partition goes into one radix tree, and only byte depths that end a turn give trie nodes.
3. A trie node is named by the SHA-256 of its key. What a tree knows of a node (members, children,
   leaves, saved tokens) is a sum over the tree's keys, so nodes that several trees share are added up.
   What both trees counted, the nodes that a tree's first key shares with the key before it, is
   taken off again; between partitions this needs one row per partition.
4. Conversations that end in a node are sorted by range too, joined into texts of bounded length where
   they lie, and these run through one SHA-256 per node in their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlemill.llm.radix import Tree, common
from candlemill.llm.shared import fields, map_parts, map_rows, parts_of, staged

WIDTH = 8
"""Bytes of a turn's number."""
TREE_KEYS = 1 << 14
"""Keys of one radix tree."""
TREE_BYTES = 8 << 20
"""Bytes of one tree's keys; a longer key has a tree of its own."""
PIECE = 1 << 16
"""Characters of joined conv_ids in one row."""
WORDS = r"[^\x20\x09-\x0D]+"

KEYS = fields("conv_id long, key binary, sizes binary")
PARTIALS = fields(
    "name binary, parent binary, depth long, low long, n long, kids long, leaves long, saved long, "
    "part long, first binary, first_sizes binary, last binary"
)
ENDS = fields("name binary, conv_id long, piece string")
HASHES = fields("name binary, ends_sha256 string")


def sequences(conversations: DataFrame) -> DataFrame:
    """Per conversation its key and its turns' word counts, eight bytes a turn: conv_id, key, sizes.

    Turns go by number, null first; equal numbers by role, then by a digest of the text. Null role or text is
    empty; rows without conv_id belong to none and go. A task holds the ids of one conversation at a
    time, never its texts.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    named = staged(turns.select(
        "conv_id", "turn", "role", F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"),
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
        .alias("name"),
    ), "turns")
    # Numbers are dense inside a partition; staged, so that all readers see the same.
    numbers = staged(
        named.groupBy("name").agg(F.first("words").alias("size"))
        .select("name", "size", F.monotonically_increasing_id().alias("number")), "numbers",
    )
    numbered = named.join(numbers, "name").select("conv_id", "turn", "role", "name", "number", "size")
    sorted_turns = (
        numbered.repartition(parts_of(conversations.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "name").select("conv_id", "number", "size")
    )
    return staged(map_parts(sorted_turns, _strung, KEYS, rows=1024), "sequences")


def _strung(parts: Iterator[dict]) -> Iterator[tuple]:
    own, key, sizes = None, bytearray(), bytearray()
    for columns in parts:
        for conv_id, number, size in zip(
            columns["conv_id"], columns["number"], columns["size"], strict=True
        ):
            if conv_id != own and own is not None:
                yield own, bytes(key), bytes(sizes)
                key, sizes = bytearray(), bytearray()
            own = conv_id
            key += number.to_bytes(WIDTH, "big")
            sizes += size.to_bytes(WIDTH, "big")
    if own is not None:
        yield own, bytes(key), bytes(sizes)


def with_shared_heads(keys: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin with the first turns of another, then go on with their own.

    The first h turns come from conversation ``conv_id - conv_id % every`` (all if it has fewer, none
    if there is none), with h = crc32(conv_id as text) % ``most``; own turns follow after the first h.
    """
    heads = keys.select(
        F.col("conv_id").alias("base"), F.substring("key", 1, WIDTH * most).alias("head"),
        F.substring("sizes", 1, WIDTH * most).alias("head_sizes"),
    )
    taken = (F.crc32(F.col("conv_id").cast("string")) % most * WIDTH).cast("int")
    joined = (
        keys.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
        .withColumn("taken", taken).join(heads, "base", "left")
    )

    def rebuilt(own: str, head: str):
        front = F.coalesce(F.substr(head, F.lit(1), F.col("taken")), F.lit("").cast("binary"))
        return F.concat(front, F.substr(own, F.col("taken") + 1)).alias(own)

    return staged(joined.select("conv_id", rebuilt("key", "head"), rebuilt("sizes", "head_sizes")), "rebuilt")


def _size(sizes: bytes, depth: int) -> int:
    """Words of the turn that ends at a depth; the root has none."""
    return int.from_bytes(sizes[(depth - 1) * WIDTH : depth * WIDTH], "big") if depth else 0


def _names(key: bytes, start: int, end: int, hasher) -> list[tuple[int, bytes]]:
    """(depth, name) of the turn ends after byte ``start`` up to ``end``; the hasher has read so far."""
    found, at = [], start
    for stop in range(start // WIDTH * WIDTH + WIDTH, end + 1, WIDTH):
        hasher.update(key[at:stop])
        found.append((stop // WIDTH, hasher.digest()))
        at = stop
    hasher.update(key[at:end])
    return found


def _walk(tree: Tree, rows: list[tuple]) -> Iterator[tuple]:
    """The trie nodes of one tree, each after those below it, as PARTIALS."""
    start = hashlib.sha256()
    # Open: node, its key's length, names on its path, the nearest name above, children yet to visit, and what is summed.
    root = [(0, start.digest())]
    open_ = [_opened(tree.root, 0, root, None, start)]
    while open_:
        top = open_[-1]
        if top["todo"]:
            kid = top["todo"].pop()
            row = _some_row(kid)
            begin, end = top["end"], top["end"] + 1 + len(kid.path)
            hasher = top["hasher"].copy()
            names = _names(rows[row][0], begin, end, hasher)
            above = top["names"][-1][1] if top["names"] else top["above"]
            open_.append(_opened(kid, end, names, above, hasher))
            continue
        open_.pop()
        node = top["node"]
        n, low, leaves = top["n"], top["low"], top["leaves"]
        if node.row is not None:
            n, low = n + rows[node.row][2], min(x for x in (low, rows[node.row][3]) if x is not None)
        leaves = leaves or 1
        saved, heads = top["saved"], top["heads"]
        sizes = rows[_some_row(node)][1] if rows else b""
        for i in range(len(top["names"]) - 1, -1, -1):
            depth, name = top["names"][i]
            saved += (n - 1) * _size(sizes, depth)
            parent = top["names"][i - 1][1] if i else top["above"]
            yield name, parent, depth, low, n, heads, leaves, saved, None, None, None, None
            heads = 1
        if open_:
            up = open_[-1]
            up["n"] += n
            up["low"] = low if up["low"] is None else min(up["low"], low)
            up["leaves"] += leaves
            up["saved"] += saved
            up["heads"] += heads


def _opened(node, end: int, names: list, above, hasher) -> dict:
    return {
        "node": node, "end": end, "names": names, "above": above, "hasher": hasher,
        "todo": node.kids()[::-1], "n": 0, "low": None, "leaves": 0, "saved": 0, "heads": 0,
    }


def _some_row(node) -> int:
    while node.row is None:
        node = next(iter(node.links.pairs()))[1]
    return node.row


def _taken_off(last: bytes, first: bytes, sizes: bytes) -> Iterator[tuple]:
    """What two trees counted twice, where one ends with a key and the next begins with another."""
    depth = common(last, first) // WIDTH
    names = [(0, hashlib.sha256().digest()), *_names(first, 0, depth * WIDTH, hashlib.sha256())]
    leaf = -1 if len(last) == depth * WIDTH else 0
    back = 0
    for d in range(depth, -1, -1):
        back += _size(sizes, d)
        parent = names[d - 1][1] if d else None
        yield names[d][1], parent, d, None, 0, -1 if d < depth else 0, leaf, back, None, None, None, None


def _grown(parts: Iterator[dict]) -> Iterator[tuple]:
    """Sorted keys in, partial trie nodes out, and one row with the partition's first and last key."""
    tree, rows, size = Tree(), [], 0
    first = last = None
    for columns in parts:
        for row in zip(columns["key"], columns["sizes"], columns["n"], columns["low"], strict=True):
            key = row[0]
            if rows and (len(rows) >= TREE_KEYS or size + len(key) > TREE_BYTES):
                yield from _walk(tree, rows)
                yield from _taken_off(last, key, row[1])
                tree, rows, size = Tree(), [], 0
            first = row if first is None else first
            tree.insert(key, len(rows))
            rows.append(row)
            size += len(key)
            last = key
    if rows:
        yield from _walk(tree, rows)
        part = TaskContext.get().partitionId()
        yield (*(None,) * 8, part, first[0], first[1], last)


def _between(columns: dict) -> Iterator[tuple]:
    for last, first, sizes in zip(
        columns["before"], columns["first"], columns["first_sizes"], strict=True
    ):
        yield from _taken_off(last, first, sizes)


def trie(keys: DataFrame) -> DataFrame:
    """The nodes of the trie over (conv_id, key, sizes), one row each.

    name (SHA-256 of the node's key), conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. A conversation without turns ends in the root;
    without conversations there are no nodes.
    """
    parts = parts_of(keys.sparkSession)
    distinct = keys.groupBy("key").agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("low")
    )
    ranged = distinct.repartitionByRange(parts, "key").sortWithinPartitions("key")
    partial = staged(map_parts(ranged, _grown, PARTIALS), "partials")
    # One row per partition: the key before its first is the last one of the partition before.
    edges = partial.where("part IS NOT NULL").withColumn(
        "before", F.lag("last").over(Window.orderBy("part"))
    ).where("before IS NOT NULL").select("before", "first", "first_sizes")
    twice = map_rows(edges, _between, PARTIALS)
    nodes = staged(
        partial.where("part IS NULL").unionByName(twice).groupBy("name").agg(
            F.first("parent", True).alias("parent"), F.max("depth").alias("depth"),
            F.min("low").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("kids").alias("n_children"),
            F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
        ), "nodes",
    )
    parents = nodes.where("n_children > 0").select(
        F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    ends = staged(_ends(keys, parts), "ends")
    placed = staged(nodes.join(parents, "parent", "left"), "placed")
    none = F.lit(hashlib.sha256().hexdigest())
    return placed.join(ends, "name", "left").select(
        "name", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


def _ends(keys: DataFrame, parts: int) -> DataFrame:
    """Per node in which conversations end: the hash of their ids, ascending, joined by commas."""
    ended = keys.select(F.unhex(F.sha2("key", 256)).alias("name"), "conv_id")
    ranged = ended.repartitionByRange(parts, "name", "conv_id").sortWithinPartitions("name", "conv_id")
    pieces = map_parts(ranged, _joined, ENDS, rows=256)
    together = pieces.repartition(parts, "name").sortWithinPartitions("name", "conv_id")
    return map_parts(together, _hashed, HASHES)


def _joined(parts: Iterator[dict]) -> Iterator[tuple]:
    own, first, ids, size = None, None, [], 0
    for columns in parts:
        for name, conv_id in zip(columns["name"], columns["conv_id"], strict=True):
            if ids and (name != own or size >= PIECE):
                yield own, first, ",".join(ids)
                ids, size = [], 0
            if not ids:
                own, first = name, conv_id
            ids.append(str(conv_id))
            size += len(ids[-1]) + 1
    if ids:
        yield own, first, ",".join(ids)


def _hashed(parts: Iterator[dict]) -> Iterator[tuple]:
    own, hasher = None, None
    for name, piece in chain.from_iterable(
        zip(c["name"], c["piece"], strict=True) for c in parts
    ):
        if name != own:
            if own is not None:
                yield own, hasher.hexdigest()
            own, hasher = name, hashlib.sha256()
        else:
            hasher.update(b",")
        hasher.update(piece.encode())
    if own is not None:
        yield own, hasher.hexdigest()
