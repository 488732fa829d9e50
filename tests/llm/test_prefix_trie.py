import collections
import hashlib
import random
import re
import zlib

import pytest

from candlemill.llm import prefix_trie, radix

TURNS = "conv_id long, turn long, role string, text string, n_convs long, key string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def plain_nodes(rows, heads=True):
    """The nodes by definition: prefixes as tuples, subtrees by comparing all of them."""
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", hashlib.sha256(
                f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if heads else 0
        rebuilt[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    size = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in members}
    kids = collections.Counter(p[:-1] for p in members if p)
    found = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(p))
        found.append((
            min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), kids[p],
            sum(1 for q in below if not kids[q]), sum((len(members[q]) - 1) * size[q] for q in below),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def got(spark, rows, heads=True):
    frame = spark.createDataFrame([(*r, None, "taken") for r in rows], TURNS)
    keys = prefix_trie.sequences(frame)
    nodes = prefix_trie.trie(prefix_trie.with_shared_heads(keys) if heads else keys).drop("name")
    assert nodes.columns == COLUMNS
    return sorted((tuple(r) for r in nodes.collect()), key=repr)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "Hi  there\x0b you"), (1, 1, None, None), (2, None, "user", "first"), (2, 0, "user", "then"),
        (3, 0, "user", "same"), (3, 0, "user", "same"), (None, 0, "user", "of no conversation"), (20, 5, "user", ""),
        (21, 0, "assistant", "a b c"), (39, 1, "user", "q"), (40, 0, "ab", "c"), (60, 0, "a", "bc"), (-7, 0, "user", "x y"),
    ]
    rows += [(21, i, "user", f"turn {i}") for i in range(1, 30)] + [(80, i, "user", "again") for i in range(200)]
    rows += [(100, i, "user", "again") for i in range(180)]
    for heads in (True, False):
        assert got(spark, rows, heads) == plain_nodes(rows, heads)
    assert got(spark, []) == []


@pytest.mark.parametrize("keys", [1, 3, 1000])
def test_prefixes_over_many_trees(spark, monkeypatch, keys):
    """Few keys a tree, so that most nodes are shared by trees and by partitions."""
    monkeypatch.setattr(prefix_trie, "TREE_KEYS", keys)
    random.seed(keys)
    rows, told = [], {}
    for c in range(160):
        front = told[random.randrange(c)][: random.randint(0, 6)] if c and random.random() < 0.7 else []
        told[c] = front + [(random.choice("ab"), " ".join("w" * random.randint(0, 4))) for _ in range(random.randint(0, 3))]
        told[c] = told[c] or [("a", "only")]
        rows += [(c, i, *t) for i, t in enumerate(told[c])]
    random.shuffle(rows)
    assert got(spark, rows, heads=False) == plain_nodes(rows, heads=False)
    assert got(spark, rows) == plain_nodes(rows)


def test_a_hot_conversation_is_one_path(spark):
    rows = [(c, i, "user", f"turn {i}") for c in range(600) for i in range(5)] + [(900, 0, "user", "other")]
    assert got(spark, rows, heads=False) == plain_nodes(rows, heads=False)


def test_ids_are_hashed_in_order_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 20)
    rows = [(c, 0, "user", "same") for c in range(95, 1200)]
    root, node = sorted(got(spark, rows, heads=False), key=lambda r: r[1])
    assert node[-1] == hashlib.sha256(",".join(map(str, range(95, 1200))).encode()).hexdigest()
    assert root[-1] == hashlib.sha256(b"").hexdigest()


def test_tree_keeps_keys_and_order():
    """All layouts: nodes with 3, 10, 40 and 256 children, and keys that are fronts of others."""
    random.seed(2)
    keys = {bytes([1, b]) for b in range(256)} | {bytes([2, b]) for b in range(40)} | {bytes([3, b]) for b in range(10)}
    keys |= {bytes([4, b]) for b in range(3)} | {b"", bytes([2]), bytes([9]) * 500, bytes([9]) * 300 + b"x"}
    keys |= {bytes(random.choices(range(4), k=random.randint(0, 12))) for _ in range(500)}
    order = sorted(keys)
    shuffled = random.sample(order, len(order))
    tree = radix.Tree()
    for key in shuffled:
        tree.insert(key, shuffled.index(key))
    found, open_, layouts = [], [(tree.root, b"")], set()
    while open_:
        node, path = open_.pop()
        if node.row is not None:
            found.append(path)
            assert shuffled[node.row] == path
        layouts.add((type(node.links), getattr(node.links, "most", None)))
        open_ += [(kid, path + bytes([b]) + kid.path) for b, kid in (list(node.links.pairs())[::-1] if node.links else ())]
    assert found == order
    assert layouts == {(radix.Few, 4), (radix.Few, 16), (radix.Indexed, None), (radix.Full, None), (type(None), None)}
