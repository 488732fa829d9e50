import random
import re

import numpy as np
import pytest

from candlemill.llm import graph, near_dup, setsketch
from candlemill.llm.shared import table

from .conftest import ODD, rows_of

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([" ".join(words)]) if words else frozenset()
    return frozenset(" ".join(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, percent):
    """All pairs of all rows; rows without id are linked with nothing."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for at, (i, s) in enumerate(sets):
        for j, t in sets[:at]:
            both = len(s & t)
            if i is not None and j is not None and both and 100 * both >= percent * (len(s) + len(t) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted(
        ((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=repr
    )


def near_copies(n, source, words=80):
    """A base text and copies with more and more words changed, some of them copies of copies."""
    base = [f"w{source.randint(0, 10**6)}" for _ in range(words)]
    texts = [base]
    for _ in range(n - 1):
        text = list(source.choice(texts[:1] * 3 + texts))
        for _ in range(source.randint(0, 4)):
            text[source.randrange(len(text))] = f"x{source.randint(0, 10**6)}"
        texts.append(text)
    return [" ".join(t) for t in texts]


def test_odd_rows(odd, none):
    assert rows_of(near_dup.near_duplicates(odd, 85), *COLUMNS) == brute(ODD, 85)
    assert near_dup.near_duplicates(none, 85).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_near_copies_match_all_pairs(documents, percent, monkeypatch):
    """Small limits, so that buckets are compared in several blocks."""
    monkeypatch.setattr(near_dup, "FEW", 8)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    source = random.Random(percent)
    texts = near_copies(110, source) + near_copies(20, source, 12) + near_copies(5, source, 400)
    texts += texts[::9] + [t.upper() for t in texts[::13]]
    source.shuffle(texts)
    rows = list(enumerate(texts, 100))
    got = rows_of(near_dup.near_duplicates(documents(rows), percent), *COLUMNS)
    want = brute(rows, percent)
    assert len({r[2] for r in want}) > 3
    assert got == want


def test_one_of_each_group_stays(documents):
    source = random.Random(3)
    texts = near_copies(12, source)
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[0]), (50, None)]
    kept = near_dup.keep_one(documents(rows), 80)
    groups = {r[2] for r in brute(rows, 80)}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(groups, key=repr)


def test_texts_of_one_doc_id_are_told_apart(documents):
    """A repeated doc_id loses no text: copies of another document go, a text of its own stays."""
    a, b, c = near_copies(1, random.Random(5))[0], "another text altogether, of its own words", "x y z"
    docs = documents([(3, a), (7, a), (7, b), (7, b), (8, b), (9, None), (9, ""), (None, b), (2, c), (2, f"{a} end")])
    kept = sorted(((r.doc_id, r.text) for r in near_dup.keep_one(docs, 80).collect()), key=repr)
    assert kept == sorted([(7, b), (9, None), (9, ""), (None, b), (2, c), (2, f"{a} end")], key=repr)
    got = rows_of(near_dup.near_duplicates(docs, 80), "doc_id", "component_id")
    assert got == sorted(
        [(3, 2), (7, 2), (7, 7), (7, 7), (8, 7), (9, 9), (9, 9), (None, None), (2, 2), (2, 2)], key=repr
    )


def test_shared_passages_alone_are_no_links(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(near_dup.near_duplicates(docs, 85), *COLUMNS) == brute(rows, 85)


def test_registers_merge_and_estimate():
    source = np.random.default_rng(4)
    pool = setsketch.mix(source.integers(0, 2**63, 3000).astype(np.uint64))
    for shared in (0, 500, 900, 1000):
        a, b = pool[:1000], np.concatenate([pool[:shared], pool[1000 : 2000 - shared]])
        both = np.concatenate([a, b])
        one, other, union = setsketch.sketch(np.concatenate([a, b, both]), np.array([0, 1000, 2000]))
        assert (setsketch.merge(one, other) == union).all()
        true = shared / (2000 - shared)
        size = np.array([1000.0])
        above, below = np.array([(one > other).sum()]), np.array([(one < other).sum()])
        values = [setsketch.log_likelihood(above, below, size, size, np.array([j / 100]))[0] for j in range(101)]
        assert abs(int(np.argmax(values)) / 100 - true) < 0.15
        assert setsketch.plausible(above, below, size, size, 0.85)[0] == (true > 0.6)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (3, 2)]
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: 0 if i < 100 else 100 for i in [*range(41), *range(100, 130)]}
