import itertools
import random

import numpy as np
import xxhash

from candlemill.llm import gray_index, simhash

from .conftest import ODD


def plain_fingerprint(text):
    words = simple_words(text or "")
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def simple_words(text):
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\r\x0b\f":
            if word:
                words.append(word)
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return words


def plain_components(codes, most=2):
    """Smallest doc_id reachable, by all pairs; codes are (doc_id, code)."""
    ids = list(range(len(codes)))

    def top(i):
        while ids[i] != i:
            i = ids[i]
        return i

    for i, j in itertools.combinations(range(len(codes)), 2):
        if (codes[i][1] ^ codes[j][1]).bit_count() <= most:
            a, b = top(i), top(j)
            ids[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(codes):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return [least.get(top(i)) for i in range(len(codes))]


def test_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    codes = [(i, plain_fingerprint(t)) for i, t in ODD]
    wanted = sorted(
        ((i, f"{code:016x}", c) for (i, code), c in zip(codes, plain_components(codes), strict=True)), key=repr
    )
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=repr) == wanted
    assert simhash.near_duplicates(none).count() == 0


def test_all_pairs_over_many_blocks(documents, monkeypatch):
    """Small blocks, so that the hierarchy has several levels; close codes, chains and copies."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "FAN", 4)
    random.seed(3)
    seeds = [" ".join(random.choices("abcdefghij", k=random.randint(1, 60))) for _ in range(150)]
    docs = []
    for i, seed in enumerate(seeds):
        for k in range(random.randint(1, 5)):
            words = seed.split()
            for _ in range(k % 3):
                words[random.randrange(len(words))] = random.choice("klm")
            docs.append((1000 - i * 5 - k, " ".join(words)))
    rows = {r.doc_id: r for r in simhash.near_duplicates(documents(docs)).collect()}
    codes = [(i, plain_fingerprint(t)) for i, t in docs]
    assert len(rows) == len(docs)
    for (doc_id, code), component in zip(codes, plain_components(codes), strict=True):
        assert (rows[doc_id].fingerprint, rows[doc_id].component_id) == (f"{code:016x}", component)


def test_index_finds_every_pair():
    rng = np.random.default_rng(5)
    hubs = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (40, 30, 3), dtype=np.uint64)) * rng.integers(0, 2, (40, 30, 3), dtype=np.uint64)
    codes = np.unique(np.bitwise_xor.reduce(flips, axis=2) ^ hubs[:, None])
    codes = codes[np.argsort(gray_index.gray_rank(codes))]
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    index = gray_index.Index(codes)
    a, b = gray_index.within(index, index, 2, same=True)
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == sorted(
        (i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(apart <= 2)), strict=True) if i < j
    )
    half = len(codes) // 3
    a, b = gray_index.within(gray_index.Index(codes[:half]), gray_index.Index(codes[half:]), 2)
    assert len(a) == (apart[:half, half:] <= 2).sum()
    assert (apart[a, b + half] <= 2).all()


def test_ranks_follow_the_gray_sequence():
    places = np.arange(1 << 10, dtype=np.uint64)
    assert (gray_index.gray_rank(places ^ (places >> np.uint64(1))) == places).all()


def test_stars_join_what_links_join():
    random.seed(9)
    links = [(random.randrange(200), random.randrange(200)) for _ in range(150)]
    links += [(i, i + 1) for i in range(300, 399)]
    a, b = map(np.array, zip(*links, strict=True))
    low, at = gray_index.stars(a, b, 400)

    def parts(pairs):
        label = list(range(400))
        for _ in range(400):
            for x, y in pairs:
                label[x] = label[y] = min(label[x], label[y])
        return label

    assert parts(links) == parts(list(zip(low.tolist(), at.tolist(), strict=True)))
    assert len(low) == sum(1 for i, x in enumerate(parts(links)) if i != x)
