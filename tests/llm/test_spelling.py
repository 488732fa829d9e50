import collections
import random
import re
import zlib

from candlemill.llm import spelling

from .conftest import ODD

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def plain_words(docs):
    """Words and counts by the contract, one code point at a time."""
    counts = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                low = "".join(c for i, c in enumerate(low) if i != h % len(low))
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(docs):
    words = plain_words(docs)
    found = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)] for w in words}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(
        ((w, form[w], root(w), n, len(found[w]), words.get(form[w])) for w, n in words.items()), key=repr
    )


def got(docs):
    frame = spelling.variants(docs)
    assert frame.columns == COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_odd_rows(documents, odd, none):
    assert got(odd) == plain_variants(ODD)
    assert got(none) == []


def test_every_near_word_by_all_pairs(documents):
    """Runs of equal letters, upper case beyond ASCII, chains of forms, ties, words that are fronts of others."""
    random.seed(1)
    stems = ["aaaaaaa", "abababa", "bookkeeper", "éÉtudiant", "straßen", "zzzzzzzz", "committee", "übergröße"]
    words = collections.Counter()
    for stem in stems:
        words[stem] += 300
        for size in (30, 2):
            for _ in range(12):
                word = list(stem)
                for _ in range(random.choice((1, 1, 2))):
                    at = random.randrange(len(word))
                    change = random.choice("idr")
                    if change == "d" and len(word) > 6:
                        del word[at]
                    elif change == "i":
                        word.insert(at, random.choice("abzéÉß"))
                    else:
                        word[at] = random.choice("abzéÉß")
                words["".join(word)] += size
    spoken = [w if random.random() < 0.8 else w.capitalize() for w, n in words.items() for _ in range(n)]
    random.shuffle(spoken)
    docs = [(i, " ".join(spoken[i::40])) for i in range(40)] + [(None, "bookkeeper bookkeepers×bookkeepers"), (3, "bookkeepr")]
    wanted = plain_variants(docs)
    assert got(documents(docs)) == wanted
    assert sum(r[1] is not None for r in wanted) > 40 and any(r[1] != r[2] for r in wanted if r[1])


def test_a_long_run_is_a_word(documents):
    long = "".join(random.Random(4).choices("abcdé", k=40_000))
    docs = [(1, long), (2, f"{long} {long}x"), (3, f"{long}x"), (4, long[:100] + long[101:]), (5, long[:100] + long[101:])]
    assert got(documents(docs)) == plain_variants(docs)


def test_fronts_shared_by_partitions_have_one_number():
    edges = [(2, "anders", "andorra", [0, 7, 8, 9, 20, 21, 22, 23]), (5, "andy", "andy", [0, 1, 2, 3, 4]), (9, "bea", "bea", [0, 1, 2, 3])]
    two, five = 3 << 40, 6 << 40
    edges[0] = (2, "anders", "andorra", [0, two + 1, two + 2, two + 3, two + 7, two + 8, two + 9, two + 10])
    edges[1] = (5, "andy", "andyz", [0, five + 1, five + 2, five + 3, five + 4, five + 5])
    assert spelling.renames(edges) == {five + 1: two + 1, five + 2: two + 2, five + 3: two + 3}
