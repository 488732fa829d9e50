import itertools
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from candlemill.llm import bytelevel, packing, token_count
from candlemill.llm.shared import tokenizer_file

from .conftest import ODD, rows_of

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
ALPHABET = "a b\n\t é'sßñ<|>9., \xadﬁ​ 　中文😀\x1c\x85\r\x0bI'llWE'LL'd½²ªºΣσİ̈"


def strings(n, seed):
    source = random.Random(seed)
    for _ in range(n):
        text = "".join(source.choice(ALPHABET) for _ in range(source.randint(0, 14)))
        yield text + "<|endoftext|>" + text if source.random() < 0.1 else text


def test_counts_are_the_librarys_on_odd_strings():
    counter, library = token_count.Counter(BYTES), Tokenizer.from_file(BYTES)
    for text in strings(4000, 1):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_word_ids_are_the_librarys_on_odd_strings():
    ids, library = packing.WordIds(WORDS), Tokenizer.from_file(WORDS)
    for text in strings(4000, 2):
        own = np.frombuffer(ids.encode([text])[0], "<u4").tolist()
        assert own == library.encode(text, add_special_tokens=False).ids, text


def test_word_ids_of_many_texts_at_once_are_the_librarys():
    ids, library = packing.WordIds(WORDS), Tokenizer.from_file(WORDS)
    texts = ["", " \t", *strings(3000, 3), "ÀÉ\xa0éa ﬁ", "ÀÉ\xa0éa,", "İstanbul DON'T"]
    own = [np.frombuffer(b, "<u4").tolist() for b in ids.encode(texts)]
    assert own == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.encode([]) == [] and ids.encode([""]) == [b""]


class Asked(dict):
    """Keeps nothing and lists what it is asked for."""

    def __init__(self, make, seen):
        super().__init__()
        self.make, self.seen = make, seen

    def __getitem__(self, key):
        self.seen.append(key)
        return self.make(key)


def test_a_word_that_comes_again_is_looked_up_once():
    ids, seen = packing.WordIds(WORDS), []
    ids.words, ids.parts = Asked(ids._cut, seen), Asked(ids._part, seen)
    text = "The cat, the dog\xa0and éa AND THE cat, a2"
    assert ids.encode([text, text]) == [ids._whole(text)] * 2
    assert sorted(seen) == sorted(["the", "cat,", "cat", ",", "dog", "and", "éa", "a2", "a", "2"])


def test_agreed_characters_fall_into_the_same_classes():
    pre, words = Tokenizer.from_file(BYTES).pre_tokenizer, packing.WordIds(WORDS)
    for code in [*range(0x250), *range(0x2000, 0x2070)]:
        c = chr(code)
        if bytelevel.AGREED.search(c):
            continue
        text = f"a{c}{c}b 1{c}2 .{c}! {c} {c}"
        assert [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)] == token_count.PRE_TOKEN.findall(text)
        assert words.encode([text])[0] == words._whole(text)


def test_a_memo_forgets_but_stays_right(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    ids = packing.WordIds(WORDS)
    text = "some words that come and go and come again some words"
    assert ids.encode([text, text]) == [ids._whole(text)] * 2
    assert len(ids.words) <= 3


def test_a_memo_keeps_no_more_than_it_says_older_words_included(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 8)
    ids = packing.WordIds(WORDS)
    text = " ".join(f"word{i}x" for i in range(100))
    assert ids.encode([text]) == [ids._whole(text)]
    for memo in (ids.words, ids.parts):
        assert 0 < len(memo) + len(memo.old) <= 8


def test_memos_are_let_go_before_the_search(monkeypatch):
    packing._word_ids(WORDS).encode(["some words"])
    block = pd.DataFrame({
        "doc_id": [1, 2], "piece": 0, "start": 0, "length": [3, 4], "ids_crc32": 0, "salt": [1, 2], "block": 0,
    })
    kept = []
    monkeypatch.setattr(packing.Bins, "search", lambda bins: kept.append(packing._word_ids.cache_info().currsize))
    assert len(packing._pack(block, 8, 0)) == 2
    assert kept == [0]


def test_letters_alone_are_one_pre_token():
    ids = packing.WordIds(WORDS)
    for word in ["Word", "s", "IT", "ll", "é", "éa", "don't", "a1", "\x7f", "~", "K"]:
        assert ids._cut(word) == b"".join(map(ids._part, packing.PRE_TOKEN.findall(word.lower())))


def test_proven_strings_are_single_tokens():
    library = Tokenizer.from_file(BYTES)
    proven = token_count.proven_tokens(BYTES)
    assert " the" in proven and len(proven) > 40_000
    for text in sorted(proven)[::997]:
        assert len(library.encode(text, add_special_tokens=False).ids) == 1


def test_count_tokens_on_odd_rows(odd, none):
    library = Tokenizer.from_file(BYTES)
    got = rows_of(token_count.with_limit(token_count.count_tokens(odd, BYTES), 1024),
                  "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = []
    for key, text in ODD:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((key, len((text or "").encode()), n, n > 1024))
    assert got == sorted(want, key=repr)
    assert token_count.count_tokens(none, BYTES).count() == 0


def check_packing(rows, docs, limit):
    """Pieces are the documents' ids, sequences hold their pieces gaplessly and within the limit."""
    library = Tokenizer.from_file(WORDS)
    want = []
    for key, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), limit)):
            part = ids[at : at + limit]
            want.append((key, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted([r[:5] for r in rows], key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return sequences


PACKED = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def test_packing_on_odd_rows(odd, none):
    check_packing(rows_of(packing.pack(odd, WORDS), *PACKED), ODD, 2048)
    assert packing.pack(none, WORDS).count() == 0


def test_packing_over_several_blocks_stays_close_to_the_bound(documents, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 100)
    source = random.Random(5)
    docs = [(i, "word " * source.randint(0, 150)) for i in range(600)]
    got = check_packing(rows_of(packing.pack(documents(docs), WORDS, 128), *PACKED), docs, 128)
    tokens = sum(n for parts in got.values() for _, n in parts)
    assert len(got) <= 1.03 * tokens / 128 + 3


def test_search_empties_a_sequence():
    # Three sequences of 6 + 3, 6 + 2 and 4 + 3 + 2 of 12: one-for-one and two-for-one fill two.
    bins = packing.Bins([6, 3, 6, 2, 4, 3], 12)
    for members in ([0, 1], [2, 3], [4, 5]):
        bins.add(members)
    squares = sum(f * f for f in bins.fill)
    bins.search()
    assert sum(f * f for f in bins.fill) > squares
    assert sorted(i for b in bins.bins for i in b) == list(range(6))
    assert max(bins.fill) == 12 and sum(f > 0 for f in bins.fill) == 2


@pytest.mark.parametrize("seed", range(5))
def test_search_keeps_all_pieces_and_limits(seed):
    source = random.Random(seed)
    lengths = [source.randint(1, 100) for _ in range(200)]
    bins = packing.Bins(lengths, 100)
    for i in range(200):
        bins.add([i])
    bins.search()
    assert sorted(i for b in bins.bins for i in b) == list(range(200))
    assert all(f == sum(lengths[i] for i in b) <= 100 for f, b in zip(bins.fill, bins.bins, strict=True))
    assert sum(f > 0 for f in bins.fill) <= 1.1 * sum(lengths) / 100 + 2


def improvable(bins):
    """An exchange of the search's kinds that raises squared fill, by trying all of them."""
    sizes, live = bins.lengths, [b for b, f in enumerate(bins.fill) if 0 < f < bins.limit]

    def some(b):
        return [(i,) for i in bins.bins[b]] + list(itertools.combinations(bins.bins[b], 2))

    for x, y in itertools.permutations(live, 2):
        for out in [(), *some(x)]:
            for into in some(y):
                gain = sum(sizes[i] for i in into) - sum(sizes[i] for i in out)
                if len(out) + len(into) < 4 and 0 < gain <= bins.limit - bins.fill[x] and bins.fill[y] < bins.fill[x] + gain:
                    return x, y, out, into
    return None


@pytest.mark.parametrize("limit, sizes", [(100, range(20, 71)), (100, (34, 35, 51, 67, 26)), (2048, range(500, 1101))])
def test_search_ends_where_no_exchange_is_left(limit, sizes):
    source = random.Random(limit + len(sizes))
    lengths = [source.choice(list(sizes)) for _ in range(140)]
    bins = packing.Bins(lengths, limit)
    bins.best_fit(list(range(len(lengths))))
    first = len(bins.bins)
    bins.search()
    assert sorted(i for members in bins.bins for i in members) == list(range(len(lengths)))
    assert all(f == sum(lengths[i] for i in m) <= limit for m, f in zip(bins.bins, bins.fill, strict=True))
    assert bins.fewest() or improvable(bins) is None
    assert sum(1 for m in bins.bins if m) <= first
