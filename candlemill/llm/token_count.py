"""Token counts with a shortcut for whole tokens.

A byte-level pair-merge tokenizer cuts a text into pre-tokens and merges each by itself, so the count
of a text is the sum over its pre-tokens. Before any text is read, every string of the vocabulary is
put through the tokenizer alone; those that come back as one pre-token and one token are *proven*.
Pre-tokens that are proven count 1 without merging; only the others are merged, each once per worker
and bounded memo.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.bytelevel import AGREED, Memo, byte_alphabet
from candlemill.llm.shared import fields, map_rows, text_rows

# Fixed value: the pre-token pattern of byte-level tokenizers.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
MEMO = 400_000
"""Pre-tokens remembered in a worker, about 50 MB."""

COUNTS = fields("doc_id long, n_bytes long, n_tokens long")


class Counter:
    """Counts tokens of texts as the tokenizer file gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.alphabet = byte_alphabet()
        self.special = [
            t.content for t in self.library.get_added_tokens_decoder().values()
        ]
        self.specials = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.proven = proven_tokens(path)
        self.merged = Memo(MEMO, self._merge)

    def count(self, text: str) -> int:
        if self.specials is not None and self.specials.search(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        if AGREED.search(text):
            pieces = [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        else:
            pieces = PRE_TOKEN.findall(text)
        proven = self.proven
        rest = [p for p in pieces if p not in proven]
        return len(pieces) - len(rest) + sum(map(self.merged.__getitem__, rest))

    def _merge(self, piece: str) -> int:
        return len(self.model.tokenize("".join([self.alphabet[b] for b in piece.encode()])))


@cache
def proven_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that the tokenizer gives back as one pre-token and one token, alone."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    texts = []
    for token in library.get_vocab(with_added_tokens=False):
        if all(c in byte_of for c in token):
            try:
                texts.append(bytes(byte_of[c] for c in token).decode())
            except UnicodeDecodeError:
                continue
    encoded = library.encode_batch(texts, add_special_tokens=False)
    return frozenset(
        text for text, e in zip(texts, encoded, strict=True)
        if len(e.ids) == 1 and len(library.pre_tokenizer.pre_tokenize_str(text)) == 1
    )


@cache
def _counter(path: str) -> Counter:
    return Counter(path)


def _counted(columns: dict, path: str) -> Iterator[tuple]:
    counter = _counter(path)
    for key, text in zip(columns["doc_id"], columns["text"], strict=True):
        text = text or ""
        yield key, len(text.encode()), counter.count(text)


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens of the whole text.

    A null text counts as empty (0 and 0), a null doc_id is kept, repeated rows are counted each, an
    empty table gives none, further columns are ignored. Special strings inside a text are single
    tokens, as the library has it. No shuffle: every text is counted where it is read.
    """
    return map_rows(text_rows(docs), _counted, COUNTS, tokenizer)


def with_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
