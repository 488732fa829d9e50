"""Quality rules on whole texts: counts, and lines labelled by a linear-chain random field.

Every line with a word gets features (length, symbols, case, sentence end, repetition). A conditional
random field over the lines of a document, with two labels and weights for label pairs, is decoded by
Viterbi into content and boilerplate; a document whose content lines hold too small a share of its
characters goes.

Labels are of documents, not of lines. The lines of a good document are content; which lines of a poor
document are content is hidden, and its label only bounds their share. The weights are fitted by turns:
the likeliest distribution over hidden labels within that bound, then the weights that explain it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.shared import fields, map_rows, staged, text_rows
from candlemill.llm.textstats import (
    SENTENCE_ENDS, SPACES, SYMBOLS, count_of, duplicate_lines, lines_of, repeated_words, words_of,
)

SAMPLE = 600
"""Labelled documents of either kind, at most, that the weights are fitted on."""
CONTENT_SHARE = 0.5
CHAIN = 16
"""Lines of one training chain; longer documents make several."""
CHAINS = 8 * SAMPLE
"""Training chains of either kind, at most."""
POOR_SHARE = 0.2
"""Share of a poor document's characters, at most, that training takes for content."""
RENEWED = 10
"""Gradient steps between two looks at the hidden labels."""

JUDGED = fields(
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, content_share double"
)
LINES = fields("quality int, doc_id long, place int, features doubles, sizes doubles")

FEATURES = 13


def line_features(line: str, seen: bool) -> list[float]:
    n = len(line)
    words = line.split()
    count = max(1, len(words))
    letters = sum(map(len, words))
    stripped = line.rstrip(SPACES)
    cased = line.lower() != line
    loud = cased and line.upper() == line
    return [
        1.0,
        min(1.0, math.log1p(count) / 5),
        float(count < 4),
        min(1.0, count_of(line, SYMBOLS) / count),
        min(1.0, line.count("|") / count),
        min(1.0, line.count("!") / count),
        float(loud and letters > 3),
        float(stripped.endswith(SENTENCE_ENDS)),
        float(seen),
        min(1.0, letters / count / 20),
        min(1.0, sum(map(line.count, "0123456789")) / n),
        min(1.0, sum(map(line.count, ".,;:")) / count),
        sum(map(str.__eq__, words, words[1:])) / count,
    ]


def all_features(lines: list[str]) -> np.ndarray:
    seen: set[str] = set()
    rows = []
    for line in lines:
        rows.append(line_features(line, line in seen))
        seen.add(line)
    return np.array(rows).reshape(len(rows), FEATURES)


@dataclass(frozen=True)
class Chain:
    """Weights of the field: features by label, and label pairs (boilerplate 0, content 1)."""

    emit: tuple[tuple[float, ...], ...]
    step: tuple[tuple[float, ...], ...]

    def decode(self, features: np.ndarray) -> list[int]:
        """The most likely labels of a document's lines; ties go to content."""
        scores = (features @ np.array(self.emit).T).tolist()
        (s00, s01), (s10, s11) = self.step
        back = []
        a, b = scores[0]
        for x, y in scores[1:]:
            from_0 = a + s00 > b + s10, a + s01 > b + s11
            back.append(from_0)
            a, b = (a + s00 if from_0[0] else b + s10) + x, (a + s01 if from_0[1] else b + s11) + y
        label = int(b >= a)
        labels = [label]
        for from_0 in reversed(back):
            label = 0 if from_0[label] else 1
            labels.append(label)
        return labels[::-1]


def fit_chain(chains: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = 250, ridge: float = 1e-4) -> Chain:
    """Maximum conditional likelihood by accelerated gradient steps; labels of poor lines are hidden.

    ``chains``: (label of the document, features of up to ``CHAIN`` lines, their characters).
    """
    m = len(chains)
    x = np.zeros((m, CHAIN, FEATURES))
    mask = np.zeros((m, CHAIN), bool)
    shares = np.zeros((m, CHAIN))
    good = np.zeros(m, bool)
    for i, (label, f, sizes) in enumerate(chains):
        x[i, : len(f)], mask[i, : len(f)], good[i] = f, True, label == 1
        shares[i, : len(f)] = sizes / sizes.sum()
    emit, step = np.zeros((2, FEATURES)), np.zeros((2, 2))
    speed_e, speed_s = np.zeros_like(emit), np.zeros_like(step)
    lines = mask.sum()
    # Content lines weigh thrice: to lose a clean document costs more than to keep a poor one.
    of = np.bincount(good, weights=mask.sum(1), minlength=2)
    weight = (lines * np.array([0.25, 0.75]) / np.maximum(of, 1))[good.astype(int)][:, None] * mask
    for n in range(rounds):
        scores = x @ emit.T
        if n % RENEWED == 0:
            believed = _believed(scores, mask, shares, good, step)
        node, pair = _marginals(scores, mask, step)
        grad_e = np.einsum("mnl,mnf->lf", (believed[0] - node) * weight[:, :, None], x)
        grad_s = np.einsum("mnij,mn->ij", believed[1] - pair, weight[:, 1:])
        speed_e = 0.9 * speed_e + grad_e / lines - ridge * emit
        speed_s = 0.9 * speed_s + grad_s / lines - ridge * step
        emit, step = emit + 0.5 * speed_e, step + 0.5 * speed_s
    return Chain(tuple(map(tuple, emit.tolist())), tuple(map(tuple, step.tolist())))


def _believed(scores, mask, shares, good, step) -> tuple[np.ndarray, np.ndarray]:
    """Distributions over labels and label pairs that the documents' labels allow.

    Good lines are content. For a poor chain it is the distribution nearest to the field's own with an
    expected content share of at most ``POOR_SHARE``: each line's content score is lowered by its share
    of the characters times one factor per chain, found by halving.
    """
    m, n, _ = scores.shape
    node, pair = np.zeros((m, n, 2)), np.zeros((m, n - 1, 2, 2))
    node[good, :, 1], pair[good, :, 1, 1] = mask[good], mask[good, 1:]
    poor = ~good
    own, inside, share = scores[poor], mask[poor], shares[poor]

    def lowered(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tilted = own.copy()
        tilted[:, :, 1] -= factor[:, None] * share
        return _marginals(tilted, inside, step)

    low, high = np.zeros(len(own)), np.full(len(own), float(1 << 12))
    above = (lowered(low)[0][:, :, 1] * share).sum(1) > POOR_SHARE
    for _ in range(18):
        middle = (low + high) / 2
        over = (lowered(middle)[0][:, :, 1] * share).sum(1) > POOR_SHARE
        low, high = np.where(over, middle, low), np.where(over, high, middle)
    node[poor], pair[poor] = lowered(np.where(above, high, 0.0))
    return node, pair


def _marginals(scores, mask, step) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of labels and of label pairs, by forward and backward sums in logarithms."""
    m, n, _ = scores.shape
    forward = np.zeros((m, n, 2))
    backward = np.zeros((m, n, 2))
    forward[:, 0] = scores[:, 0]
    for t in range(1, n):
        new = np.logaddexp.reduce(forward[:, t - 1, :, None] + step, axis=1) + scores[:, t]
        forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
    for t in range(n - 2, -1, -1):
        new = np.logaddexp.reduce(step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
        backward[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    node = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
    pair = (
        forward[:, :-1, :, None] + step + (scores[:, 1:] + backward[:, 1:])[:, :, None, :]
        - total[:, None, None, None]
    )
    return node, np.exp(np.minimum(pair, 0.0)) * mask[:, 1:, None, None]


def _featured(columns: dict) -> Iterator[tuple]:
    for quality, doc_id, text in zip(columns["quality"], columns["doc_id"], columns["text"], strict=True):
        lines = lines_of(text or "")
        if lines and not base_failed(text)[1]:
            features = all_features(lines)
            for at in range(0, len(lines), CHAIN):
                cut = slice(at, at + CHAIN)
                yield quality, doc_id, at, features[cut].ravel().tolist(), [float(len(x)) for x in lines[cut]]


def _by_hash(df: DataFrame, most: int, *key: str) -> DataFrame:
    """At most so many rows of either kind, chosen by a hash of their key."""
    good, poor = (
        df.where(F.col("quality") == kind).orderBy(F.xxhash64(*key), *key).limit(most) for kind in (1, 0)
    )
    return poor.unionByName(good)


def training_chains(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = CHAINS) -> DataFrame:
    """Per chosen chain: quality, doc_id, place, features and sizes of up to ``CHAIN`` lines.

    Of rows that share a doc_id, one text teaches (the least by hash).
    """
    marked = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    ).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    chosen = F.broadcast(_by_hash(marked, sample, "doc_id"))
    rows = (
        text_rows(docs).where("text IS NOT NULL").join(chosen, "doc_id").groupBy("quality", "doc_id")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    )
    return _by_hash(staged(map_rows(rows, _featured, LINES, rows=64), "chains"), most, "doc_id", "place")


def learn_chain(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain | None:
    """Fit the field on at most ``sample`` labelled documents of either kind, chosen by hash.

    Documents that fail the counts teach nothing about lines and are left out. Only features of at
    most ``CHAINS`` chains of either kind reach the driver. Without documents of both kinds there is
    no field (None).
    """
    got = [
        (r.quality, np.array(r.features).reshape(-1, FEATURES), np.array(r.sizes))
        for r in training_chains(docs, labels, sample).collect()
    ]
    if {q for q, *_ in got} != {0, 1}:
        return None
    return fit_chain(sorted(got, key=lambda g: (g[0], len(g[1]), float(g[1].sum()))))


def content_share(lines: list[str], chain: Chain | None) -> float:
    """Share of the characters that stand in content lines; 1 without a field, 0 without lines."""
    if not lines:
        return 0.0
    if chain is None:
        return 1.0
    labels = chain.decode(all_features(lines))
    sizes = list(map(len, lines))
    return sum(n for n, label in zip(sizes, labels, strict=True) if label) / sum(sizes)


def _judge(columns: dict, chain: Chain | None) -> Iterator[tuple]:
    for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
        yield (doc_id, *judge_text(text or "", chain))


def base_failed(text: str) -> tuple[tuple[int, int], bool]:
    """(words, repeated words), and whether they fail: too few, or too many repeated."""
    words = words_of(text)
    repeated = repeated_words(words)
    return (len(words), repeated), len(words) < 10 or 100 * repeated > 20 * len(words)


def judge_text(text: str, chain: Chain | None) -> tuple:
    lines = lines_of(text)
    (words, repeated), failed = base_failed(text)
    return (
        words, len(text) - count_of(text, SPACES), count_of(text, SYMBOLS),
        duplicate_lines(lines), repeated, failed, content_share(lines, chain),
    )


def judge(docs: DataFrame, chain: Chain | None, least: float = CONTENT_SHARE) -> DataFrame:
    """Per input row: counts over the whole text, base_failed, content_share, kept.

    A null text has no words and fails. Repeated rows are judged each, a null doc_id is kept as it
    is, an empty table gives none, further columns are ignored. No shuffle.
    """
    return map_rows(text_rows(docs), _judge, JUDGED, chain).withColumn(
        "kept", ~F.col("base_failed") & (F.col("content_share") >= least)
    )


def _kept(columns: dict, chain: Chain | None, least: float) -> Iterator[tuple]:
    names = list(columns)
    text_at = names.index("text")
    for row in zip(*columns.values(), strict=True):
        verdict = judge_text(row[text_at] or "", chain)
        if not verdict[5] and verdict[6] >= least:
            yield row


def keep_good(docs: DataFrame, chain: Chain | None, least: float = CONTENT_SHARE) -> DataFrame:
    """The rows of documents that pass, with all their columns; texts aren't shuffled.

    Null and empty texts have no words and go. Rows that repeat or have no doc_id are judged each by its
    text; an empty table gives none; other columns, whatever their names, pass through.
    """
    return map_rows(docs, _kept, docs.schema, chain, least)
