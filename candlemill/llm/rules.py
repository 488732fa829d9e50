"""Quality scores from a sparse ensemble of rules over text statistics.

A forest of shallow trees is grown on labelled statistics; every path from a root is a conjunctive
rule. A logistic model with a lasso penalty gives the rules weights, most of them zero. What is left
is compiled into one Spark column over the statistics, so scoring is a projection.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.shared import fields, map_rows, staged, text_rows
from candlemill.llm.textstats import (
    SENTENCE_ENDS, SPACES, SYMBOLS, count_of, duplicate_lines, lines_of, repeated_words, words_of,
)

SAMPLE = 20_000
"""Labelled documents that are learned from, at most, chosen by hash."""
TREES, DEPTH = 24, 3
PENALTY = 0.001
STEPS = 60
RARE = 0.002
"""Rules that hold, or fail, for a smaller share of the sample are left out."""

FEATURES = (
    "log_words", "word_length", "line_words", "symbols", "pipes", "bangs", "capitals", "digits",
    "ended_lines", "repeated_lines", "repeated_words", "doubled_words", "distinct_words", "commas",
    "short_lines", "ended_words",
)
STATISTICS = fields("doc_id long, " + ", ".join(f"{name} double" for name in FEATURES))

_TEST = re.compile(r"feature (\d+) (<=|>) (-?[0-9.]+(?:E-?[0-9]+)?)")


def statistics(text: str) -> tuple[float, ...]:
    """Figures of one text in the order of ``FEATURES``; all zero without words."""
    words, lines = words_of(text), lines_of(text)
    n, rows = len(words), len(lines)
    if not n:
        return (0.0,) * len(FEATURES)
    letters = len(text) - count_of(text, SPACES)
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    return (
        math.log1p(n), letters / n, n / rows, count_of(text, SYMBOLS) / n, text.count("|") / n,
        text.count("!") / n, capitals / letters, count_of(text, "0123456789") / letters,
        sum(line.rstrip(SPACES).endswith(SENTENCE_ENDS) for line in lines) / rows,
        duplicate_lines(lines) / rows, repeated_words(words) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n, len(set(words)) / n, text.count(",") / n,
        sum(line.count(" ") < 3 for line in lines) / rows, count_of(text, ".?!") / n,
    )


def _figures(columns: dict) -> Iterator[tuple]:
    for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
        yield (doc_id, *statistics(text or ""))


def document_statistics(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id and the figures of the whole text; a null text counts as empty."""
    return map_rows(text_rows(docs), _figures, STATISTICS)


@dataclass(frozen=True)
class Rule:
    """A conjunction of tests (feature, above, threshold)."""

    tests: tuple[tuple[int, bool, float], ...]

    def column(self) -> Column:
        hold = None
        for feature, above, threshold in self.tests:
            name = F.col(FEATURES[feature])
            test = name > threshold if above else name <= threshold
            hold = test if hold is None else hold & test
        return hold


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def rules_of(tree: str) -> set[Rule]:
    """Every path from the root of a tree, as its printed form shows them."""
    rules, path = set(), []
    for line in tree.splitlines():
        test = _TEST.search(line)
        if not test:
            continue
        depth = len(line) - len(line.lstrip())
        path = [(d, t) for d, t in path if d < depth]
        path.append((depth, (int(test[1]), test[2] == ">", float(test[3]))))
        rules.add(Rule(tuple(sorted({t for _, t in path}))))
    return rules


def learned_rows(figures: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Figures with labels of rows that may be learned from: crc32 of the id modulo 4 is not 2."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
        .where(F.col("label").isin(0.0, 1.0) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    return figures.join(F.broadcast(marked), "doc_id").drop("doc_id")


def held_out(doc_id: Column) -> Column:
    """A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(figures: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """Grow trees, take their paths as rules, weigh them under a lasso penalty.

    Without labels of both kinds the score is the smoothed share of label 1 for every text.
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = staged(learned_rows(figures, labels, sample), "learned")
    seen = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        share = (seen.get(1.0, 0) + 1) / (sum(seen.values()) + 2)
        return Ensemble(math.log(share / (1 - share)), ())
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=17, minInstancesPerNode=5, subsamplingRate=0.7,
        featureSubsetStrategy="onethird",
    ).fit(vectors)
    rules = sorted(
        set().union(*(rules_of(tree.toDebugString) for tree in forest.trees)), key=lambda r: r.tests
    )
    if not rules:
        return Ensemble(math.log(seen[1.0] / seen[0.0]), ())
    total = sum(seen.values())
    held = rows.agg(*[
        F.sum(F.when(r.column(), 1).otherwise(0)).alias(f"r{i}") for i, r in enumerate(rules)
    ]).first()
    rules = [r for i, r in enumerate(rules) if RARE * total <= held[f"r{i}"] <= (1 - RARE) * total]
    if not rules:
        return Ensemble(math.log(seen[1.0] / seen[0.0]), ())
    marks = rows.select("label", *[
        F.when(r.column(), 1.0).otherwise(0.0).alias(f"r{i}") for i, r in enumerate(rules)
    ])
    design = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features")
    model = LogisticRegression(
        elasticNetParam=1.0, regParam=PENALTY, maxIter=STEPS, standardization=False
    ).fit(design.transform(marks).select("label", "features"))
    weights = model.coefficients.toArray().tolist()
    return Ensemble(
        float(model.intercept), tuple((r, w) for r, w in zip(rules, weights, strict=True) if w)
    )


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per input row: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    Only statistics of the text enter the score. Null and empty texts are scored by their zero
    figures, repeated rows each, a null id is kept and not held out, an empty table gives none,
    further columns are ignored. Texts are read once; figures are staged and joined with labels.
    """
    figures = staged(document_statistics(docs), "figures")
    score = learn(figures, labels).score()
    return figures.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
    )
