import collections
import random
import re

from candlemill.llm import quality, rules, textstats
from candlemill.llm.shared import table

from .conftest import ODD, rows_of

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = collections.Counter(windows)
    inside = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 5)}
    lines, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in lines
            lines.add(line)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside), failed)


COUNTS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_match_brute_force_on_odd_rows(odd, none):
    assert rows_of(quality.judge(odd, None), *COUNTS) == sorted(((i, *brute(t)) for i, t in ODD), key=repr)
    assert quality.judge(none, None).count() == 0


def test_kept_rows_are_whole(odd):
    kept = quality.keep_good(odd, None)
    assert kept.columns == odd.columns
    want = sorted((i for i, t in ODD if not brute(t)[5]), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want


def test_repeated_words_with_many_distinct_words():
    words = [str(i).encode() for i in range(7000)] + [b"1", b"2", b"3", b"4", b"5"]
    assert textstats.repeated_words(words) == 10


def test_field_keeps_good_and_drops_poor_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    chain = quality.learn_chain(docs, labels)
    judged = quality.judge(docs, chain).join(labels, "doc_id")
    rows = [(r.quality, r.kept, r.base_failed) for r in judged.collect()]
    good = [k for q, k, f in rows if q == 1 and not f]
    poor = [k for q, k, f in rows if q == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(poor) <= 0.05 * len(poor)


def test_lines_of_mixed_documents_are_told_apart(spark):
    """Held-out good and poor lines spliced: at least 0.9 of the lines get their own label."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    chain = quality.learn_chain(docs, labels.where("doc_id % 2 = 0"))
    rows = docs.join(labels, "doc_id").where("text IS NOT NULL").orderBy("doc_id").collect()
    lines = {0: [], 1: []}
    for r in rows:
        if r.doc_id % 2 and not quality.base_failed(r.text)[1]:
            lines[r.quality] += [x for x in textstats.lines_of(r.text) if len(x) > (60 if r.quality else 200)]
    source = random.Random(1)
    right = told = parted = 0
    for _ in range(200):
        kinds = [k for kind in source.choice([(1, 0, 1), (0, 1, 0), (1, 0), (0, 1)])
                 for k in [kind] * source.randint(1, 4)]
        got = chain.decode(quality.all_features([source.choice(lines[k]) for k in kinds]))
        right += sum(a == b for a, b in zip(got, kinds, strict=True))
        told += len(kinds)
        parted += got == kinds
    assert right >= 0.9 * told and parted >= 120
    # The documents of the table itself come out with lines of both kinds, too.
    mixed = quality.judge(docs, chain).where("content_share > 0 AND content_share < 1").count()
    assert mixed >= 10


def test_hidden_labels_keep_to_their_bound():
    """One poor chain of two lines, the field for content: only the share's bound holds it down."""
    import numpy as np

    scores = np.zeros((2, 2, 2))
    scores[:, :, 1] = 3.0
    mask = np.ones((2, 2), bool)
    shares = np.full((2, 2), 0.5)
    node, pair = quality._believed(scores, mask, shares, np.array([True, False]), np.zeros((2, 2)))
    assert node[0, :, 1].tolist() == [1.0, 1.0] and pair[0, 0, 1, 1] == 1.0
    assert abs(node[1, :, 1].mean() - quality.POOR_SHARE) < 1e-3
    assert abs(node[1].sum() - 2) < 1e-9 and abs(pair[1].sum() - 1) < 1e-9


def test_training_chains_are_bounded_by_documents_and_lines(spark, documents):
    """A doc_id of many rows teaches once; a long text gives no more chains than are asked for."""
    def text(n):
        return "\n".join(f"line {i} differs from {i * i}" for i in range(n))

    rows = [(1, text(20))] * 50 + [(1, text(21))] * 50 + [(2, text(4000)), (3, None), (None, text(5))]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    got = quality.training_chains(documents(rows), labels, most=7).collect()
    assert sorted(r.place for r in got if r.quality == 1) == [0, 16]
    assert sum(r.quality == 0 for r in got) == 7
    assert all(len(r.features) <= quality.CHAIN * quality.FEATURES for r in got)
    assert quality.learn_chain(documents(rows), labels) is not None


def test_without_labels_only_counts_decide(spark, odd):
    labels = table(spark, SF, "labels").where("doc_id < 0")
    assert quality.learn_chain(odd, labels) is None


def test_viterbi_is_the_best_labelling():
    import itertools

    import numpy as np

    source = np.random.default_rng(1)
    for _ in range(30):
        chain = quality.Chain(
            tuple(map(tuple, source.normal(size=(2, quality.FEATURES)).tolist())),
            tuple(map(tuple, source.normal(size=(2, 2)).tolist())),
        )
        x = source.normal(size=(6, quality.FEATURES))
        emit = x @ np.array(chain.emit).T

        def value(labels, emit=emit, chain=chain):
            steps = sum(chain.step[a][b] for a, b in itertools.pairwise(labels))
            return steps + sum(emit[i, v] for i, v in enumerate(labels))

        best = max(itertools.product((0, 1), repeat=6), key=value)
        assert abs(value(best) - value(chain.decode(x))) < 1e-9


def test_rules_separate_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = rules.score_quality(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    good = [r.score for r in rows if r.quality == 1]
    poor = [r.score for r in rows if r.quality == 0]
    assert sum(g > p for g in good for p in poor) >= 0.97 * len(good) * len(poor)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_rules_on_odd_rows(spark, odd, none):
    labels = table(spark, SF, "labels").where("doc_id < 0")
    rows = rules.score_quality(odd, labels).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.5}
    assert all(r.held_out in (True, False) for r in rows)
    assert rules.score_quality(none, labels).count() == 0


def test_paths_of_a_printed_tree():
    tree = """DecisionTreeClassificationModel: depth=2
  If (feature 0 <= 1.5)
   If (feature 3 > 2.0E-4)
    Predict: 1.0
   Else (feature 3 <= 2.0E-4)
    Predict: 0.0
  Else (feature 0 > 1.5)
   Predict: 0.0
"""
    first, second = (0, False, 1.5), (3, True, 2.0e-4)
    assert rules.rules_of(tree) == {
        rules.Rule((first,)), rules.Rule((first, second)),
        rules.Rule(((0, False, 1.5), (3, False, 2.0e-4))), rules.Rule(((0, True, 1.5),)),
    }
