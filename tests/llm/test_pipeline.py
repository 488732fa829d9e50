import corpus_pipeline
from candlemill.llm import decontaminate, near_dup, packing, pii, quality
from candlemill.llm.shared import staged, table, tokenizer_file

from .conftest import ODD
from .test_near_dup import brute
from .test_quality import brute as counts
from .test_tokens import PACKED, check_packing

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark):
    """Every stage against a plain version of it on what the one before kept."""
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents")
    chain = quality.learn_chain(docs, labels)
    raw = {r.doc_id: r.text for r in docs.collect()}
    items = [decontaminate.plain(r.text) for r in table(spark, SF, "benchmark").collect()]

    def good(text):
        share = quality.content_share(quality.lines_of(text), chain)
        return not counts(text)[5] and share >= quality.CONTENT_SHARE

    want = [{i: t for i, t in raw.items() if good(t)}]
    groups = {r[2] for r in brute(list(want[0].items()), 80)}
    want.append({i: t for i, t in want[0].items() if i in groups})
    want.append({i: t for i, t in want[1].items() if not any(x in decontaminate.plain(t) for x in items)})
    want.append({i: pii.redacted(t, pii.base_spans(t)) for i, t in want[2].items()})
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:4], want, strict=True):
        docs = staged(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r.doc_id: r.text for r in docs.collect()} == expected, name
    assert len(raw) > len(want[0]) > len(want[1])
    rows = [tuple(r) for r in corpus_pipeline.STAGES[4][1](spark, docs, SF).select(*PACKED).collect()]
    check_packing(rows, list(want[3].items()), 2048)
    assert sorted(r[:5] for r in rows) == sorted(
        tuple(r)[:5] for r in corpus_pipeline.run(spark, SF).select(*PACKED).collect()
    )


def test_stages_on_odd_and_empty_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert (packing.pack(docs, tokenizer_file("word_bpe_49k.json")).count() > 0) == (docs is odd)
    assert near_dup.keep_one(odd).count() == len(ODD) - 1
