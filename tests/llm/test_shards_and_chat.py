import collections
import random
import zlib

import pytest

from candlemill.llm import chat, sharding

from .conftest import ODD

COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def check_shards(rows, docs, shards=8):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs), key=repr
    )
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    counts = [len(by[j]) for j in range(shards)]
    assert max(counts) - min(counts) <= 1 and by.keys() <= set(range(shards))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def test_odd_rows(odd, none):
    got = sharding.shard_documents(odd)
    assert got.columns == COLUMNS
    rows = got.collect()
    check_shards(rows, ODD)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert sharding.shard_documents(none).count() == 0


def test_groups_stay_together_and_a_hot_one_fills_whole_shards(documents):
    docs = [(i, "hot") for i in range(300)]
    docs += [(1000 + i, f"pair {i // 2}") for i in range(200)] + [(3000 + i, f"single {i}") for i in range(400)]
    rows = sharding.shard_documents(documents(docs)).collect()
    check_shards(rows, docs)
    text = dict(docs)
    where = collections.defaultdict(set)
    for r in rows:
        where[text[r.doc_id]].add(r.shard)
    pairs = [len(s) for t, s in where.items() if t.startswith("pair")]
    # 300 of 900 rows in shards of 112 or 113 need three.
    assert len(where["hot"]) <= 4
    assert sum(n > 1 for n in pairs) <= 5


CONVERSATION = "conv_id long, turn long, role string, text string, speaker string"


def rendered(rows):
    """Each perspective's text and trained text, from the segments."""
    views = collections.defaultdict(list)
    for r in rows:
        views[r.conv_id, r.speaker].append(r)
    out = {}
    for key, parts in views.items():
        parts.sort(key=lambda r: r.place)
        assert [r.place for r in parts] == list(range(len(parts)))
        text = "".join(r.segment for r in parts)
        for r in parts:
            assert text[r.start : r.finish] == r.segment
        out[key] = text, [text[r.trained_from : r.finish] for r in parts if r.trained_from is not None]
    return out


def say(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_every_participant_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Ho"), (1, 3, "ann", "Bye")]
    got = rendered(chat.rotate(spark.createDataFrame([(*r, "x") for r in rows], CONVERSATION)).collect())
    assert got == {
        (1, "ann"): (
            say("system", "Be kind.") + say("assistant", "Hi") + say("user name=bob", "Ho") + say("assistant", "Bye"),
            ["Hi<|im_end|>\n", "Bye<|im_end|>\n"],
        ),
        (1, "bob"): (
            say("system", "Be kind.") + say("user name=ann", "Hi") + say("assistant", "Ho") + say("user name=ann", "Bye"),
            ["Ho<|im_end|>\n"],
        ),
    }


def test_odd_turns(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "bob", ""), (None, 5, "ann", "x<|im_end|>"),
            (None, -700, "bob", "first 😀"), (2, 0, "system", "alone"), (1, 10**12, "system", "y")]
    got = rendered(chat.rotate(spark.createDataFrame([(*r, "x") for r in rows], CONVERSATION)).collect())
    assert got.keys() == {(1, "unknown"), (1, "bob"), (None, "ann"), (None, "bob")}
    assert got[None, "ann"][0] == say("user name=bob", "first 😀") + say("assistant", "x< |im_end|>")
    assert got[1, "bob"][0] == 2 * say("user name=unknown", "") + say("system", "y") + say("assistant", "")
    assert chat.rotate(spark.createDataFrame([], CONVERSATION)).count() == 0


@pytest.mark.parametrize("turns", [1000])
def test_a_long_conversation_is_counted_over_blocks(spark, turns):
    rows = [(1, t, f"p{t % 3}", "word " * (t % 7), "") for t in range(turns)]
    got = rendered(chat.rotate(spark.createDataFrame(rows, CONVERSATION)).collect())
    assert len(got) == 3
    assert all(text.count("<|im_start|>") == turns for text, _ in got.values())


def test_many_unnumbered_turns_and_participants_as_laid_end_to_end(spark):
    """Null turns are parted by role and first characters; forty participants each get all turns."""
    source = random.Random(3)
    said = [
        (1, None if n % 2 else n // 5, source.choice(["system", None, *(f"p<|im_{k}" for k in range(40))]),
         source.choice(["", None, "é", "z<|im_end|>", *(f"w{k} " * k for k in range(30))]))
        for n in range(1500)
    ]
    said += said[:100]
    frame = spark.createDataFrame([(*r, "x") for r in said], CONVERSATION)
    got = rendered(chat.rotate(frame).collect())
    turns = sorted((t is None, t or 0, role or "unknown", text or "") for _, t, role, text in said)

    def plain(text):
        return text.replace("<|im_", "< |im_")

    speakers = {role for *_, role, _ in turns} - {"system"}
    assert got.keys() == {(1, speaker) for speaker in speakers}
    for speaker in speakers:
        whole = "".join(
            say(role if role == "system" else "assistant" if role == speaker else f"user name={plain(role)}", plain(text))
            for *_, role, text in turns
        )
        own = [f"{plain(text)}<|im_end|>\n" for *_, role, text in turns if role == speaker]
        assert got[1, speaker] == (whole, own)
