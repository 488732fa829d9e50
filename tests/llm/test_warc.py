import base64
import gzip
import hashlib
import io

import pytest

from candlemill.llm import warc

from .conftest import rows_of


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, keeper string, digest string")


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_on_odd_rows(spark):
    big = "<p>ü\r\n\r\nWARC/1.1\x00</p>" * 20_000
    rows = [(1, "http://a/x y\r\nz", "<b>one</b>"), (2, None, "<b>one</b>"), (9, "u", "<b>one</b>"),
            (3, "u", None), (4, "u", ""), (5, "u", big), (6, "u", "only"), (6, "u", "only"),
            (None, "u", "<b>one</b>"), (None, None, None)]
    got = rows_of(
        warc.round_trip(pages(spark, [(*r, "k", "d") for r in rows])),
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
    )
    largest = {}
    for key, _, html in rows:
        if key is not None:
            largest[html or ""] = max(key, largest.get(html or "", key))
    want = []
    for key, _, html in rows:
        again = key is not None and key < largest[html or ""]
        want.append((key, len((html or "").encode()), digest(html), "revisit" if again else "response",
                     largest[html or ""] if again else None))
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [(1, "u", "x", "", "")]).where("page_id > 1")).count() == 0


def test_small_payloads_are_never_revisits(spark, tmp_path):
    path = str(tmp_path / "small")
    warc.write_archives(pages(spark, [(1, "u", "xy", "", ""), (2, "u", "xy", "", "")]), path, least=3)
    assert {r.record_type for r in warc.read_archives(spark, path).collect()} == {"response"}


def test_archives_are_plain_gzip_and_keep_payloads(spark, tmp_path):
    path = str(tmp_path / "plain")
    texts = {i: f"<p>{i}</p>" * (i + 1) for i in range(40)}
    warc.write_archives(pages(spark, [(i, f"http://h/{i}", t, "", "") for i, t in texts.items()]), path)
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "plain").glob("part-*"))
    assert whole.count(b"WARC/1.1\r\n") == 40
    read = warc.read_archives(spark, path).collect()
    assert {r.uri: r.payload.decode() for r in read} == {f"http://h/{i}": t for i, t in texts.items()}
    assert all(r.intact for r in read)


def record(payload=b"abc", **changes):
    return warc.record_bytes(7, "u", payload, None, False, warc.DATE)


def test_damaged_records_are_noticed():
    good = record()
    bad = good.replace(b"abc", b"abd")
    (header, parts), = list_of(warc.member(bad))
    block = warc._Block(header, True)
    for part in parts:
        block.add(part)
    assert block.result()[3] is False
    with pytest.raises(EOFError):
        list_of(warc.member(good)[:-9])
    short = good.replace(b"Content-Length: %d" % (len(good.split(b"\r\n\r\n", 1)[1]) - 4), b"Content-Length: 9999")
    with pytest.raises(EOFError):
        list_of(warc.member(short))
    with pytest.raises(ValueError):
        list_of(gzip.compress(b"no record\r\n\r\n"))


def list_of(data):
    return [(h, list(p)) for h, p in warc.ArchiveReader(io.BytesIO(data), "x")]


def test_member_ends_in_zero_even_beyond_sixteen_mebibytes():
    assert warc.member(b"\x01" * (17 << 20))[-1] == 0
    data = warc.member(b"\x01" * (17 << 20)) + warc.member(record())
    with pytest.raises(ValueError):
        list_of(data)
    assert len(list_of(warc.member(record(b"\x01" * (17 << 20))) + warc.member(record()))) == 2
