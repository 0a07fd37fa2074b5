"""Record files and archives: exact round trips, odd rows."""

import base64
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from emergent.llm import crc32c, ranges, records, tokens, warc
from emergent.llm.common import Scratch

DOCS = "doc_id long, text string, id string, file int"
TEXTS = [(5, "Hello, hello WORLD. it's 42!", "x", 1), (2, None, "y", 2), (9, "", "z", 3), (None, "no id", "n", 4),
         (7, "same text", "a", 5), (7, "same text", "a", 5), (3, "word " * 30_000, "long", 6),
         (1, "<|endoftext|> Ünïcode é Σς ２\ttabs\nlines", "u", 7)]


def encoded(text, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.public_path())
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_crc32c_known_values():
    parts = [b"123456789", b"", b"a", b"\0" * 32, bytes(range(256)) * 300]
    got = crc32c.crc32c(parts)
    assert [int(x) for x in got[:4]] == [0xE3069283, 0, 0xC1D04330, 0x8A9136AA]

    def slow(data):
        c = 0xFFFFFFFF
        for byte in data:
            c ^= byte
            for _ in range(8):
                c = c >> 1 ^ (crc32c.POLYNOMIAL if c & 1 else 0)
        return c ^ 0xFFFFFFFF

    assert int(got[4]) == slow(parts[4])


def test_round_trip(llm_spark):
    df = llm_spark.createDataFrame(TEXTS, DOCS)
    index = records.write_records(df, Scratch(llm_spark, "t"), vocabulary=tokens.public_path(), end_id=1)
    got = sorted(((r["start"], r["id"], bytes(r["ids"])) for r in records.read_records(index).collect()))
    want, start = [], 0
    for doc, text in sorted(((t[0], t[1]) for t in TEXTS), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = encoded(text, 1)
        want.append((start, doc, ids.tobytes()))
        start += len(ids)
    assert got == want
    some = records.read_records(index.filter("id = 3 or id = 5")).collect()
    assert sorted(r["id"] for r in some) == [3, 5]


def test_empty_table(llm_spark):
    df = llm_spark.createDataFrame([], DOCS)
    index = records.write_records(df, Scratch(llm_spark, "t"), vocabulary=tokens.public_path(), end_id=1)
    assert index.count() == 0 and records.read_records(index).count() == 0


def test_damage_is_found(llm_spark):
    df = llm_spark.createDataFrame(TEXTS[:1], DOCS)
    index = records.write_records(df, Scratch(llm_spark, "t"), vocabulary=tokens.public_path(), end_id=1)
    row = index.first()
    _, path = ranges.open_store(row["file"])
    data = bytearray(open(path, "rb").read())
    data[20] ^= 1
    with open(path, "wb") as f:
        f.write(data)
    with pytest.raises(Exception, match="checksum"):
        records.read_records(index).collect()


PAGES = "page_id long, url string, html string, payload string, digest int"
HTML = [(4, "http://a/x y\r\nz", "<p>é</p>", "c", 1), (2, None, "<p>é</p>", "c", 1), (8, "u", None, "c", 1),
        (6, "v", "", "c", 1), (1, "w", "only", "c", 1), (1, "w", "only", "c", 1), (None, "n", "only", "c", 2),
        (3, "long", "<b>" * 200_000, "c", 3)]


@pytest.mark.parametrize("least", [0, 9])
def test_archives(llm_spark, least):
    index = warc.write_archives(llm_spark.createDataFrame(HTML, PAGES), Scratch(llm_spark, "w"), least_bytes=least)
    got = {}
    for r in warc.read_archives(index, with_payload=True).collect():
        got.setdefault(r["page_id"], []).append(r)
    for page, _, html, *_ in HTML:
        body = (html or "").encode()
        same = [p for p, _, h, *_ in HTML if (h or "").encode() == body and p is not None]
        first = min(same) if len(body) >= least else page
        for r in got[page]:
            assert (r["payload_bytes"], r["payload_digest"]) == (
                len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
            assert r["record_type"] == ("response" if page == first else "revisit")
            assert r["refers_to"] == (None if page == first else first)
            assert r["payload"] is None or bytes(r["payload"]) == body
    assert sum(map(len, got.values())) == len(HTML)
    one = index.filter("page_id = 3").first()
    store, path = ranges.open_store(one["file"])
    raw = store.open_input_file(path).read_at(one["length"], one["offset"])
    assert zlib.decompress(raw, wbits=31).startswith(b"WARC/1.1\r\nWARC-Type: response")
    assert "\r" not in index.agg(F.max("url")).first()[0]


def test_empty_archives(llm_spark):
    index = warc.write_archives(llm_spark.createDataFrame([], PAGES), Scratch(llm_spark, "w"))
    assert index.count() == 0 and warc.read_archives(index).count() == 0


def test_coalesced_reads(tmp_path):
    path = tmp_path / "f"
    path.write_bytes(bytes(range(200)))
    rows = [(str(path), 0, 10, "a"), (str(path), 12, 5, "b"), (str(path), 150, 20, "c")]
    got = [(tag, bytes(v)) for tag, v in ranges.coalesced(rows, gap=4, most=30)]
    assert got == [("a", bytes(range(10))), ("b", bytes(range(12, 17))), ("c", bytes(range(150, 170)))]
