"""Segments are valid WARC 1.1, those of other writers are joined, and long payloads are read in pieces."""

import gzip
import hashlib
import re
from pathlib import Path

import pyarrow as pa
import pytest

from plinth.llm import warc
from tests.llm.conftest import LONG
from tests.llm.test_warc_files import parse

URN = re.compile(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>")


def test_fields_of_segments_and_revisits(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", LONG), (2, "", LONG), (3, None, "x"), (3, "http://b\r\nWARC-Type: x", "y")], "page_id long, url string, html string")
    warc.write(warc.plan_records(pages), str(tmp_path / "out"), 1000)
    records = [r for f in sorted((tmp_path / "out").glob("part-*.gz")) for r in parse(gzip.decompress(f.read_bytes()))]
    heads = [h for h, _ in records]
    ids = [h["WARC-Record-ID"] for h in heads]
    assert len(set(ids)) == len(ids) and all(map(URN.fullmatch, ids)) and all(h["WARC-Target-URI"] for h in heads)
    assert all(h["WARC-Type"] in ("response", "continuation", "revisit") for h in heads)
    own = sorted((h for h in heads if "WARC-Segment-Number" in h), key=lambda h: int(h["WARC-Segment-Number"]))
    assert [int(h["WARC-Segment-Number"]) for h in own] == list(range(1, len(own) + 1)) and len(own) > 2
    assert "WARC-Segment-Origin-ID" not in own[0] and {h["WARC-Segment-Origin-ID"] for h in own[1:]} == {own[0]["WARC-Record-ID"]}
    assert [int(h["WARC-Segment-Total-Length"]) for h in own if "WARC-Segment-Total-Length" in h] == [len(LONG.encode())]
    assert "WARC-Segment-Total-Length" in own[-1]
    (revisit,) = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert revisit["WARC-Refers-To"] == own[0]["WARC-Record-ID"]


def record(kind, body, **fields):
    lines = [f"WARC-Type: {kind}", f"Content-Length: {len(body)}", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items())]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


def test_segments_of_another_writer(spark, tmp_path):
    a, b, c = b"one\n" * 900, b"\r\n\r\nWARC/1.1\r\n", b"end"
    raw = [record("response", a, WARC_Record_ID="<urn:x:1>", WARC_Segment_Number=1), record("resource", b"other", WARC_Record_ID="<urn:x:9>"),
           record("continuation", c, WARC_Record_ID="<urn:x:3>", WARC_Segment_Number=3, WARC_Segment_Origin_ID="<urn:x:1>", WARC_Segment_Total_Length=len(a + b + c)),
           record("continuation", b, WARC_Record_ID="<urn:x:2>", WARC_Segment_Number=2, WARC_Segment_Origin_ID="<urn:x:1>")]
    Path(tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(raw[:2])))
    Path(tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"".join(raw[2:])))
    rows = sorted((r.record_type, r.payload_bytes, r.payload_digest) for r in warc.digests(warc.read(spark, str(tmp_path))).collect())
    assert rows == [("resource", 5, hashlib.sha1(b"other").hexdigest()), ("response", len(a + b + c), hashlib.sha1(a + b + c).hexdigest())]
    Path(tmp_path / "b.warc.gz").write_bytes(gzip.compress(raw[3]))
    with pytest.raises(Exception, match="last segment is missing"):
        warc.digests(warc.read(spark, str(tmp_path))).collect()


def test_a_long_record_comes_in_pieces(spark, tmp_path):
    body = b"".join(b"%d\r\n\r\n" % i for i in range(900_000))                   # some 9 MB in one record
    raw = record("response", body, WARC_Record_ID="<urn:x:1>")
    lines = raw.split(b"\n")[:-1]
    batches = [pa.RecordBatch.from_arrays([pa.array(lines[i:i + 1024], pa.binary())], ["v"]) for i in range(0, len(lines), 1024)]
    pieces = [r for out in warc.cut_records(batches) for r in out.to_pylist()]
    assert [p["piece"] for p in pieces] == list(range(1, len(pieces) + 1)) and len(pieces) > 5
    assert max(len(p["chunk"]) for p in pieces) == warc.PIECE and b"".join(p["chunk"] for p in pieces) == body
    # given twice, it is one record read twice, as repeated rows are
    for name in "ab":
        Path(tmp_path / f"{name}.warc.gz").write_bytes(gzip.compress(raw))
    rows = [(r.payload_bytes, r.payload_digest) for r in warc.digests(warc.read(spark, str(tmp_path))).collect()]
    assert rows == [(len(body), hashlib.sha1(body).hexdigest())] * 2
