import gzip
import hashlib
from pathlib import Path

import pytest

from plinth.llm import warc
from tests.llm.conftest import LONG


def parse(raw):
    """The records of one archive as (headers, payload), by a plain walk."""
    out, at = [], 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode().split("\r\n")
        assert version == "WARC/1.1"
        head = dict(x.split(": ", 1) for x in lines)
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(head)
        stop = end + 4 + int(head["Content-Length"])
        assert raw[stop:stop + 4] == b"\r\n\r\n"
        out.append((head, raw[end + 4:stop]))
        at = stop + 4
    return out


def test_each_file_is_a_whole_archive(spark, tmp_path):
    trap = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    htmls = ["x", None, LONG, LONG, trap * 40, trap, "a\r\nb\n", "\r\n\r\n", "é€" * 900]
    pages = spark.createDataFrame([(i, "http://a", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    warc.write(warc.plan_records(pages).repartition(3), str(tmp_path / "out"), 1000)
    files = sorted((tmp_path / "out").glob("part-*.gz"))
    records = [r for f in files for r in parse(gzip.decompress(f.read_bytes()))]
    whole = {}
    for head, body in sorted(records, key=lambda r: int(r[0].get("WARC-Segment-Number", 1))):
        if head["WARC-Type"] != "revisit":
            whole[int(head["WARC-Page-ID"])] = whole.get(int(head["WARC-Page-ID"]), b"") + body
    assert whole == {i: (h or "").encode() for i, h in enumerate(htmls) if i != 2}      # 2 is a revisit of 3
    assert len(files) > 1 and len(records) > len(htmls)


def test_other_archives_are_read(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\n\r\n\xff\n"
    one = b"WARC/1.0\r\ncontent-length: 0\r\nWARC-Type: warcinfo\r\n\r\n\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    Path(tmp_path / "a.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))   # a member for each record
    rows = sorted((r.record_type, r.payload_bytes, r.payload_digest) for r in warc.digests(warc.read(spark, str(tmp_path))).collect())
    assert rows == [("response", len(body), hashlib.sha1(body).hexdigest()), ("warcinfo", 0, hashlib.sha1(b"").hexdigest())]
    Path(tmp_path / "a.warc.gz").write_bytes(gzip.compress(one + two[:-9]))
    with pytest.raises(Exception, match="ends inside|differs"):
        warc.read(spark, str(tmp_path)).collect()
