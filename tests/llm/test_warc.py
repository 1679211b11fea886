import hashlib

from plinth.llm import warc
from plinth.llm.catalog import ORACLE, op6_warc
from tests.llm.conftest import LONG

_SCHEMA = "page_id long, url string, html string, body string"


def brute(rows):
    groups = {}
    for page, html in rows:
        b = (html or "").encode()
        if len(b) >= 1000 and page is not None:
            groups[b] = max(page, groups.get(b, page))
    out = []
    for page, html in rows:
        b = (html or "").encode()
        to = groups.get(b)
        again = to is not None and to != page
        out.append((page, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def test_query_matches_brute_force_and_sql(spark):
    import duckdb
    d = "/root/testdata/sf0.01"
    rows = sorted((tuple(r) for r in op6_warc(spark, d).collect()), key=str)
    pages = spark.read.parquet(f"{d}/pages.parquet").collect()
    assert rows == brute([(r.page_id, r.html) for r in pages])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{d}/pages.parquet'")
    assert rows == sorted(con.execute(ORACLE["op6_warc"]).fetchall(), key=str)


def test_chunks_copies_and_edge_rows(spark):
    trap = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\n\r\n\r\n"
    htmls = [None, "", "x", "x", LONG, LONG, LONG[:-1], "é€\U0001f600" * 5000, trap * 40, trap * 40, trap, "\r\n\r\n", "a\n" * 700, "a\n" * 700]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None, 12, None, 13]
    pages = spark.createDataFrame([(i, None if k % 3 else "http://a\r\nb", h, "clash") for k, (i, h) in enumerate(zip(ids, htmls, strict=True))], _SCHEMA)
    for chunk in (warc.CHUNK, 1000):
        got = warc.round_trip(pages, chunk)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(list(zip(ids, htmls, strict=True)))
    twice = warc.round_trip(pages.union(pages), 1000)
    assert sorted((tuple(r) for r in twice.collect()), key=str) == brute(2 * list(zip(ids, htmls, strict=True)))
    assert warc.round_trip(pages.limit(0)).count() == 0
