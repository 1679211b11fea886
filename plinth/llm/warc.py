"""WARC archives over a chunked record table.

Writing: a payload becomes rows (record, chunk number, chunk) of at most ``CHUNK`` characters.
Each row is one WARC record: the first a ``response``, the others ``continuation`` records that name
the first by its record id, with segment numbers, the last one with the total length, as the format
has it for segmented records.  So no row, on either side, holds more than a chunk of an oversized payload.  Of records with equal payloads of at least
``MIN_REVISIT`` bytes only the one of largest id is written in full; the others are ``revisit``
records that name it by its record id.  A page without a URL gets its record id as target.

Archives are written by Spark's text source, one value for each record from its version line to its
payload, with the two line ends after a record as the separator; so every part file is a whole archive.

Reading: the lines of each file (gzip, so a task has whole files, in order) are joined again and cut
into records by Content-Length, whatever the payloads hold; of a long payload, pieces of ``PIECE`` bytes
are given as they are read, so a worker holds one Arrow batch of lines and one piece at a time.  The
digest of a record in one piece is taken in place; segments and pieces are dealt by the record id of
the first and sorted by number, and a running SHA-1 goes through them, so the payload is never joined.
Segmented records of other writers are read by the same fields.

Defined results: a null payload is empty; rows of equal id and payload are the same record and
give equal rows; among equal payloads, rows without id never are the response unless none has an
id (then all of them are); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.common import bound_batches, ship
from plinth.session import work_path

CHUNK, PIECE, MIN_REVISIT, SALTS = 1 << 16, 1 << 20, 1000, 16
_DATE = "2020-01-01T00:00:00Z"
_VERSION, _END = "WARC/1.1", "\r\n\r\n"
_SIZE = re.compile(rb"\r\nContent-Length:[ \t]*(\d+)[ \t]*\r\n", re.IGNORECASE)


def _urn(key: Column) -> Column:
    h = F.md5(F.coalesce(key.cast("string"), F.lit("null")))
    return F.concat(F.lit("urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4)) for x in (F.substring(h, a, n), F.lit("-"))],
                    F.substring(h, 21, 12))


def plan_records(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """(page_id, url, html, bytes, digest, refers_to): which records are revisits, and of which."""
    text = F.coalesce(F.col(payload), F.lit(""))
    target = F.coalesce(F.col(url), F.lit("")) if url in pages.columns else F.lit("")
    rows = pages.select(F.col(key).alias("page_id"), target.alias("url"), text.alias("html"),
                        F.octet_length(text).cast("long").alias("bytes"), F.sha1(F.encode(text, "utf-8")).alias("digest"),
                        F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int").alias("salt"))
    # one row for each payload that occurs under several ids, repeated for the salts that split
    # the rows of a common payload
    known = pages.select(F.col(key).alias("page_id"), text.alias("html")).filter(F.octet_length("html") >= MIN_REVISIT)
    first = (known.groupBy(F.sha1(F.encode("html", "utf-8")).alias("digest"))
             .agg(F.max("page_id").alias("response"), F.min("page_id").alias("low"), F.count("*").alias("n"), F.count("page_id").alias("m"))
             .filter("response IS NOT NULL AND (low < response OR m < n)")
             .select("digest", "response", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    joined = rows.join(first, ["digest", "salt"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return joined.select("page_id", "url", "html", "bytes", "digest", refers.alias("refers_to"))


def chunk_table(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per chunk: the record's columns, chunk_no, n_chunks and the chunk's text."""
    body = F.when(F.col("refers_to").isNull(), F.col("html")).otherwise("")
    count = F.greatest(F.lit(1), F.ceil(F.length(body) / chunk)).cast("int")
    return (records.withColumn("body", body).withColumn("n_chunks", count).drop("html")
            .withColumn("chunk_no", F.explode(F.sequence(F.lit(1), "n_chunks")))
            .withColumn("chunk", F.when(F.col("n_chunks") == 1, F.col("body"))
                        .otherwise(F.substr("body", (F.col("chunk_no") - 1) * chunk + 1, F.lit(chunk)))).drop("body"))


def write(records: DataFrame, path: str, chunk: int = CHUNK) -> None:
    """The archives of planned records, one in each part file."""
    rows = chunk_table(records, chunk)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    when = lambda cond, value: F.when(cond, value).otherwise("")
    first, segmented = F.col("chunk_no") == 1, F.col("n_chunks") > 1
    revisit, named = F.col("refers_to").isNotNull(), F.col("page_id").isNotNull()
    kind = F.when(revisit, "revisit").when(first, "response").otherwise("continuation")
    # a record's id is that of its page, payload and segment
    urn = lambda page, no: _urn(F.concat_ws("/", F.col(page).cast("string"), F.col("digest"), no.cast("string")))
    quoted = lambda x: F.concat(F.lit("<"), x, F.lit(">"))
    origin = urn("page_id", F.lit(1))
    header = F.concat(
        line("WARC-Type", kind), line("WARC-Record-ID", quoted(urn("page_id", F.col("chunk_no")))), line("WARC-Date", F.lit(_DATE)),
        # what would end a header line has no place in one
        line("WARC-Target-URI", F.coalesce(F.nullif(F.trim(F.regexp_replace("url", r"[\r\n]", "")), F.lit("")), origin)),
        when(named, line("WARC-Page-ID", F.col("page_id"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                               line("WARC-Refers-To", quoted(urn("refers_to", F.lit(1)))),
                               line("WARC-Refers-To-Page-ID", F.col("refers_to")), line("WARC-Payload-Length", F.col("bytes")))),
        when(segmented, line("WARC-Segment-Number", F.col("chunk_no"))),
        when(segmented & ~first, line("WARC-Segment-Origin-ID", quoted(origin))),
        when(segmented & (F.col("chunk_no") == F.col("n_chunks")), line("WARC-Segment-Total-Length", F.col("bytes"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.octet_length("chunk")))
    value = F.concat(F.lit(f"{_VERSION}\r\n"), header, F.lit("\r\n"), F.col("chunk"))
    # the writer adds the separator after each value, the last one, too
    rows.select(value.alias("value")).write.option("lineSep", _END).option("compression", "gzip").text(path)


def cut_records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(head, piece number, whether it is the last, piece) of the records of archives given as their lines,
    without line ends, in order; a payload is cut after every ``PIECE`` bytes, wherever the batches end."""
    kept, head, left, no = bytearray(), None, 0, 0
    for batch in batches:
        kept += b"".join(x + b"\n" for x in batch.column(0).to_pylist())
        out, at = [], 0
        while True:
            if head is None:
                cut = kept.find(b"\r\n\r\n", at)
                if cut < 0:
                    break
                head = bytes(kept[at:cut + 2])
                size = _SIZE.search(head)
                if not head.startswith(b"WARC/") or size is None:
                    raise ValueError("no record starts where the one before has its end by Content-Length")
                at, left, no = cut + 4, int(size[1]), 1
            if left > PIECE and len(kept) >= at + PIECE:
                out.append((head, no, False, bytes(kept[at:at + PIECE])))
                at, left, no = at + PIECE, left - PIECE, no + 1
            elif left <= PIECE and len(kept) >= at + left + 4:
                if kept[at + left:at + left + 4] != b"\r\n\r\n":
                    raise ValueError("a record differs from its Content-Length")
                out.append((head, no, True, bytes(kept[at:at + left])))
                at, head = at + left + 4, None
            else:
                break
        del kept[:at]
        heads, numbers, lasts, pieces = ([x[k] for x in out] for k in range(4))
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int32()), pa.array(lasts, pa.bool_()),
                                          pa.array(pieces, pa.binary())], names=["head", "piece", "whole", "chunk"])
    if kept or head is not None:
        raise ValueError("an archive ends inside a record")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of archives: page_id, kind, refers_to, origin (the record id of the first segment), chunk_no
    (the segment), piece, last (whether the payload ends here), bytes (of the payload or, if it is segmented, of the
    segment), digest, chunk."""
    ship(spark)
    bound_batches(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))
    parts = lines.mapInArrow(cut_records, "head string, piece int, whole boolean, chunk binary")
    field = lambda name, kind="string": F.nullif(F.regexp_extract("head", rf"(?i)(?:^|\n){name}:[ \t]*([^\r]*)\r", 1), F.lit("")).cast(kind)
    number = field("WARC-Segment-Number", "int")
    return parts.select(
        field("WARC-Page-ID", "long").alias("page_id"), field("WARC-Type").alias("kind"), field("WARC-Refers-To-Page-ID", "long").alias("refers_to"),
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("origin"),
        F.coalesce(number, F.lit(1)).alias("chunk_no"), "piece",
        (F.col("whole") & (number.isNull() | field("WARC-Segment-Total-Length").isNotNull())).alias("last"),
        F.coalesce(field("WARC-Payload-Length", "long"), field("Content-Length", "long")).alias("bytes"),
        F.substr(field("WARC-Payload-Digest"), F.lit(6)).alias("digest"), "chunk")


def digests(chunks: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, taken from
    the payloads that were read (for a revisit, from its header, as it has none)."""
    ship(chunks.sparkSession)
    alone = F.col("last") & (F.col("chunk_no") == 1) & (F.col("piece") == 1)
    revisit = F.col("kind") == "revisit"
    out = chunks.filter(alone).select(
        "page_id", F.when(revisit, F.col("bytes")).otherwise(F.octet_length("chunk").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.sha1("chunk")).alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")
    order = ["origin", "chunk_no", "piece"]
    long = chunks.filter(~alone).select(*order, "last", "page_id", "kind", "chunk").repartition("origin").sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, size, at, about, open_ = None, hashlib.sha1(), 0, (0, 0), (None, None), False
        for batch in batches:
            done: list[tuple] = []
            for origin, no, piece, last, page, kind, chunk in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if origin is None:
                    raise ValueError("a long record has no record id")
                if now != origin:
                    if open_:
                        raise ValueError(f"record {now}: its last segment is missing")
                    now, sha, size, at, about = origin, hashlib.sha1(), 0, (0, 0), (page, kind)
                if (no, piece) != at:                       # else a repeated row's record
                    if (no, piece) not in ((at[0], at[1] + 1), (at[0] + 1, 1)):
                        raise ValueError(f"record {origin}: segment {no}, piece {piece} follows {at}")
                    sha.update(chunk)
                    size, at, open_ = size + len(chunk), (no, piece), not last
                if last:
                    done.append((*about, size, sha.hexdigest()))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)],
                                             names=["page_id", "record_type", "payload_bytes", "payload_digest"])
        if open_:
            raise ValueError(f"record {now}: its last segment is missing")

    joined = long.mapInArrow(run, "page_id long, record_type string, payload_bytes long, payload_digest string")
    return out.unionByName(joined.withColumn("refers_to", F.lit(None).cast("long")))


def round_trip(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Writes the archives to the shared folder and gives the digests of what it reads back."""
    path = work_path(pages.sparkSession, "warc")
    write(plan_records(pages), path, chunk)
    return digests(read(pages.sparkSession, path))
