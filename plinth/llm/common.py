"""Small helpers the operators share: work tables, Arrow column appending, hashing of words.

Work tables go to the shared folder of ``spark.checkpoint.dir`` (``plinth.session.work_path``),
so a lost executor costs a re-read, never a recomputation from an executor's own disk.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.session import work_path

_SHIPPED = "plinth-llm.zip"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once a session, so that worker functions import there."""
    sc = spark.sparkContext
    if getattr(sc, "_plinth_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="plinth-ship-"), _SHIPPED)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "plinth")):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._plinth_shipped = True


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again (cuts the lineage)."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ROWS rows from now on in this session; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS:
        spark.conf.set(key, str(ROWS))


def append(df: DataFrame, names_types: Sequence[tuple[str, T.DataType]],
           fn: Callable[[pa.RecordBatch], list[pa.Array]], leave: Sequence[str] = ()) -> DataFrame:
    """``df`` with columns that ``fn`` computes for each Arrow batch, without the columns ``leave``.

    An input column that has the name of a computed one is replaced.
    """
    ship(df.sparkSession)
    bound_batches(df.sparkSession)
    new, gone = {n.lower() for n, _ in names_types}, {c.lower() for c in leave}
    df = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in new])
    kept = [i for i, c in enumerate(df.columns) if c.lower() not in gone]
    schema = T.StructType([*[df.schema.fields[i] for i in kept], *[T.StructField(n, t) for n, t in names_types]])
    names = [f.name for f in schema.fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], *fn(part)], names=names)

    return df.mapInArrow(run, schema)


def in_share(hashed: Column, share: float) -> Column:
    """Whether a 64-bit hash is in the lowest ``share`` of its range, however small that is."""
    if share >= 1:
        return F.lit(True)
    return hashed < F.lit(int(share * 2.0**64) - 2**63).cast("long")


#: Rows that a worker holds in expanded form at once, and bytes of text a kernel joins at once.
ROWS, JOIN_BYTES = 1024, 1 << 20


def raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column as UTF-8 bytes; null is the empty text."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = JOIN_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, texts): runs of texts of about ``limit`` bytes; a longer text stands alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > limit:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, texts[at:]


# Words of many texts at once -------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words that are split at ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of words made of digits, letters a-z and all that is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_P = 0x9E3779B97F4A7C15 | 1
_IP = pow(_P, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(max(n, 1 << 12), base, np.uint64)
        p[0] = 1
        _powers[base] = np.multiply.accumulate(p)
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each i a hash of values[start[i]:stop[i]], by prefix sums of a polynomial mod 2**64."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(_P, n), out=sums[1:])
    at = start.astype(np.int64)
    return mix((sums[stop] - sums[at]) * powers(_IP, n + 1)[at] + (stop - start).astype(np.uint64))


class Words:
    """The words of several texts: byte ranges in ``data``, hashes, and each text's word range."""

    def __init__(self, texts: list[bytes], kind: np.ndarray = SPACED):
        joined = b"\n".join(texts)
        self.data = _LOWER[np.frombuffer(joined, np.uint8)] if joined else np.zeros(0, np.uint8)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.text_start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        starts, ends, hashes = [], [], []
        at, n = 0, len(self.data)
        while at < n:
            stop = min(n, at + JOIN_BYTES)
            while stop < n and kind[self.data[stop]]:      # never inside a word
                near = np.flatnonzero(~kind[self.data[stop:stop + 4096]])
                stop = min(n, stop + (int(near[0]) if len(near) else 4096))
            part = self.data[at:stop]
            flag = np.zeros(len(part) + 2, np.int8)
            flag[1:-1] = kind[part]
            step = np.diff(flag)
            s, e = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            if len(s):
                hashes.append(run_hashes(part.astype(np.uint64) + np.uint64(1), s, e))
                starts.append(s + at)
                ends.append(e + at)
            at = stop
        none = np.zeros(0, np.int64)
        self.start = np.concatenate(starts) if starts else none
        self.end = np.concatenate(ends) if ends else none
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.start, self.text_start)             # first word of each text
        self.stop = np.append(self.first[1:], len(self.start))

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return self.stop - self.first

    @property
    def text(self) -> np.ndarray:
        """The text's index, for each word."""
        return np.repeat(np.arange(len(self.first)), self.counts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum of its words' values."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.stop] - total[self.first]
