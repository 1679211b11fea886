"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no pattern matching: every code point has a class, a class is a function
from state to state, and functions compose associatively.  The texts of a batch are laid out in
blocks; all blocks compose their functions side by side (the closure of the class functions is
small, so a composed function is a number and composition a table), the blocks' functions are
chained, and a last side-by-side pass marks where pieces start.  The pieces are byte slices whose
merges are cached.  Each token keeps its byte offset.

The rank file's path is a parameter; its entries (a fixed vocabulary) are broadcast.

Defined results: a null text is encoded as the empty one (no ids); repeated rows give equal
results; an empty table gives an empty result; a piece of any length is merged by a heap.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plinth.llm.common import append, chunks, raw_texts, ship

# Classes: letter, number, other, apostrophe of a one- or two-letter ending, white space that is
# U+0020 or not and that has a non-space right after it ("last") or not, end of a text.
L, N, O, Q1, Q2, SP, SP_LAST, WS, WS_LAST, END = range(10)
# States: fresh, in letters, numbers, others, after a space that joins the next piece, in other
# white space, and one or two letters of an ending to come.
FRESH, IN_L, IN_N, IN_O, JOIN, IN_WS, END1, END2 = range(8)
_CODES = 0x110000


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a piece starts) by [class, state]."""
    to, new = np.zeros((10, 8), np.uint8), np.ones((10, 8), bool)
    for cls, state in ((L, IN_L), (N, IN_N), (O, IN_O)):
        to[cls] = state
        new[cls, [state, JOIN]] = False
    to[L, END2], to[L, END1] = END1, FRESH
    new[L, [END1, END2]] = False
    for cls, state in ((Q1, END1), (Q2, END2)):
        to[cls] = state
        to[cls, [IN_O, JOIN]] = IN_O
        new[cls, [IN_O, JOIN]] = False
    to[SP_LAST], to[WS_LAST] = JOIN, IN_WS
    for cls in (SP, WS):
        to[cls] = IN_WS
        new[cls, IN_WS] = False
    to[END] = FRESH
    return to, new


def _closure(to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All compositions of the class functions: (each one as a row of states, the table
    [f, class] -> number of "f, then class")."""
    known: dict[tuple, int] = {tuple(range(8)): 0}
    rows, table = [tuple(range(8))], []
    at = 0
    while at < len(rows):
        line = []
        for cls in range(10):
            f = tuple(int(to[cls, s]) for s in rows[at])
            if f not in known:
                known[f] = len(rows)
                rows.append(f)
            line.append(known[f])
        table.append(line)
        at += 1
    return np.array(rows, np.uint8), np.array(table, np.uint16)


_TO, _NEW = _machine()
_FUNCTIONS, _COMPOSE = _closure(_TO)


def piece_starts(cls: np.ndarray, block: int = 512) -> np.ndarray:
    """For each position of a class sequence whether a piece starts there."""
    n = len(cls)
    width = -(-n // block)
    laid = np.full(width * block, END, np.uint8)
    laid[:n] = cls
    laid = np.ascontiguousarray(laid.reshape(width, block).T)              # step, block number
    f = np.zeros(width, np.uint16)
    for step in laid:
        f = _COMPOSE[f, step]
    state = np.zeros(width, np.uint8)
    now = FRESH
    for k, row in enumerate(_FUNCTIONS[f].tolist()):                       # chain the blocks
        state[k] = now
        now = row[now]
    out = np.empty(laid.shape, bool)
    for k, step in enumerate(laid):
        out[k] = _NEW[step, state]
        state = _TO[step, state]
    return out.T.reshape(-1)[:n]


def code_classes() -> np.ndarray:
    """The class of each code point (white space as SP or WS, END at the last index).

    Taken from the tokenizer library's own character tables where it is installed, so that both
    know the same Unicode version; else from Python's.
    """
    out = np.full(_CODES + 1, O, np.uint8)
    try:
        import tiktoken
        singles = {bytes([i]): i for i in range(256)}
        text = "".join(map(chr, chain(range(0xD800), range(0xE000, _CODES))))
        for cls, kind in ((L, r"\p{L}"), (N, r"\p{N}"), (WS, r"\s")):
            of_kind = tiktoken.Encoding(f"kind{cls}", pat_str=kind, mergeable_ranks=singles, special_tokens={})
            found = bytes(of_kind.encode_ordinary(text)).decode("utf-8")
            out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = cls
    except ImportError:
        for c in range(_CODES):
            kind = unicodedata.category(chr(c))[0]
            out[c] = L if kind == "L" else N if kind == "N" else O
        out[[*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WS
    out[32], out[_CODES] = SP, END
    return out


def classify(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Classes of code points in which the texts are each followed by the code _CODES."""
    cls = table[codes]
    after = np.append(codes[1:], _CODES).astype(np.uint32)
    then = np.append(after[1:], _CODES).astype(np.uint32)
    mark = codes == 0x27
    if mark.any():
        at = np.flatnonzero(mark)
        a, b = after[at], then[at]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        cls[at[one]], cls[at[two]] = Q1, Q2
    white = (cls == SP) | (cls == WS)
    next_white = np.append(white[1:], True)
    next_white |= after == _CODES
    cls[white & ~next_white] += 1
    return cls


class Merges(dict):
    """piece -> its ids, as little-endian 32-bit bytes.

    Merges of pieces seen are kept in two generations of up to LIMIT pieces: a full one becomes
    the old one, out of which pieces that come again are taken over.
    """

    LIMIT = 1 << 16

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.none = ranks, max(ranks.values()) + 1
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.packed.get(piece) or self.old.get(piece)
        if ids is None:
            ids = self._short(piece) if len(piece) <= 64 else self._long(piece)
        if len(piece) <= 256:
            if len(self) >= self.LIMIT:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _short(self, piece: bytes) -> bytes:
        rank, none = self.ranks.get, self.none
        edge = list(range(len(piece) + 1))
        pair = [rank(piece[i:i + 2], none) for i in edge[:-2]]
        while pair and (best := min(pair)) != none:
            at = pair.index(best)
            del edge[at + 1], pair[at]
            if at < len(pair):
                pair[at] = rank(piece[edge[at]:edge[at + 2]], none)
            if at:
                pair[at - 1] = rank(piece[edge[at - 1]:edge[at + 1]], none)
        return b"".join([self.packed[piece[a:b]] for a, b in zip(edge, edge[1:], strict=False)])

    def _long(self, piece: bytes) -> bytes:
        ranks, n = self.ranks, len(piece)
        stop, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = stop[i]
            if j < n and (r := ranks.get(piece[i:stop[j]])) is not None:
                heapq.heappush(heap, (r, i, stop[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or stop[i] >= n or stop[stop[i]] != end or not alive[stop[i]]:
                continue
            alive[stop[i]] = False
            stop[i] = end
            if end < n:
                before[end] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return b"".join([self.packed[piece[i:stop[i]]] for i in range(n) if alive[i]])


class Coder:
    """Encodes and decodes texts by a rank table."""

    def __init__(self, ranks: dict[bytes, int], classes: np.ndarray):
        self.merges, self.classes = Merges(ranks), classes
        size = max(ranks.values()) + 1
        self.bytes = [b""] * size
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.size = np.array([len(b) for b in self.bytes], np.int32)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        out = []
        for _, some in chunks(texts, 1 << 18):
            some = [t.decode("utf-8", "replace") for t in some]
            codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in some]
            end = np.array([_CODES], np.uint32)
            joined = np.concatenate([x for c in codes for x in (c, end)])
            starts = np.flatnonzero(piece_starts(classify(joined, self.classes)))
            width = 1 + (joined >= 0x80).astype(np.int64) + (joined >= 0x800) + (joined >= 0x10000)
            width[joined == _CODES] = 0
            place = np.concatenate([[0], np.cumsum(width)])
            edge = place[starts].tolist()
            data = "".join(some).encode("utf-8")
            pieces = [data[a:b] for a, b in zip(edge, edge[1:] + [len(data)], strict=True)]
            # a text's end is an empty piece of its own, the last one of the text
            last = np.searchsorted(starts, np.cumsum([len(c) + 1 for c in codes]) - 1).tolist()
            at = 0
            for stop in last:
                out.append(np.frombuffer(b"".join(map(self.merges.__getitem__, pieces[at:stop])), "<i4"))
                at = stop + 1
        return out

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte offset in the text of each token."""
        return np.cumsum(self.size[ids], dtype=np.int32) - self.size[ids]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_coders: dict[str, Coder] = {}


class Vocabulary:
    """A rank file for the executors; a worker builds its coder once and keeps it."""

    def __init__(self, spark, path: str):
        ranks = read_ranks(path)
        ship(spark)
        self.name = hashlib.sha256(repr(sorted(ranks.items(), key=lambda x: x[1])).encode()).hexdigest()
        self.shared = spark.sparkContext.broadcast((ranks, code_classes()))

    def coder(self) -> Coder:
        if self.name not in _coders:
            _coders[self.name] = Coder(*self.shared.value)
        return _coders[self.name]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0] + [len(p) for p in parts])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.values.to_numpy(zero_copy_only=False)
    edge = column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


_INTS = T.ArrayType(T.IntegerType(), False)
_ENCODED = [("n_tokens", T.LongType()), ("ids", _INTS), ("offsets", _INTS)]
_DECODED = [("decoded", T.BinaryType()), ("ids_sha256", T.StringType())]


def _encoded(coder: Coder, ids: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array([len(i) for i in ids], pa.int64()), _lists(ids), _lists([coder.offsets(i) for i in ids])]


def _decoded(coder: Coder, ids: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array([coder.decode(i) for i in ids], pa.binary()),
            pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], pa.string())]


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, ``ids`` and ``offsets`` (bytes before each token)."""
    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = vocabulary.coder()
        return _encoded(coder, coder.encode(raw_texts(batch, text)))

    return append(df, _ENCODED, columns)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes of the ids (a null list is empty), and ``ids_sha256``, the
    digest of the ids as little-endian unsigned 32-bit integers."""
    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        return _decoded(vocabulary.coder(), _arrays(batch.column(ids)))

    return append(df, _DECODED, columns)


def round_trip(df: DataFrame, vocabulary: Vocabulary, text: str = "text", keep_text: bool = True) -> DataFrame:
    """What ``decode(encode(df))`` gives, in one Python step (so with one worker for each core);
    without ``keep_text`` the text isn't sent back."""
    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = vocabulary.coder()
        ids = coder.encode(raw_texts(batch, text))
        return _encoded(coder, ids) + _decoded(coder, ids)

    return append(df, _ENCODED + _DECODED, columns, () if keep_text else (text,))
