"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A byte-level BPE (A) reads a space and the text, a sentence-piece model (B) the text, to which it
adds that space itself.  The ends of A's and B's tokens are two sorted lists of byte offsets; to
align them is to merge them.  A merge path cuts the merge into pieces of equal work: binary
searches on evenly spaced diagonals tell how many ends of each list come before, so each piece
knows its ranges alone.  A piece emits one overlap (an A and a B token that share bytes) for each
distinct end in its range; a piece whose first end equals the last of the piece before leaves it
to that one, and groups that run across pieces are stitched from the overlaps in order.  Overlaps
whose two tokens end together are links; they end the groups.

The texts of a batch are merged as one pair of lists, so pieces are equal whatever the lengths of
texts are.  A text is tokenised in parts cut at single spaces between word characters, where
neither tokenizer has a token that goes across (checked for B's vocabulary when it is loaded), so
a worker reads equal parts once, many at a time; one stretch without such a space is a part of its
own.

A linked pair's bytes end together, so one is a suffix of the other: their number is bounded by
the two vocabularies (``Pair.bound``), not by the corpus, and the table of their counts over all
rows may go to the driver and to each task.

Defined results: null and empty texts, and those whose joined A or B bytes differ from space +
text, have no tokens, groups or links; special tokens' strings are plain text; repeated rows are
aligned one by one and count each; an empty table gives an empty result; input columns named like
an added one are replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import append, chunks, raw_texts, written

#: Merge steps of a piece; characters of a long text that are split into words at once; words read together.
PIECE, BLOCK_CHARS, SENTENCE = 1 << 16, 1 << 20, 512
#: Bytes of texts that are read and aligned together, and words whose tokens a worker keeps between them.
CHUNK_BYTES, KEPT_WORDS = 1 << 20, 300_000
_CUT = re.compile(r"(?<=\w) (?=\w)")


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level BPE files write bytes: printable Latin-1 ones stand for
    themselves, the others for 256, 257, ... in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Pair:
    """The two tokenizers, loaded in each worker from the files' bytes."""

    def __init__(self, a_json: bytes, b_model: bytes):
        self.a_json, self.b_model = a_json, b_model
        self.forget()

    def forget(self) -> None:
        """Drop the words read so far: their numbers, and by number A's and B's ids, counts, equality."""
        self.known: dict[str, int] = {}
        none = np.zeros(0, np.int64)
        self.read = [none.astype(np.int32), none, none.astype(np.int32), none, none.astype(bool)]

    def __reduce__(self):
        return Pair, (self.a_json, self.b_model)

    @cached_property
    def a(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        a = Tokenizer.from_str(self.a_json.decode())
        a.encode_special_tokens = True
        return a

    @cached_property
    def b(self):
        from sentencepiece import SentencePieceProcessor
        b = SentencePieceProcessor(model_proto=self.b_model)
        if any(re.search("[^▁]▁", b.id_to_piece(i)) for i in range(b.get_piece_size())):
            raise ValueError("a piece has a space after another character; long texts can't be cut at spaces")
        return b

    @cached_property
    def a_bytes(self) -> list[bytes]:
        letters, found = _byte_letters(), json.loads(self.a_json)
        vocabulary = {**found["model"]["vocab"], **{t["content"]: t["id"] for t in found["added_tokens"]}}
        out = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        return out

    @cached_property
    def b_bytes(self) -> list[bytes]:
        def of(piece: str) -> bytes:
            byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece)
            return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()
        return [of(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]

    @cached_property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(t) for t in v], np.int64) for v in (self.a_bytes, self.b_bytes))

    @cached_property
    def names(self) -> list[str]:
        """Ids as text with the mark that follows: A's with ``,`` and ``|``, then B's with ``,`` and ``;``."""
        a, b = range(len(self.a_bytes)), range(len(self.b_bytes))
        return [f"{i}{mark}" for ids, mark in ((a, ","), (a, "|"), (b, ","), (b, ";")) for i in ids]

    @cached_property
    def bound(self) -> int:
        """How many pairs of an A and a B token there are of which one is a suffix of the other."""
        def of(these, those):
            held: dict[bytes, int] = {}
            for t in these:
                held[t] = held.get(t, 0) + 1
            return sum(held.get(t[i:], 0) for t in those for i in range(len(t)))
        return of(self.a_bytes, self.b_bytes) + of(self.b_bytes, self.a_bytes)

    def tokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A's ids, how many of each word, B's ids, how many of each word, whether the bytes are those of
        space + word) for words that no token joins with a neighbour."""
        found_a = [x.ids for x in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
        found_b = self.b.encode(words, num_threads=1)
        out = []
        for ids in (found_a, found_b):
            out += [np.fromiter(chain.from_iterable(ids), np.int32), np.array([len(x) for x in ids], np.int64)]
        same = [_joined(self.a_bytes, a) == _joined(self.b_bytes, b) == b" " + w.encode()
                for w, a, b in zip(words, found_a, found_b, strict=True)]
        return *out, np.array(same, bool)

    def sentence_tokens(self, words: list[str]):
        """As ``tokens``, for words with word characters at both ends: read as sentences of them."""
        lists = [words[i:i + SENTENCE] for i in range(0, len(words), SENTENCE)]
        a_ids, a_counts, b_ids, b_counts, same = self.tokens([" ".join(x) for x in lists])
        if not same.all():                                                 # a byte differs somewhere: word by word
            return self.tokens(words)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        out = []
        for ids, size in ((a_ids, self.sizes[0]), (b_ids, self.sizes[1])):
            out += [ids, np.diff(np.searchsorted(np.cumsum(size[ids]), ends) + 1, prepend=0)]
        return *out, np.ones(len(words), bool)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A's and B's ids of space + text for the texts one after the other, and their numbers for each text;
        none where the bytes of one differ from it.  Words that the worker has read before aren't read again."""
        parts = [_CUT.split(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(parts))
        if len(self.known) > KEPT_WORDS or len(self.read[0]) > 8 * KEPT_WORDS:
            self.forget()
        known = self.known
        new = [w for w in dict.fromkeys(flat) if w not in known]
        # only the first and the last part of a text can begin or end without a word character
        ends = {w for some, t in zip(parts, texts, strict=True) if some for w in (some if "▁" in t else (some[0], some[-1]))}
        other = [w for w in new if w in ends and not _plain(w)]
        plain = [w for w in new if w not in ends or _plain(w)]
        if new:
            found = [self.sentence_tokens(plain), self.tokens(other)]
            self.read = [np.concatenate(x) for x in zip(self.read, *found, strict=True)]
            known.update(zip(chain(plain, other), range(len(known), len(known) + len(new)), strict=True))
        order = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
        a_ids, a_counts, b_ids, b_counts, same = self.read
        text = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
        bad = np.zeros(len(texts), bool)
        bad[text[~same[order]]] = True
        order, text = order[~bad[text]], text[~bad[text]]
        out, counts = [], np.zeros((len(texts), 2), np.int64)
        for side, (ids, n) in enumerate(((a_ids, a_counts), (b_ids, b_counts))):
            take = n[order]
            first = (np.cumsum(n) - n)[order] - (np.cumsum(take) - take)
            out.append(ids[np.repeat(first, take) + np.arange(take.sum())])
            counts[:, side] = np.bincount(text, take, len(texts))
        return *out, counts


def _joined(table: list[bytes], ids: list[int]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


def _plain(word: str) -> bool:
    """Whether the word has word characters at both ends (and no mark that B reads as a space)."""
    return (word[0].isalnum() or word[0] == "_") and (word[-1].isalnum() or word[-1] == "_") and "▁" not in word


def _blocks(text: str):
    """A long text cut at some single spaces between word characters, which are left out."""
    at = 0
    while len(text) - at > BLOCK_CHARS:
        cut = _CUT.search(text, at + BLOCK_CHARS)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def load(json_path: str, model_path: str) -> Pair:
    with open(json_path, "rb") as a, open(model_path, "rb") as b:
        return Pair(a.read(), b.read())


def path_cuts(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two sorted lists (an end of A before an equal one of B) stands after 0, size,
    2 size, ... steps and at its end: how many of A and of B came.  One binary search a diagonal, all at once."""
    steps = np.append(np.arange(0, len(a) + len(b), size), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        i = (low + high) // 2
        j = steps - i - 1
        first = np.zeros(len(steps), bool)
        first[open_] = a[i[open_]] <= b[j[open_]]
        low, high = np.where(open_ & first, i + 1, low), np.where(open_ & ~first, i, high)
    return low, steps - low


def piece_overlaps(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, np.ndarray]:
    """(A index, B index) of the overlaps that end inside one piece."""
    ends = np.concatenate([a[i0:i1], b[j0:j1]])
    ends.sort(kind="stable")                                               # two sorted runs: a merge
    before = max(a[i0 - 1] if i0 else 0, b[j0 - 1] if j0 else 0)
    ends = ends[np.diff(ends, prepend=before) > 0]
    return i0 + np.searchsorted(a[i0:i1], ends), j0 + np.searchsorted(b[j0:j1], ends)


def overlaps(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(A index, B index) of all overlaps of two lists of token ends, in order, piece by piece."""
    i, j = path_cuts(a, b, size)
    found = [piece_overlaps(a, b, *cut) for cut in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist(), strict=True)]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Aligned:
    """The alignment of several texts: their tokens one after the other, overlaps, groups and links."""

    def __init__(self, pair: Pair, texts: list[bytes]):
        some = [t.decode("utf-8", "replace") for t in texts]
        if len(some) == 1 and len(some[0]) > BLOCK_CHARS:                  # a long text, block by block
            found = [pair.encode([x]) for x in _blocks(some[0])]
            whole = all(x[2].any() for x in found)
            self.a, self.b = (np.concatenate([x[w] for x in found] if whole else [found[0][w][:0]]) for w in (0, 1))
            self.counts = np.array([[len(self.a), len(self.b)]], np.int64)
        else:
            self.a, self.b, self.counts = pair.encode(some)
        a_end, b_end = np.cumsum(pair.sizes[0][self.a]), np.cumsum(pair.sizes[1][self.b])
        self.over_a, self.over_b = overlaps(a_end, b_end)
        ends = np.flatnonzero(a_end[self.over_a] == b_end[self.over_b])
        self.link_a, self.link_b = self.over_a[ends], self.over_b[ends]    # the last tokens of each group
        self.a_sizes, self.b_sizes = np.diff(self.link_a, prepend=-1), np.diff(self.link_b, prepend=-1)

    def by_text(self, which: int, last: np.ndarray) -> np.ndarray:
        """How many of the ascending token numbers ``last`` each text has."""
        stops = np.cumsum(self.counts[:, which])
        return np.diff(np.searchsorted(last, stops), prepend=0)

    def digests(self, pair: Pair) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` of each text; '' without tokens."""
        n_a, n_b = len(pair.a_bytes), len(pair.b_bytes)
        group_a = np.repeat(np.arange(len(self.a_sizes)), self.a_sizes)
        group_b = np.repeat(np.arange(len(self.b_sizes)), self.b_sizes)
        line = np.empty(len(self.a) + len(self.b), np.int64)
        a, b = self.a.astype(np.int64), self.b.astype(np.int64) + 2 * n_a
        a[self.link_a] += n_a
        b[self.link_b] += n_b
        line[np.arange(len(a)) + (np.cumsum(self.b_sizes) - self.b_sizes)[group_a]] = a
        line[np.arange(len(b)) + np.cumsum(self.a_sizes)[group_b]] = b
        out, at, names = [], 0, pair.names
        for n in self.counts.sum(1).tolist():
            text = "".join(map(names.__getitem__, line[at:at + n].tolist()))
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest() if n else "")
            at += n
        return out


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


_ARRAYS = {"a_ids": T.IntegerType(), "b_ids": T.IntegerType(), "a_sizes": T.IntegerType(), "b_sizes": T.IntegerType(),
           "overlap_a": T.IntegerType(), "overlap_b": T.IntegerType(), "links": T.LongType()}
_PLAIN = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "groups_sha256": T.StringType()}
#: All that ``align`` can add: ids, the numbers of A and B tokens of each group, the A and B token number of
#: each overlap, each link as A id * (size of B's vocabulary) + B id; counts; the digest of the groups.
COLUMNS = {**{k: T.ArrayType(v) for k, v in _ARRAYS.items()}, **_PLAIN}


def align(df: DataFrame, pair: Pair, add: tuple[str, ...] = tuple(COLUMNS), text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with the columns ``add`` of COLUMNS."""
    sent = df.sparkSession.sparkContext.broadcast(pair)                    # the vocabularies' files

    def some(texts: list[bytes]) -> list[pa.Array]:
        p = sent.value
        found = Aligned(p, texts)
        links = found.by_text(0, found.link_a)
        over = found.by_text(0, found.over_a)
        starts = [np.concatenate([[0], np.cumsum(found.counts[:, w])])[:-1] for w in (0, 1)]
        values = {
            "a_ids": lambda: (found.a, found.counts[:, 0]), "b_ids": lambda: (found.b, found.counts[:, 1]),
            "a_sizes": lambda: (found.a_sizes, links), "b_sizes": lambda: (found.b_sizes, links),
            "overlap_a": lambda: (found.over_a - np.repeat(starts[0], over), over),
            "overlap_b": lambda: (found.over_b - np.repeat(starts[1], over), over),
            "links": lambda: (found.a[found.link_a].astype(np.int64) * len(p.b_bytes) + found.b[found.link_b], links),
            "n_a": lambda: found.counts[:, 0], "n_b": lambda: found.counts[:, 1], "n_groups": lambda: links,
            "groups_sha256": lambda: found.digests(p)}
        out = []
        for name in add:
            made = values[name]()
            if name in _ARRAYS:
                out.append(_lists(*made, pa.int64() if name == "links" else pa.int32()))
            else:
                out.append(pa.array(made))
        return out

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        parts = [some(texts) for _, texts in chunks(raw_texts(batch, text), CHUNK_BYTES)]
        return [pa.concat_arrays(p) for p in zip(*parts, strict=True)]

    return append(df, [(c, COLUMNS[c]) for c in add], columns, leave=() if keep_text else [text])


def link_counts(aligned: DataFrame) -> DataFrame:
    """(link, n): how many links of all rows hold each pair."""
    return aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n"))


def with_scores(aligned: DataFrame, pair: Pair) -> DataFrame:
    """A written ``aligned`` with ``n_links``, ``n_best`` (links whose pair is as frequent as its B id's most
    frequent one) and ``count_sum`` (the frequencies of its links' pairs), instead of ``links``."""
    counts = link_counts(aligned).toArrow()                                # at most pair.bound rows
    if counts.num_rows > pair.bound:
        raise RuntimeError("more linked pairs than the vocabularies allow")
    link, n = (counts.column(c).to_numpy() for c in ("link", "n"))
    order = np.argsort(link)
    link, n = link[order], n[order]
    b = link % len(pair.b_bytes)
    top = np.zeros(len(pair.b_bytes), np.int64)
    np.maximum.at(top, b, n)
    sent = aligned.sparkSession.sparkContext.broadcast((link, n, n == top[b]))

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        lists = batch.column("links")
        stops = np.asarray(lists.offsets)
        values = np.asarray(lists.values)[stops[0]:stops[-1]]
        known, many, best = sent.value
        at = np.searchsorted(known, values)
        sums = [np.concatenate([[0], np.cumsum(x[at])]) for x in (best, many)]
        edges = stops - stops[0]
        return [pa.array(np.diff(edges).astype(np.int64)), *[pa.array(np.diff(s[edges]).astype(np.int64)) for s in sums]]

    names = [(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")]
    return append(aligned, names, columns, leave=["links"])


def aligned_scores(df: DataFrame, pair: Pair, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, counts, group digest and link scores of each row: one pass over the texts, whose links are written
    to the shared folder, and one over the links."""
    first = align(df.select(f"`{key}`", f"`{text}`"), pair, ("n_a", "n_b", "n_groups", "groups_sha256", "links"),
                  text, keep_text=False)
    return with_scores(written(first, "align"), pair)
