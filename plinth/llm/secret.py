"""Secret scans by a trigram inverted index.

Each rule is a regular expression over the bytes of a text.  From its parse tree comes a Boolean
query of trigrams that every match must contain, letters folded to lower case: strings that follow
each other are joined, alternatives become an OR of their ANDs, and what has too many forms
(open classes, open repeats) ends a string.  The index is partitioned by rows, as search engines
shard it: a segment is at most ROWS rows of a partition, with a posting list of its rows for each
trigram that some rule asks for.  A rule's query intersects and unites posting lists; only the
rows left are read by the expression.  A rule without a mandatory trigram reads all rows.

Index, query and check of a segment happen in one task, so texts are read once and never
shuffled, and no group grows with a key.  ``postings`` gives the same index as a table and
``candidates`` asks it, for callers who keep it.

Defined results: a null text is empty and has no spans; offsets count code points, the end is
exclusive; spans of one rule never overlap (leftmost first), those of different rules may; repeated
rows are scanned one by one; an empty table gives an empty result; an input column ``secrets`` is
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from re import _constants as K
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import _LOWER, ROWS, append, bound_batches, chunks, raw_texts, ship


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern.encode(), re.IGNORECASE if self.any_case else 0)


#: The three base rules, in the order of their kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         any_case=True, group=2, least=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
)
#: Rules beyond the base: key blocks and the public formats of some services' keys.
MORE = (
    Rule("key_block", r"-----BEGIN (?:[A-Z]{2,12} ){0,3}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("bearer", r"authorization\x20*[:=]\x20*[\"']?(?:bearer|basic)\x20+([A-Za-z0-9+/_.=~-]+)", any_case=True, group=1, least=16),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,11}://[A-Za-z0-9._%+-]{1,64}:[A-Za-z0-9._%+!$&*=~-]{4,64}@[A-Za-z0-9.-]+"),
)
RULES = BASE + MORE

# Boolean queries: a trigram (bytes), ("all", parts) or ("any", parts); ("all", ()) holds for every text.
ALL = ("all", ())
#: Strings that a part of an expression may stand for before it is closed, and members of a class.
_MOST_STRINGS, _MOST_MEMBERS = 64, 8


def _all(parts: Iterable) -> tuple | bytes:
    kept = tuple(dict.fromkeys(p for p in parts if p != ALL))
    return kept[0] if len(kept) == 1 else ("all", kept)


def _any(parts: Iterable) -> tuple | bytes:
    kept = tuple(dict.fromkeys(parts))
    return ALL if ALL in kept else kept[0] if len(kept) == 1 else ("any", kept)


def _of_strings(strings: set[bytes]) -> tuple | bytes:
    """The query of texts that hold one of the strings; what needs more than another one is left out."""
    sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)): s for s in sorted(strings, reverse=True)}
    least = [s for k, s in sets.items() if not any(other < k for other in sets)]
    return _any(_all(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(least))


def _members(items: list) -> set[bytes] | None:
    found: set[int] = set()
    for op, arg in items:
        if op is K.LITERAL:
            found.add(arg)
        elif op is K.RANGE and arg[1] - arg[0] < 4 * _MOST_MEMBERS:
            found.update(range(arg[0], arg[1] + 1))
        else:                                                              # negation, categories, long ranges
            return None
    folded = {bytes([c]).lower() for c in found if c < 256}
    return folded if len(folded) <= _MOST_MEMBERS else None


def _strings(op, arg) -> set[bytes] | None:
    """All strings (folded) that a part can match, or None if they are too many."""
    if op is K.LITERAL:
        return {bytes([arg]).lower()} if arg < 256 else None
    if op is K.IN:
        return _members(arg)
    if op is K.AT:
        return {b""}
    if op is K.SUBPATTERN:
        return _joined(arg[-1])
    if op is K.BRANCH:
        parts = [_joined(p) for p in arg[1]]
        found = set().union(*parts) if None not in parts else None
        return found if found is None or len(found) <= _MOST_STRINGS else None
    if op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[1] is not K.MAXREPEAT and arg[1] <= 4:
        body = _joined(arg[2])
        if body is None:
            return None
        found, now = set(), {b""}
        for n in range(int(arg[1]) + 1):
            found |= now if n >= arg[0] else set()
            now = {a + b for a in now for b in body}
            if len(found) + len(now) > _MOST_STRINGS:
                return None
        return found
    return None


def _joined(tree) -> set[bytes] | None:
    found = {b""}
    for op, arg in tree:
        part = _strings(op, arg)
        if part is None or len(found) * len(part) > _MOST_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def _of_tree(tree) -> tuple | bytes:
    parts, run = [], {b""}
    for op, arg in tree:
        strings = _strings(op, arg)
        if strings is not None and len(run) * len(strings) <= _MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        parts.append(_of_strings(run))
        run = strings if strings is not None else {b""}
        if strings is None:
            if op is K.SUBPATTERN:
                parts.append(_of_tree(arg[-1]))
            elif op is K.BRANCH:
                parts.append(_any(_of_tree(p) for p in arg[1]))
            elif op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] > 0:
                parts.append(_of_tree(arg[2]))
    return _all([*parts, _of_strings(run)])


@cache
def query(rule: Rule) -> tuple | bytes:
    """The trigrams that each match of the rule needs, as a Boolean query; ALL if there are none."""
    return _of_tree(parser.parse(rule.pattern.encode(), re.IGNORECASE if rule.any_case else 0))


def trigrams(q: tuple | bytes) -> set[bytes]:
    return {q} if isinstance(q, bytes) else set().union(*[trigrams(p) for p in q[1]])


class Segment:
    """Posting lists of the rows of some texts for the trigrams asked for."""

    def __init__(self, texts: list[bytes], wanted: tuple[bytes, ...]):
        self.n, self.wanted = len(texts), wanted
        codes, classes, size = _codes(wanted)
        found = []
        for first, some in chunks(texts):
            for row, text in _long(some):
                data = classes[_LOWER[np.frombuffer(text, np.uint8)]]
                if len(data) > 2:
                    code = (data[:-2] * size + data[1:-1]) * size + data[2:]
                    at = np.flatnonzero(codes[code] >= 0)
                    owner = np.searchsorted(row, at, side="right") - 1 + first
                    found.append(np.unique(codes[code[at]].astype(np.int64) * self.n + owner))
        self.keys = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def rows(self, trigram: bytes) -> np.ndarray:
        k = self.wanted.index(trigram)
        a, b = np.searchsorted(self.keys, [k * self.n, (k + 1) * self.n])
        return self.keys[a:b] - k * self.n

    def ask(self, q: tuple | bytes) -> np.ndarray:
        """The rows that satisfy a query, in order; short lists first where all must hold."""
        if isinstance(q, bytes):
            return self.rows(q)
        if q == ALL:
            return np.arange(self.n)
        parts = sorted((self.ask(p) for p in q[1]), key=len)
        out = parts[0]
        for p in parts[1:]:
            if q[0] == "all" and not len(out):
                break
            out = np.intersect1d(out, p, assume_unique=True) if q[0] == "all" else np.union1d(out, p)
        return out


@cache
def _codes(wanted: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the trigram by code, class of a byte, number of classes): bytes in no trigram share a class."""
    classes = np.zeros(256, np.int32)
    for i, b in enumerate(sorted({b for t in wanted for b in t}), 1):
        classes[b] = i
    size = int(classes.max()) + 1
    codes = np.full(size ** 3, -1, np.int32)
    for i, t in enumerate(wanted):
        a, b, c = (int(classes[x]) for x in t)
        codes[(a * size + b) * size + c] = i
    return codes, classes, size


def _long(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """(start of each text, joined bytes): short texts together, one long text in overlapping parts."""
    if len(texts) > 1 or len(texts[0]) <= 1 << 20:
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        yield np.concatenate([[0], np.cumsum(sizes)])[:-1], b"\x00".join(texts)
        return
    for at in range(0, len(texts[0]), 1 << 20):
        yield np.zeros(1, np.int64), texts[0][at:at + (1 << 20) + 2]


def _found(text: bytes, rule: Rule, rx: re.Pattern) -> list[tuple[int, int]]:
    return [m.span() for m in rx.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _reader(rule: Rule) -> re.Pattern:
    """The expression that reads candidates: a rule that is one class repeated, kept from ``least`` on, may
    ask for the length itself, since its matches are the longest runs."""
    tree = parser.parse(rule.pattern.encode())
    if len(tree) == 1 and tree[0][0] is K.MAX_REPEAT and tree[0][1][:2] == (1, K.MAXREPEAT) \
            and len(tree[0][1][2]) == 1 and tree[0][1][2][0][0] is K.IN and rule.group == 0 and rule.least > 1:
        return re.compile(rule.pattern.encode()[:-1] + b"{%d,}" % rule.least, re.IGNORECASE if rule.any_case else 0)
    return rule.compiled()


def find(texts: list[bytes], rules: tuple[Rule, ...]) -> dict[int, list[tuple[int, int, int]]]:
    """row -> (start, rule, end) of its spans in code points, in order, for the rows that have any."""
    segment = Segment(texts, _wanted(rules))
    found: dict[int, list[tuple[int, int, int]]] = {}
    for r, rule in enumerate(rules):
        rx = _reader(rule)
        for row in segment.ask(query(rule)).tolist():
            for a, b in _found(texts[row], rule, rx):
                found.setdefault(row, []).append((a, r, b))
    for row, spans in found.items():
        spans.sort()
        if not texts[row].isascii():
            ends = sorted({x for a, _, b in spans for x in (a, b)})
            place, at, n = {}, 0, 0
            for x in ends:                                                 # matches begin and end at ASCII bytes
                n, at = n + len(texts[row][at:x].decode("utf-8", "replace")), x
                place[x] = n
            spans[:] = [(place[a], r, place[b]) for a, r, b in spans]
    return found


@cache
def _wanted(rules: tuple[Rule, ...]) -> tuple[bytes, ...]:
    return tuple(sorted(set().union(*[trigrams(query(r)) for r in rules])))


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``secrets``, its spans (kind, start, end) by start, then by the rules' order."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        found = find(raw_texts(batch, text), rules)
        return [pa.array([[{"kind": rules[r].kind, "start": a, "end": b} for a, r, b in found.get(i, ())]
                          for i in range(batch.num_rows)], kind)]

    return append(df, [("secrets", SPANS)], columns, leave=() if keep_text else [text])


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(df: DataFrame, text: str = "text", spans: str = "secrets") -> DataFrame:
    """``df`` with each span of the text replaced by its kind in brackets; of spans that overlap, the
    first by start (then by the rules' order) names the hole, which covers all of them."""
    body, state = F.col(f"`{text}`"), "struct<out:string,at:bigint>"

    def step(acc, s):
        more = F.concat(acc["out"], body.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                        F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.when(s["start"] >= acc["at"], more).otherwise(acc["out"]).alias("out"),
                        F.greatest(acc["at"], s["end"]).alias("at")).cast(state)

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at")).cast(state)
    folded = F.aggregate(F.col(spans), start, step)
    rest = F.concat(folded["out"], body.substr((folded["at"] + 1).cast("int"), F.length(body)))
    return df.withColumn(text, F.when(F.size(spans) > 0, rest).otherwise(body))


def postings(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index as a table: for each segment and trigram the keys of its rows (trigram, keys)."""
    wanted = _wanted(rules)
    ship(df.sparkSession)
    bound_batches(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                segment, keys = Segment(raw_texts(part, text), wanted), part.column(key)
                rows = [(t, keys.take(pa.array(segment.rows(t)))) for t in wanted]
                rows = [(t, k.to_pylist()) for t, k in rows if len(k)]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.binary()),
                                                  pa.array([k for _, k in rows], pa.list_(keys.type))], ["trigram", "keys"])

    schema = T.StructType([T.StructField("trigram", T.BinaryType()),
                           T.StructField("keys", T.ArrayType(df.schema[key].dataType))])
    return df.select(f"`{key}`", f"`{text}`").mapInArrow(run, schema)


def candidates(index: DataFrame, rule: Rule) -> DataFrame:
    """The keys whose posting lists satisfy the rule's query; only lists of its trigrams are read."""
    q = query(rule)
    if q == ALL:
        raise ValueError(f"{rule.kind} has no mandatory trigram; scan all rows")
    wanted = sorted(trigrams(q))
    asked = index.filter(F.col("trigram").isin(*[F.lit(t) for t in wanted]))
    held = asked.select(F.explode("keys").alias("key"), "trigram").groupBy("key").agg(
        *[F.max(F.col("trigram") == F.lit(t)).alias(f"t{i}") for i, t in enumerate(wanted)])

    def holds(part) -> Column:
        if isinstance(part, bytes):
            return F.col(f"t{wanted.index(part)}")
        out = F.lit(part[0] == "all")
        for p in part[1]:
            out = (out & holds(p)) if part[0] == "all" else (out | holds(p))
        return out

    return held.filter(holds(q)).select("key")
