"""Chat formatting: roles of transcript turns by a hidden Markov model, then canonical turns.

A transcript is rows (conversation, turn, text); a text may begin with a speaker marker
("User:", "Bot>", "### System"), or not.  The hidden state is the role; what is seen of a turn is
one symbol made of its marker and of features of its lines.  The most likely roles of each
conversation (Viterbi) label the turns, whose markers go, and every turn is rendered alike.

A conversation may be long, so no step needs one in one task: the rows are range-partitioned by
(conversation, turn), and a conversation cut by a partition's edge is decoded in parts.  Each part
first gives the best score from every role before it to every role at its end (a max-plus matrix);
these small matrices, of the first and last conversation of each partition only, are chained on the
driver, which fixes the roles at the cuts; then each part decodes between its fixed ends.  The
result is that of one Viterbi run over the whole conversation.

Rates are counts over all rows whose role is known, pairs across cuts included, summed in Spark.  Turn marks
inside a text are escaped, which ``unescape`` undoes.

Defined results: a null text is empty; equal turn numbers follow the order of their texts' hashes;
a null turn comes first and rows of null conversation are one conversation; repeated rows are turns
like others; a role outside ROLES counts as unknown; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import ship, written

ROLES = ("system", "user", "assistant")
#: Marker words of each role.
MARKERS = {"system": "system|instructions?", "user": "user|human|customer|question|q|me", "assistant": "assistant|ai|bot|agent|answer|a"}
_SHAPE = r"(?i)^\s*(?:#+ *)?(?:\[|\*\*|<\|?)?(?:%s)(?:\]|\*\*|\|?>)? *(?:[:>]|\n)\s*"
_SYMBOLS, _ROWS = 4 * 4 * 3 * 2, 100_000


def symbol(text: Column) -> Column:
    """The symbol of a turn: marker, length, number of lines, whether a question mark is in it."""
    marker = F.lit(0)
    for k, role in reversed(list(enumerate(ROLES, 1))):
        marker = F.when(text.rlike(_SHAPE % MARKERS[role]), k).otherwise(marker)
    bare = strip_marker(text)
    size, lines = F.length(bare), F.length(bare) - F.length(F.replace(bare, F.lit("\n")))
    length = F.when(size < 80, 0).when(size < 300, 1).when(size < 800, 2).otherwise(3)
    return marker * 24 + length * 6 + F.least(lines, F.lit(2)) * 2 + F.contains(bare, F.lit("?")).cast("int")


def strip_marker(text: Column) -> Column:
    return F.regexp_replace(text, _SHAPE % "|".join(MARKERS.values()), "")


def escape(text: Column) -> Column:
    """The text with its own turn marks made harmless: each gets one backslash more behind its "<"."""
    return F.regexp_replace(text, r"<(\\*)\|im_(start|end)\|>", r"<\\$1|im_$2|>")


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    return F.regexp_replace(text, r"<\\(\\*)\|im_(start|end)\|>", "<$1|im_$2|>")


def render(role: Column, text: Column) -> Column:
    """The canonical form of one turn; no text can end it or begin another."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), escape(F.trim(text)), F.lit("<|im_end|>\n"))


def _ordered(turns: DataFrame) -> DataFrame:
    """The turns with ``part`` (a contiguous range of the order) and the columns of the order."""
    order = ["conv", "turn_no", "tie"]
    n = max(1, -(-turns.count() // _ROWS), int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return written(turns.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "turns")


def _runs(frame: pd.DataFrame) -> tuple[pd.DataFrame, list[tuple[int, int]]]:
    frame = frame.sort_values(["conv", "turn_no", "tie"], kind="stable").reset_index(drop=True)
    conv = frame["conv"].to_numpy()
    edge = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1], [True]]))
    return frame, list(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))


def _counts(frame: pd.DataFrame) -> pd.DataFrame:
    """(part, kind, i, j, n): first roles, pairs of roles, symbols of roles, and the part's ends."""
    frame, runs = _runs(frame)
    role, seen, part = frame["state"].to_numpy(), frame["symbol"].to_numpy(), int(frame["part"].iloc[0])
    rows: dict[tuple, int] = {}
    for a, b in runs[1:]:
        rows["start", role[a], 0] = rows.get(("start", role[a], 0), 0) + 1
    same = np.ones(len(frame), bool)
    same[[a for a, _ in runs]] = False
    for kind, x, y in (("pair", role[:-1][same[1:]], role[1:][same[1:]]), ("seen", role, seen)):
        for i, j in zip(*np.unique(np.stack([x, y]), axis=1), strict=True):
            rows[kind, int(i), int(j)] = int(((x == i) & (y == j)).sum())
    out = [(part, k, int(i), int(j), n) for (k, i, j), n in rows.items()]
    conv = frame["conv"].to_numpy()
    out += [(part, "first", int(role[0]), 0, int(conv[0])), (part, "last", int(role[-1]), 0, int(conv[-1]))]
    return pd.DataFrame(out, columns=["part", "kind", "i", "j", "n"])


class Model:
    """Log-rates of first roles, of following roles and of symbols."""

    def __init__(self, rows: list[tuple]):
        k = len(ROLES)
        start, pair, seen = np.full(k, 0.5), np.full((k, k), 0.5), np.full((k, _SYMBOLS), 0.1)
        ends: dict[int, dict[str, tuple[int, int]]] = {}
        for part, kind, i, j, n in rows:
            if kind in ("first", "last"):
                ends.setdefault(part, {})[kind] = (i, n)
            elif i < k and kind == "start":
                start[i] += n
            elif i < k and kind == "seen":
                seen[i, j] += n
            elif i < k and j < k:
                pair[i, j] += n
        before = None
        for part in sorted(ends):
            role, conv = ends[part]["first"]
            if before is not None and before[1] == conv:
                if before[0] < k and role < k:
                    pair[before[0], role] += 1
            elif role < k:
                start[role] += 1
            before = ends[part]["last"]
        self.start = np.log(start / start.sum())
        self.pair = np.log(pair / pair.sum(1, keepdims=True))
        self.seen = np.log(seen / seen.sum(1, keepdims=True))

    def transfer(self, symbols: np.ndarray) -> np.ndarray:
        """[role before, role at the end]: the best score of a part; the last row is a start."""
        k = len(ROLES)
        best = np.vstack([self.pair, self.start]) + self.seen[:, symbols[0]]
        for s in symbols[1:]:
            best = (best[:, :, None] + self.pair[None]).max(1) + self.seen[:, s]
        return best.reshape(k + 1, k)

    def decode(self, symbols: np.ndarray, before: int, end: int | None) -> np.ndarray:
        """The best roles of a part after the role ``before`` (-1: a start) that end in ``end``."""
        n = len(symbols)
        back = np.zeros((n, len(ROLES)), np.int8)
        best = (self.start if before < 0 else self.pair[before]) + self.seen[:, symbols[0]]
        for t in range(1, n):
            score = best[:, None] + self.pair
            back[t] = score.argmax(0)
            best = score.max(0) + self.seen[:, symbols[t]]
        out = np.empty(n, np.int64)
        out[-1] = best.argmax() if end is None else end
        for t in range(n - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out


def _edges(model: Model) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame, runs = _runs(frame)
        conv, seen = frame["conv"].to_numpy(), frame["symbol"].to_numpy()
        ends = sorted({runs[0], runs[-1]})
        return pd.DataFrame({"part": int(frame["part"].iloc[0]), "conv": [int(conv[a]) for a, _ in ends],
                             "best": [model.transfer(seen[a:b]).ravel().tolist() for a, b in ends]})
    return run


def fixed_ends(edges: list[tuple[int, int, list[float]]]) -> dict[tuple[int, int], tuple[int, int]]:
    """(part, conversation) -> (role before, role at the end) for the parts of cut conversations."""
    out: dict[tuple[int, int], tuple[int, int]] = {}
    k, chains = len(ROLES), {}
    for part, conv, best in sorted(edges):
        chains.setdefault(conv, []).append((part, np.array(best).reshape(k + 1, k)))
    for conv, parts in chains.items():
        if len(parts) < 2:
            continue
        score, froms = parts[0][1][k], []
        for _, best in parts[1:]:
            step = score[:, None] + best[:k]
            froms.append(step.argmax(0))
            score = step.max(0)
        end = int(score.argmax())
        for (part, _), came in zip(parts[:0:-1], froms[::-1], strict=True):
            out[part, conv] = (int(came[end]), end)
            end = int(came[end])
        out[parts[0][0], conv] = (-1, end)
    return out


def parse(transcripts: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", role: str = "role") -> DataFrame:
    """(conv_id, turn, role, role_pred, rendered): one row per row; ``role`` is only learned from."""
    ship(transcripts.sparkSession)
    state = F.lit(len(ROLES))
    for k, name in enumerate(ROLES):
        state = F.when(F.col(role) == name, k).otherwise(state)
    body = F.coalesce(F.col(text), F.lit(""))
    turns = transcripts.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), body.alias("text"),
                               F.coalesce(F.col(conv).cast("long"), F.lit(-(1 << 62))).alias("conv"),
                               F.coalesce(F.col(turn).cast("long"), F.lit(-(1 << 62))).alias("turn_no"),
                               F.xxhash64(body, role).alias("tie"), state.alias("state"), symbol(body).alias("symbol"))
    turns = _ordered(turns)
    narrow = turns.select("part", "conv", "turn_no", "tie", "state", "symbol")
    counts = written(narrow.groupBy("part").applyInPandas(_counts, "part int, kind string, i int, j int, n long"), "counts")
    ends = F.col("kind").isin("first", "last")                      # two rows for each part
    sums = counts.filter(~ends).groupBy("kind", "i", "j").agg(F.sum("n")).collect()      # one for each rate
    model = Model([tuple(r) for r in counts.filter(ends).collect()] + [(-1, *r) for r in sums])
    edges = narrow.groupBy("part").applyInPandas(_edges(model), "part int, conv long, best array<double>").collect()
    fixed = fixed_ends([(r["part"], r["conv"], r["best"]) for r in edges])

    def label(frame: pd.DataFrame) -> pd.DataFrame:
        frame, runs = _runs(frame)
        part, seen, names = int(frame["part"].iloc[0]), frame["symbol"].to_numpy(), frame["conv"].to_numpy()
        found = [model.decode(seen[a:b], *fixed.get((part, int(names[a])), (-1, None))) for a, b in runs]
        out = frame[["conv_id", "turn", "role", "text"]].copy()
        out["role_pred"] = [ROLES[s] for s in np.concatenate(found)]
        return out

    kinds = dict(turns.dtypes)
    labelled = turns.groupBy("part").applyInPandas(
        label, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, role_pred string")
    return labelled.select("conv_id", "turn", "role", "role_pred", render(F.col("role_pred"), strip_marker(F.col("text"))).alias("rendered"))


def transcripts_of(conversations: DataFrame) -> DataFrame:
    """Plain transcripts of a conversations table: three turns of four begin with one of several
    markers of their role, by a hash; of the others, the parser sees the text alone."""
    pick = lambda *names: F.element_at(F.array(*map(F.lit, names)), F.pmod(F.xxhash64("turn", "conv_id"), F.lit(len(names))).cast("int") + 1)
    marker = (F.when(F.col("role") == "system", pick("System: ", "### Instruction\n", "[system]: "))
              .when(F.col("role") == "user", pick("User: ", "Human: ", "Q: ", "**User**: "))
              .when(F.col("role") == "assistant", pick("Assistant: ", "Bot> ", "A: ", "<|assistant|>\n")).otherwise(""))
    hidden = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0
    text = F.concat(F.when(hidden, "").otherwise(marker), F.coalesce("text", F.lit("")))
    return conversations.withColumn("text", text)
