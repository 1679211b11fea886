"""Quality rules by weak supervision.

Rules vote good (1), bad (-1) or abstain (0) on a text; expectation-maximisation over the counts
of vote patterns estimates how often each rule gives each vote on good and on bad texts; the
posterior probability of "good" replaces an all-must-pass filter.  The model is estimated on the
rows it decides on, those that pass the base rules.

The counts cover all such rows and reach the driver as one row per vote pattern, at most
3 ** len(RULES) of them whatever the input is.  Reading the texts twice (counts, then verdicts)
stands in for a stored copy.

Defined results: a null or blank text has no words and fails the base rules; repeated rows are
judged one by one, alike; an empty table gives an empty result (the model is its prior).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import Words, append, chunks, raw_texts, run_hashes

WINDOW = 8
_WHITE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "n_lines", "n_upper", "n_letters", "n_stops", "n_shouts", "n_same", "n_marks"]


def _repeat_words(w: Words) -> np.ndarray:
    """For each text the number of words inside WINDOW-word windows that it holds twice or more."""
    n = len(w)
    if n <= WINDOW:
        return np.zeros(len(w.first), np.int64)
    at = np.arange(n - WINDOW + 1)
    text = w.text
    at = at[text[at] == text[at + WINDOW - 1]]
    key = run_hashes(w.hash, at, at + WINDOW) ^ (text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    k, p = key[order], at[order]
    same = np.flatnonzero((k[1:] == k[:-1]) & (text[p[1:]] == text[p[:-1]]))
    edge = np.zeros(n + 1, np.int64)
    hit = np.unique(np.concatenate([p[same], p[same + 1]]))
    edge[hit] += 1
    edge[hit + WINDOW] -= 1
    return w.sums(np.cumsum(edge)[:-1] > 0)


def features(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts the rules look at, for each text."""
    out: dict[str, list] = {k: [] for k in _FEATURES}
    for _, some in chunks(texts):
        w = Words(some)
        out["n_words"].append(w.counts)
        out["n_repeat_words"].append(_repeat_words(w))
        last = w.data[w.end - 1] if len(w) else w.data
        out["n_stops"].append(w.sums(np.isin(last, np.frombuffer(b".!?", np.uint8))))
        same = np.zeros(len(w), bool)
        same[1:] = w.hash[1:] == w.hash[:-1]
        same[w.first[w.counts > 0]] = False
        out["n_same"].append(w.sums(same))
        for name, drop in (("n_symbols", _SYMBOLS), ("n_upper", _UPPER), ("n_letters", _LETTERS),
                           ("n_shouts", b"!"), ("n_marks", _MARKS)):
            out[name].append([len(t) - len(t.translate(None, drop)) for t in some])
        out["word_chars"].append([
            len(t.decode("utf-8", "replace")) - (len(t) - len(t.translate(None, _WHITE))) for t in some])
        lines = [[x for x in t.split(b"\n") if x.strip()] for t in some]
        out["n_lines"].append([len(x) for x in lines])
        out["n_dup_lines"].append([len(x) - len(set(x)) for x in lines])
    return {k: np.concatenate([np.asarray(p, np.int64) for p in v]) if v else np.zeros(0, np.int64)
            for k, v in out.items()}


def with_features(df: DataFrame, text: str = "text") -> DataFrame:
    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        found = features(raw_texts(batch, text))
        return [pa.array(found[k], pa.int64()) for k in _FEATURES]

    return append(df, [(k, T.LongType()) for k in _FEATURES], columns)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vote(value: Column, bad: Column, good: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Name -> vote of each rule, over the feature columns."""
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    per_word = lambda c: F.col(c) / words
    length, mean = words, per_word("word_chars")
    symbols, shouts, same, stops = (per_word(c) for c in ("n_symbols", "n_shouts", "n_same", "n_stops"))
    repeat = per_word("n_repeat_words")
    marks = F.col("n_marks") / F.when(F.col("word_chars") > 0, F.col("word_chars"))
    lines = F.col("n_dup_lines") / F.when(F.col("n_lines") > 1, F.col("n_lines"))
    upper = F.col("n_upper") / F.when(F.col("n_letters") > 0, F.col("n_letters"))
    return {
        "length": _vote(length, length < 20, length >= 40),
        "word_length": _vote(mean, (mean < 2.5) | (mean > 11), (mean >= 3) & (mean <= 9)),
        "symbols": _vote(symbols, symbols > 0.2, symbols < 0.02),
        "duplicate_lines": _vote(lines, lines > 0.3, lines < 0.05),
        "repeats": _vote(repeat, repeat > 0.3, repeat < 0.1),
        "capitals": _vote(upper, upper > 0.4, upper < 0.15),
        "same_word": _vote(same, same > 0.2, same < 0.05),
        "sentence_ends": _vote(stops, (stops == 0) & (words >= 40), (stops >= 0.02) & (stops <= 0.5)),
        "shouts": _vote(shouts, shouts > 0.3, shouts < 0.05),
        "marks": _vote(marks, marks > 0.1, marks < 0.06),
    }


def fit(counts: dict[tuple[int, ...], int], steps: int = 200) -> tuple[float, np.ndarray]:
    """(share of good texts, log P(vote | class) by [class, rule, vote + 1]) from pattern counts.

    Starts from the majority vote; Dirichlet pseudo-counts keep a class that a rule never saw
    defined and the classes' meaning (1 = good) as the votes have it.
    """
    n_rules = len(rules())
    prior = np.empty((2, n_rules, 3))
    prior[0], prior[1] = (2.0, 2.0, 1.0), (0.1, 2.0, 4.0)
    if not counts:
        return 0.5, np.log(prior / prior.sum(2, keepdims=True))
    votes = np.array(list(counts), np.int64) + 1
    weight = np.array(list(counts.values()), float)
    onehot = np.eye(3)[votes]                                           # pattern, rule, vote
    good = np.where((votes == 0).any(1), 0.1, 0.9)
    for _ in range(steps):
        table = np.stack([np.einsum("p,prv->rv", weight * r, onehot) for r in (1 - good, good)]) + prior
        logs = np.log(table / table.sum(2, keepdims=True))
        share = (weight @ good + 1) / (weight.sum() + 2)
        score = math.log(share / (1 - share)) + np.einsum("prv,rv->p", onehot, logs[1] - logs[0])
        now = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        if np.abs(now - good).max() < 1e-9:
            break
        good = now
    return float(share), logs


def pattern_counts(featured: DataFrame) -> dict[tuple[int, ...], int]:
    names = list(rules())
    rows = featured.groupBy(*[v.alias(k) for k, v in rules().items()]).count().collect()
    return {tuple(int(r[k]) for k in names): int(r["count"]) for r in sorted(rows)}


def posterior(share: float, logs: np.ndarray) -> Column:
    """P(good | votes) as an expression over the feature columns."""
    score = F.lit(math.log(share / (1 - share)))
    for r, vote in enumerate(rules().values()):
        gain = logs[1, r] - logs[0, r]
        score = score + F.when(vote == -1, float(gain[0])).when(vote == 1, float(gain[2])).otherwise(float(gain[1]))
    return 1 / (1 + F.exp(-score))


def judge(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``df`` with the features, ``base_failed``, ``quality`` (the posterior) and ``kept``."""
    share, logs = fit(pattern_counts(with_features(df.select(text), text).filter(~base_failed())))
    out = with_features(df, text)
    new = {"base_failed", "quality", "kept"}
    out = out.select(*[f"`{c}`" for c in out.columns if c.lower() not in new])
    return (out.withColumn("base_failed", base_failed())
            .withColumn("quality", posterior(share, logs))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))
