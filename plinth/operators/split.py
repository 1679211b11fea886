"""Stratify labels, folds and holdouts - reproducible in any partitioning.

Row order comes from ``md5(id|seed)`` (not ``rand``), and every "position
within an order" is a global rank from ``operators.rank`` (range partitions,
no one-task window).  Stratified k-fold needs no per-label window either:
ranking all rows by (label, hash) and dealing fold = (rank - 1) mod k gives
each label a consecutive run, so per-label fold sizes differ by at most one,
and so do the overall sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.exprs import c
from plinth.functions.hashing import seeded_order
from plinth.operators.rank import global_rank

LABEL, FOLD, TRAIN_FOLD = "stratum", "fold", "train_fold"
_MIXED = "__mixed"


def n_label_bins(n_distinct: int, bins: int) -> int:
    return min(max(2, bins), max(2, n_distinct))


def stratify_labels(df: DataFrame, target: str, id_col: str, bins: int = 10) -> DataFrame:
    """Equal-frequency labels of the first-come rank of the target.

    label = 0 for rank 1, else ceil((r - 1) q / (n - 1)) - 1, in integer
    arithmetic; q = min(max(2, bins), max(2, #distinct targets)).
    """
    n = df.count()
    # only min(#distinct, bins) matters, so the search stops at ``bins`` different values
    q = n_label_bins(df.select(c(target)).filter(c(target).isNotNull()).distinct().limit(max(2, bins)).count(), bins)
    ranked = global_rank(df, [c(target), c(id_col)], "__r")
    r = F.col("__r")
    if n <= 1:
        label = F.lit(0)
    else:
        label = F.when(r == 1, F.lit(0)).otherwise(F.expr(f"((__r - 1) * {q} + {n - 2}) div {n - 1}") - 1)
    return ranked.withColumn(LABEL, label.cast("int")).drop("__r")


def stratified_kfold(df: DataFrame, id_col: str, k: int, seed: int, label: str = LABEL, shuffle: bool = True) -> DataFrame:
    """Rows of a label are dealt round the folds in seeded order (without ``shuffle``: in id order)."""
    mixed = {_MIXED: seeded_order(c(id_col), seed)} if shuffle else {}
    ranked = global_rank(df, [F.col(label), *mixed, c(id_col)], "__r", computed=mixed)
    return ranked.withColumn(FOLD, ((F.col("__r") - 1) % k).cast("int")).drop("__r")


def kfold(df: DataFrame, id_col: str, k: int, seed: int, shuffle: bool = True) -> DataFrame:
    """Rows are dealt round the folds in seeded order; without ``shuffle`` folds are runs of ids,
    the first ``n mod k`` of them one row longer."""
    if not shuffle:
        small, longer = divmod(df.count(), k)
        at = F.col("__r") - 1
        edge = longer * (small + 1)
        fold = F.when(at < edge, F.floor(at / (small + 1))).otherwise(longer + F.floor((at - edge) / max(small, 1)))
        return global_rank(df, [c(id_col)], "__r").withColumn(FOLD, fold.cast("int")).drop("__r")
    ranked = global_rank(df, [_MIXED, c(id_col)], "__r", computed={_MIXED: seeded_order(c(id_col), seed)})
    return ranked.withColumn(FOLD, ((F.col("__r") - 1) % k).cast("int")).drop("__r")


def holdout_quotas(label_counts: dict[int, int], valid_size: float) -> dict[int, int]:
    """Validation rows per label: ceil(share x n) split by largest remainder, ties to the lower label."""
    n = sum(label_counts.values())
    n_valid = math.ceil(valid_size * n)
    exact = {lab: cnt * n_valid / n for lab, cnt in label_counts.items()}
    quota = {lab: math.floor(v) for lab, v in exact.items()}
    rest = n_valid - sum(quota.values())
    for lab in sorted(exact, key=lambda x: (-(exact[x] - quota[x]), x))[:rest]:
        quota[lab] += 1
    return quota


def stratified_holdout(df: DataFrame, id_col: str, valid_size: float, seed: int, label: str = LABEL) -> DataFrame:
    """fold = 0 for validation rows, 1 for training rows (one split)."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}   # one row per label
    quota = holdout_quotas(counts, valid_size)
    starts, run = {}, 0
    for lab in sorted(counts):
        starts[lab] = run
        run += counts[lab]
    ranked = global_rank(df, [F.col(label), _MIXED, c(id_col)], "__r", computed={_MIXED: seeded_order(c(id_col), seed)})
    start = F.element_at(F.create_map(*[x for lab in starts for x in (F.lit(lab), F.lit(starts[lab]))]), F.col(label))
    limit = F.element_at(F.create_map(*[x for lab in quota for x in (F.lit(lab), F.lit(quota[lab]))]), F.col(label))
    pos = F.col("__r") - start
    return ranked.withColumn(FOLD, F.when(pos <= limit, 0).otherwise(1).cast("int")).drop("__r")


def assign_folds(df: DataFrame, target: str, id_col: str, n_splits: int, seed: int, bins: int = 10,
                 valid_size: float = 0.2, shuffle: bool = True) -> DataFrame:
    """Stratified k-fold, or a stratified holdout when ``n_splits <= 1`` (valid rows: fold 0)."""
    return split_labelled(stratify_labels(df, target, id_col, bins), id_col, n_splits, seed, valid_size, shuffle)


def split_labelled(labelled: DataFrame, id_col: str, n_splits: int, seed: int, valid_size: float = 0.2,
                   shuffle: bool = True) -> DataFrame:
    """``assign_folds`` on rows that have their label; a holdout is always drawn in seeded order."""
    if n_splits <= 1:
        return stratified_holdout(labelled, id_col, valid_size, seed)
    return stratified_kfold(labelled, id_col, n_splits, seed, shuffle=shuffle)


def fold_ids(n_splits: int) -> list[int]:
    return [0] if n_splits <= 1 else list(range(n_splits))


def training_rows(df: DataFrame, n_splits: int, fold_col: str = FOLD) -> DataFrame:
    """Each row once per fold it trains (its ``train_fold``): fits all folds in one pass.

    With a holdout (one split) the training rows are those of fold 1.
    """
    if n_splits <= 1:
        return df.filter(F.col(fold_col) == 1).withColumn(TRAIN_FOLD, F.lit(0))
    folds = F.array(*[F.lit(f) for f in range(n_splits)])
    return df.withColumn(TRAIN_FOLD, F.explode(F.filter(folds, lambda f: f != F.col(fold_col))))


def fold_train(df: DataFrame, f: int, n_splits: int, fold_col: str = FOLD) -> DataFrame:
    return df.filter(F.col(fold_col) == 1) if n_splits <= 1 else df.filter(F.col(fold_col) != f)


def fold_valid(df: DataFrame, f: int, fold_col: str = FOLD) -> DataFrame:
    return df.filter(F.col(fold_col) == f)
