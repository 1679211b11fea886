"""Category dictionaries: the slots of a column's values, at any number of values.

A column of at most SMALL values keeps them as a sorted list in the fitted state and is indexed
by literals.  Beyond that its dictionary is a table (value, slot) in the shared folder: slots are
the ranks of the values, from a range partitioning and the partitions' sizes, and a row finds its
slot by an equi-join on the value.  Both give the same slots (values in order), so encoders,
vectors and models see no difference.  No size is an error.

The driver holds at most SMALL values of a column, and the number of values of each.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.exprs import c
from plinth.operators.rank import global_rank
from plinth.operators.state import StageHolder
from plinth.session import work_path, written_table

#: Values of a column that are kept on the driver.
SMALL = 10_000
COLUMN, VALUE, GROUP = "column", "value", "__group"


@dataclass(frozen=True)
class CategoryTable:
    """A dictionary on disk: ``size`` values in the Parquet table (value, slot) at ``path``."""

    path: str
    size: int

    def __len__(self) -> int:
        return self.size


def small(values) -> bool:
    return not isinstance(values, CategoryTable)


def _cells(df: DataFrame, keys: list[Column], cols: list[str]) -> DataFrame:
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias(COLUMN), c(n).cast("string").alias(VALUE)) for n in cols]))
    return df.select(*keys, cells.alias("cell")).select("*", "cell.*").drop("cell")


def dictionary(values: DataFrame, size: int, name: str) -> CategoryTable:
    """The table of the distinct non-null ``value`` rows, slots 0, 1, ... in their order."""
    path = work_path(values.sparkSession, f"categories-{name}")
    ranked = global_rank(values.select(VALUE), [VALUE], "slot")
    ranked.select(VALUE, (F.col("slot") - 1).alias("slot")).write.parquet(path)
    return CategoryTable(path, size)


def _collected(distinct: DataFrame, keys: list[str], sizes: dict) -> dict:
    """{key: sorted values or a CategoryTable} from the distinct rows (keys..., value) and their numbers."""
    low = [k for k, n in sizes.items() if n <= SMALL]
    out: dict = {k: [] for k in low}

    def of(k: tuple) -> Column:
        return reduce(and_, [F.col(n) == F.lit(v) for v, n in zip(k, keys, strict=True)])

    if low:
        for r in distinct.filter(reduce(or_, map(of, low))).collect():
            out[tuple(r[k] for k in keys)].append(r[VALUE])
        for k in low:
            out[k].sort()
    for i, (k, n) in enumerate(x for x in sizes.items() if x[1] > SMALL):
        out[k] = dictionary(distinct.filter(of(k)), n, str(i))
    return out


def categories(df: DataFrame, cols: list[str], group: str | None = None) -> dict:
    """{g: {col: its distinct non-missing values in order, or their CategoryTable}}."""
    if not cols:
        return {}
    key = F.lit(0) if group is None else F.col(group)
    distinct = _cells(df, [key.alias(GROUP)], cols).filter(F.col(VALUE).isNotNull()).distinct()
    distinct = written_table(distinct, "categories")
    sizes = {(r[0], r[1]): r[2] for r in distinct.groupBy(GROUP, COLUMN).count().collect()}
    out: dict = {}
    for (g, x), values in _collected(distinct, [GROUP, COLUMN], sizes).items():
        out.setdefault(None if group is None else g, {})[x] = values
    return out


def fold_categories(df: DataFrame, cols: list[str], fold_col: str, folds: list, fill: str | None) -> dict:
    """{f: {col: (fill, values)}} of each fold's training rows (fold <> f), from one count of every
    (column, value) and fold.

    ``fill`` is the token for missing cells, or None for the most frequent value (ties to the
    smallest); it is among the values where a training cell is missing.
    """
    key = F.col(fold_col)
    counts = _cells(df, [key.alias(GROUP)], cols).groupBy(COLUMN, VALUE).agg(
        *[F.count_if(F.col(GROUP) != f).alias(f"n{i}") for i, f in enumerate(folds)])
    counts = written_table(counts, "fold-categories")
    present = F.col(VALUE).isNotNull()
    per = [(F.count_if(present & (F.col(f"n{i}") > 0)).alias(f"s{i}"),
            F.max(F.when(~present, F.col(f"n{i}"))).alias(f"m{i}"),
            F.min_by(VALUE, F.when(present & (F.col(f"n{i}") > 0), F.struct(-F.col(f"n{i}"), F.col(VALUE)))).alias(f"t{i}"))
           for i in range(len(folds))]
    lines = {r[COLUMN]: r for r in counts.groupBy(COLUMN).agg(*[a for p in per for a in p]).collect()}
    out: dict = {f: {} for f in folds}
    for i, f in enumerate(folds):
        held = counts.filter(present & (F.col(f"n{i}") > 0)).select(COLUMN, VALUE)
        fills = {x: (r[f"t{i}"] if fill is None else fill) for x, r in lines.items()}
        gaps = {x: v for x, v in fills.items() if v is not None and lines[x][f"m{i}"]}
        if fill is not None and gaps:                                      # the token is a value of its own
            token = df.sparkSession.createDataFrame([(x, v) for x, v in gaps.items()], held.schema)
            extra = token.join(held, [COLUMN, VALUE], "left_anti")         # one row for each column at most
            new = {r[COLUMN] for r in extra.collect()}
            held = held.unionByName(token.filter(F.col(COLUMN).isin(*new))) if new else held
        else:
            new = set()
        sizes = {(x,): r[f"s{i}"] + (x in new) for x, r in lines.items()}
        for (x,), values in _collected(held, [COLUMN], sizes).items():
            out[f][x] = (fills[x], values)
    return out


class DictionaryIndexModel(StageHolder, Transformer):
    """The slot of each value by a join with the dictionary table; unknown and missing values get ``size``.

    A saved stage has the table in its own folder."""

    def __init__(self, column: str, index: str, size: int, path: str | None = None, slots: DataFrame | None = None):
        super().__init__()
        self.column, self.index, self.size, self.path, self.slots = column, index, size, path, slots

    def settings(self) -> dict:
        return {"column": self.column, "index": self.index, "size": self.size}

    def parts(self) -> dict:
        return {"slots": self._slots(SparkSession.active())}

    def _slots(self, spark: SparkSession) -> DataFrame:
        if self.slots is not None:
            return self.slots
        return spark.read.schema(f"{VALUE} string, slot long").parquet(self.path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x, index, size = self.column, self.index, self.size
        slots = self._slots(dataset.sparkSession)
        slots = slots.select(F.col(VALUE).alias("__value"), F.col("slot").alias("__slot"))
        joined = dataset.join(slots, c(x).cast("string") == F.col("__value"), "left")
        return joined.withColumn(index, F.coalesce(F.col("__slot"), F.lit(size)).cast("double")).drop("__value", "__slot")


def index_models(cats: dict) -> list:
    """One joining stage for each column whose values are a table; the index column is ``{col}__idx``."""
    return [DictionaryIndexModel(x, f"{x}__idx", v.size, v.path)
            for x, v in cats.items() if not small(v)]
