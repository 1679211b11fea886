"""Global ranks and weighted prefix sums without a one-partition window.

``row_number() over (order by ...)`` with no ``partitionBy`` moves every row
into one task.  Instead the rows are range partitioned on the order key
(plus a unique tie-breaker, so a hot value is split across partitions),
sorted within partitions and written as Parquet with their range's number
and their place in it.  Counts per range (a scan of one column, one number
per range) give the offsets.  Later scans read only the columns they need,
and ranks do not depend on how the files are read.

There are as many ranges as the session has shuffle partitions, more if the
tables read are so large that a range would hold over RANGE_BYTES.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.session import written_table

RANGE_BYTES = 256 << 20
_PID, _PLACE = "__pid", "__place"


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    read = sum(n for n in sizes if n < 1 << 62)           # above: of no known size
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), min(100_000, read // RANGE_BYTES))


def _starts(spark, counts: dict[int, int]) -> DataFrame:
    """(range, rows before it): one row per range."""
    pids = sorted(counts)
    before = [0, *accumulate(counts[p] for p in pids)]
    return spark.createDataFrame(list(zip(pids, before)), f"{_PID} int, __start long")


def global_rank(df: DataFrame, order: list, name: str = "rank", num_partitions: int | None = None,
                computed: dict[str, Column] | None = None) -> DataFrame:
    """Add ``name`` = row_number() over (order by ``order``), 1-based.

    ``order`` must end in a unique column so that the result is deterministic.  A sort evaluates an
    expression at every comparison: keys that take work are given in ``computed`` under the names that
    ``order`` has for them, and are computed once a row, after the shuffle, and not written.
    """
    computed = computed or {}
    dealt = [computed.get(o, o) if isinstance(o, str) else o for o in order]
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)     # the rows of its task before it
    ranged = df.repartitionByRange(_partitions(df, num_partitions), *dealt).withColumns(computed)
    ranged = (ranged.sortWithinPartitions(*order)
              .withColumns({_PID: F.spark_partition_id(), _PLACE: place}).drop(*computed))
    table = written_table(ranged, "ranked")
    counts = {r[0]: r[1] for r in table.groupBy(_PID).count().collect()}   # one row per range
    return (table.join(F.broadcast(_starts(df.sparkSession, counts)), _PID)
            .withColumn(name, F.col("__start") + F.col(_PLACE) + 1).drop(_PID, _PLACE, "__start"))


def prefix_sums(df: DataFrame, keys: list[str], order_col: str, weight_col: str,
                cum_name: str = "cum", num_partitions: int | None = None) -> tuple[DataFrame, dict]:
    """Inclusive running sum of ``weight_col`` per ``keys`` ordered by ``order_col``.

    ``order_col`` must be unique within a key (pre-aggregate first).  Every
    task holds one range partition, never a whole key group.  Returns the
    frame and ``{key tuple: total}`` (one entry per key group).
    """
    out, totals = prefix_sums_multi(df, keys, order_col, [weight_col], num_partitions)
    out = out.withColumnRenamed(f"cum_{weight_col}", cum_name)
    return out, {k: v[0] for k, v in totals.items()}


def prefix_sums_multi(df: DataFrame, keys: list[str], order_col: str, weight_cols: list[str],
                      num_partitions: int | None = None) -> tuple[DataFrame, dict]:
    """Inclusive running sums of several weight columns per ``keys`` ordered by ``order_col``:
    adds ``cum_<w>`` for each and returns ``{key tuple: [total per weight]}``.

    Range partitions on (keys, order) are written with their number,
    per-(range, key) sums give the offsets (at most #ranges + #keys rows,
    broadcast), and a window per (range, key) adds the running part inside
    each range.
    """
    spark = df.sparkSession
    n_parts = _partitions(df, num_partitions)
    ranged = df.repartitionByRange(n_parts, *keys, order_col).withColumn(_PID, F.spark_partition_id())
    tagged = written_table(ranged, "ranges")
    part_rows = tagged.groupBy(_PID, *keys).agg(*[F.sum(w).alias(f"__p{i}") for i, w in enumerate(weight_cols)]).collect()
    by_key: dict = {}
    for r in part_rows:
        by_key.setdefault(tuple(r[k] for k in keys), []).append((r[_PID], [r[f"__p{i}"] or 0 for i in range(len(weight_cols))]))
    off_rows, totals = [], {}
    for key, parts in by_key.items():
        parts.sort(key=lambda x: x[0])
        run = [0] * len(weight_cols)
        for pid, sums in parts:
            off_rows.append((pid, *key, *[int(v) for v in run]))
            run = [a + b for a, b in zip(run, sums)]
        totals[key] = [int(v) for v in run]
    key_fields = sorted([f for f in df.schema.fields if f.name in keys], key=lambda f: keys.index(f.name))
    off_schema = T.StructType([T.StructField(_PID, T.IntegerType())] + key_fields +
                              [T.StructField(f"__o{i}", T.LongType()) for i in range(len(weight_cols))])
    offsets = spark.createDataFrame(off_rows, off_schema)   # one row per (partition, key): bounded
    w = Window.partitionBy(_PID, *keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    with_run = tagged.withColumns({f"__r{i}": F.sum(c).over(w) for i, c in enumerate(weight_cols)})
    out = with_run.join(F.broadcast(offsets), [_PID, *keys]).withColumns(
        {f"cum_{c}": (F.col(f"__o{i}") + F.col(f"__r{i}")).cast("long") for i, c in enumerate(weight_cols)})
    return out.drop(_PID, *[f"__r{i}" for i in range(len(weight_cols))],
                    *[f"__o{i}" for i in range(len(weight_cols))]), totals
