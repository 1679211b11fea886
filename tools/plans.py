"""Print the physical plans of the key operators (for review; no data is written).

usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from plinth.operators import ensemble as ens  # noqa: E402
from plinth.operators import profile  # noqa: E402
from plinth.operators.quantile import to_long, value_counts  # noqa: E402
from plinth.operators.split import training_rows  # noqa: E402
from plinth.session import get_spark  # noqa: E402
from plinth.sources.fixture import train_test  # noqa: E402


def show(title: str, df) -> None:
    print(f"\n===== {title}")
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(plan)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    train, test = train_test(spark, sf)
    show("fx train, three columns (pruned scans, partial aggregation before the shuffle)",
         train.select("id", "sale_price", "zoning"))
    show("missing counts (one aggregate over all columns)", profile.missing_counts(train))
    vc = value_counts(to_long(train, ["area_living", "overall_qual"], []), ["column"])
    show("quantile input: pre-aggregated value counts (hot values collapse map-side)", vc)
    folded = train.withColumn("fold", (F.col("id") % 5).cast("int"))
    stacked = training_rows(folded, 5)
    show("fold-stacked training rows, grouped statistics (partial aggregation per train_fold)",
         stacked.groupBy("train_fold").agg(F.avg("area_living"), F.count(F.lit(1))))
    preds = train.select(F.col("id").cast("long").alias("id"), F.lit("a").alias("experiment"),
                         F.col("sale_price").alias("prediction"))
    show("blend: group by id (members per id bounded)", ens.blend(preds, "id", ["a"], "mean"))
    show("stack input: pivot with the member list given", ens.wide(preds, "id", ["a"]))


if __name__ == "__main__":
    main()
