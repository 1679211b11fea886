"""Command line: the whole run on two CSV files, like the original script.

    python -m plinth --train train.csv --test test.csv [--out DIR] [--master local[8]]

The house-price preset (``house_prices_spec``) names the columns; types are
inferred from the CSV with pandas-style missing tokens.
"""

from __future__ import annotations

import argparse
import json

from plinth.plans.run import run
from plinth.session import get_spark
from plinth.sources.csv import scan_csv
from plinth.spec import house_prices_spec


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="plinth")
    ap.add_argument("--train", required=True)
    ap.add_argument("--test", required=True)
    ap.add_argument("--out", default=None, help="artifact folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = get_spark(args.master)
    spec = house_prices_spec()
    train = scan_csv(spark, args.train)
    test = scan_csv(spark, args.test)
    out = run(spark, train, test, spec, args.out)
    out.leaderboard.show(truncate=False)
    for exp, stage, err in out.errors:
        print(f"Skipping {exp} at {stage}: {err}")
    print(json.dumps({"best": out.best.experiment_name, "score": out.best.primary_score, "artifacts": out.out_dir}))


if __name__ == "__main__":
    main()
