"""Bench: the whole run (profile, folds, CV grid, refits, ensembles, outputs) on fx.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line.  The grid is the original default (ridge x3, lasso x2,
elastic net, random forest) except that the forest uses 30 trees of depth 10
instead of 600 unlimited-depth trees (out of reach on one machine).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from plinth.session import get_spark
    from plinth.spec import DEFAULT_MODELS, ModelSpec, fixture_spec
    from plinth.plans.run import run
    from plinth.session import written_table
    from plinth.sources.fixture import ID, TARGET, fixture
    from pyspark.sql import functions as F

    scratch = tempfile.mkdtemp(prefix="plinth-bench-")
    spark = get_spark(f"local[{cpus}]", cpus, extra={
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": f"{scratch}/ckpt",
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    })
    models = []
    for m in DEFAULT_MODELS:
        if m.name == "random_forest":
            m = ModelSpec("random_forest", True, ((("max_depth", 10), ("min_samples_leaf", 1), ("n_estimators", 30),
                                                   ("random_state", 42)),))
        models.append(m)
    spec = replace(fixture_spec(), models=tuple(models), parallelism=cpus)
    timings = {}
    t_all = time.time()
    t0 = time.time()
    fx = written_table(fixture(spark, sf_dir), "fx")            # sources scanned once
    train = fx.filter(F.col(ID) % 5 != 0)
    test = fx.filter(F.col(ID) % 5 == 0).drop(TARGET)
    timings["inputs"] = round(time.time() - t0, 3)
    out = run(spark, train, test, spec, f"{scratch}/out", materialize_inputs=False)
    for k, v in out.timings.items():
        if k != "inputs":
            timings[k] = round(v, 3)
    t0 = time.time()
    n_sub = out.submission.count() if out.submission is not None else 0
    timings["submission_count"] = round(time.time() - t0, 3)
    total = time.time() - t_all
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "end_to_end_run_sec", "value": round(total, 3), "unit": "sec",
                      "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "best": out.best.experiment_name, "best_score": round(out.best.primary_score, 6),
                      "submission_rows": n_sub, "errors": len(out.errors),
                      "grid": "default, reduced forest (30 trees, depth 10)"}))
    spark.stop()


if __name__ == "__main__":
    main()
