"""Seeded, partition-independent row order and experiment names."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_order(id_col: Column, seed: int) -> Column:
    """md5 of ``id|seed``: the same order in any engine and any partitioning.

    ``rand(seed)`` depends on the partition layout, so it cannot be repeated.
    """
    return F.md5(F.concat_ws("|", id_col.cast("string"), F.lit(str(seed))))


def params_json(params: dict) -> str:
    return json.dumps(params, sort_keys=True)


def experiment_name(model_name: str, params: dict) -> str:
    digest = hashlib.md5(params_json(params).encode("utf-8")).hexdigest()[:10]
    return f"{model_name}__{digest}"
