"""The leaderboard's queries send the package once: a cluster refuses a second file of its name."""

import os
import time

import pytest

import __spark_entry__
from plinth.session import ship_package
from tests.conftest import SF


@pytest.mark.parametrize("name", ["best_experiment", "leaderboard"])
def test_query_ends_where_a_second_package_is_refused(spark, monkeypatch, name):
    ship_package(spark)                       # the workers have it; below only the sending is watched
    sc, sent = spark.sparkContext, {}

    def add(path):
        time.sleep(0.2)
        assert sent.setdefault(os.path.basename(path), path) == path, f"{path} was already registered with a different path"

    monkeypatch.setattr(sc, "addPyFile", add)
    monkeypatch.setattr(sc, "_plinth_shipped", False)
    rows = __spark_entry__.queries()[name](spark, SF).collect()
    assert len(sent) == 1
    assert rows[0]["experiment_name"] == "ensemble_stacking_ridge"
    assert [r["primary_score"] for r in rows] == sorted(r["primary_score"] for r in rows)
