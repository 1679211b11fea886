"""Blends and member columns: one grouping by id, without a percentile's map or a pivot."""

import math
import statistics

import pytest

from plinth.operators import ensemble as ens

_M = ["a", "b", "c", "d"]


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id long, experiment string, prediction double")


def test_median_of_any_number_of_members(spark):
    rows = [(i, m, float((i * 37 + j * 11) % 17) / 3) for i in range(60) for j, m in enumerate(_M) if (i + j) % 5]
    rows += [(i, "other", 1e9) for i in range(60)] + [(100, "a", None), (100, "b", None), (101, "a", None), (101, "c", 2.5)]
    got = {r[0]: r[1] for r in ens.blend(_rows(spark, rows), "id", _M, "median").collect()}
    want: dict = {}
    for i, m, p in rows:
        if m in _M:
            want.setdefault(i, []).extend([] if p is None else [p])
    assert got.keys() == want.keys()
    for i, p in want.items():
        assert got[i] == (pytest.approx(statistics.median(p), abs=1e-15) if p else None)


def test_median_of_values_that_are_no_number(spark):
    rows = [(1, "a", math.nan), (1, "b", 1.0), (1, "c", 2.0), (2, "a", math.inf), (2, "b", math.inf), (3, "a", math.nan)]
    got = {r[0]: r[1] for r in ens.blend(_rows(spark, rows), "id", _M, "median").collect()}
    assert got[1] == 2.0 and got[2] == math.inf and math.isnan(got[3])


def test_median_refuses_a_member_twice(spark):
    with pytest.raises(Exception, match="id=7 has two predictions of a member"):
        ens.blend(_rows(spark, [(7, "a", 1.0), (7, "a", 2.0), (7, "b", 3.0)]), "id", _M, "median").collect()


def test_wide_has_a_column_for_each_member(spark):
    rows = _rows(spark, [(1, "a", 1.0), (1, "c", 3.0), (2, "b", None), (2, "x", 9.0), (3, "x", 9.0)])
    got = ens.wide(rows, "id", _M)
    assert got.columns == ["id", *_M]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [(1, 1.0, None, 3.0, None), (2, None, None, None, None)]


def test_blends_are_hash_aggregates(spark):
    rows = _rows(spark, [(1, "a", 1.0)])
    for df in (ens.blend(rows, "id", _M, "median"), ens.blend(rows, "id", _M, "mean"), ens.wide(rows, "id", _M)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("HashAggregate") == 2 and "ObjectHash" not in plan and "Sort" not in plan.replace("sort_array", "")
