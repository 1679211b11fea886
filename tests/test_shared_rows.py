"""Members share one table of rows and folds; partitions that are scanned often stay small."""

import glob
import threading

from plinth.plans import catalog_models as cm
from plinth.plans import cv
from plinth.session import checkpoint_dir
from tests.conftest import SF


def _written(spark, name):
    return set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/plinth-work/{name}-*"))


def test_members_share_one_base(spark):
    before = _written(spark, "base") | _written(spark, "labelled")
    oof, tp, truth, results = cm.run_members(spark, SF, refit=True)
    assert len((_written(spark, "base") | _written(spark, "labelled")) - before) == 1
    n, tests = truth.count(), {r[0]: r[1] for r in tp.groupBy("experiment").count().collect()}
    assert {r[0]: r[1] for r in oof.groupBy("experiment").count().collect()} == {e: n for e in cm._NAMES}
    assert set(tests) == set(cm._NAMES) and len(set(tests.values())) == 1
    assert [r.experiment_name for r in results] == cm._NAMES


def test_partitions_follow_the_cells(spark, monkeypatch):
    monkeypatch.setattr(cv, "PARTITION_CELLS", 100, raising=False)
    rows = spark.range(0, 500, 1, 1).selectExpr("id", "id AS a")
    assert cv.training_partitions(spark, rows) == 10


def test_prepared_rows_keep_their_partitions(spark, monkeypatch):
    train, test = cm._tt(spark, SF)
    monkeypatch.setattr(cv, "PARTITION_CELLS", 200, raising=False)
    one = cv.CrossValidation(spark, train.select("id", "sale_price", "overall_qual"), cm._spec(), folds=False)
    rows = one.prepared(None, None, False)[2]
    n = rows.count()
    assert rows.rdd.getNumPartitions() >= n * 5 // 200 > 4 and n == train.count()
    one.release()


def test_members_share_the_passes_of_their_statistics(spark):
    before = _written(spark, "brackets")
    cm.run_members(spark, SF, refit=True)
    assert len(_written(spark, "brackets") - before) == 2        # of the folds and of all rows


def test_a_member_has_the_statistics_of_its_column_alone(spark):
    train, _ = cm._tt(spark, SF)
    cols = ["overall_qual", "area_garage", "alley"]
    one = cv.CrossValidation(spark, train.select("id", "sale_price", *cols), cm._spec())
    for x, member in zip(cols, one.on_each(cols), strict=True):
        for k in (5, None):
            assert member.recipes(k, True) == one.on([x]).recipes(k, True)


def test_members_submit_no_more_fold_fits_than_one_engine(spark, monkeypatch):
    lock, now, most, fit = threading.Lock(), [0], [0], cv.CrossValidation.fit_fold_linear

    def counted(*args, **kwargs):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        try:
            return fit(*args, **kwargs)
        finally:
            with lock:
                now[0] -= 1

    monkeypatch.setattr(cv.CrossValidation, "fit_fold_linear", counted)
    cm.run_members(spark, SF)
    assert 1 <= most[0] <= cm.SPEC.parallelism
