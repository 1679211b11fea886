"""Correlations in tiles: against pandas and numpy, per group and per training fold, thousands of columns."""

import math
import os

import numpy as np
import pandas as pd
import pytest

from plinth.operators import correlate
from plinth.operators.clean import fit_cleaner
from plinth.operators.correlate import later_columns, pair_correlations


@pytest.fixture
def gaps():
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({f"c{i}": rng.normal(100.0 * i, 1 + i, 400) for i in range(7)})
    pdf["c4"] = pdf.c1 * 2 + rng.normal(size=400)
    pdf["c5"] = -pdf.c2
    pdf["k"] = 3.0
    pdf.loc[::3, "c1"] = np.nan
    pdf.loc[1::4, "c5"] = np.nan
    pdf["e"] = np.nan
    pdf["g"] = rng.integers(0, 3, 400)
    return pdf


def expected(pdf, cols):
    r = pdf[cols].corr().abs()
    return {(a, b): None if math.isnan(r.loc[a, b]) or "k" in (a, b) else r.loc[a, b]
            for i, a in enumerate(cols) for b in cols[i + 1:]}


def same(got, want):
    assert list(got) == list(want)
    for pair, v in want.items():
        assert (got[pair] is None) == (v is None) and (v is None or math.isclose(got[pair], v, rel_tol=1e-9, abs_tol=1e-12)), pair


@pytest.mark.parametrize("tile", [128, 2])
def test_any_tile_width_gives_the_same(spark, gaps, tile, monkeypatch):
    monkeypatch.setattr(correlate, "TILE", tile)
    df, cols = spark.createDataFrame(gaps).repartition(5), [x for x in gaps if x != "g"]
    same(pair_correlations(df, cols)[None], expected(gaps, cols))
    grouped = pair_correlations(df, cols, "g")
    training = pair_correlations(df, cols, "g", [0, 1, 2])
    for f in range(3):
        same(grouped[f], expected(gaps[gaps.g == f], cols))
        same(training[f], expected(gaps[gaps.g != f], cols))
    allowed = {f: cols if f else ["c1", "c4", "c5"] for f in range(3)}
    later = later_columns(df, allowed, 0.9, "g", [0, 1, 2])
    for f in range(3):
        pairs = expected(gaps[gaps.g != f], cols)
        assert later[f] == [b for b in cols if any(a in allowed[f] and y in allowed[f] and y == b and v is not None and v > 0.9
                                                   for (a, y), v in pairs.items())]
    assert later[0] == ["c4"] and later[1] == ["c4", "c5"]


def test_empty_and_single(spark, gaps):
    df = spark.createDataFrame(gaps)
    assert pair_correlations(df.limit(0), ["c0", "c1"]) == {}
    assert later_columns(df.limit(0), {None: ["c0", "c1"]}, 0.9) == {None: []}
    assert later_columns(df, {None: ["c0"]}, 0.9) == {None: []}


def test_five_thousand_columns(spark, tmp_path):
    """Near copies far from each other are found; the table of tiles is deleted; the driver gets names only."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 5000))
    planted = {int(b): int(a) for a, b in rng.choice(5000, (40, 2), replace=False) if a < b}
    for b, a in planted.items():
        x[:, b] = x[:, a] * (-1) ** b * 1000 + 1e5 + rng.normal(size=300)
    x[::7, 4999], x[::5, 17] = np.nan, np.nan
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(5000)])
    pdf.to_parquet(tmp_path / "wide.parquet")
    df = spark.read.parquet(str(tmp_path / "wide.parquet"))
    got = fit_cleaner(df, df.columns, drop_constant=False)[None]
    assert got == sorted(f"c{b}" for b in planted) and len(got) > 10
    work = os.path.join(spark.conf.get("spark.checkpoint.dir"), "plinth-work")
    assert not [x for x in (os.listdir(work) if os.path.isdir(work) else []) if x.startswith("tiles")]
