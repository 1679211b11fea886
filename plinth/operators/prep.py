"""Fitted value stages: clipping, imputation, standard scaling, one-hot encoding.

Each ``fit_*`` computes its statistics for every group at once and returns
driver-side state ``{g: {column: ...}}``; the matching ``*Model`` applies
one group's state as a projection (whole-stage codegen, no Python).
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.exprs import c, nan_to_null
from plinth.operators.categories import categories, index_models, small
from plinth.operators.state import StateModel, by_group
from plinth.operators.stats import modes, moments, quantiles_by_group

# ---------------------------------------------------------------- clipping


def clip_expr(col: Column, lo, hi) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (least/greatest alone would fill it)."""
    v = col.cast("double")
    if lo is not None:
        v = F.greatest(v, F.lit(float(lo)))
    if hi is not None:
        v = F.least(v, F.lit(float(hi)))
    return F.when(col.isNotNull(), v)


def fit_clip_bounds(df: DataFrame, cols: list[str], lower: float, upper: float, group: str | None = None,
                    exact: bool = True, accuracy: int = 100_000) -> dict:
    """{g: {col: [lo, hi]}} from the (lower, upper) quantiles; a column with no value gets [None, None]."""
    q = quantiles_by_group(df, cols, [lower, upper], group, exact, accuracy)
    groups = q.keys() if q else [None]
    return {g: {x: [q.get(g, {}).get(x, {}).get(lower), q.get(g, {}).get(x, {}).get(upper)] for x in cols}
            for g in groups}


class ClipModel(StateModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        bounds = self.get("bounds", {})
        present = {x: b for x, b in bounds.items() if x in dataset.columns}
        return dataset.withColumns({x: clip_expr(c(x), lo, hi) for x, (lo, hi) in present.items()}) if present \
            else dataset


def clip_grouped(df: DataFrame, bounds: dict, group: str | None) -> DataFrame:
    """Apply per-group bounds in one projection (used while fitting all folds at once)."""
    if not bounds:
        return df
    cols = next(iter(bounds.values())).keys()
    g = None if group is None else F.col(group)
    out = {}
    for x in cols:
        lo = by_group(g, {k: b[x][0] for k, b in bounds.items()}, "double")
        hi = by_group(g, {k: b[x][1] for k, b in bounds.items()}, "double")
        v = c(x).cast("double")
        out[x] = F.when(c(x).isNotNull(), F.least(F.greatest(v, F.coalesce(lo, v)), F.coalesce(hi, v)))
    return df.withColumns(out)

# -------------------------------------------------------------- imputation


def fit_numeric_fill(df: DataFrame, cols: list[str], strategy: str = "median", group: str | None = None,
                     exact: bool = True, accuracy: int = 100_000, groups: list | None = None) -> dict:
    """{g: {col: fill value or None (column had no value: dropped like SimpleImputer)}}."""
    keys = groups if groups is not None else [None]
    if not cols:
        return {g: {} for g in keys}
    if strategy == "median":
        q = quantiles_by_group(df, cols, [0.5], group, exact, accuracy)
        return {g: {x: q.get(g, {}).get(x, {}).get(0.5) for x in cols} for g in keys}
    if strategy == "mean":
        m = moments(df, cols, group)
        return {g: {x: (m[g][x][1] if g in m else None) for x in cols} for g in keys}
    if strategy == "most_frequent":
        md = modes(df, cols, group, as_text=False)
        return {g: {x: md.get(g, {}).get(x) for x in cols} for g in keys}
    if strategy == "constant":
        return {g: {x: 0.0 for x in cols} for g in keys}
    raise ValueError(f"unknown numeric imputer strategy {strategy!r}")


def fit_categorical_fill(df: DataFrame, cols: list[str], strategy: str = "most_frequent",
                         group: str | None = None, groups: list | None = None,
                         constant: str = "missing_value") -> dict:
    keys = groups if groups is not None else [None]
    if not cols:
        return {g: {} for g in keys}
    if strategy == "most_frequent":
        md = modes(df, cols, group, as_text=True)
        return {g: {x: md.get(g, {}).get(x) for x in cols} for g in keys}
    if strategy == "constant":
        return {g: {x: constant for x in cols} for g in keys}
    raise ValueError(f"unknown categorical imputer strategy {strategy!r}")


class ImputeModel(StateModel):
    """``numeric``/``categorical``: {col: fill}; a None fill drops the column."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        num, cat = self.get("numeric", {}), self.get("categorical", {})
        exprs = {}
        for x, v in num.items():
            if v is not None:
                exprs[x] = F.coalesce(nan_to_null(c(x).cast("double")), F.lit(float(v)))
        for x, v in cat.items():
            if v is not None:
                exprs[x] = F.coalesce(c(x).cast("string"), F.lit(str(v)))
        dropped = [x for x, v in list(num.items()) + list(cat.items()) if v is None]
        out = dataset.withColumns(exprs) if exprs else dataset
        return out.drop(*dropped)


def impute_grouped(df: DataFrame, fills: dict, group: str | None) -> DataFrame:
    if not fills:
        return df
    cols = next(iter(fills.values())).keys()
    g = None if group is None else F.col(group)
    return df.withColumns({x: F.coalesce(nan_to_null(c(x).cast("double")),
                                         by_group(g, {k: f[x] for k, f in fills.items()}, "double"))
                           for x in cols})

# ------------------------------------------------------------------ scaling


def fit_scaler(df: DataFrame, cols: list[str], group: str | None = None) -> dict:
    """{g: {col: [mean, scale]}}: population std, a zero std scales by 1."""
    m = moments(df, cols, group)
    out = {}
    for g, per in m.items():
        out[g] = {}
        for x in cols:
            n, mu, sp, _ = per[x]
            scale = sp if sp is not None and sp > 0 else 1.0
            out[g][x] = [mu if mu is not None else 0.0, scale]
    return out


class ScaleModel(StateModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        params = {x: v for x, v in self.get("scale", {}).items() if x in dataset.columns}
        if not params:
            return dataset
        return dataset.withColumns({x: (c(x).cast("double") - F.lit(mu)) / F.lit(s) for x, (mu, s) in params.items()})

# ----------------------------------------------------------------- one-hot


class NominalSizeModel(StateModel):
    """Marks index columns as nominal with a known number of values (``sizes``).

    The one-hot encoder then takes its width from metadata instead of a data pass.
    """

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes = self.get("sizes", {})
        return dataset.withColumns({
            x: F.col(x).alias(x, metadata={"ml_attr": {"type": "nominal", "num_vals": int(n), "name": x}})
            for x, n in sizes.items()})


def _indexed(cats: dict, cols: list[str]) -> list:
    """Stages that give each column its index column: literals where the values are a list, a join where
    they are a table."""
    listed = [x for x in cols if small(cats[x])]
    stages = [StringIndexerModel.from_arrays_of_labels([cats[x] for x in listed], inputCols=listed,
                                                       outputCols=[f"{x}__idx" for x in listed], handleInvalid="keep")] if listed else []
    return stages + index_models({x: cats[x] for x in cols})


def onehot_stages(df: DataFrame, cats: dict, suffix: str = "__oh") -> tuple[list, list[str]]:
    """Indexers (fitted values, unknown kept) + OneHotEncoder(dropLast).

    The indexers send unknown and missing values to index n; the encoder,
    told there are n known values, treats n as invalid, keeps it as an extra
    slot and dropLast removes that slot: unknowns encode as all zeros and
    known values keep all n slots.
    The encoder's width comes from metadata, so fitting it runs no job.
    """
    cols = [x for x in cats if len(cats[x])]
    if not cols:
        return [], []
    idx_cols = [f"{x}__idx" for x in cols]
    oh_cols = [f"{x}{suffix}" for x in cols]
    sizes = NominalSizeModel.of(sizes={i: len(cats[x]) for x, i in zip(cols, idx_cols)})
    encoder = OneHotEncoder(inputCols=idx_cols, outputCols=oh_cols, dropLast=True, handleInvalid="keep")
    probe = sizes.transform(df.limit(0).withColumns({i: F.lit(0.0) for i in idx_cols}))
    return [*_indexed(cats, cols), sizes, encoder.fit(probe)], oh_cols


def index_stages(cats: dict, suffix: str = "__idx") -> tuple[list, list[str]]:
    """Categories as nominal indices (for trees with native categorical splits); unknown -> index n."""
    cols = [x for x in cats if len(cats[x])]
    if not cols:
        return [], []
    idx_cols = [f"{x}{suffix}" for x in cols]
    sizes = NominalSizeModel.of(sizes={i: len(cats[x]) + 1 for x, i in zip(cols, idx_cols)})
    return [*_indexed(cats, cols), sizes], idx_cols


def dummies(df: DataFrame, cols: list[str], token: str = "Missing"):
    """Wide 0/1 double columns ``{col}_{value}`` for every value (gaps filled with ``token``).

    Returns (frame without the source columns, dummy names).  A column whose values are a table
    (``categories.SMALL``), or differ in case alone and so can't name columns, becomes one sparse
    vector column ``{col}__oh`` of the same slots instead.
    """
    filled = df.fillna(token, subset=cols)
    cats = categories(filled, cols).get(None, {})
    exprs, wide = {}, {x: v for x, v in cats.items() if not small(v) or len({n.lower() for n in v}) < len(v)}
    for x in cols:
        for v in cats.get(x, []) if x not in wide else ():
            exprs[f"{x}_{v}"] = (c(x) == F.lit(v)).cast("double")
    out = filled.withColumns(exprs)
    stages, vectors = onehot_stages(out, wide)
    for stage in stages:
        out = stage.transform(out)
    return out.drop(*cols, *[f"{x}__idx" for x in wide]), [*exprs, *vectors]
