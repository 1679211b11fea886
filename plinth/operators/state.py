"""Bases for stages that save themselves: fitted state, estimators' settings, stages that hold others.

State and settings are a small JSON document in a ``Param``, so ``DefaultParamsWritable`` saves it and
``DefaultParamsReadable`` loads it back.  A ``StageHolder`` also saves the stages and the tables it
holds, each in a folder of its own below its path.  A saved ``PipelineModel`` made of these stages
reloads without this process, from its folder alone.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _State(Params, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "state or settings as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, state: str | None = None):
        super().__init__()
        self._setDefault(state="{}")
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, **state):
        return cls(state=json.dumps(state, sort_keys=True))

    def get(self, key: str, default=None):
        return json.loads(self.getOrDefault(self.state)).get(key, default)


class StateModel(_State, Transformer):
    """A fitted stage."""


class StateEstimator(_State, Estimator):
    """An estimator whose settings are all keyword arguments of ``of``."""


class StageHolder(MLWritable, MLReadable):
    """A stage whose constructor takes plain ``settings()``, and ``parts()``: other stages or tables."""

    def settings(self) -> dict:
        return {}

    def parts(self) -> dict:
        return {}

    def write(self) -> MLWriter:
        return _HolderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _HolderReader(cls)


class _HolderWriter(MLWriter):
    def __init__(self, holder):
        super().__init__()
        self.holder = holder

    def saveImpl(self, path: str) -> None:
        parts = self.holder.parts()
        tables = [k for k, v in parts.items() if isinstance(v, DataFrame)]
        DefaultParamsWriter.saveMetadata(self.holder, path, self.sparkSession, {
            "settings": json.dumps(self.holder.settings()), "stages": [k for k in parts if k not in tables], "tables": tables})
        for name, part in parts.items():
            if name in tables:
                part.write.parquet(f"{path}/{name}")
            else:
                part.write().save(f"{path}/{name}")


class _HolderReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        parts = {k: DefaultParamsReader.loadParamsInstance(f"{path}/{k}", self.sparkSession) for k in meta["stages"]}
        parts.update({k: self.sparkSession.read.parquet(f"{path}/{k}") for k in meta["tables"]})
        out = self.cls(**json.loads(meta["settings"]), **parts)
        out._resetUid(meta["uid"])
        return out


def by_group(group: Column | None, mapping: dict, cast: str | None = None) -> Column:
    """A per-group value: ``element_at(map(g -> v), group)``, or a literal when ungrouped."""
    if group is None:
        (value,) = mapping.values()
        lit = F.lit(value)
        return lit.cast(cast) if cast else lit
    pairs = []
    for g, v in mapping.items():
        lit = F.lit(v)
        pairs += [F.lit(g), lit.cast(cast) if cast else lit]
    return F.element_at(F.create_map(*pairs), group)
