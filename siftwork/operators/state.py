"""Fitted stages whose whole state is a small JSON document, saved with the ML metadata."""

from __future__ import annotations

import json
from typing import Any

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter


class Options(Params):
    """Stage options kept as one JSON parameter, so every stage saves and loads the same way."""

    options = Param(Params._dummy(), "options", "options as JSON", TypeConverters.toString)

    def set_options(self, **values: Any):
        return self._set(options=json.dumps(values))

    def option(self, name: str) -> Any:
        return json.loads(self.getOrDefault("options"))[name]


class OptionTransformer(Transformer, Options, DefaultParamsReadable, DefaultParamsWritable):
    pass


class OptionEstimator(Estimator, Options, DefaultParamsReadable, DefaultParamsWritable):
    pass


class FittedWriter(DefaultParamsWriter):
    """Saves the state and a copy of every table it points to, so a saved model stands on its own."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for name, source in self.instance.tables().items():
            self.sparkSession.read.parquet(source).write.parquet(f"{path}/tables/{name}")


class FittedReader(DefaultParamsReader):
    def load(self, path: str):
        stage = super().load(path)
        names = stage.tables() if stage.isSet("state") else {}
        return stage.with_tables({name: f"{path}/tables/{name}" for name in names}) if names else stage


class FittedStage(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A model that holds parameters only; transforming is a projection or a filter."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def with_state(self, **values: Any):
        return self._set(state=json.dumps(values))

    @property
    def values(self) -> dict:
        if not self.isSet("state"):
            raise ValueError(f"{type(self).__name__} holds no fitted state")
        return json.loads(self.getOrDefault("state"))

    def tables(self) -> dict[str, str]:
        """Name and folder of the tables that are too large for the state."""
        return {}

    def with_tables(self, folders: dict[str, str]):
        raise NotImplementedError

    def write(self) -> FittedWriter:
        return FittedWriter(self)

    @classmethod
    def read(cls) -> FittedReader:
        return FittedReader(cls)
