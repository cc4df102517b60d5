"""The featurizer and the trainer as stages of ``pyspark.ml`` pipelines, with their persistence."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from .modelling import FEATURES, Featurizer, FitState, RegressionModel, trainer_from_config


class _FeaturizerParams(Params):
    kind = Param(Params._dummy(), "kind", "structure_descriptors or columns", TypeConverters.toString)
    columns = Param(Params._dummy(), "columns", "numeric columns, or one array, of the kind columns", TypeConverters.toListString)
    column = Param(Params._dummy(), "column", "the structure column", TypeConverters.toString)
    bits = Param(Params._dummy(), "bits", "length of fingerprints", TypeConverters.toInt)
    radius = Param(Params._dummy(), "radius", "radius of fingerprints", TypeConverters.toInt)
    state = Param(Params._dummy(), "state", "what was learned, as JSON", TypeConverters.toString)

    def featurizer(self) -> Featurizer:
        get = self.getOrDefault
        state = None
        if self.isDefined(self.state):
            raw = json.loads(get(self.state))
            state = FitState(tuple(raw["mean"]), tuple(raw["std"]), tuple(raw["active_bits"]), raw["n_train_rows"])
        return Featurizer(get(self.kind), get(self.bits), get(self.radius), True, get(self.column), tuple(get(self.columns)), state)


class FeaturizerStage(Estimator, _FeaturizerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns means, deviations and active bits; the model adds the vector column of features."""

    @keyword_only
    def __init__(self, *, kind: str = "columns", columns: Sequence[str] = (), column: str = "smiles", bits: int = 1024, radius: int = 2) -> None:
        super().__init__()
        self._setDefault(kind="columns", columns=[], column="smiles", bits=1024, radius=2)
        self._set(**{k: list(v) if k == "columns" else v for k, v in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> FeaturizerStageModel:
        made = self.featurizer().fit(dataset)
        model = self._copyValues(FeaturizerStageModel())
        return model._set(state=json.dumps(made.state.__dict__))


class FeaturizerStageModel(Model, _FeaturizerParams, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self) -> None:
        super().__init__()
        self._setDefault(kind="columns", columns=[], column="smiles", bits=1024, radius=2)

    @property
    def version(self) -> str:
        return self.featurizer().version

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.featurizer().transform(dataset)


class _TrainerParams(Params):
    targets = Param(Params._dummy(), "targets", "columns to be predicted", TypeConverters.toListString)
    estimator = Param(Params._dummy(), "estimator", "kind of the regressors", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "their parameters, as JSON", TypeConverters.toString)


class TrainerStage(Estimator, _TrainerParams, DefaultParamsReadable, DefaultParamsWritable):
    """One regressor for each target on the features of the stage before; the model adds pred_<t> and unc_<t>."""

    @keyword_only
    def __init__(self, *, targets: Sequence[str] = (), estimator: str = "RandomForestRegressor", settings: dict[str, Any] | None = None) -> None:
        super().__init__()
        self._setDefault(targets=[], estimator="RandomForestRegressor", settings="{}")
        given = dict(self._input_kwargs)
        if given.get("settings") is not None:
            given["settings"] = json.dumps(given["settings"])
        self._set(**{k: list(v) if k == "targets" else v for k, v in given.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TrainerStageModel:
        get = self.getOrDefault
        trainer = trainer_from_config({"estimator": get(self.estimator), "params": json.loads(get(self.settings))})
        return TrainerStageModel(trainer.fit(dataset, get(self.targets)))


class TrainerStageModel(Model, MLReadable, MLWritable):
    def __init__(self, fitted: RegressionModel) -> None:
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.predict(dataset, with_uncertainty=True).drop(FEATURES)

    def write(self) -> MLWriter:
        return _FittedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FittedReader()


class _FittedWriter(MLWriter):
    """The regressors as the library saves them, beside the metadata by which a pipeline knows the class."""

    def __init__(self, instance: TrainerStageModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        from pyspark.ml.util import DefaultParamsWriter

        DefaultParamsWriter.saveMetadata(self.instance, path, SparkSession.active())
        self.instance.fitted.save(f"{path}/fitted")


class _FittedReader(MLReader):
    def load(self, path: str) -> TrainerStageModel:
        return TrainerStageModel(RegressionModel.load(f"{path}/fitted"))
