"""Featurizers, regressors for each target, and models bound to the featurizer they were trained with."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.identity import short_hash
from ..functions.shared import work_folder
from ..functions.smiles import DESCRIPTORS, structure_features
from ..sources.manifest import write_json
from ..sources.storage import absolute, join, read_bytes
from .forests import FlatForest, scores

FEATURES = "_features"


def _rounded(x: float) -> float:
    """12 significant digits: sums differ in the last bits with the partitioning, identities must not."""
    return float(f"{x:.12g}")


@dataclass(frozen=True)
class FitState:
    mean: tuple[float, ...]
    std: tuple[float, ...]
    active_bits: tuple[int, ...]
    n_train_rows: int

    def fingerprint(self) -> str:
        return short_hash([self.mean, self.std, self.active_bits, self.n_train_rows], 12)


@dataclass
class Featurizer:
    """Scaled numbers and active bits as one array column.

    ``structure_descriptors`` reads a structure column; ``columns`` takes numeric columns or one array.
    """

    kind: str = "structure_descriptors"
    bits: int = 1024
    radius: int = 2
    include_descriptors: bool = True
    column: str = "smiles"
    columns: tuple[str, ...] = ()
    state: FitState | None = None

    def params(self) -> dict[str, Any]:
        names = (list(DESCRIPTORS) if self.include_descriptors else []) if self.kind == "structure_descriptors" else list(self.columns)
        return {"bits": self.bits, "radius": self.radius, "include_descriptors": self.include_descriptors, "column": self.column, "descriptors": names}

    @property
    def version(self) -> str:
        """kind@params/fit; an unfitted one never equals a recorded binding."""
        return f"{self.kind}@{short_hash(self.params(), 12)}/{self.state.fingerprint() if self.state else 'unfitted'}"

    @property
    def fitted(self) -> bool:
        return self.state is not None

    def _raw(self, df: DataFrame) -> DataFrame:
        """``df`` with _numbers (array of doubles) and _bits (array of ints)."""
        if self.kind == "structure_descriptors":
            made = df.withColumn("_made", structure_features(F.col(self.column).cast("string"), self.radius, self.bits))
            numbers = F.col("_made.descriptors") if self.include_descriptors else F.array().cast("array<double>")
            return made.withColumns({"_numbers": numbers, "_bits": F.col("_made.bits")}).drop("_made")
        if len(self.columns) == 1 and df.schema[self.columns[0]].dataType.typeName() == "array":
            numbers = F.col(self.columns[0]).cast("array<double>")
        else:
            numbers = F.array(*(F.col(c).cast("double") for c in self.columns))
        return df.withColumns({"_numbers": numbers, "_bits": F.array().cast("array<int>")})

    def _named(self, df: DataFrame) -> bool:
        """Whether each number is a column of its own."""
        return self.kind == "columns" and bool(self.columns) and not (len(self.columns) == 1 and df.schema[self.columns[0]].dataType.typeName() == "array")

    def fit(self, df: DataFrame) -> Featurizer:
        """Means, population deviations and the bits ever set, from one aggregation by place; of named columns in one job."""
        if self._named(df):
            numbers = [F.col(c).cast("double") for c in self.columns]
            there = [F.when(~F.isnan(v), v) for v in numbers]
            row = df.agg(F.count("*"), *(f(v) for v in there for f in (F.avg, F.stddev_pop))).first()
            found = [(m, s) for m, s in zip(row[1::2], row[2::2], strict=True) if m is not None]
            self.state = FitState(tuple(_rounded(m) for m, _ in found), tuple(_rounded(s) if s and s > 0 else 1.0 for _, s in found), (), row[0])
            return self
        raw = self._raw(df)
        places = raw.select(F.posexplode("_numbers").alias("k", "v")).filter("v is not null and not isnan(v)")
        stats = sorted(places.groupBy("k").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect(), key=lambda r: r.k)
        bits = sorted(r.b for r in raw.select(F.explode("_bits").alias("b")).distinct().collect())
        mean = tuple(_rounded(r.m) for r in stats)
        std = tuple(_rounded(r.s) if r.s and r.s > 0 else 1.0 for r in stats)
        self.state = FitState(mean, std, tuple(bits), df.count())
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the vector column of features."""
        if self.state is None:
            raise RuntimeError("the featurizer is not fitted; load the one bound to the model")
        if self._named(df) and len(self.columns) == len(self.state.mean) and not self.state.active_bits:
            own = [(F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(self.columns, self.state.mean, self.state.std, strict=True)]
            return df.withColumn(FEATURES, array_to_vector(F.array(*(F.when(v.isNull() | F.isnan(v), F.lit(0.0)).otherwise(v) for v in own))))
        mean, std = (F.array(*map(F.lit, x)).cast("array<double>") for x in (self.state.mean, self.state.std))
        scaled = F.transform(F.zip_with(F.zip_with("_numbers", mean, lambda v, m: v - m), std, lambda d, s: d / s), lambda v: F.when(v.isNull() | F.isnan(v), F.lit(0.0)).otherwise(v))
        active = F.array(*map(F.lit, self.state.active_bits)).cast("array<int>")
        flags = F.transform(active, lambda b: F.array_contains("_bits", b).cast("double"))
        return self._raw(df).withColumn(FEATURES, array_to_vector(F.concat(scaled, flags))).drop("_numbers", "_bits")

    @property
    def n_features(self) -> int:
        if self.state is None:
            raise RuntimeError("the featurizer is not fitted")
        return len(self.state.mean) + len(self.state.active_bits)

    def save(self, path: str | Path) -> str:
        state = None if self.state is None else self.state.__dict__
        return write_json(path, {"kind": self.kind, "bits": self.bits, "radius": self.radius, "include_descriptors": self.include_descriptors, "column": self.column, "columns": self.columns, "state": state})

    @classmethod
    def load(cls, path: str | Path) -> Featurizer:
        raw = json.loads(read_bytes(path))
        state = raw.pop("state")
        raw["columns"] = tuple(raw["columns"])
        if state:
            state = FitState(tuple(state["mean"]), tuple(state["std"]), tuple(state["active_bits"]), state["n_train_rows"])
        return cls(**raw, state=state)


def featurizer_from_config(cfg: Mapping[str, Any]) -> Featurizer:
    kind, params = cfg.get("kind"), cfg.get("params", {})
    if kind == "from_promoted_model":
        raise ValueError("this featurizer comes from the registry with its model, it can't be made from a configuration")
    if kind in ("rdkit_descriptors", "structure_descriptors"):
        return Featurizer("structure_descriptors", int(params.get("morgan_bits", 1024)), int(params.get("morgan_radius", 2)), bool(params.get("include_descriptors", True)), params.get("column", "smiles"))
    if kind == "columns":
        return Featurizer("columns", columns=tuple(params["columns"]))
    raise ValueError(f"unknown featurizer kind {kind!r}")


@dataclass
class MeanBaseline:
    """The training mean of each target, with its deviation as uncertainty."""

    targets: Sequence[str]
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    kind: str = "mean"

    def fit(self, df: DataFrame) -> MeanBaseline:
        row = df.agg(*(F.avg(t).alias(f"m_{t}") for t in self.targets), *(F.stddev_pop(t).alias(f"s_{t}") for t in self.targets)).first()
        self.means = {t: row[f"m_{t}"] if row[f"m_{t}"] is not None else math.nan for t in self.targets}
        self.stds = {t: row[f"s_{t}"] or 0.0 for t in self.targets}
        return self

    def predict(self, df: DataFrame, with_uncertainty: bool = False) -> DataFrame:
        out = {f"pred_{t}": F.lit(self.means[t]) for t in self.targets}
        if with_uncertainty:
            out |= {f"unc_{t}": F.lit(self.stds[t]) for t in self.targets}
        return df.withColumns(out)


@dataclass
class RegressionModel:
    """One fitted regressor for each target."""

    targets: list[str]
    models: dict[str, Any]
    estimator: str
    params: dict[str, Any]
    featurizer_version: str = ""
    saved: str | None = None
    flat: FlatForest | None = field(default=None, repr=False, compare=False)

    def predict(self, df: DataFrame, with_uncertainty: bool = False) -> DataFrame:
        """pred_<t> and, if asked for, unc_<t>: the trees' population deviation, zero where there are no independent trees."""
        if with_uncertainty and self.estimator in FORESTS:
            columns = [c for c in df.columns if c not in {f"{kind}_{t}" for t in self.targets for kind in ("pred", "unc")}]
            made = df.select(*columns, scores(df.sparkSession, self._forest(df.sparkSession), vector_to_array(FEATURES)).alias("_scores"))
            return made.select(*columns, "_scores.*")
        for t in self.targets:
            df = self.models[t].setPredictionCol(f"pred_{t}").transform(df)
            if with_uncertainty:
                df = df.withColumn(f"unc_{t}", F.lit(0.0))
        return df

    def _forest(self, spark: SparkSession) -> FlatForest:
        """The node tables, read from where the model is saved; one that isn't is saved in the session's shared folder."""
        if self.flat is None:
            if self.saved is None:
                self.save(work_folder(spark, "forest"))
            self.flat = FlatForest.read(spark, [(t, f"{self.saved}/{t}") for t in self.targets])
        return self.flat

    def save(self, path: str | Path) -> None:
        for t, m in self.models.items():
            m.write().overwrite().save(f"{path}/{t}")
        self.saved = str(path)
        write_json(join(path, "model.json"), {"targets": self.targets, "estimator": self.estimator, "params": self.params, "featurizer_version": self.featurizer_version})

    @classmethod
    def load(cls, path: str | Path) -> RegressionModel:
        raw = json.loads(read_bytes(join(path, "model.json")))
        loader = RandomForestRegressionModel if raw["estimator"] in FORESTS else GBTRegressionModel
        return cls(raw["targets"], {t: loader.load(f"{path}/{t}") for t in raw["targets"]}, raw["estimator"], raw["params"], raw["featurizer_version"], str(path))


FORESTS = ("RandomForestRegressor",)
BOOSTED = ("HistGradientBoostingRegressor", "GradientBoostingRegressor", "GBTRegressor")


@dataclass
class Trainer:
    """Fits one regressor for each target."""

    estimator: str = "RandomForestRegressor"
    params: dict[str, Any] = field(default_factory=dict)

    def _make(self, target: str):
        p = self.params
        seed = int(p.get("random_state", 0) or 0)
        if self.estimator in FORESTS:
            made = RandomForestRegressor(numTrees=int(p.get("n_estimators", 100)), maxDepth=int(p.get("max_depth") or 12), maxBins=int(p.get("max_bins", 64)), seed=seed, featureSubsetStrategy="all", bootstrap=bool(p.get("bootstrap", True)))
        elif self.estimator in BOOSTED:
            made = GBTRegressor(maxIter=int(p.get("max_iter", p.get("n_estimators", 50))), maxDepth=int(p.get("max_depth") or 5), seed=seed)
        else:
            raise ValueError(f"unknown estimator {self.estimator!r}")
        return made.setFeaturesCol(FEATURES).setLabelCol(target)

    def fit(self, df: DataFrame, targets: Sequence[str], featurizer_version: str = "") -> RegressionModel:
        if missing := [t for t in targets if t not in df.columns]:
            raise KeyError(f"missing target columns: {missing}")
        data = df.select(FEATURES, *targets).cache()
        try:
            data.count()  # in all tasks; MLlib's first look takes one row, for which one task alone would make a whole partition
            models = {t: self._make(t).fit(data.filter(F.col(t).isNotNull() & ~F.isnan(F.col(t).cast("double")))) for t in targets}
        finally:
            data.unpersist()
        return RegressionModel(list(targets), models, self.estimator, dict(self.params), featurizer_version)


def trainer_from_config(cfg: Mapping[str, Any]) -> Trainer:
    if cfg.get("backend", "spark") not in ("spark", "sklearn"):
        raise ValueError(f"unknown model backend {cfg.get('backend')!r}")
    trainer = Trainer(cfg.get("estimator", "RandomForestRegressor"), dict(cfg.get("params", {})))
    trainer._make("y")
    return trainer


@dataclass
class BoundModel:
    """A model with its featurizer; they are saved, loaded and used together."""

    model: RegressionModel
    featurizer: Featurizer
    version: str = ""
    record: Any = None

    def score(self, df: DataFrame) -> DataFrame:
        self.verify_binding()
        return self.model.predict(self.featurizer.transform(df), with_uncertainty=True).drop(FEATURES)

    def verify_binding(self) -> None:
        if self.model.featurizer_version != self.featurizer.version:
            raise ValueError(f"the model was trained with {self.model.featurizer_version}, not {self.featurizer.version}")


def save_artifacts(directory: str | Path, model: RegressionModel, featurizer: Featurizer, extra: Mapping[str, Any] | None = None) -> str:
    d = absolute(directory)
    model.save(join(d, "model"))
    featurizer.save(join(d, "featurizer.json"))
    write_json(join(d, "binding.json"), {"featurizer_version": featurizer.version, "model_featurizer_version": model.featurizer_version, **(extra or {})})
    return d


def load_bound(directory: str | Path, version: str = "", record: Any = None) -> BoundModel:
    """A saved pair; refused if the featurizer isn't the one that the binding names."""
    d = absolute(directory)
    binding = json.loads(read_bytes(join(d, "binding.json")))
    bound = BoundModel(RegressionModel.load(join(d, "model")), Featurizer.load(join(d, "featurizer.json")), version, record)
    if binding["featurizer_version"] != bound.featurizer.version:
        raise ValueError("the saved featurizer isn't the one in the binding")
    bound.verify_binding()
    return bound


def load_stage(registry, stage: str = "production") -> BoundModel:
    """The production model, or the first one in another stage."""
    record = registry.production() if stage == "production" else next((r for r in registry.records() if r.stage == stage), None)
    if record is None:
        raise LookupError(f"no model in stage {stage}")
    return load_bound(record.artifact_dir, record.version, record)
