"""PRJ-9, ML-1, ML-2 and ML-5: boosted trees on Spark ML, with the preparation inside the saved model."""

from __future__ import annotations

import itertools
import math
import threading
import warnings
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.config import Model
from shelfline.plans import packed
from shelfline.plans.boosting import CHECK, FEATURES, LABEL, grow
from shelfline.plans.packed import Packs, pack
from shelfline.schemas import numeric
from shelfline.session import written

FRAMEWORKS = ("gbt", "lightgbm", "xgboost")

# Parameter names of other boosting libraries and the Spark parameter each one means.
PARAMETER_NAMES = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "feature_fraction": "featureSubsetStrategy",
    "min_data_in_leaf": "minInstancesPerNode",
    "min_child_weight": "minInstancesPerNode",
    "min_info_gain": "minInfoGain",
    "random_state": "seed",
    "max_bins": "maxBins",
    "validation_tol": "validationTol",
}

# What holds where the parameters name nothing.
DEFAULT_TREES, DEFAULT_RATE, DEFAULT_PATIENCE = 2000, 0.05, 200

#: Labels of a text column that are categories of their own, and categories that all other labels share.
MOST_LABELS, LABEL_BINS = 128, 32

#: Training rows up to which trees are left to Spark, whose caches hold so few: a pass over packs would cost no less.
SMALL_ROWS = 250_000

#: Marks the shared categories; labels that are spelled out begin with an equals sign next to it.
_BIN = "#"


def merge_params(base: dict[str, Any], tuned: dict[str, Any]) -> dict[str, Any]:
    """ML-5: tuned parameters over the base ones, without changing either."""
    return {**base, **tuned}


def spark_params(params: dict[str, Any]) -> dict[str, Any]:
    """Parameters by Spark name; those without a counterpart are warned about."""
    out: dict[str, Any] = {}
    for name, value in params.items():
        if name == "early_stopping_rounds":
            continue
        if name == "num_leaves":
            out.setdefault("maxDepth", max(1, math.ceil(math.log2(value))))
        elif name in PARAMETER_NAMES:
            out[PARAMETER_NAMES[name]] = value
        else:
            warnings.warn(f"model parameter {name!r} has no counterpart in Spark's boosted trees", stacklevel=2)
    for name in ("maxIter", "maxDepth", "minInstancesPerNode", "seed", "maxBins"):
        if name in out:
            out[name] = int(round(out[name]))
    if "featureSubsetStrategy" in out:
        share = out["featureSubsetStrategy"]
        # "1" would be one feature, "1.0" is all of them.
        out["featureSubsetStrategy"] = share if isinstance(share, str) else str(float(share))
    return out


def check_framework(model: Model) -> None:
    if str(model.framework).lower() not in FRAMEWORKS:
        raise ValueError(f"unsupported framework: {model.framework}")


def model_inputs(df: DataFrame, target_col: str) -> tuple[list[str], list[str]]:
    """PRJ-9: numeric and text columns a model reads; dates and the target are left out."""
    numbers, texts = [], []
    for f in df.schema.fields:
        if f.name == target_col:
            continue
        if numeric(f.dataType) or isinstance(f.dataType, T.BooleanType):
            numbers.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            texts.append(f.name)
    return numbers, texts


def _with_gaps(rows: DataFrame, columns: list[str]) -> set[str]:
    """Columns with a missing value, by one aggregate."""
    if not columns:
        return set()
    missing = rows.agg(*[F.bool_or(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return {c for c, found in zip(columns, missing, strict=True) if found}


def label_index(rows: DataFrame, columns: Sequence[str], most: int) -> dict[str, list[str]]:
    """PRJ-9: the ``most`` most frequent labels of each text column, frequent ones first, then by name.

    The counts combine on the map side and the first few are picked by each task before they meet, so that the driver holds a
    bounded list however many labels there are.
    """
    out: dict[str, list[str]] = {}
    for c in columns:
        counts = rows.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
        out[c] = [r["label"] for r in counts.orderBy(F.desc("n"), "label").limit(most).collect()]
    return out


def _text_stage(labels: dict[str, list[str]], most: int, bins: int) -> tuple[list, list[str]]:
    """Stages that turn text into categories: frequent labels by rank, all others dealt to ``bins`` categories by hash.

    Only a column with more labels than ``most`` has such bins. Missing labels, and unseen ones of a column without bins, share
    one more category.
    """
    pieces, kept = [], []
    for c, known in labels.items():
        value = f"cast(`{c}` AS string)"
        if len(known) < most:
            pieces.append(f"{value} AS `_label_{c}`")
            kept.append(known)
            continue
        spelled = ", ".join(_literal(x) for x in known)
        rare = f"concat('{_BIN}', cast(pmod(xxhash64({value}), {bins}) AS string))"
        pieces.append(f"CASE WHEN `{c}` IS NULL THEN NULL WHEN {value} IN ({spelled}) THEN concat('=', {value}) ELSE {rare} END AS `_label_{c}`")
        kept.append([f"={x}" for x in known] + [f"{_BIN}{k}" for k in range(bins)])
    spelled_out = SQLTransformer(statement=f"SELECT *, {', '.join(pieces)} FROM __THIS__")
    indexers = [
        StringIndexerModel.from_labels(names, f"_label_{c}", f"_x_{c}", handleInvalid="keep") for c, names in zip(labels, kept, strict=True)
    ]
    return [spelled_out, *indexers], [f"_x_{c}" for c in labels]


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _preparation(train: DataFrame, rows: DataFrame, target_col: str, most: int, bins: int) -> tuple[list, list[str], dict[str, int]]:
    """Preparation stages, the names of the assembled inputs, and the number of categories of those that have such.

    Spark's trees take no missing values: a number becomes its value or 0, next to a flag that says it was missing, if
    it ever is in the training and validation rows.
    """
    numbers, texts = model_inputs(train, target_col)
    gaps = _with_gaps(rows, numbers)
    pieces, inputs = [], []
    for c in numbers:
        pieces.append(f"coalesce(cast(`{c}` AS double), 0D) AS `_x_{c}`")
        inputs.append(f"_x_{c}")
        if c in gaps:
            pieces.append(f"cast(`{c}` IS NULL AS double) AS `_missing_{c}`")
            inputs.append(f"_missing_{c}")
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(pieces)} FROM __THIS__")] if pieces else []
    categories: dict[str, int] = {}
    if texts:
        text_stages, indexed = _text_stage(label_index(train, texts, most), most, bins)
        stages += text_stages
        inputs += indexed
        categories = {name: len(stage.labels) + 1 for name, stage in zip(indexed, text_stages[1:], strict=True)}
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    return stages, inputs, categories


class TreeInputs:
    """What all fits on one fold read: the preparation, and both sides' rows after it, each form of them stored once when first needed."""

    def __init__(self, stages: list, inputs: list[str], categories: dict[str, int], both: DataFrame, target_col: str):
        self.stages, self.inputs, self.labels = stages, inputs, categories
        #: The largest number of categories of an input.
        self.categories = max(categories.values(), default=0)
        self._both, self._label = both, F.col(target_col).cast("double").alias(LABEL)
        self._stored: dict[Any, Any] = {}
        # Fits run side by side.
        self._lock = threading.Lock()

    def _once(self, name: Any, build: Callable[[], Any]) -> Any:
        with self._lock:
            if name not in self._stored:
                self._stored[name] = build()
            return self._stored[name]

    @property
    def rows(self) -> DataFrame:
        """Rows with assembled inputs."""
        prepared = PipelineModel(self.stages).transform(self._both).select(FEATURES, self._label, CHECK)
        return self._once("rows", lambda: written(prepared, "fold-inputs"))

    @property
    def large(self) -> bool:
        """Whether there are more training rows than Spark's trees are given."""
        return self._once("rows of training", lambda: self._both.where(~F.col(CHECK)).count()) > SMALL_ROWS

    def packs(self, max_bins: int, seed: int) -> Packs:
        """Rows with inputs cut into bins."""
        # All stages but the last, which assembles.
        prepared = lambda rows: PipelineModel(self.stages[:-1]).transform(rows.withColumn(LABEL, self._label))
        return self._once((max_bins, seed), lambda: pack(self._both, prepared, self.inputs, self.labels, max_bins, seed))


def tree_inputs(train: DataFrame, val: DataFrame, target_col: str, most_labels: int = MOST_LABELS, bins: int = LABEL_BINS) -> TreeInputs:
    """PRJ-9: prepare a fold once for any number of fits. Rows without a target are left out."""
    known = F.col(target_col).isNotNull()
    both = train.where(known).withColumn(CHECK, F.lit(False)).unionByName(val.where(known).withColumn(CHECK, F.lit(True)))
    both = written(both, "fold-rows")
    stages, inputs, categories = _preparation(both.where(~F.col(CHECK)).drop(CHECK), both, target_col, most_labels, bins)
    return TreeInputs(stages, inputs, categories, both, target_col)


def fit_trees(inputs: TreeInputs, model: Model) -> PipelineModel:
    """ML-1: boosted regression trees on prepared rows, as many as had the lowest validation error.

    Trees are added until the error has not fallen for ``early_stopping_rounds`` trees (200 unless given) or
    ``n_estimators`` (2000 unless given) is reached. No tree is fitted twice. Of large folds, trees that read all rows grow on
    packs; small folds, and trees that sample rows, are left to Spark's.
    """
    check_framework(model)
    params = spark_params(model.params)
    params["maxBins"] = max(int(params.get("maxBins", 32)), inputs.categories)
    most = params.pop("maxIter", DEFAULT_TREES)
    rate = float(params.pop("stepSize", DEFAULT_RATE))
    patience = int(model.params.get("early_stopping_rounds", DEFAULT_PATIENCE))
    if inputs.large and packed.growable(params):
        fitted, _ = packed.grow(inputs.packs(params["maxBins"], int(params.get("seed", 42))), params, most, rate, patience)
    else:
        fitted, _ = grow(inputs.rows, params, most, rate, patience)
    return PipelineModel([*inputs.stages, fitted])


def train_model(train: DataFrame, val: DataFrame, target_col: str, model: Model) -> PipelineModel:
    """ML-1 in one step: prepare the rows and fit."""
    check_framework(model)
    return fit_trees(tree_inputs(train, val, target_col), model)


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """ML-2: the rows with a ``prediction`` column, prepared as in training."""
    return model.transform(features).select(*features.columns, F.col("prediction").cast("double"))


def feature_importance(model: PipelineModel) -> list[tuple[str, float]]:
    """Importance per input column, the missing-flag of a column counted with it."""
    assembler = next(stage for stage in model.stages if isinstance(stage, VectorAssembler))
    weights = model.stages[-1].featureImportances.toArray()
    total: dict[str, float] = {}
    # The vector ends with the last column that any tree splits on.
    for name, weight in itertools.zip_longest(assembler.getInputCols(), weights, fillvalue=0.0):
        column = name.removeprefix("_missing_").removeprefix("_x_")
        total[column] = total.get(column, 0.0) + float(weight)
    return sorted(total.items(), key=lambda item: (-item[1], item[0]))
