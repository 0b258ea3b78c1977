"""Feature sets and the encoding stages that turn a clean table into vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.ml.leastsquares import BlockModel
from lotwise.ml.levels import Levels, LevelsModel, SlotVector
from lotwise.operators.profile import per_column
from lotwise.sources.staging import small_table, stage

LABEL = "log_price"


@dataclass(frozen=True)
class FeatureSet:
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]

    def columns(self, flags: Sequence[str]) -> list[str]:
        return [*self.categorical, *self.numeric, *flags]


_PLACES = ("Area", "State", "Tenure")
FEATURE_SETS = {
    "linear": FeatureSet(_PLACES, (S.TX, S.LOG_SIZE, S.DENSITY)),
    "svr": FeatureSet(_PLACES, (S.TX, S.LOG_SIZE, S.DENSITY)),
    "forest": FeatureSet(_PLACES, (S.TX, S.LOG_SIZE, S.DENSITY)),
    "boosted": FeatureSet(_PLACES, (S.TX, S.LOG_SIZE)),
}


def with_label(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.withColumn(LABEL, F.log1p(target))


def scaling_parameters(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; 1 for a constant."""
    stats = per_column(df, columns, {"mean": lambda c: F.avg(c), "std": lambda c: F.stddev_pop(c)})
    return {r["column"]: (r["mean"], r["std"] or 1.0) for r in stats.collect()}


def standard_scale(
    df: DataFrame, columns: Sequence[str], parameters: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Replace columns by (x - mean) / std of the given or own parameters."""
    fitted = parameters or scaling_parameters(df, columns)
    return df.withColumns({c: (F.col(c) - fitted[c][0]) / fitted[c][1] for c in columns})


def category_indexer(columns: Sequence[str]) -> StringIndexer:
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"_index_{c}" for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )


class OneHot(Estimator):
    """Levels by name, and a vector ``_onehot_<column>`` with a slot for each; unseen and NULL values are all zeros."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        levels = Levels(inputCols=self.columns, by="name", labelCol=LABEL).fit(dataset)
        vectors = [
            SlotVector(inputCols=[f"_index_{c}"], levels=[f"_index_{c}"], widths=[n], outputCol=f"_onehot_{c}") for c, n in levels.size_of().items()
        ]
        return PipelineModel(stages=[levels, *vectors])


def one_hot_stages(columns: Sequence[str]) -> list:
    """Slots by name of the level; unseen and NULL values have none."""
    return [OneHot(columns)]


def scaling_stage(train: DataFrame, columns: Sequence[str]) -> SQLTransformer:
    parameters = scaling_parameters(train, columns)
    scaled = ", ".join(
        f"(`{c}` - {mean!r}D) / {std!r}D AS `_scaled_{c}`" for c, (mean, std) in parameters.items()
    )
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


#: Quantile bins of a tree learner, whatever the number of levels.
BINS = 32


def fit_encoder(train: DataFrame, features: FeatureSet, encoding: str = "one_hot") -> PipelineModel:
    """Scaled numbers, encoded categories and flags as one vector.

    Tree learners hold every slot of every row in memory, so wide one-hot vectors do not scale for them.
    ``encoding="ordered"`` gives them one number per category column, the place of the level in the order of the mean
    label, which they split like any number; ``"indexed"`` one slot that they split as a category, with as many bins as levels.
    ``train`` has the target, or the label already. The encoding never depends on the data.
    """
    flags = S.flag_columns(train.columns)
    stages: list = [scaling_stage(train, features.numeric)]
    labelled = train if LABEL in train.columns else with_label(train)
    if features.categorical and encoding == "indexed":
        stages.append(category_indexer(features.categorical).fit(train))
    elif features.categorical and encoding == "ordered":
        stages.append(Levels(inputCols=list(features.categorical), by="label", labelCol=LABEL).fit(labelled))
    inputs = [*[f"_scaled_{c}" for c in features.numeric], *[f"_index_{c}" for c in features.categorical], *flags]
    if features.categorical and encoding not in ("indexed", "ordered"):
        # The vector is made from the places at once: assembled from one-hot vectors, every slot would be named on the driver.
        levels = Levels(inputCols=list(features.categorical), by="name", labelCol=LABEL).fit(labelled)
        places = {f"_index_{c}": n for c, n in levels.size_of().items()}
        stages += [levels, SlotVector(inputCols=inputs, levels=list(places), widths=[places.get(c, 0) for c in inputs], outputCol="features")]
    else:
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return Pipeline(stages=stages).fit(train)


def _levels_stage(model: PipelineModel):
    return next((s for s in model.stages if hasattr(s, "labelsArray") or isinstance(s, (LevelsModel, BlockModel))), None)


def expected_columns(model: PipelineModel) -> list[str]:
    """Raw input columns of a fitted model: categories, numbers, flags."""
    block = _levels_stage(model)
    if isinstance(block, BlockModel):
        design = block.fitted()
        return [*design["categories"], *design["numbers"], *design["flags"]]
    inputs = next(s for s in model.stages if isinstance(s, (VectorAssembler, SlotVector))).getInputCols()
    numbers = [c.removeprefix("_scaled_") for c in inputs if c.startswith("_scaled_")]
    return [*category_columns(model), *numbers, *[c for c in inputs if c.startswith(S.TYPE_PREFIX)]]


def category_columns(model: PipelineModel) -> list[str]:
    stage = _levels_stage(model)
    if isinstance(stage, BlockModel):
        return stage.fitted()["categories"]
    return list(stage.getInputCols()) if stage else []


def category_levels(model: PipelineModel) -> dict[str, list[str]]:
    """Levels per category column of an indexed encoding; empty for the others, which keep them in a table."""
    stage = _levels_stage(model)
    return dict(zip(stage.getInputCols(), stage.labelsArray)) if hasattr(stage, "labelsArray") else {}


def tree_bins(encoder: PipelineModel) -> int:
    """Bins that a tree learner needs: one per level where it splits categories."""
    return max(BINS, *[len(v) + 1 for v in category_levels(encoder).values()], BINS)


def known_categories(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(column, value) of the levels a model was fitted on, from the table saved beside it."""
    stage = _levels_stage(model)
    if isinstance(stage, LevelsModel):
        return stage.table().select("column", "value")
    if isinstance(stage, BlockModel):
        design = stage.fitted()
        small = small_table(spark, [(c, v) for c, values in design["levels"].items() for v in values], "column string, value string")
        wide = stage.table()
        return small if wide is None else wide.select(F.lit(design["wide"]).alias("column"), F.col("level").alias("value")).unionByName(small)
    rows = [(c, v) for c, levels in category_levels(model).items() for v in levels]
    return small_table(spark, rows, "column string, value string")


def _slots(encoder: PipelineModel) -> list[tuple[bool, str, int]]:
    """(whether it has a slot for each level, raw column, number of slots) in the order of the vector."""
    last = encoder.stages[-1]
    slots = last.slots() if isinstance(last, SlotVector) else [(c, False, 1) for c in last.getInputCols()]
    return [(by_level, column.removeprefix("_scaled_").removeprefix("_index_"), size) for column, by_level, size in slots]


def slot_names(encoder: PipelineModel, slots: Sequence[int]) -> dict[int, str]:
    """Names of a few slots of the feature vector; only their levels are read."""
    first, wanted, names = 0, {}, {}
    for by_level, raw, size in _slots(encoder):
        for slot in slots:
            if first <= slot < first + size:
                if by_level:
                    wanted[raw, slot - first] = slot
                else:
                    names[slot] = raw
        first += size
    if wanted:
        chosen = [(F.col("column") == c) & (F.col("place") == float(p)) for c, p in wanted]
        condition = chosen[0]
        for other in chosen[1:]:
            condition = condition | other
        for r in _levels_stage(encoder).table().where(condition).collect():
            names[wanted[r["column"], int(r["place"])]] = f"{r['column']}_{r['value']}"
    return names


def encoded_names(encoder: PipelineModel) -> list[str]:
    """Names of all slots of the feature vector, in order; for vectors that fit the driver."""
    levels: dict[str, list[str]] = {}
    slots = _slots(encoder)
    if any(by_level for by_level, _, _ in slots):
        for r in _levels_stage(encoder).table().orderBy("column", "place").collect():
            levels.setdefault(r["column"], []).append(r["value"])
    out = []
    for by_level, raw, _ in slots:
        out += [f"{raw}_{v}" for v in levels.get(raw, [])] if by_level else [raw]
    return out


def slot_scores(df: DataFrame, features: str, label: str) -> tuple[DataFrame, int]:
    """((slot, score) of every slot that is not 0 everywhere, number of slots).

    The score is the squared correlation with the label: the F-test ranks by it, as p-values of large tables are all
    0. Each vector becomes one row for each of its non-zero entries, and these are added up by slot, so no
    vector is made dense and no task holds a sum for every slot. A slot that does not vary has the score -1.

    The entries are staged: the vectors are computed once, and the plans behind them no longer carry a name for every slot.
    """
    rows = stage(df.select(F.unwrap_udt(F.col(features)).alias("entry"), F.col(label).alias("y")))
    entry = F.col("entry")
    n, mean, spread, width = rows.agg(
        F.count(F.lit(1)), F.avg("y"), F.var_pop("y"), F.max(F.coalesce(entry["size"], F.size(entry["values"])))
    ).first()
    indices = F.coalesce(entry["indices"], F.sequence(F.lit(0), F.size(entry["values"]) - 1))
    pairs = rows.select(F.explode(F.arrays_zip(indices.alias("slot"), entry["values"].alias("x"))).alias("e"), (F.col("y") - F.lit(mean)).alias("y"))
    x = F.col("e.x")
    sums = pairs.where(x != 0).groupBy(F.col("e.slot").alias("slot")).agg(
        F.count(F.lit(1)).alias("m"), F.sum(x).alias("sx"), F.avg(x).alias("mx"), F.var_pop(x).alias("vx"), F.sum(x * F.col("y")).alias("sxy"),
    )
    # Population variance over all n rows from that of the m entries that are not 0.
    share = F.col("m") / F.lit(float(n or 1))
    variance = share * F.col("vx") + share * (1 - share) * F.col("mx") * F.col("mx")
    # The label is centred, so the sum of the products is the covariance.
    covariance = F.col("sxy") / F.lit(float(n or 1))
    varies = (variance > F.lit(1e-12) * F.col("mx") * F.col("mx")) & F.lit(bool(spread))
    score = F.when(varies, covariance * covariance / (variance * F.lit(float(spread or 1.0)))).otherwise(F.lit(-1.0))
    return sums.select("slot", score.alias("score")), width or 0


def f_scores(df: DataFrame, features: str, label: str) -> np.ndarray:
    """The scores of all slots, for vectors that fit the driver."""
    scores, width = slot_scores(df, features, label)
    out = np.full(width, -1.0)
    for r in scores.collect():
        out[r["slot"]] = r["score"]
    return out


class KBestSelector(Estimator, HasInputCol, HasOutputCol, HasLabelCol):
    """Keeps the k slots with the best F-test against the label; fits a VectorSlicer."""

    k = Param(Params._dummy(), "k", "number of slots to keep", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="selected", labelCol=LABEL, k=10):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="features", outputCol="selected", labelCol=LABEL, k=10)

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        scores, width = slot_scores(dataset, self.getInputCol(), self.getOrDefault(self.labelCol))
        k = min(self.getOrDefault(self.k), width)
        # Ties go to the smaller slot; slots without a score come last, in their order.
        best = [r["slot"] for r in scores.where("score >= 0").orderBy(F.desc("score"), "slot").limit(k).collect()]
        if len(best) < k:
            taken, rest = set(best), iter(range(width))
            best += [i for i in rest if i not in taken][: k - len(best)]
        return VectorSlicer(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), indices=sorted(best))


def select_k_best(k: int, output: str = "selected") -> KBestSelector:
    return KBestSelector(outputCol=output, k=k)
