"""Weighted least squares with one wide category taken out, and the losses that are built on it.

The effects of the widest category are eliminated: their normal equations are diagonal, so each effect follows from
the sums over its level, and what is left is a small dense system. Two aggregations over the rows give it (products of
the small columns, sums by level); the effects come back as a table that is joined by its own size.

The insensitive loss max(0, |error| - epsilon) is lowered by the same system: each step fits a parabola above every row's
loss that touches it at the present error (majorisation), so the loss cannot rise.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.ml.tables import TableStage
from lotwise.sources.staging import stage, staging_path

#: Small columns at most: their products are a square of this width.
WIDEST = 2_000
#: Levels whose sums a task holds before it passes them on.
HELD = 20_000
#: Reweighted fits at most; squared errors take one.
STEPS = 60
#: Distance to the edge of the tube below which a row's parabola gets no steeper, as a share of epsilon and the spread of the label.
NEAREST = 1e-4


@dataclass
class Solution:
    """Coefficients of the small columns, the constant, and the effects of the levels (level, effect) or None."""

    weights: np.ndarray
    constant: float
    effects: DataFrame | None
    losses: list[float]


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    y = batch.column("y").to_numpy(zero_copy_only=False)
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
    return x, y, batch.column("offset").to_numpy(zero_copy_only=False)


def _parabolas(error: np.ndarray, epsilon: float | None, nearest: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weight, shift of the error that the parabola wants, loss) of each row for its present error."""
    if epsilon is None:
        return np.ones_like(error), np.zeros_like(error), error * error
    beyond = np.abs(error) - epsilon
    outside = beyond > 0
    # Outside the tube the parabola around the near edge, inside the one around the present error that stays above both edges.
    weight = np.where(outside, 1 / (2 * np.maximum(beyond, nearest)), 1 / (4 * np.maximum(-beyond, nearest)))
    wanted = np.where(outside, np.sign(error) * epsilon, error)
    return weight, wanted, np.maximum(beyond, 0.0)


def _sums(weights: np.ndarray, constant: float, epsilon: float | None, nearest: float):
    """Rows (kind, at, level, values): products of the small columns by column, sums by level, and the loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = len(weights)
        products, total = np.zeros((p + 1, p + 1)), 0.0
        held: dict[str | None, np.ndarray] = {}

        def passed() -> pa.RecordBatch:
            return _rows([1] * len(held), [0] * len(held), list(held), list(held.values()))

        for batch in batches:
            x, y, offset = _batch(batch)
            error = y - x @ weights - constant - offset
            weight, wanted, loss = _parabolas(error, epsilon, nearest)
            total += float(loss.sum())
            # The target of the weighted fit: the label moved by the error that is wanted.
            both = np.column_stack([x, y - wanted])
            scaled = both * weight[:, None]
            products += both.T @ scaled
            levels = batch.column("level").dictionary_encode()
            codes = levels.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            names = levels.dictionary.to_pylist()
            if names:
                inside = codes >= 0
                order = np.argsort(codes, kind="stable")[np.count_nonzero(~inside) :]
                found, first = np.unique(codes[order], return_index=True)
                sums = np.add.reduceat(np.column_stack([weight, scaled])[order], first) if len(order) else ()
                for code, row in zip(found.tolist(), sums):
                    held[names[code]] = held[names[code]] + row if names[code] in held else row
                if len(held) > HELD:
                    yield passed()
                    held.clear()
        yield _rows([0] * (p + 1), list(range(p + 1)), [None] * (p + 1), list(products))
        yield _rows([2], [0], [None], [np.array([total])])
        if held:
            yield passed()

    return run


def _rows(kinds: list, at: list, levels: list, values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "kind": pa.array(kinds, pa.int32()), "at": pa.array(at, pa.int32()), "level": pa.array(levels, pa.string()),
        "values": pa.array([v.tolist() for v in values], pa.list_(pa.float64())),
    })


_SUMS = "kind int, at int, level string, values array<double>"


def _added(df: DataFrame, *by: str) -> DataFrame:
    """Sums of the arrays, entry by entry."""
    total = Summarizer.metrics("sum").summary(array_to_vector("values"))
    return df.groupBy(*by).agg(vector_to_array(total["sum"]).alias("values"))


def _eliminated(ridge: float, p: int):
    """What the effects of the levels take from the products: the sum of s s' / (n + ridge)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = np.zeros((p + 1, p + 1))
        for batch in batches:
            s = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            taken += s[:, 1:].T @ (s[:, 1:] / (s[:, :1] + ridge))
        yield _rows([0] * (p + 1), list(range(p + 1)), [None] * (p + 1), list(taken))

    return run


def _square(df: DataFrame, p: int) -> tuple[np.ndarray, float]:
    """The products, and the loss."""
    out, loss = np.zeros((p + 1, p + 1)), 0.0
    for r in _added(df, "kind", "at").collect():  # p + 1 rows of p + 1 numbers, and one
        if r["kind"] == 2:
            loss = r["values"][0]
        else:
            out[r["at"]] = r["values"]
    return out, loss


def solve(
    rows: DataFrame, ridge: float = 0.0, epsilon: float | None = None, steps: int = STEPS, tolerance: float = 2e-4, unpenalised: Sequence[int] = ()
) -> Solution:
    """Least squares, or the insensitive loss where ``epsilon`` is given, over staged ``rows`` (x array<double>, y, level).

    Minimises the sum of the squared errors plus ``ridge`` times the squared weights and effects, or the sum of the insensitive
    losses plus half of that; the weights listed in ``unpenalised`` are free. Without a penalty the weights of columns that
    depend on each other are those of least norm (each scaled by its root of squares), and the effects have the mean 0 over the rows. A NULL
    level has no effect. ``losses`` has the objective before each step and at the end. It does not rise: the search ends when a
    step lowers it by less than ``tolerance`` of itself, and a step that would raise it (by the bound ``NEAREST``) is not taken.
    """
    p, least, n, n_levels, mean, spread = rows.agg(
        F.max(F.size("x")), F.min(F.size("x")), F.count(F.lit(1)), F.count("level"), F.avg("y"), F.stddev_pop("y")
    ).first()
    if not n:
        raise ValueError("there are no rows to fit")
    if p != least:
        raise ValueError("rows have different numbers of columns")
    if p > WIDEST:
        raise ValueError(f"{p} small columns: take out another category")
    penalty = ridge if epsilon is None else ridge / 2
    free = np.isin(np.arange(p), list(unpenalised))
    nearest = NEAREST * max(epsilon or 0.0, spread or 0.0, 1e-12)
    now, norm, losses = Solution(np.zeros(p), float(mean), None, []), 0.0, []
    previous = now
    for step in range(steps + 1):
        located = rows.withColumn("offset", F.lit(0.0))
        if now.effects is not None:
            effects = now.effects.withColumnsRenamed({"level": "_level", "effect": "_effect"})
            located = rows.join(effects, F.col("level") == F.col("_level"), "left").select("x", "y", "level", F.coalesce("_effect", F.lit(0.0)).alias("offset"))
        found = located.select("x", "y", "level", "offset").mapInArrow(_sums(now.weights, now.constant, epsilon, nearest), _SUMS)
        found = stage(found) if n_levels else found
        products, total = _square(found.where("kind <> 1"), p)
        objective = total + penalty * norm
        if losses and objective > losses[-1]:
            now = previous
            break
        losses.append(objective)
        done = len(losses) > 1 and (epsilon is None or losses[-2] - objective <= tolerance * losses[-2])
        if done or step == steps:
            break
        previous = now
        now, norm = _step(found if n_levels else None, products, penalty, free)
    now.losses = losses
    return now


def _step(found: DataFrame | None, products: np.ndarray, ridge: float, free: np.ndarray) -> tuple[Solution, float]:
    """The weighted fit and the squared norm of what is penalised."""
    p = len(free)
    levels, reduced = None, products
    if found is not None:
        levels = stage(_added(found.where("kind = 1"), "level"))
        reduced = products - _square(levels.select("values").mapInArrow(_eliminated(ridge, p), _SUMS), p)[0]
    left, right = reduced[:p, :p] + np.diag(np.where(free, 0.0, ridge)), reduced[:p, p]
    scale = np.sqrt(np.maximum(np.diag(products)[:p], 1e-300))
    weights = np.linalg.lstsq(left / np.outer(scale, scale), right / scale, rcond=1e-11)[0] / scale
    norm = float(weights[~free] @ weights[~free])
    if levels is None:
        return Solution(weights, 0.0, None, []), norm
    # An effect is what the sums of its level leave: (sum of targets - sums of the columns by their weights) / (n + ridge).
    n, target, columns = F.col("values")[0], F.element_at("values", -1), F.slice("values", 2, p)
    by_weight = F.zip_with(columns, F.array(*[F.lit(float(w)) for w in weights]).cast("array<double>"), lambda s, w: s * w)
    rest = target - F.aggregate(by_weight, F.lit(0.0), lambda a, b: a + b)
    effects = levels.select("level", n.alias("n"), (rest / (n + F.lit(float(ridge)))).alias("effect"))
    squares, middle = effects.agg(F.sum(F.col("effect") ** 2), F.sum(F.col("effect") * F.col("n")) / F.sum("n")).first()
    if ridge:
        return Solution(weights, 0.0, effects.select("level", "effect"), []), norm + squares
    return Solution(weights, float(middle), effects.select("level", (F.col("effect") - F.lit(float(middle))).alias("effect")), []), norm


def linear_sum(columns: Sequence[Column], weights: Sequence[float], constant: float) -> Column:
    total = F.lit(float(constant))
    for column, weight in zip(columns, weights):
        total = total + column * F.lit(float(weight))
    return total


class BlockRegression(Estimator, HasLabelCol, HasPredictionCol, HasMaxIter):
    """A linear model over raw columns: numbers, flags, small categories, and one wide category that is taken out.

    ``epsilon`` below 0 means squared errors, whose fit is exact whatever ``maxIter``. Numbers are scaled by their mean and population deviation, a NULL number
    counts as the mean. Unseen and NULL levels of any category add nothing.
    """

    design = Param(Params._dummy(), "design", "numbers, flags, small and wide categories as JSON", TypeConverters.toString)
    ridge = Param(Params._dummy(), "ridge", "penalty of the squared weights", TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "half width of the tube, or -1", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, design="{}", labelCol="log_price", predictionCol="prediction", ridge=0.0, epsilon=-1.0, maxIter=STEPS):
        super().__init__()
        self._setDefault(labelCol="log_price", predictionCol="prediction", ridge=0.0, epsilon=-1.0, maxIter=STEPS)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> BlockModel:
        design = json.loads(self.getOrDefault(self.design))
        design["levels"] = {c: _small_levels(dataset, c) for c in design["small"]}
        shape = {c: (F.avg(f"`{c}`").alias(f"m{i}"), F.stddev_pop(f"`{c}`").alias(f"s{i}")) for i, c in enumerate(design["numbers"])}
        found = dataset.agg(F.count(F.lit(1)), *[a for pair in shape.values() for a in pair]).first()
        design["scale"] = {c: [found[f"m{i}"] or 0.0, found[f"s{i}"] or 1.0] for i, c in enumerate(design["numbers"])}
        ridge, epsilon = self.getOrDefault(self.ridge), self.getOrDefault(self.epsilon)
        columns = design_columns(design)
        # A penalised fit needs a constant of its own; otherwise the effects hold it.
        free = [0] if ridge or not design["wide"] else []
        x = F.array(*([F.lit(1.0)] if free else []), *columns) if free or columns else F.array().cast("array<double>")
        level = F.col(f"`{design['wide']}`").cast("string") if design["wide"] else F.lit(None).cast("string")
        rows = stage(dataset.select(x.alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"), level.alias("level")))
        solution = solve(rows, ridge, None if epsilon < 0 else epsilon, self.getMaxIter(), unpenalised=free)
        weights, constant = solution.weights.tolist(), solution.constant
        if free:
            constant, weights = constant + weights[0], weights[1:]
        source = ""
        if solution.effects is not None:
            source = staging_path(dataset.sparkSession)
            solution.effects.write.parquet(source)
        model = BlockModel(
            design=json.dumps(design), weights=weights, constant=float(constant), predictionCol=self.getPredictionCol(), source=source
        )
        model.losses = solution.losses
        return model


def _small_levels(dataset: DataFrame, column: str) -> list[str]:
    """Levels of a category without the widest one, by name; there are few, and more than ``WIDEST`` are refused."""
    found = dataset.select(F.col(f"`{column}`").cast("string").alias("v")).where("v IS NOT NULL").distinct().orderBy("v").limit(WIDEST + 1).collect()
    if len(found) > WIDEST:
        raise ValueError(f"{column} has more than {WIDEST} levels: take it out")
    return [r["v"] for r in found]


def design_columns(design: dict) -> list[Column]:
    numbers = [
        F.coalesce((F.col(f"`{c}`").cast("double") - F.lit(float(mean))) / F.lit(float(std)), F.lit(0.0)) for c, (mean, std) in design["scale"].items()
    ]
    levels = [F.when(F.col(f"`{c}`") == v, 1.0).otherwise(0.0) for c, values in design["levels"].items() for v in values]
    flags = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in design["flags"]]
    return [*numbers, *levels, *flags]


class BlockModel(Transformer, HasPredictionCol, TableStage):
    """Adds the prediction: the small columns by their weights and the effect of the wide category's level."""

    design = Param(Params._dummy(), "design", "the fitted design as JSON", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "weights of the small columns", TypeConverters.toListFloat)
    constant = Param(Params._dummy(), "constant", "the constant", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, design="{}", weights=(), constant=0.0, predictionCol="prediction", source=""):
        super().__init__()
        self._setDefault(predictionCol="prediction", source="")
        self._set(**self._input_kwargs)
        self.losses: list[float] = []

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.design))

    def names(self) -> list[str]:
        """Names of the small columns, in order."""
        design = self.fitted()
        return [*design["scale"], *[f"{c}_{v}" for c, values in design["levels"].items() for v in values], *design["flags"]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        design, table, name = self.fitted(), self.table(), self.getPredictionCol()
        kept = [f"`{c}`" for c in dataset.columns if c != name]
        total = linear_sum(design_columns(design), self.getOrDefault(self.weights), self.getOrDefault(self.constant))
        if table is None:
            return dataset.select(*kept, total.alias(name))
        effects = table.select(F.col("level").alias("_level"), F.col("effect").alias("_effect"))
        joined = dataset.join(effects, F.col(f"`{design['wide']}`").cast("string") == F.col("_level"), "left")
        return joined.select(*kept, (total + F.coalesce("_effect", F.lit(0.0))).alias(name))


class InsensitiveRegression(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter):
    """A linear model over a vector of some hundred slots with the insensitive loss and a ridge."""

    ridge = Param(Params._dummy(), "ridge", "penalty of the squared weights", TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "half width of the tube", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="log_price", predictionCol="prediction", ridge=1.0, epsilon=0.1, maxIter=STEPS):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="log_price", predictionCol="prediction", ridge=1.0, epsilon=0.1, maxIter=STEPS)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> VectorModel:
        x = F.concat(F.array(F.lit(1.0)), vector_to_array(self.getFeaturesCol()))
        rows = stage(dataset.select(x.alias("x"), F.col(self.getLabelCol()).alias("y"), F.lit(None).cast("string").alias("level")))
        solution = solve(rows, self.getOrDefault(self.ridge), self.getOrDefault(self.epsilon), self.getMaxIter(), unpenalised=[0])
        model = VectorModel(
            featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
            weights=solution.weights[1:].tolist(), constant=float(solution.constant + solution.weights[0]),
        )
        model.losses = solution.losses
        return model


class VectorModel(Transformer, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    weights = Param(Params._dummy(), "weights", "weights of the slots", TypeConverters.toListFloat)
    constant = Param(Params._dummy(), "constant", "the constant", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", weights=(), constant=0.0):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        self._set(**self._input_kwargs)
        self.losses: list[float] = []

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(float(w)) for w in self.getOrDefault(self.weights)])
        parts = F.zip_with(vector_to_array(self.getFeaturesCol()), weights, lambda x, w: x * w)
        return dataset.withColumn(self.getPredictionCol(), F.aggregate(parts, F.lit(self.getOrDefault(self.constant)), lambda a, b: a + b))
