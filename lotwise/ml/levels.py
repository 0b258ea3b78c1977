"""Places of category levels: one aggregation over the rows, one table, joined by its own size.

The levels never pass through the driver, so their number is not bounded by it. Trees get them in the order of the
mean label, where a threshold splits them as well as any set of levels does for a squared error; one-hot vectors get
them by name.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.ml.tables import TableStage
from lotwise.operators.chartdata import ordered_index
from lotwise.sources.staging import stage, staging_path

#: Digits of a mean label that count; beyond them levels are tied and follow their names.
DIGITS = 9


def level_means(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(column, value, n, mean): rows and mean label of every level that is not NULL."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    long = df.select(F.explode(pairs).alias("p"), F.col(label).alias("y")).select("p.*", "y").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), DIGITS).alias("mean"))


class Levels(Estimator, HasInputCols, HasLabelCol):
    """Fits the place of each level, from 0, by mean label (ties by name) or by name."""

    by = Param(Params._dummy(), "by", "'label' or 'name'", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=(), labelCol="log_price", by="label"):
        super().__init__()
        self._setDefault(labelCol="log_price", by="label")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LevelsModel:
        columns, by = self.getInputCols(), self.getOrDefault(self.by)
        if by not in ("label", "name"):
            raise ValueError(f"unknown order {by}")
        order = ["column", "mean", "value"] if by == "label" else ["column", "value"]
        ranked = stage(ordered_index(level_means(dataset, columns, self.getLabelCol()), order))
        sums = ranked.groupBy("column").agg(
            F.min("index").alias("first"), F.count(F.lit(1)).alias("size"), (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("overall")
        )
        found = {r["column"]: r for r in sums.collect()}  # one row for each category column
        # The entry without a name gives the map its types where there are no levels.
        firsts = F.create_map(*[F.lit(x) for c, at in [("", 0), *((c, found[c]["first"]) for c in found)] for x in (c, at)])
        path = staging_path(dataset.sparkSession)
        places = ranked.select("column", "value", "n", "mean", (F.col("index") - firsts[F.col("column")]).cast("double").alias("place"))
        places.write.parquet(path)
        sizes = [found[c]["size"] if c in found else 0 for c in columns]
        defaults = [float(s) for s in sizes]
        if by == "label" and found:
            below = [F.count(F.when((F.col("column") == c) & (F.col("mean") < found[c]["overall"]), 1)).alias(str(i)) if c in found else F.lit(0).alias(str(i)) for i, c in enumerate(columns)]
            defaults = [float(x) for x in ranked.agg(*below).first()]
        return LevelsModel(inputCols=columns, sizes=sizes, defaults=defaults, source=path)


class LevelsModel(Transformer, HasInputCols, TableStage):
    """Adds ``_index_<column>``, the place of the row's level.

    A level that was not fitted, and NULL, has the place where the mean label of all rows would be, or by name the
    first one behind all levels.
    """

    sizes = Param(Params._dummy(), "sizes", "number of levels of each column", TypeConverters.toListInt)
    defaults = Param(Params._dummy(), "defaults", "place of other values", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=(), sizes=(), defaults=(), source=""):
        super().__init__()
        self._setDefault(source="")
        self._set(**self._input_kwargs)

    def size_of(self) -> dict[str, int]:
        return dict(zip(self.getInputCols(), self.getOrDefault(self.sizes)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table, columns = self.table(), dataset.columns
        for column, default in zip(self.getInputCols(), self.getOrDefault(self.defaults)):
            name = f"_index_{column}"
            # Both sides get names of their own, so a dataset made from the same table joins as well.
            places = table.where(F.col("column") == column).select(F.col("value").alias("_level"), F.col("place").alias("_place"))
            joined = dataset.join(places, F.col(f"`{column}`").cast("string") == F.col("_level"), "left")
            columns = [c for c in columns if c != name]
            dataset = joined.select(*[f"`{c}`" for c in columns], F.coalesce("_place", F.lit(default)).alias(name))
            columns = [*columns, name]
        return dataset


@F.arrow_udf(VectorUDT())
def _as_vector(entries: pa.Array) -> pa.Array:
    """The same rows under the type of vectors, which SQL cannot cast to."""
    return entries


class SlotVector(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A sparse vector of numbers and of the places of levels, each place as a one among as many slots as there are levels.

    A place behind all levels has no slot: all zeros. Slots have no names in the schema, where the driver would hold one object for each.
    """

    widths = Param(Params._dummy(), "widths", "number of levels of each input, 0 for a number", TypeConverters.toListInt)
    levels = Param(Params._dummy(), "levels", "inputs that are places", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=(), outputCol="features", levels=(), widths=()):
        super().__init__()
        self._set(**self._input_kwargs)

    def slots(self) -> list[tuple[str, bool, int]]:
        """(input column, whether it is a place, number of slots) in the order of the vector."""
        levels = set(self.getOrDefault(self.levels))
        return [(c, c in levels, w if c in levels else 1) for c, w in zip(self.getInputCols(), self.getOrDefault(self.widths))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        first, entries = 0, []
        for column, is_place, size in self.slots():
            value = F.col(f"`{column}`").cast("double")
            missing = value.isNull() | F.isnan(value)
            known = F.when(missing, F.raise_error(F.lit(f"{column} has no value")).cast("double")).otherwise(value)
            if is_place:
                entries.append(F.when(known < size, F.struct((known + first).cast("int").alias("i"), F.lit(1.0).alias("x"))))
            else:
                entries.append(F.when(known != 0, F.struct(F.lit(first).alias("i"), known.alias("x"))))
            first += size
        filled = F.array_compact(F.array(*entries))
        vector = F.struct(
            F.lit(0).cast("byte").alias("type"), F.lit(first).alias("size"),
            F.transform(filled, lambda e: e["i"]).alias("indices"), F.transform(filled, lambda e: e["x"]).alias("values"),
        )
        return dataset.withColumn(self.getOutputCol(), _as_vector(vector))
