"""Preprocessing fitted on some rows and applied to others: nothing of the test rows enters a statistic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.functions.numeric import nan_as_null
from lotwise.ml.split import train_test_split
from lotwise.operators import cleaning as C
from lotwise.operators.encoding import column_names_of, multi_hot
from lotwise.operators.quantiles import quantile_values
from lotwise.plans.preprocess import clean_rows
from lotwise.sources.staging import small_table, stage

_NUMBERS = ("median", "price_low", "price_high", "tx_low", "tx_high")


def _join_known(df: DataFrame, known: DataFrame, column: str, other) -> DataFrame:
    """``other`` in place of the values that ``known`` does not have; NULLs stay."""
    flagged = df.join(known.withColumn("_known", F.lit(True)), column, "left")
    unknown = F.col(column).isNotNull() & F.col("_known").isNull()
    return flagged.withColumn(column, F.when(unknown, other).otherwise(F.col(column))).select(*df.columns)


@dataclass(frozen=True)
class Preprocessor:
    """What the fit rows say: a few numbers, and tables that are joined by their own size.

    ``median`` fills the transactions; ``price`` and ``transactions`` are fences (None: the fit rows had no number);
    ``shares`` has the density of each Area; ``states`` and ``areas`` have the frequent values; ``types`` the items.
    """

    median: float | None
    price: tuple[float, float] | None
    transactions: tuple[float, float] | None
    shares: DataFrame | None
    states: DataFrame
    areas: DataFrame
    types: DataFrame

    def transform(self, rows: DataFrame) -> DataFrame:
        """Cleaned rows (:func:`clean_rows`) to model columns; further columns stay, at the end.

        Rows outside the fences go. A State or Area that was rare among the fit rows, or that they did not have, goes
        into the bucket for rare ones; an Area that they did not have has density 0; items that they did not have
        have no flag. NULL stays NULL.
        """
        if self.median is not None:
            rows = rows.withColumn(S.TX, F.coalesce(nan_as_null(F.col(S.TX)), F.lit(self.median)))
        if self.price is not None:
            rows = rows.where(F.col(S.TARGET).between(*self.price))
        rows = rows.where(F.lit(False) if self.transactions is None else F.col(S.TX).between(*self.transactions))
        if self.shares is not None:
            density = F.when(F.col("Area").isNotNull(), F.coalesce(F.col(S.DENSITY), F.lit(0.0)))
            rows = C.add_density(rows, self.shares).withColumn(S.DENSITY, density)
        rows = _join_known(rows, self.states, "State", F.lit(C.OTHER_STATE))
        rows = _join_known(rows, self.areas, "Area", F.concat(F.lit(C.OTHER_AREA_PREFIX), F.col("State")))
        return multi_hot(rows, vocabulary=column_names_of(self.types))

    def save(self, path: str) -> None:
        """Write all statistics below ``path``, in place of what is there."""
        spark = self.states.sparkSession
        values = [self.median, *(self.price or (None, None)), *(self.transactions or (None, None))]
        numbers = small_table(spark, list(zip(_NUMBERS, values)), "name string, value double")
        tables = {"numbers": numbers, "states": self.states, "areas": self.areas, "types": self.types}
        # Without shares an empty table stands for them, so that none of an earlier fit is read again.
        none = small_table(spark, [], f"Area string, {S.DENSITY} double")
        tables["shares"] = none if self.shares is None else self.shares
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("numbers", "shares", "states", "areas", "types")}
        found = {r["name"]: r["value"] for r in tables["numbers"].collect()}

        def ends(low: str, high: str) -> tuple[float, float] | None:
            return None if found[low] is None else (found[low], found[high])

        shares = None if tables["shares"].isEmpty() else tables["shares"]
        return cls(
            found["median"], ends("price_low", "price_high"), ends("tx_low", "tx_high"),
            shares, tables["states"], tables["areas"], tables["types"],
        )


def fit_preprocessor(rows: DataFrame, approx: bool = False) -> Preprocessor:
    """The statistics of :func:`lotwise.plans.preprocess.preprocess` from cleaned rows, in the same order.

    Each is counted on the rows that the filters before it leave. ``rows`` is read several times: stage it before.
    """
    quartiles = quantile_values(rows, [S.TARGET, S.TX], [0.25, 0.5, 0.75], approx)
    median = quartiles[S.TX][1] if S.TX in quartiles else None
    if median is not None:
        rows = rows.withColumn(S.TX, F.coalesce(nan_as_null(F.col(S.TX)), F.lit(median)))
    shares = C.area_shares(rows)
    price = None
    if S.TARGET in quartiles:
        price = C.fences(quartiles[S.TARGET][0], quartiles[S.TARGET][2])
        rows = rows.where(F.col(S.TARGET).between(*price))
    left = quantile_values(rows, [S.TX], [0.25, 0.75], approx).get(S.TX)
    transactions = None if left is None else C.fences(*left)
    rows = rows.where(F.lit(False) if transactions is None else F.col(S.TX).between(*transactions))
    frequencies = C.category_frequencies(rows)

    def frequent(column: str, at_least: int) -> DataFrame:
        return stage(frequencies.where((F.col("column") == column) & (F.col("n") >= at_least)).select(F.col("value").alias(column)))

    return Preprocessor(
        median, price, transactions, shares,
        frequent("State", C.MIN_STATE_ROWS), frequent("Area", C.MIN_AREA_ROWS), frequent("Type", 1),
    )


def split_and_fit(raw: DataFrame) -> tuple[DataFrame, Preprocessor]:
    """The staged clean table with its ``split`` column, and the preprocessor fitted on its train rows.

    The rows are split before any statistic is taken, by State (States with a single row count as one), and the
    filters come after it, so the share of test rows is exact before the filters and close to it after them.
    """
    rows = clean_rows(raw)
    columns = rows.columns
    if "State" in columns:
        strata = C.bucket_rare_state(stage(rows.withColumn("_state", F.col("State"))))
        rows = train_test_split(strata).withColumn("State", F.col("_state"))
    else:
        rows = train_test_split(stage(rows), by=None)
    rows = stage(rows.select(*columns, "split"))
    fitted = fit_preprocessor(rows.where("split = 'train'").drop("split"))
    clean = fitted.transform(rows)
    return stage(clean.select(*[F.col(f"`{c}`") for c in clean.columns if c != "split"], "split")), fitted
