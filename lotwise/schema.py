"""Column names and schemas of the tables this library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import DataType, StructType

ID = "listing_id"
TARGET = "Median_Price"
PSF = "Median_PSF"
TX = "Transactions"
SIZE = "Estimated_Size"
LOG_SIZE = "Log_Estimated_Size"
DENSITY = "Area_Transaction_Density"
TYPE_PREFIX = "Type_"
TEXT_COLUMNS = ["Area", "State", "Tenure", "Type"]

RAW = StructType(
    [
        T.StructField(ID, T.LongType()),
        T.StructField("Township", T.StringType()),
        T.StructField("Area", T.StringType()),
        T.StructField("State", T.StringType()),
        T.StructField("Tenure", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField(TARGET, T.DoubleType()),
        T.StructField(PSF, T.DoubleType()),
        T.StructField(TX, T.DoubleType()),
    ]
)

LOOKUP = StructType(
    [
        T.StructField("State", T.StringType()),
        T.StructField("Area", T.StringType()),
        T.StructField(TX, T.DoubleType()),
        T.StructField(DENSITY, T.DoubleType()),
    ]
)

METRIC_NAMES = [
    f"{part}_{name}" for name in ("r2", "mae", "rmse", "mape") for part in ("train", "test")
]

METRICS = StructType(
    [T.StructField("model", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in METRIC_NAMES]
)

REQUEST = StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("Area", T.StringType()),
        T.StructField("State", T.StringType()),
        T.StructField("Tenure", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField(SIZE, T.DoubleType()),
        T.StructField(TX, T.DoubleType()),
    ]
)


def is_numeric(dtype: DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_columns(schema: StructType, exclude: tuple[str, ...] = (ID,)) -> list[str]:
    return [f.name for f in schema if is_numeric(f.dataType) and f.name not in exclude]


def text_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.StringType)]


def flag_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c.startswith(TYPE_PREFIX)]
