"""Reading and writing listing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from lotwise import schema as S
from lotwise.sources.staging import stage


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def require_path(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no dataset at {path}")
    return path


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL: Spark orders NaN above every number and lets it join and group."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
            for c in df.columns
        ]
    )


def read_raw(spark: SparkSession, path: str, schema: StructType = S.RAW, multiline: bool = False) -> DataFrame:
    """CSV with a header row, read with a declared schema (inference would scan twice).

    ``multiline`` allows line breaks inside quotes; such files cannot be split
    between tasks.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    # Quotes inside a quoted field are doubled, as CSV writers commonly do.
    reader = reader.option("quote", '"').option("escape", '"').option("multiLine", multiline)
    return nan_to_null(reader.csv(require_path(spark, path)))


#: Equal rows that are numbered in one array.
_EQUAL = 10_000


def with_listing_id(df: DataFrame) -> DataFrame:
    """Adds a row key to a table without one: the hash of the row and its number among equal rows.

    The key follows from the content, whatever the files and partitions it comes from. Equal rows are counted, which
    a partial aggregation does before the shuffle, and written out again; staged, as every later job reads the keys.
    """
    names = [f"`{c}`" for c in df.columns]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    # JSON names the fields, so a NULL in one column is not a NULL in another.
    digest = F.md5(F.to_json(F.struct(*names)))
    blocks = counted.select(*names, digest.alias("_digest"), "_n", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(_EQUAL))).alias("_first"))
    last = F.least(F.col("_first") + _EQUAL, F.col("_n")) - 1
    rows = blocks.select("_digest", *names, F.explode(F.sequence("_first", last)).alias("_number"))
    return stage(rows.select(F.concat_ws("-", "_digest", "_number").alias(S.ID), *names))


def read_clean(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    require_path(spark, path)
    if fmt == "parquet":
        return nan_to_null(spark.read.parquet(path))
    if schema is None:
        raise ValueError("a CSV table needs a schema")
    return read_raw(spark, path, schema)


def write_clean(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        # Surrounding blanks are data, so the writer must not trim them.
        writer = writer.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.format(fmt).save(path)
