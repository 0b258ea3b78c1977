"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A staged table cuts lineage, survives the loss of executors, and has a known
file size. Joins against it need no hint: Catalyst broadcasts it when the size
is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans a shuffle
join, whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Sequence
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_KEY = "spark.checkpoint.dir"
_staged: list[str] = []
_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The folder of the session; where a local session names none, a temporary one that goes when Python ends."""
    root = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_KEY} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="lotwise-")
        atexit.register(shutil.rmtree, _local_roots[application], ignore_errors=True)
    return _local_roots[application]


def staging_path(spark: SparkSession) -> str:
    """A new, unused location below the staging root."""
    path = f"{staging_root(spark).rstrip('/')}/lotwise/{uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new Parquet table and return a reader of that table."""
    spark = df.sparkSession
    path = staging_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A local relation of rows made on the driver (names, grid points, labels).

    Unlike a frame made from a list it has a known size, so Catalyst broadcasts it.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = [dict(zip(fields.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(fields)))


def drop_staged(spark: SparkSession) -> None:
    """Delete the tables staged by this driver, once their results are written."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    while _staged:
        path = hadoop(_staged.pop())
        path.getFileSystem(conf).delete(path, True)
