"""A listing table derived from an orders star schema, used by the tests, the bench and the entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.sources.staging import stage


def listing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    part = table("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    # The lines of an order come together before they are added up: sets that differ by order do not get smaller before a shuffle.
    lots = (
        table("lineitem")
        .join(part, "l_partkey")
        .select("l_orderkey", "p_type", "l_extendedprice", "l_quantity", "l_linenumber")
        .repartition("l_orderkey")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.round(F.sum("l_extendedprice"), 2).alias("price"),
            F.sum("l_quantity").alias("qty"),
            F.sum("l_linenumber").alias("tx"),
            F.array_join(F.array_sort(F.collect_set("p_type")), ", ").alias("ty"),
        )
    )
    nation = table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    owners = (
        table("customer")
        .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
        .join(nation, "c_nationkey")
    )
    key = F.col("o_orderkey")
    tenure = (
        F.when(F.col("o_orderstatus") == "F", "FREEHOLD")
        .when(F.col("o_orderstatus") == "P", "Leasehold")
        .when(key % 2 == 0, "Freehold, Leasehold")
        .otherwise(" leasehold,  freehold")
    )
    return (
        table("orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus")
        .join(lots, "o_orderkey")
        .join(owners, "o_custkey")
        .select(
            key.alias(S.ID),
            F.concat(F.lit("lot "), key.cast("string")).alias("Township"),
            F.col("c_name").alias("Area"),
            F.col("n_name").alias("State"),
            tenure.alias("Tenure"),
            F.col("ty").alias("Type"),
            F.when(key % 50 != 0, F.col("price")).alias(S.TARGET),
            F.try_divide("price", "qty").alias(S.PSF),
            F.when(key % 20 != 7, F.col("tx").cast("double")).alias(S.TX),
        )
    )


_tables: dict[tuple[str, str], DataFrame] = {}


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing view as a table of its own, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        table = stage(listing_view(spark, sf_dir))
        cores = spark.sparkContext.defaultParallelism
        if table.rdd.getNumPartitions() < cores:
            # A table this small has fewer files than the session has cores.
            table = stage(table.repartition(cores))
        _tables[key] = table
    return _tables[key]
