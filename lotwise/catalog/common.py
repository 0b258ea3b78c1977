"""Shared inputs of the queries, and the same inputs as common table expressions."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lotwise import schema as S
from lotwise.fixtures import listings
from lotwise.operators import cleaning as C
from lotwise.plans.preprocess import preprocess
from lotwise.plans.training import prepare_split
from lotwise.sources.staging import stage

FLAGS = ["Type_Economy", "Type_Large", "Type_Medium", "Type_Promo", "Type_Small", "Type_Standard"]

_memo: dict[tuple[str, str, str], Any] = {}


def _once(name: str, spark: SparkSession, sf: str, make: Callable[[], Any]) -> Any:
    key = (spark.sparkContext.applicationId, name, sf)
    if key not in _memo:
        _memo[key] = make()
    return _memo[key]


def clean_table(spark: SparkSession, sf: str) -> DataFrame:
    return _once("clean", spark, sf, lambda: stage(preprocess(listings(spark, sf))))


def split_table(spark: SparkSession, sf: str) -> DataFrame:
    return _once("split", spark, sf, lambda: prepare_split(listings(spark, sf)))


def baseline(spark: SparkSession, sf: str, by: str = "State") -> DataFrame:
    """(listing_id, split, actual, predicted): the mean train price of the row's group."""
    rows = split_table(spark, sf)
    means = stage(rows.where("split = 'train'").groupBy(by).agg(F.avg(S.TARGET).alias("predicted")))
    return rows.join(means, by).select(S.ID, "split", F.col(S.TARGET).alias("actual"), "predicted")


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every listing as a scoring request; leasehold ones name an Area nobody knows."""
    rows = C.canonicalize_tenure(C.standardize_text(listings(spark, sf)))
    area = F.when(F.col("Tenure") == "Leasehold", F.col("Township")).otherwise(F.col("Area"))
    return rows.select(
        F.col(S.ID).alias("request_id"),
        area.alias("Area"),
        "State",
        "Tenure",
        "Type",
        F.try_divide(S.TARGET, S.PSF).alias(S.SIZE),
        S.TX,
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {f.name for f in df.schema if isinstance(f.dataType, DoubleType)}
    return df.select(
        *[F.round(f"`{c}`", digits).alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns]
    )


LISTING_SQL = """
li AS (
  SELECT l_orderkey, round(sum(l_extendedprice), 2) AS price, sum(l_quantity) AS qty, sum(l_linenumber) AS tx,
         string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS ty
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
listing AS (
  SELECT o_orderkey AS listing_id, 'lot ' || o_orderkey AS Township, c_name AS Area, n_name AS State,
         CASE o_orderstatus WHEN 'F' THEN 'FREEHOLD' WHEN 'P' THEN 'Leasehold'
              ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Freehold, Leasehold' ELSE ' leasehold,  freehold' END END AS Tenure,
         ty AS "Type",
         CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE price END AS Median_Price,
         price / nullif(qty, 0) AS Median_PSF,
         CASE WHEN o_orderkey % 20 = 7 THEN NULL ELSE CAST(tx AS DOUBLE) END AS Transactions
  FROM orders JOIN li ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def text_sql(column: str) -> str:
    flat = rf"regexp_replace(regexp_replace({column}, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"
    runs = rf"regexp_extract_all(lower({flat}), '([\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+)', 1)"
    return f"array_to_string(list_transform({runs}, lambda t: upper(t[1]) || t[2:]), '')"


def tenure_sql(column: str) -> str:
    return (
        f"CASE WHEN {column} IN ('Freehold, Leasehold', 'Leasehold, Freehold') "
        f"THEN 'Freehold and Leasehold' ELSE {column} END"
    )


def fences_sql(table: str, column: str) -> str:
    """A condition that keeps the rows of ``table`` inside its own fences."""
    q = f"quantile_cont({column}, {{p}})"
    q1, q3 = q.format(p=0.25), q.format(p=0.75)
    return (
        f"{column} >= (SELECT {q1} - 1.5 * ({q3} - {q1}) FROM {table}) "
        f"AND {column} <= (SELECT {q3} + 1.5 * ({q3} - {q1}) FROM {table})"
    )


TEXT_SQL = (
    f"""
texts AS (
  SELECT * REPLACE ({", ".join(f'{text_sql(chr(34) + c + chr(34))} AS "{c}"' for c in S.TEXT_COLUMNS)}) FROM listing),
tenured AS (SELECT * REPLACE ({tenure_sql("Tenure")} AS Tenure) FROM texts)"""
)

CLEAN_SQL = f"""{LISTING_SQL},{TEXT_SQL},
priced AS (SELECT * EXCLUDE (Township) FROM tenured WHERE Median_Price IS NOT NULL),
filled AS (
  SELECT * REPLACE (coalesce(Transactions, (SELECT quantile_cont(Transactions, 0.5) FROM priced)) AS Transactions)
  FROM priced),
sized AS (
  SELECT * EXCLUDE (Median_PSF), Median_Price / nullif(Median_PSF, 0) AS Estimated_Size,
         ln(1 + Median_Price / nullif(Median_PSF, 0)) AS Log_Estimated_Size FROM filled),
dense AS (
  SELECT s.*, a.area_tx / (SELECT sum(Transactions) FROM sized) AS Area_Transaction_Density
  FROM sized s LEFT JOIN (SELECT Area, sum(Transactions) AS area_tx FROM sized WHERE Area IS NOT NULL GROUP BY Area) a
  ON s.Area = a.Area),
cut1 AS (SELECT * FROM dense WHERE {fences_sql("dense", "Median_Price")}),
cut2 AS (SELECT * FROM cut1 WHERE {fences_sql("cut1", "Transactions")}),
states AS (
  SELECT * REPLACE (CASE WHEN State IN (SELECT State FROM cut2 GROUP BY State HAVING count(*) < 2)
                    THEN 'Other_State' ELSE State END AS State) FROM cut2),
areas AS (
  SELECT * REPLACE (CASE WHEN Area IN (SELECT Area FROM states GROUP BY Area HAVING count(*) < 5)
                    THEN 'Other_' || State ELSE Area END AS Area) FROM states),
clean AS (
  SELECT * EXCLUDE ("Type"),
         {", ".join(f"CAST(list_contains(string_split(" + chr(34) + "Type" + chr(34) + f", ', '), '{f[5:]}') AS INTEGER) AS " + chr(34) + f + chr(34) for f in FLAGS)}
  FROM areas)"""


def split_sql(table: str, by: str = "State") -> str:
    """``split``: the rows of ``table`` with their split, stratified by a column."""
    return f"""
strata AS (SELECT {by} AS stratum, count(*) AS size FROM {table} GROUP BY {by}),
wanted AS (
  SELECT stratum, size, sum(size) OVER () AS n, ceil(sum(size) OVER () * CAST(0.2 AS DOUBLE)) AS n_test FROM strata),
quotas AS (
  SELECT stratum, floor(size * n_test / n) AS base, size * n_test / n - floor(size * n_test / n) AS rest, n_test
  FROM wanted),
limits AS (
  SELECT stratum, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, stratum) <= n_test - sum(base) OVER ()
                         THEN 1 ELSE 0 END AS quota FROM quotas),
split AS (
  SELECT c.*, CASE WHEN row_number() OVER (PARTITION BY {by} ORDER BY substr(md5('42:' || listing_id), 1, 13)) <= quota
              THEN 'test' ELSE 'train' END AS split
  FROM {table} c JOIN limits ON {by} = stratum)"""


SPLIT_SQL = f"{CLEAN_SQL},{split_sql('clean')}"

#: The clean table with all statistics from the train rows: split first, then everything else.
TRAIN_FITTED_SQL = f"""{LISTING_SQL},{TEXT_SQL},
sized AS (
  SELECT * EXCLUDE (Township, Median_PSF), Median_Price / nullif(Median_PSF, 0) AS Estimated_Size,
         ln(1 + Median_Price / nullif(Median_PSF, 0)) AS Log_Estimated_Size FROM tenured WHERE Median_Price IS NOT NULL),
grouped AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY State) < 2 THEN 'Other_State' ELSE State END AS by_state FROM sized),{split_sql("grouped", "by_state")},
filled AS (
  SELECT * REPLACE (coalesce(Transactions, (SELECT quantile_cont(Transactions, 0.5) FROM split WHERE split = 'train')) AS Transactions)
  FROM split),
dense AS (
  SELECT f.*, coalesce(a.area_tx, 0) / (SELECT sum(Transactions) FROM filled WHERE split = 'train') AS Area_Transaction_Density
  FROM filled f LEFT JOIN (SELECT Area, sum(Transactions) AS area_tx FROM filled WHERE split = 'train' GROUP BY Area) a ON f.Area = a.Area),
train1 AS (SELECT * FROM dense WHERE split = 'train'),
cut1 AS (SELECT * FROM dense WHERE {fences_sql("train1", "Median_Price")}),
train2 AS (SELECT * FROM cut1 WHERE split = 'train'),
cut2 AS (SELECT * FROM cut1 WHERE {fences_sql("train2", "Transactions")}),
train3 AS (SELECT * FROM cut2 WHERE split = 'train'),
states AS (
  SELECT * REPLACE (CASE WHEN State NOT IN (SELECT State FROM train3 GROUP BY State HAVING count(*) >= 2)
                    THEN 'Other_State' ELSE State END AS State) FROM cut2),
areas AS (
  SELECT * REPLACE (CASE WHEN Area NOT IN (SELECT Area FROM train3 GROUP BY Area HAVING count(*) >= 5)
                    THEN 'Other_' || State ELSE Area END AS Area) FROM states),
train_fitted AS (
  SELECT * EXCLUDE ("Type"),
         {", ".join(f"CAST(list_contains(string_split(" + chr(34) + "Type" + chr(34) + f", ', '), '{f[5:]}') AS INTEGER) AS " + chr(34) + f + chr(34) for f in FLAGS)}
  FROM areas)"""


def baseline_sql(by: str = "State", name: str = "preds") -> str:
    return f"""{name} AS (
  SELECT listing_id, split, Median_Price AS actual, m.predicted
  FROM split JOIN (SELECT {by} AS k, avg(Median_Price) AS predicted FROM split WHERE split = 'train' GROUP BY {by}) m
  ON {by} = m.k)"""


REQUESTS_SQL = f"""{CLEAN_SQL},
requests AS (
  SELECT listing_id AS request_id, CASE WHEN Tenure = 'Leasehold' THEN Township ELSE Area END AS Area, State, Tenure,
         "Type", Median_Price / nullif(Median_PSF, 0) AS Estimated_Size, Transactions FROM tenured)"""

LOOKUP_SQL = """
lookup AS (
  SELECT State, Area, coalesce(quantile_cont(Transactions, 0.5), 16.0) AS Transactions,
         coalesce(sum(Transactions), 0) / (SELECT sum(Transactions) FROM listing) AS Area_Transaction_Density
  FROM listing WHERE State IS NOT NULL AND Area IS NOT NULL GROUP BY State, Area)"""


def on_listing(body: str) -> str:
    return f"WITH {LISTING_SQL} {body}"


def on_clean(body: str) -> str:
    return f"WITH {CLEAN_SQL} {body}"


def on_baseline(body: str, by: str = "State") -> str:
    return f"WITH {SPLIT_SQL}, {baseline_sql(by)} {body}"


CLEAN_COLUMNS_SQL = (
    "listing_id, Area, State, Tenure, Median_Price, Transactions, round(Estimated_Size, 6) AS Estimated_Size, "
    "round(Log_Estimated_Size, 8) AS Log_Estimated_Size, round(Area_Transaction_Density, 10) AS Area_Transaction_Density, "
    + ", ".join(f'"{f}"' for f in FLAGS)
)


def clean_output(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        S.ID, "Area", "State", "Tenure", S.TARGET, S.TX,
        F.round(S.SIZE, 6).alias(S.SIZE), F.round(S.LOG_SIZE, 8).alias(S.LOG_SIZE),
        F.round(S.DENSITY, 10).alias(S.DENSITY), *FLAGS, *more,
    )
