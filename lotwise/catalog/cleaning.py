"""Projections, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.catalog.common import (
    CLEAN_COLUMNS_SQL, FLAGS, TEXT_SQL, clean_output, clean_table, fences_sql, on_clean,
    on_listing, tenure_sql, text_sql,
)
from lotwise.fixtures import listings
from lotwise.operators import cleaning as C
from lotwise.operators import encoding as E
from lotwise.plans.preprocess import preprocess

FIXED_VOCABULARY = ["Economy", "Large", "Semi D", "Standard"]


def _over(operator, *columns: str):
    """The operator over all listings, then the named columns."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return operator(listings(spark, sf)).select(*columns)

    return query


def _many_rare(df: DataFrame) -> DataFrame:
    """States of the listings by Township make every value rare, so the bucket shows."""
    return df.withColumn("State", F.when(F.col("Tenure") == "Leasehold", F.col("Township")).otherwise(F.col("State")))


def _size(df: DataFrame) -> DataFrame:
    return C.size_feature(df).withColumns(
        {S.SIZE: F.round(S.SIZE, 6), S.LOG_SIZE: F.round(S.LOG_SIZE, 8)}
    )


def _density(df: DataFrame) -> DataFrame:
    return C.area_density(df).withColumn(S.DENSITY, F.round(S.DENSITY, 10))


def _select_features(spark: SparkSession, sf: str) -> DataFrame:
    picked = E.select_features(clean_table(spark, sf), ["Area", "State", "Tenure"], [S.TX, S.LOG_SIZE, S.DENSITY])
    return picked.withColumns({S.LOG_SIZE: F.round(S.LOG_SIZE, 8), S.DENSITY: F.round(S.DENSITY, 10)})


def _hot_sql(vocabulary: list[str], column: str = "t") -> str:
    return ", ".join(
        f"CAST(list_contains(string_split({column}, ', '), '{v}') AS INTEGER) AS \"Type_{v}\"" for v in vocabulary
    )


_UPPER_TYPES = [f[5:].upper() for f in FLAGS]
_WIDE = r"""regexp_replace(replace("Type", ', ', ' ,  '), '\s*,\s*', ', ', 'g')"""

QUERIES = {
    "drop_null_target": _over(C.drop_null_target, S.ID, S.TARGET, S.TX),
    "impute_median": _over(lambda d: C.impute_median(C.drop_null_target(d)), S.ID, S.TX),
    "iqr_filter": _over(lambda d: C.iqr_filter(d, S.TARGET), S.ID, S.TARGET),
    "iqr_filter_chain": _over(C.iqr_filter_chain, S.ID, S.TARGET, S.TX),
    "standardize_text": _over(C.standardize_text, S.ID, *S.TEXT_COLUMNS),
    "drop_identifier": lambda spark, sf: C.drop_identifier(listings(spark, sf)),
    "canonicalize_tenure": _over(lambda d: C.canonicalize_tenure(C.standardize_text(d, ["Tenure"])), S.ID, "Tenure"),
    "bucket_rare_state": _over(lambda d: C.bucket_rare_state(_many_rare(d)), S.ID, "State"),
    "bucket_rare_area": _over(C.bucket_rare_area, S.ID, "Area", "State"),
    "bucket_rare_type": _over(lambda d: C.bucket_rare_type(d, 200), S.ID, "Type", "Type_Plot"),
    "size_feature": _over(_size, S.ID, S.TARGET, S.SIZE, S.LOG_SIZE),
    "area_density": _over(_density, S.ID, "Area", S.DENSITY),
    "normalize_separator": _over(
        lambda d: E.normalize_separator(d.withColumn("Type", F.replace("Type", F.lit(", "), F.lit(" ,  ")))), S.ID, "Type"
    ),
    "multi_hot": _over(E.multi_hot, S.ID, *[f"Type_{t}" for t in _UPPER_TYPES]),
    "multi_hot_fixed": _over(
        lambda d: E.multi_hot_fixed(C.standardize_text(d, ["Type"]), vocabulary=FIXED_VOCABULARY),
        S.ID, *[f"`Type_{v}`" for v in FIXED_VOCABULARY],
    ),
    "select_features": _select_features,
    "filter_state": _over(lambda d: C.filter_state(d, "NATION_3"), S.ID, "State", "Area"),
    "preprocess": lambda spark, sf: clean_output(preprocess(listings(spark, sf))),
}

_PRICED = ", p AS (SELECT * FROM listing WHERE Median_Price IS NOT NULL)"
_RARE = ", l AS (SELECT * REPLACE (CASE WHEN Tenure = 'Leasehold' THEN Township ELSE State END AS State) FROM listing)"

SQL = {
    "drop_null_target": on_listing(
        "SELECT listing_id, Median_Price, Transactions FROM listing WHERE Median_Price IS NOT NULL"
    ),
    "impute_median": on_listing(
        f"{_PRICED} SELECT listing_id, coalesce(Transactions, (SELECT quantile_cont(Transactions, 0.5) FROM p)) "
        "AS Transactions FROM p"
    ),
    "iqr_filter": on_listing(
        f"SELECT listing_id, Median_Price FROM listing WHERE {fences_sql('listing', 'Median_Price')}"
    ),
    "iqr_filter_chain": on_listing(
        f", c AS (SELECT * FROM listing WHERE {fences_sql('listing', 'Median_Price')}) "
        f"SELECT listing_id, Median_Price, Transactions FROM c WHERE {fences_sql('c', 'Transactions')}"
    ),
    "standardize_text": on_listing(f', {TEXT_SQL} SELECT listing_id, Area, State, Tenure, "Type" FROM texts'),
    "drop_identifier": on_listing("SELECT * EXCLUDE (Township) FROM listing"),
    "canonicalize_tenure": on_listing(
        f", t AS (SELECT listing_id, {text_sql('Tenure')} AS t FROM listing) "
        f"SELECT listing_id, {tenure_sql('t')} AS Tenure FROM t"
    ),
    "bucket_rare_state": on_listing(
        f"{_RARE} SELECT listing_id, CASE WHEN count(*) OVER (PARTITION BY State) < 2 THEN 'Other_State' ELSE State END "
        "AS State FROM l"
    ),
    "bucket_rare_area": on_listing(
        "SELECT listing_id, CASE WHEN count(*) OVER (PARTITION BY Area) < 5 THEN 'Other_' || State ELSE Area END AS Area, "
        "State FROM listing"
    ),
    "bucket_rare_type": on_listing(
        'SELECT listing_id, "Type", CASE WHEN "Type" IS NULL OR count(*) OVER (PARTITION BY "Type") < 200 THEN \'Others\' '
        'ELSE "Type" END AS Type_Plot FROM listing'
    ),
    "size_feature": on_listing(
        "SELECT listing_id, Median_Price, round(Median_Price / nullif(Median_PSF, 0), 6) AS Estimated_Size, "
        "round(ln(1 + Median_Price / nullif(Median_PSF, 0)), 8) AS Log_Estimated_Size FROM listing"
    ),
    "area_density": on_listing(
        "SELECT listing_id, Area, round(coalesce(sum(Transactions) OVER (PARTITION BY Area), 0) / "
        "(SELECT sum(Transactions) FROM listing), 10) AS Area_Transaction_Density FROM listing"
    ),
    "normalize_separator": on_listing(f'SELECT listing_id, {_WIDE} AS "Type" FROM listing'),
    "multi_hot": on_listing(
        f'SELECT listing_id, {_hot_sql(_UPPER_TYPES, chr(34) + "Type" + chr(34))} FROM listing'
    ),
    "multi_hot_fixed": on_listing(
        f", t AS (SELECT listing_id, {text_sql(chr(34) + 'Type' + chr(34))} AS t FROM listing) "
        f"SELECT listing_id, {_hot_sql(FIXED_VOCABULARY)} FROM t"
    ),
    "select_features": on_clean(
        "SELECT listing_id, Area, State, Tenure, Transactions, round(Log_Estimated_Size, 8) AS Log_Estimated_Size, "
        f"round(Area_Transaction_Density, 10) AS Area_Transaction_Density, {', '.join(FLAGS)}, Median_Price FROM clean"
    ),
    "filter_state": on_listing("SELECT listing_id, State, Area FROM listing WHERE State = 'NATION_3'"),
    "preprocess": on_clean(f"SELECT {CLEAN_COLUMNS_SQL} FROM clean"),
}
