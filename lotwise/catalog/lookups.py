"""Lookups and joins of the scoring path, and the rules that fill requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.catalog.common import FLAGS, LOOKUP_SQL, REQUESTS_SQL, clean_table, on_listing, requests, rounded
from lotwise.fixtures import listings
from lotwise.operators import market as K
from lotwise.operators.cleaning import value_frequencies
from lotwise.plans import scoring as P
from lotwise.sources.staging import stage

EXPECTED = ["Area", "State", "Tenure", S.TX, S.LOG_SIZE, S.DENSITY, *FLAGS, "Distance"]


def _known(spark: SparkSession, sf: str) -> DataFrame:
    areas = clean_table(spark, sf).select(F.lit("Area").alias("column"), F.col("Area").alias("value"))
    return stage(areas.distinct())


def _lookup(spark: SparkSession, sf: str) -> DataFrame:
    return stage(K.lookup_table(listings(spark, sf)))


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    return P.category_fallback(requests(spark, sf), _known(spark, sf))


def _lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    # The lookup keeps raw spelling, so it is asked with raw States.
    raw = requests(spark, sf).withColumn("State", F.upper("State"))
    joined = P.lookup_join(raw, _lookup(spark, sf))
    return rounded(joined.select("request_id", "tx_filled", "density_filled"), 10)


def _fallback(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf).select("request_id", "Area", "area_used", "area_remapped", P.fallback_note().alias("note"))


def _reliability(spark: SparkSession, sf: str) -> DataFrame:
    counts = stage(value_frequencies(listings(spark, sf), "Area"))
    return P.area_reliability(requests(spark, sf), counts).select("request_id", "Area", "few_note")


def _known_unknown(spark: SparkSession, sf: str) -> DataFrame:
    seen, unseen = P.known_unknown_split(requests(spark, sf), _known(spark, sf))
    label = [("known", seen), ("unknown", unseen)]
    parts = [d.select("request_id", "Area", F.lit(name).alias("kind")) for name, d in label]
    return parts[0].unionByName(parts[1])


def _filled(spark: SparkSession, sf: str) -> DataFrame:
    return P.fill_features(_resolved(spark, sf), EXPECTED, _lookup(spark, sf), "area_used")


def _fill_features(spark: SparkSession, sf: str) -> DataFrame:
    filled = _filled(spark, sf).select(
        "request.request_id", *[f"`{c}`" for c in EXPECTED], F.array_join("fill_notes", " | ").alias("notes")
    )
    return rounded(filled, 8)


def _request_notes(spark: SparkSession, sf: str) -> DataFrame:
    resolved = _resolved(spark, sf).withColumn("_area_note", P.fallback_note())
    filled = P.fill_features(resolved, EXPECTED, _lookup(spark, sf), "area_used")
    notes = F.concat(F.array_compact(F.array("request._area_note")), "fill_notes")
    noted = P.request_notes(filled.withColumn("notes", notes), listings(spark, sf))
    return noted.select("request_id", F.array_join("notes", " | ").alias("notes"))


QUERIES = {
    "count_map_back": lambda spark, sf: K.count_map_back(listings(spark, sf), "Type").select(S.ID, "Type", "n"),
    "rare_membership": lambda spark, sf: K.rare_membership(listings(spark, sf), "Area", 8).select(S.ID, "Area", "is_rare"),
    "scalar_broadcast": lambda spark, sf: rounded(
        K.share_of_total(listings(spark, sf)).select(S.ID, S.TX, "share"), 10
    ),
    "group_transform_sum": lambda spark, sf: K.group_total(listings(spark, sf)).select(S.ID, "Area", "group_total"),
    "lookup_table": lambda spark, sf: rounded(K.lookup_table(listings(spark, sf)), 10),
    "lookup_join": _lookup_join,
    "category_fallback": _fallback,
    "area_reliability": _reliability,
    "known_unknown_split": _known_unknown,
    "fill_features": _fill_features,
    "request_notes": _request_notes,
}

_RESOLVED_SQL = """
known AS (SELECT DISTINCT Area AS v FROM clean),
resolved AS (
  SELECT *, CASE WHEN Area NOT IN (SELECT v FROM known) AND 'Other_' || State IN (SELECT v FROM known)
            THEN 'Other_' || State ELSE Area END AS area_used, Area NOT IN (SELECT v FROM known) AS area_remapped
  FROM requests)"""
_NOTE_SQL = (
    "CASE WHEN area_remapped THEN '''' || r.Area || ''' not in training data''s known areas, reverted to using ''' "
    "|| area_used || ''' (state-level estimate).' END"
)


def _missing_sql(column: str) -> str:
    return f"'Missing features ''{column}'', filled with 0 by default, but prediction may be less accurate.'"


_FILL_NOTES_SQL = (
    f"concat_ws(' | ', CASE WHEN r.Estimated_Size IS NULL THEN {_missing_sql(S.LOG_SIZE)} END, {_missing_sql('Distance')})"
)
_FILLED_SQL = f"""
answered AS (
  SELECT r.*, coalesce(r.Transactions, k.Transactions, 16.0) AS tx, coalesce(k.Area_Transaction_Density, 0.005) AS density,
         {_FILL_NOTES_SQL} AS fill_notes, {_NOTE_SQL} AS area_note
  FROM resolved r LEFT JOIN lookup k ON r.State = k.State AND r.area_used = k.Area)"""
_ON_REQUESTS = f"WITH {REQUESTS_SQL}, {LOOKUP_SQL}, {_RESOLVED_SQL}, {_FILLED_SQL}"

SQL = {
    "count_map_back": on_listing('SELECT listing_id, "Type", count(*) OVER (PARTITION BY "Type") AS n FROM listing'),
    "rare_membership": on_listing(
        "SELECT listing_id, Area, count(*) OVER (PARTITION BY Area) < 8 AS is_rare FROM listing"
    ),
    "scalar_broadcast": on_listing(
        "SELECT listing_id, Transactions, round(Transactions / (SELECT sum(Transactions) FROM listing), 10) AS share "
        "FROM listing"
    ),
    "group_transform_sum": on_listing(
        "SELECT listing_id, Area, coalesce(sum(Transactions) OVER (PARTITION BY Area), 0) AS group_total FROM listing"
    ),
    "lookup_table": on_listing(
        f", {LOOKUP_SQL} SELECT * REPLACE (round(Area_Transaction_Density, 10) AS Area_Transaction_Density) FROM lookup"
    ),
    "lookup_join": (
        f"WITH {REQUESTS_SQL}, {LOOKUP_SQL} SELECT request_id, coalesce(r.Transactions, k.Transactions, 16.0) AS tx_filled, "
        "round(coalesce(k.Area_Transaction_Density, 0.005), 10) AS density_filled FROM requests r "
        "LEFT JOIN lookup k ON upper(r.State) = k.State AND r.Area = k.Area"
    ),
    "category_fallback": f"{_ON_REQUESTS} SELECT request_id, Area, area_used, area_remapped, area_note AS note FROM answered",
    "area_reliability": (
        f"WITH {REQUESTS_SQL}, c AS (SELECT Area, count(*) AS n FROM listing GROUP BY Area) "
        "SELECT request_id, r.Area, CASE WHEN n < 5 THEN 'Note: Training data only has ' || n || ' records for ''' || r.Area "
        "|| ''', prediction stability may be compromised.' END AS few_note FROM requests r LEFT JOIN c ON r.Area = c.Area"
    ),
    "known_unknown_split": (
        f"{_ON_REQUESTS} SELECT request_id, Area, CASE WHEN area_remapped THEN 'unknown' ELSE 'known' END AS kind FROM resolved"
    ),
    "fill_features": (
        f"{_ON_REQUESTS} SELECT request_id, area_used AS Area, State, Tenure, tx AS Transactions, "
        "round(coalesce(ln(1 + Estimated_Size), 0), 8) AS Log_Estimated_Size, "
        "round(density, 8) AS Area_Transaction_Density, "
        + ", ".join(
            f"CAST(list_contains(string_split(\"Type\", ', '), '{f[5:]}') AS INTEGER) AS \"{f}\"" for f in FLAGS
        )
        + ", CAST(0 AS DOUBLE) AS Distance, fill_notes AS notes FROM answered"
    ),
    "request_notes": (
        f"{_ON_REQUESTS}, c AS (SELECT Area, count(*) AS n FROM listing GROUP BY Area) "
        "SELECT request_id, concat_ws(' | ', area_note, fill_notes, CASE WHEN n < 5 THEN 'Note: Training data only has ' || n "
        "|| ' records for ''' || r.Area || ''', prediction stability may be compromised.' END) AS notes "
        "FROM answered r LEFT JOIN c ON r.Area = c.Area"
    ),
}
