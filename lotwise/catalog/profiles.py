"""Counts, nulls, duplicates, moments and frequent values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise import schema as S
from lotwise.catalog.common import FLAGS, clean_table, on_clean, on_listing, rounded
from lotwise.fixtures import listings
from lotwise.operators import market as K
from lotwise.operators import profile as P

TEXTS = ["Township", "Area", "State", "Tenure", "Type"]
NUMBERS = [S.TARGET, S.PSF, S.TX]


def _with_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the listings, and those with an even key once more, so that there is something to find."""
    rows = listings(spark, sf)
    return rows.unionByName(rows.where(f"{S.ID} % 2 = 0"))


def _describe(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.describe_all(listings(spark, sf)), 4)


QUERIES = {
    "duplicate_count": lambda spark, sf: P.duplicate_count(_with_repeats(spark, sf)),
    "profile_summary": lambda spark, sf: P.profile_summary(_with_repeats(spark, sf)),
    "nunique": lambda spark, sf: P.nunique(listings(spark, sf)),
    "null_counts": lambda spark, sf: P.null_counts(listings(spark, sf)),
    "null_counts_positive": lambda spark, sf: P.null_counts(listings(spark, sf), only_positive=True),
    "describe_all": _describe,
    "value_counts": lambda spark, sf: P.value_counts(listings(spark, sf), "Area"),
    "top_k_values": lambda spark, sf: P.top_k_values(listings(spark, sf)),
    "skew_report": lambda spark, sf: rounded(P.skew_report(listings(spark, sf))),
    "iqr_outlier_count": lambda spark, sf: rounded(P.iqr_outlier_count(listings(spark, sf))),
    "fd_check": lambda spark, sf: P.fd_check(listings(spark, sf)),
    "group_size_profile": lambda spark, sf: rounded(P.group_size_profile(listings(spark, sf))),
    "rare_category_pct": lambda spark, sf: rounded(P.rare_category_pct(listings(spark, sf))),
    "group_median_topk": lambda spark, sf: rounded(K.group_median_topk(clean_table(spark, sf)), 4),
    "sort_topk": lambda spark, sf: K.top_k(listings(spark, sf).where(f"{S.TARGET} IS NOT NULL"), S.TARGET, S.ID, 15).select(
        S.ID, S.TARGET
    ),
    "market_benchmark": lambda spark, sf: rounded(
        K.market_benchmark(listings(spark, sf), "NATION_7", "ECONOMY, LARGE", 250000.0), 4
    ),
    "type_volume_topk": lambda spark, sf: K.type_volume_topk(clean_table(spark, sf)),
    "top_types_filter": lambda spark, sf: K.top_types_filter(clean_table(spark, sf), 4),
}

_UNPIVOT = " UNION ALL ".join


def _each(template: str, columns: list[str]) -> str:
    return _UNPIVOT(template.format(c=f'"{c}"', name=c) for c in columns)


_EVERY = TEXTS + NUMBERS


def _describe_sql() -> str:
    rows = []
    for stat in P.DESCRIBE_STATS:
        cells = []
        for c in TEXTS:
            q = f'"{c}"'
            top = f"(SELECT {q} FROM listing WHERE {q} IS NOT NULL GROUP BY {q} ORDER BY count(*) DESC, {q} LIMIT 1)"
            cells.append(
                {
                    "count": f"CAST(count({q}) AS VARCHAR)",
                    "unique": f"CAST(count(DISTINCT {q}) AS VARCHAR)",
                    "top": top,
                    "freq": f"(SELECT CAST(count(*) AS VARCHAR) FROM listing WHERE {q} = {top})",
                }.get(stat, "CAST(NULL AS VARCHAR)")
                + f" AS {q}"
            )
        for c in NUMBERS:
            cells.append(
                {
                    "count": f"CAST(count({c}) AS DOUBLE)",
                    "mean": f"round(avg({c}), 4)",
                    "std": f"round(stddev_samp({c}), 4)",
                    "min": f"round(min({c}), 4)",
                    "25%": f"round(quantile_cont({c}, 0.25), 4)",
                    "50%": f"round(quantile_cont({c}, 0.5), 4)",
                    "75%": f"round(quantile_cont({c}, 0.75), 4)",
                    "max": f"round(max({c}), 4)",
                }.get(stat, "CAST(NULL AS DOUBLE)")
                + f" AS {c}"
            )
        source = "" if stat in ("top", "freq") else " FROM listing"
        rows.append(f"SELECT '{stat}' AS stat, {', '.join(cells)}{source}")
    return on_listing(_UNPIVOT(rows))


_DISTINCT_ROWS = (
    ", twice AS (SELECT * FROM listing UNION ALL SELECT * FROM listing WHERE listing_id % 2 = 0), "
    f"g AS (SELECT {', '.join(chr(34) + c + chr(34) for c in _EVERY)}, count(*) AS n FROM twice GROUP BY ALL)"
)
_MISSING = " + ".join(f'CAST("{c}" IS NULL AS INT)' for c in _EVERY)

def _outliers_sql() -> str:
    rows = []
    for c in NUMBERS:
        q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
        fence = f"(SELECT {q1} - 1.5 * ({q3} - {q1}) AS lo, {q3} + 1.5 * ({q3} - {q1}) AS hi FROM listing)"
        outside = f"count(*) FILTER (WHERE {c} < lo OR {c} > hi)"
        rows.append(
            f"SELECT '{c}' AS \"column\", {outside} AS outliers, round({outside} * 100.0 / count(*), 6) AS pct "
            f"FROM listing, {fence}"
        )
    return on_listing(_UNPIVOT(rows))


_TYPES_SQL = "SELECT listing_id, Median_Price, k AS \"Type\" FROM (" + _UNPIVOT(
    f"SELECT listing_id, Median_Price, '{f[5:]}' AS k FROM clean WHERE \"{f}\" = 1" for f in FLAGS
) + ")"

SQL = {
    "duplicate_count": on_listing(f"{_DISTINCT_ROWS} SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM g"),
    "profile_summary": on_listing(
        f"{_DISTINCT_ROWS} SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(8 AS BIGINT) AS n_columns, "
        f"CAST(sum(n - 1) AS BIGINT) AS duplicates, CAST(sum(n * ({_MISSING})) AS BIGINT) AS nulls FROM g"
    ),
    "nunique": on_listing(_each("SELECT '{name}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM listing", _EVERY)),
    "null_counts": on_listing(
        _each("SELECT '{name}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM listing", _EVERY)
    ),
    "null_counts_positive": on_listing(
        "SELECT * FROM ("
        + _each("SELECT '{name}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM listing", _EVERY)
        + ") WHERE nulls > 0"
    ),
    "describe_all": _describe_sql(),
    "value_counts": on_listing("SELECT Area, count(*) AS n FROM listing GROUP BY Area"),
    "top_k_values": on_listing(
        _each(
            "SELECT * FROM (SELECT '{name}' AS \"column\", {c} AS value, count(*) AS n, "
            "CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER) AS rank FROM listing GROUP BY {c}) WHERE rank <= 15",
            TEXTS,
        )
    ),
    "skew_report": on_listing(
        _each(
            "SELECT '{name}' AS \"column\", round(skewness({c}), 6) AS skew_raw, round(skewness(ln(1 + {c})), 6) AS skew_log1p "
            "FROM listing",
            NUMBERS,
        )
    ),
    "iqr_outlier_count": _outliers_sql(),
    "fd_check": on_listing(
        "SELECT max(n) AS max_dependents, max(n) = 1 AS holds FROM "
        "(SELECT Area, count(DISTINCT State) AS n FROM listing GROUP BY Area)"
    ),
    "group_size_profile": on_listing(
        ", s AS (SELECT Area, count(*) AS n FROM listing GROUP BY Area) SELECT count(*) AS n_groups, round(avg(n), 6) AS mean, "
        "round(stddev_samp(n), 6) AS std, CAST(min(n) AS DOUBLE) AS min, quantile_cont(n, 0.25) AS q1, "
        "quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS q3, CAST(max(n) AS DOUBLE) AS max, "
        "count(*) FILTER (WHERE n < 5) AS n_small, round(count(*) FILTER (WHERE n < 5) * 100.0 / count(*), 6) AS pct_small FROM s"
    ),
    "rare_category_pct": on_listing(
        "SELECT * FROM ("
        + _each(
            "SELECT '{name}' AS \"column\", count(*) AS n_unique, round(count(*) FILTER (WHERE n < 5) * 100.0 / count(*), 6) "
            "AS rare_pct FROM (SELECT {c}, count(*) AS n FROM listing GROUP BY {c})",
            TEXTS,
        )
        + ") WHERE n_unique > 50"
    ),
    "group_median_topk": on_clean(
        "SELECT State, round(quantile_cont(Median_Price, 0.5), 4) AS median FROM clean GROUP BY State "
        "ORDER BY quantile_cont(Median_Price, 0.5) DESC, State LIMIT 10"
    ),
    "sort_topk": on_listing(
        "SELECT listing_id, Median_Price FROM listing WHERE Median_Price IS NOT NULL ORDER BY Median_Price DESC, listing_id LIMIT 15"
    ),
    "market_benchmark": on_listing(
        'SELECT "Type", round(quantile_cont(Median_Price, 0.5), 4) AS median, CASE WHEN "Type" = \'ECONOMY, LARGE\' '
        "THEN CAST(250000 AS DOUBLE) END AS predicted FROM listing WHERE State = 'NATION_7' GROUP BY \"Type\" "
        "HAVING count(Median_Price) > 0"
    ),
    "type_volume_topk": on_clean(
        'SELECT k AS "Type", sum(Transactions * CASE k '
        + " ".join(f"WHEN '{f[5:]}' THEN \"{f}\"" for f in FLAGS)
        + f" END) AS volume FROM clean, (VALUES {', '.join(f'({chr(39)}{f[5:]}{chr(39)})' for f in FLAGS)}) t(k) "
        'GROUP BY k ORDER BY volume DESC, "Type" LIMIT 8'
    ),
    "top_types_filter": on_clean(
        f', long AS ({_TYPES_SQL}), top AS (SELECT "Type", count(*) AS n FROM long GROUP BY "Type" '
        'ORDER BY n DESC, "Type" LIMIT 4) SELECT long.* FROM long WHERE "Type" IN (SELECT "Type" FROM top)'
    ),
}
