"""Correlation and association of column pairs."""

from __future__ import annotations

from itertools import combinations

from lotwise import schema as S
from lotwise.catalog.common import on_listing, rounded
from lotwise.fixtures import listings
from lotwise.operators import association as A

TEXTS = ["Area", "State", "Tenure", "Type"]
NUMBERS = [S.TARGET, S.PSF, S.TX]
TEXT_PAIRS = list(combinations(TEXTS, 2))
MIXED_PAIRS = [(t, n) for t in TEXTS for n in NUMBERS]

QUERIES = {
    "pearson_pair": lambda spark, sf: rounded(A.pearson_pair(listings(spark, sf), S.TARGET, S.PSF), 8),
    "corr_matrix": lambda spark, sf: rounded(A.corr_matrix(listings(spark, sf)), 8),
    "contingency": lambda spark, sf: A.contingency(listings(spark, sf), "Area", "Type"),
    "cramers_v": lambda spark, sf: rounded(A.cramers_v(listings(spark, sf), TEXT_PAIRS), 8),
    "correlation_ratio": lambda spark, sf: rounded(A.correlation_ratio(listings(spark, sf), MIXED_PAIRS), 8),
    "association_matrix": lambda spark, sf: rounded(A.association_matrix(listings(spark, sf)), 8),
}


def _cramers_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS col_i, '{b}' AS col_j, round(CASE WHEN least(kc, rc) > 1 THEN
      sqrt(greatest(0, phi2 - (k - 1) * (r - 1) / (n - 1)) / (least(kc, rc) - 1)) END, 8) AS value
    FROM (SELECT *, r - (r - 1) * (r - 1) / (n - 1) AS rc, k - (k - 1) * (k - 1) / (n - 1) AS kc FROM (
      SELECT sum(x * x / (xa * xb)) - 1 AS phi2, sum(x) AS n, CAST(count(DISTINCT a) AS DOUBLE) AS r,
             CAST(count(DISTINCT b) AS DOUBLE) AS k
      FROM (SELECT a, b, x, sum(x) OVER (PARTITION BY a) AS xa, sum(x) OVER (PARTITION BY b) AS xb
            FROM (SELECT "{a}" AS a, "{b}" AS b, CAST(count(*) AS DOUBLE) AS x FROM listing
                  WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL GROUP BY 1, 2))))"""


def _ratio_sql(c: str, v: str) -> str:
    return f"""SELECT '{c}' AS col_i, '{v}' AS col_j, round(sqrt(sum((m - g) ** 2) / nullif(sum((x - g) ** 2), 0)), 8) AS value
    FROM (SELECT {v} AS x, avg({v}) OVER (PARTITION BY "{c}") AS m, avg({v}) OVER () AS g FROM listing
          WHERE "{c}" IS NOT NULL AND {v} IS NOT NULL)"""


def _pearson_sql(a: str, b: str) -> str:
    return f"SELECT '{a}' AS col_i, '{b}' AS col_j, round(corr({a}, {b}), 8) AS value FROM listing"


_UNION = " UNION ALL ".join
_UPPER = _UNION(
    [f"SELECT *, 'cramers_v' AS measure FROM ({_cramers_sql(a, b)})" for a, b in TEXT_PAIRS]
    + [f"SELECT *, 'correlation_ratio' AS measure FROM ({_ratio_sql(c, v)})" for c, v in MIXED_PAIRS]
    + [f"SELECT *, 'pearson' AS measure FROM ({_pearson_sql(a, b)})" for a, b in combinations(NUMBERS, 2)]
)
_DIAGONAL = _UNION(
    f"SELECT '{c}' AS col_i, '{c}' AS col_j, 'identity' AS measure, CAST(1 AS DOUBLE) AS value" for c in TEXTS + NUMBERS
)

SQL = {
    "pearson_pair": on_listing("SELECT round(corr(Median_Price, Median_PSF), 8) AS r FROM listing"),
    "corr_matrix": on_listing(
        "SELECT col_i, col_j, value AS r FROM ("
        + _UNION(_pearson_sql(a, b) for a in NUMBERS for b in NUMBERS)
        + ")"
    ),
    "contingency": on_listing(
        'SELECT Area, "Type", count(*) AS n FROM listing WHERE Area IS NOT NULL AND "Type" IS NOT NULL GROUP BY 1, 2'
    ),
    "cramers_v": on_listing(_UNION(_cramers_sql(a, b) for a, b in TEXT_PAIRS)),
    "correlation_ratio": on_listing(_UNION(_ratio_sql(c, v) for c, v in MIXED_PAIRS)),
    "association_matrix": on_listing(
        f", u AS ({_UPPER}) SELECT col_i, col_j, measure, value FROM u UNION ALL "
        f"SELECT col_j AS col_i, col_i AS col_j, measure, value FROM u UNION ALL {_DIAGONAL}"
    ),
}
