"""Named queries over the given tables, with the SQL that must give the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lotwise.catalog import associations, charts, cleaning, evaluation, learning, lookups, profiles, tables

Query = Callable[[SparkSession, str], DataFrame]
_TOPICS = (tables, cleaning, lookups, profiles, associations, charts, learning, evaluation)


def all_queries() -> dict[str, Query]:
    return {name: query for topic in _TOPICS for name, query in topic.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: text for topic in _TOPICS for name, text in topic.SQL.items()}
