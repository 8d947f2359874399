"""Nested entity columns to flat rows. ``id`` is carried through; NULL and empty maps give one row with NULL keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_records(df: DataFrame, column: str) -> DataFrame:
    """One row for each value of a map of records: id and the record's fields."""
    return df.select("id", F.explode_outer(column).alias("_key", "_value")).select("id", "_value.*")


def map_lists(df: DataFrame, column: str) -> DataFrame:
    """One row for each record of each list of a map of lists."""
    lists = df.select("id", F.explode_outer(column).alias("_key", "_list"))
    return lists.select("id", F.explode_outer("_list").alias("_value")).select("id", "_value.*")


def statements(df: DataFrame, column: str = "claims") -> DataFrame:
    """One row for each statement of each property: id, the main snak's fields and the statement's others."""
    lists = df.select("id", F.explode_outer(column).alias("_key", "_list"))
    rows = lists.select("id", F.explode_outer("_list").alias("_s")).select("id", "_s.*")
    rest = [c for c in rows.columns if c not in ("id", "mainsnak")]
    return rows.select("id", "mainsnak.*", *rest)


def flatten(df: DataFrame, table: str) -> DataFrame:
    """The flat frame of a processed table, rows with a NULL nested column left out."""
    from .claims import match_languages

    column = "sitelinks" if table == "links" else table
    known = df.na.drop("any", subset=[column])
    if table == "claims":
        return match_languages(statements(known))
    return map_lists(known, column) if table == "aliases" else map_records(known, column)


def quarantine(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a usable partition key, rows whose key is NULL or empty)."""
    usable = F.coalesce(F.length(key) > 0, F.lit(False))
    return df.where(usable), df.where(~usable)
