"""Language-matched unnesting of claims.

Which languages of a statement's property labels yield a row depends on its datatype: items and properties need the
value's label in that language, quantities with named units the unit's, texts are in one language, scalars take all.
``match_languages`` does this in one pass over the statements, without a join; the others are the rules one by one,
and other formulations of the first rule that must agree with it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schemas import ITEM_TYPES, KNOWN_TYPES, QUANTITY_TYPE, SCALAR_TYPES, TEXT_TYPE

LABELS = "`property-labels`"
VALUE_LABELS, UNIT_LABELS = "datavalue.labels", "datavalue.`unit-labels`"


def _columns(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns if c != "property-labels"]


def has_units() -> Column:
    return F.coalesce(F.size(F.col(UNIT_LABELS)) > 0, F.lit(False))


def match_languages(statements: DataFrame) -> DataFrame:
    """All rules at once: one scan, no exchange. Statements of unknown datatypes are left out.

    The languages that may stay are computed before the labels are exploded; NULL means any.
    """
    kind = F.col("datatype")
    none = F.array().cast("array<string>")
    allowed = (
        F.when(kind.isin(*ITEM_TYPES), F.coalesce(F.map_keys(VALUE_LABELS), none))
        .when((kind == QUANTITY_TYPE) & has_units(), F.map_keys(UNIT_LABELS))
        .when(kind == TEXT_TYPE, F.array("datavalue.language"))
    )
    known = statements.where(kind.isin(*KNOWN_TYPES)).withColumn("_allowed", allowed)
    rows = known.select(*_columns(statements), "_allowed", F.explode_outer(LABELS).alias("language", "property_label"))
    rows = rows.where("_allowed is null or array_contains(_allowed, language)")
    value_label = F.when(kind.isin(*ITEM_TYPES), F.try_element_at(VALUE_LABELS, F.col("language")))
    unit_label = F.when((kind == QUANTITY_TYPE) & has_units(), F.try_element_at(UNIT_LABELS, F.col("language")))
    return rows.select(*_columns(statements), "language", "property_label", value_label.alias("datavalue_label"), unit_label.alias("unit_label"))


def _matched(df: DataFrame, labels: str, name: str) -> DataFrame:
    """Labels of the property whose language is among others: both maps are walked in the row, so nothing is shuffled."""
    rows = df.select(*_columns(df), F.explode(LABELS).alias("language", "property_label"))
    found = F.filter(F.map_entries(labels), lambda e: e["key"] == F.col("language"))
    hits = rows.select("*", F.explode(found).alias("_hit"))
    return hits.select(*_columns(rows), F.col("_hit.value").alias(name))


def items(statements: DataFrame) -> DataFrame:
    return _matched(statements.where(F.col("datatype").isin(*ITEM_TYPES)), VALUE_LABELS, "datavalue_label")


def items_by_cartesian(statements: DataFrame) -> DataFrame:
    """The same by crossing both label maps and filtering: the form to measure the others against."""
    df = statements.where(F.col("datatype").isin(*ITEM_TYPES))
    rows = df.select(*_columns(df), F.explode(LABELS).alias("language", "property_label"))
    pairs = rows.select("*", F.explode(VALUE_LABELS).alias("_language", "datavalue_label"))
    return pairs.where("language = _language").drop("_language")


def items_by_lookup(statements: DataFrame) -> DataFrame:
    """The same by one look-up a language, kept where the map has the key (its value may be NULL)."""
    df = statements.where(F.col("datatype").isin(*ITEM_TYPES))
    rows = df.select(*_columns(df), F.explode(LABELS).alias("language", "property_label"))
    return rows.where(F.map_contains_key(VALUE_LABELS, F.col("language"))).withColumn("datavalue_label", F.try_element_at(VALUE_LABELS, F.col("language")))


def items_by_join(statements: DataFrame, key: str = "id") -> DataFrame:
    """The same by an equi-join of the exploded maps; ``key`` must identify a statement. Shuffles both sides."""
    df = statements.where(F.col("datatype").isin(*ITEM_TYPES))
    rows = df.select(*_columns(df), F.explode(LABELS).alias("language", "property_label"))
    labels = df.select(F.col(key).alias("_key"), F.explode(VALUE_LABELS).alias("_language", "datavalue_label"))
    return rows.join(labels, (rows[key] == labels["_key"]) & (rows["language"] == labels["_language"])).drop("_key", "_language")


def quantities(statements: DataFrame) -> DataFrame:
    """With named units the unit's languages, without (absent, empty or NULL) all of the property's."""
    df = statements.where(F.col("datatype") == QUANTITY_TYPE)
    named = _matched(df.where(has_units()), UNIT_LABELS, "unit_label")
    return named.unionByName(_all(df.where(~has_units())), allowMissingColumns=True)


def _all(df: DataFrame) -> DataFrame:
    return df.select(*_columns(df), F.explode_outer(LABELS).alias("language", "property_label"))


def scalars(statements: DataFrame) -> DataFrame:
    return _all(statements.where(F.col("datatype").isin(*SCALAR_TYPES)))


def texts(statements: DataFrame) -> DataFrame:
    """The property's label in the text's own language; texts without one are left out."""
    df = statements.where(F.col("datatype") == TEXT_TYPE)
    found = F.filter(F.map_entries(LABELS), lambda e: e["key"] == F.col("datavalue.language"))
    return df.select(*_columns(df), F.explode(found).alias("_hit")).select(*_columns(df), F.col("_hit.key").alias("language"), F.col("_hit.value").alias("property_label"))


def match_by_union(statements: DataFrame) -> DataFrame:
    """The four rules united by name, missing columns NULL: the oracle of ``match_languages``."""
    parts = [items(statements), quantities(statements), scalars(statements), texts(statements)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def unknown_datatypes(statements: DataFrame) -> DataFrame:
    """How many statements no rule takes, by datatype."""
    return statements.where(~F.coalesce(F.col("datatype").isin(*KNOWN_TYPES), F.lit(False))).groupBy("datatype").count()


def lost_languages(statements: DataFrame) -> DataFrame:
    """Languages of the property's labels that the value's labels lack."""
    df = statements.where(F.col("datatype").isin(*ITEM_TYPES))
    return df.select("id", F.array_except(F.map_keys(LABELS), F.map_keys(VALUE_LABELS)).alias("lost"))
