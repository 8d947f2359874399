"""JSON columns to typed columns: declared schemas, and promotion of union-typed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schemas import PARSED_CLAIMS, SITES, TERM_LISTS, TERMS


def last_wins(found: Column) -> Column:
    """The map with the last value of each key: a decoded object that repeats a key keeps every entry.

    The map is bound once by the outer lambda; only maps that do repeat a key are rebuilt.
    """

    def rebuilt(m: Column) -> Column:
        keys = F.array_distinct(F.map_keys(m))
        value = lambda k: F.element_at(F.filter(F.map_entries(m), lambda e: e["key"] == k), -1)["value"]
        return F.when(F.size(keys) == F.size(m), m).otherwise(F.map_from_arrays(keys, F.transform(keys, value)))

    return F.get(F.transform(F.array(found), rebuilt), F.lit(0))


def terms(column: str | Column) -> Column:
    """Labels or descriptions: language -> {language, value}. Malformed, ``null`` and ``[]`` give NULL."""
    return last_wins(F.from_json(column, TERMS))


def term_lists(column: str | Column) -> Column:
    """Aliases: language -> list of {language, value}."""
    return last_wins(F.from_json(column, TERM_LISTS))


def sites(column: str | Column) -> Column:
    """Site links: site -> {site, title}; further fields are dropped."""
    return last_wins(F.from_json(column, SITES))


def _number(value: Column, path: str, integer: str, number: str) -> Column:
    """{integer, number} of a value that is one or the other, told by its type and never by whether a cast succeeds."""
    part = F.try_variant_get(value, f"$.{path}", "variant")
    kind = F.schema_of_variant(part)
    whole = F.when(kind == "BIGINT", F.try_variant_get(part, "$", "bigint"))
    broken = F.when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), F.try_variant_get(part, "$", "double"))
    fields = {integer: whole, number: broken}
    order = (integer, number) if path == "precision" else (number, integer)
    return F.when(part.isNotNull(), F.struct(*(fields[name].alias(name) for name in order)))


def promote(value: Column) -> Column:
    """The declared record of a datavalue that is a bare string or an object."""
    kind = F.schema_of_variant(value)
    text = lambda name: F.try_variant_get(value, f"$['{name}']", "string").alias(name)
    whole = lambda name: F.try_variant_get(value, f"$.{name}", "bigint").alias(name)
    names = lambda name: F.try_variant_get(value, f"$['{name}']", "map<string,string>").alias(name)
    record = F.struct(
        text("id"),
        names("labels"),
        F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).alias("datavalue__string"),
        _number(value, "precision", "precision__integer", "precision__number").alias("precision"),
        *(text(n) for n in ("text", "language", "amount", "unit")),
        names("unit-labels"),
        *(text(n) for n in ("upperBound", "lowerBound", "time")),
        *(whole(n) for n in ("timezone", "before", "after")),
        text("calendarmodel"),
        _number(value, "latitude", "latitude__integer", "latitude__number").alias("latitude"),
        _number(value, "longitude", "longitude__integer", "longitude__number").alias("longitude"),
        F.lit(None).cast("string").alias("altitude"),
        text("globe"),
    )
    return F.when(value.isNotNull() & (kind != "VOID"), record)


def _snak(value: Column) -> Column:
    return F.struct(value["property"].alias("property"), promote(value["datavalue"]).alias("datavalue"), value["datatype"].alias("datatype"), value["property-labels"].alias("property-labels"))


def _snaks(value: Column) -> Column:
    return F.transform_values(value, lambda _, found: F.transform(found, _snak))


def claims(column: str | Column, nested: bool = True) -> Column:
    """Claims by property. ``nested``: whether the snaks of qualifiers and references are kept (and promoted) too."""

    def statement(value: Column) -> Column:
        parts = [_snak(value["mainsnak"]).alias("mainsnak"), value["rank"].alias("rank")]
        if nested:
            parts += [F.transform(value["references"], _snaks).alias("references"), _snaks(value["qualifiers"]).alias("qualifiers")]
        return F.struct(*parts)

    return F.transform_values(F.from_json(column, PARSED_CLAIMS), lambda _, found: F.transform(found, statement))


def plain_value(datavalue: str, datatype: str) -> Column:
    """One readable value of a datavalue: an entity's id, an amount, a time, a text or the bare string."""
    d = lambda name: F.col(f"{datavalue}.{name}")
    return F.when(F.col(datatype) == "quantity", d("amount")).when(F.col(datatype) == "time", d("time")).otherwise(F.coalesce(d("id"), d("text"), d("datavalue__string")))


def processed(entities: DataFrame, table: str) -> DataFrame:
    """(id, nested column) of one table, decoded from entity records."""
    decode = {"labels": terms, "descriptions": terms, "aliases": term_lists, "sitelinks": sites, "claims": claims}
    return entities.select("id", decode[table](table).alias(table))
