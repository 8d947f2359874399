"""Observed against declared schemas: subsets pass, anything else stops the run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaDriftError(RuntimeError):
    """Records hold a field or a type that the declared schema has no place for."""


def same_schema(a: T.DataType, b: T.DataType) -> bool:
    """Equality of shapes, whatever the order of fields."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        x, y = ({f.name: f.dataType for f in s.fields} for s in (a, b))
        return x.keys() == y.keys() and all(same_schema(x[n], y[n]) for n in x)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return same_schema(a.elementType, b.elementType)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return same_schema(a.keyType, b.keyType) and same_schema(a.valueType, b.valueType)
    return type(a) is type(b)


def _parse(text: str, at: int = 0) -> tuple[object, int]:
    """The tree of a variant schema: a name, ("ARRAY", tree) or ("OBJECT", {field: tree})."""
    if text.startswith("ARRAY<", at):
        inner, at = _parse(text, at + 6)
        return ("ARRAY", inner), at + 1
    if text.startswith("OBJECT<", at):
        fields, at = {}, at + 7
        while text[at] != ">":
            if text[at] == "`":
                end = at + 1
                while text[end] != "`" or text[end : end + 2] == "``":
                    end += 2 if text[end : end + 2] == "``" else 1
                name, at = text[at + 1 : end].replace("``", "`"), end + 1
            else:
                end = text.index(":", at)
                name, at = text[at:end], end
            at = at + 1 + (text[at + 1] == " ")
            fields[name], at = _parse(text, at)
            while text[at] in ", ":
                at += 1
        return ("OBJECT", fields), at + 1
    end = at
    depth = 0
    while end < len(text) and (depth or text[end] not in ",>"):
        depth += (text[end] == "(") - (text[end] == ")")
        end += 1
    return text[at:end], end


FITS = {
    T.StringType: ("STRING",),
    T.LongType: ("BIGINT",),
    T.DoubleType: ("DOUBLE", "FLOAT", "DECIMAL", "BIGINT"),
    T.BooleanType: ("BOOLEAN",),
}


def misfits(observed: object, declared: T.DataType, path: str = "$") -> list[str]:
    """Where an observed tree doesn't fit a declared type; missing fields and nulls always fit, conflicting ones don't."""
    if observed == "VOID":
        return []
    if isinstance(observed, tuple) and observed[0] == "OBJECT":
        fields: dict = observed[1]
        if isinstance(declared, T.MapType):
            return [m for n, o in fields.items() for m in misfits(o, declared.valueType, f"{path}.{n}")]
        if isinstance(declared, T.StructType):
            known = {f.name: f.dataType for f in declared.fields}
            return [m for n, o in fields.items() for m in (misfits(o, known[n], f"{path}.{n}") if n in known else [f"{path}.{n}: not declared"])]
    elif isinstance(observed, tuple):
        if isinstance(declared, T.ArrayType):
            return misfits(observed[1], declared.elementType, f"{path}[]")
        if isinstance(declared, T.MapType) and observed[1] == "VOID":
            return []  # an empty list stands for an empty map in some records
    elif any(isinstance(declared, kind) and observed.split("(")[0] in names for kind, names in FITS.items()):
        return []
    elif isinstance(declared, T.VariantType):
        return []
    if isinstance(declared, T.VariantType):
        return []
    return [f"{path}: {observed if isinstance(observed, str) else observed[0]} isn't {declared.simpleString()}"]


def observed_schema(df: DataFrame, column: str) -> str:
    """The merged schema of a JSON column, as one distributed aggregate."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"] or "VOID"


def observed_schemas(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The merged schemas of several JSON columns, in one pass."""
    row = df.agg(*(F.schema_of_variant_agg(F.try_parse_json(c)).alias(c) for c in columns)).first()
    return {c: row[c] or "VOID" for c in columns}


def check(df: DataFrame, column: str, declared: str | T.DataType) -> None:
    """Raises SchemaDriftError unless every record of the column fits the declared type."""
    kind = T.DataType.fromDDL(declared) if isinstance(declared, str) else declared
    found = misfits(_parse(observed_schema(df, column))[0], kind)
    if found:
        raise SchemaDriftError("; ".join(found[:20]))
