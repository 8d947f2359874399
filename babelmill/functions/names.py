"""File names, sizes and other scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = r"chunk_(\d+)-"
PART = r"chunk_\d+-(\d+)"


def number(column: str | Column, pattern: str) -> Column:
    """The first group of a pattern as a number, NULL where it doesn't match."""
    return F.nullif(F.regexp_extract(column, pattern, 1), F.lit("")).try_cast("bigint")


def chunk(column: str | Column) -> Column:
    return number(column, CHUNK)


def part(column: str | Column) -> Column:
    return number(column, PART)


def basename(column: str | Column) -> Column:
    return F.substring_index(column, "/", -1)


def between(column: str | Column) -> Column:
    """The chunk as text: what stands between the first underscore and the next hyphen."""
    return F.get(F.split(F.get(F.split(column, "_"), 1), "-"), 0)


def to_parquet(column: str | Column) -> Column:
    """The data file that a ledger file is about."""
    return F.regexp_replace(column, r"\.jsonl$", ".parquet")


def gigabytes(column: str | Column) -> Column:
    return F.bround(F.col(column) / F.lit(1024.0**3), 3) if isinstance(column, str) else F.bround(column / F.lit(1024.0**3), 3)


def chunk_glob(index: int | None = None) -> str:
    """A glob for the files of one chunk, or of all."""
    return f"chunk_{'*' if index is None else index}-*.parquet"
