"""The queries of this folder's operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import encode_documents
from .lines import duplicate_lines
from .jaccard import duplicate_groups
from .superkmers import ORACLE as REPEATS_SQL
from .superkmers import repeated_spans
from .packing import pack_documents
from .private import find_identifiers
from .licenses import scan_licenses
from .jpeg import decode_column, media_column
from .ordinal import select_documents
from .syncmers import fingerprints, match_positions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def syncmer_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_positions(table(spark, sf_dir, "documents"))


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_lines(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents"))


def op3_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))


def op6_related_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op2_private_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_identifiers(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op8_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_column(media_column(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op5_syncmers,
        op7_ordinal_quality,
        op10_fuzzy_lines,
        op9_ngram_jaccard,
        op3_super_kmers,
        op6_related_packing,
        op2_private_identifiers,
        op4_license_scan,
        op8_progressive_jpeg,
        syncmer_matches,
    )
}
ORACLE_SQL: dict[str, str] = {"op3_super_kmers": REPEATS_SQL}
