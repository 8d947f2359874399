"""Entity records, ledgers and listings derived from the star-schema tables, so that every query has whole-table input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import chunk

LANGUAGES = ("en", "fr", "de", "es")
TABLES = ("labels", "descriptions", "aliases", "links", "claims")
KINDS = ("wikibase-item", "wikibase-property", "quantity", "quantity", "string", "time", "monolingualtext", "no-such-type")

#: The same languages as a SQL relation.
LANGS = "(values (0, 'en'), (1, 'fr'), (2, 'de'), (3, 'es')) as l(i, language)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows over all cores: a few MB of compressed rows are one or two tasks to the scan, whatever their claims cost to decode."""
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, key)


def _language_map(keep: list[Column], value: list[Column]) -> Column:
    """A map of the languages whose condition holds."""
    entries = [F.when(k, F.struct(F.lit(name).alias("key"), v.alias("value"))) for name, k, v in zip(LANGUAGES, keep, value)]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))


def _where(column: str, modulus: int, hit: int | None = None) -> list[Column]:
    rests = [(F.col(column) + i) % modulus for i in range(len(LANGUAGES))]
    return [r != 0 if hit is None else r == hit for r in rests]


def term_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity a document: labels, descriptions and aliases as JSON text."""
    docs = table(spark, sf_dir, "documents")
    names = [F.lit(n) for n in LANGUAGES]
    term = lambda value: [F.struct(n.alias("language"), value(n).alias("value")) for n in names]
    labels = _language_map(_where("doc_id", 3), term(lambda n: F.concat("source", F.lit(":"), n)))
    descriptions = _language_map(_where("doc_id", 2, 0), term(lambda n: F.concat(n, F.lit("/"), F.col("n_chars").cast("string"))))
    listed = F.transform(F.sequence(F.lit(0), F.lit(1)), lambda k: F.struct(F.col("lang").alias("language"), F.concat("source", F.lit("-"), k.cast("string")).alias("value")))
    aliases = F.create_map(F.col("lang"), F.slice(listed, F.lit(1), (F.col("doc_id") % 3).cast("int")))
    entity = F.concat(F.lit("Q"), F.col("doc_id").cast("string")).alias("id")
    file = F.concat(F.lit("chunk_"), (F.col("doc_id") % 7).cast("string"), F.lit("-00000-of-00001.parquet")).alias("file")
    return docs.select(entity, file, "doc_id", F.to_json(labels).alias("labels"), F.to_json(descriptions).alias("descriptions"), F.to_json(aliases).alias("aliases"))


def site_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity a page, with a site link of the page's language; badges are there to be dropped."""
    pages = table(spark, sf_dir, "pages")
    site = F.concat(F.regexp_extract("html", '<html lang="(\\w+)"', 1), F.lit("wiki"))
    link = F.create_map(site, F.struct(site.alias("site"), F.col("url").alias("title"), F.array().cast("array<string>").alias("badges")))
    return pages.select(F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("id"), F.to_json(link).alias("sitelinks"))


def claim_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity a part with one statement; its kind, labels, units, qualifiers and references follow from the part's key and size."""
    part = spread(table(spark, sf_dir, "part"), "p_partkey")
    names = _language_map(_where("p_partkey", 3), [F.concat("p_brand", F.lit(f":{n}")) for n in LANGUAGES])
    labels = _language_map(_where("p_size", 2, 0), [F.concat("p_name", F.lit(f":{n}")) for n in LANGUAGES])
    kind, key, size = F.col("p_partkey") % 8, F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    amount = [F.concat(F.lit("+"), size).alias("amount"), F.lit("1").alias("unit")]
    units = F.when(F.col("p_size") % 5 != 0, labels)
    language = F.element_at(F.array(*map(F.lit, LANGUAGES)), (F.col("p_size") % 4 + 1).cast("int"))
    moment = [F.concat(F.lit("+2001-00-"), size).alias("time"), F.lit(0).alias("timezone"), F.lit(0).alias("before"), F.lit(0).alias("after"), F.lit(9).alias("precision"), F.lit("gregorian").alias("calendarmodel")]
    value = (
        F.when(kind < 2, F.to_json(F.struct(F.concat(F.lit("Q"), key).alias("id"), labels.alias("labels"))))
        .when(kind == 2, F.to_json(F.struct(*amount, units.alias("unit-labels"))))
        .when(kind == 3, F.to_json(F.struct(*amount, F.create_map().cast("map<string,string>").alias("unit-labels"))))
        .when(kind == 4, F.concat(F.lit('"'), "p_type", F.lit('"')))
        .when(kind == 5, F.to_json(F.struct(*moment)))
        .when(kind == 6, F.to_json(F.struct(F.col("p_name").alias("text"), language.alias("language"))))
        .otherwise(F.to_json(F.struct(key.alias("id"))))
    )
    datatype = F.element_at(F.array(*map(F.lit, KINDS)), (kind + 1).cast("int"))
    prop = F.concat(F.lit("P"), (F.col("p_partkey") % 50).cast("string"))
    snak = [F.lit('{"mainsnak":{"property":"'), prop, F.lit('","datavalue":'), value, F.lit(',"datatype":"'), datatype, F.lit('","property-labels":'), F.to_json(names), F.lit("}")]
    typed = lambda p, v, kind: [F.lit(f'{{"{p}":[{{"property":"{p}","datavalue":'), v, F.lit(f',"datatype":"{kind}","property-labels":{{}}}}]}}')]
    qualifiers = F.when(F.col("p_partkey") % 4 != 0, F.concat(*typed("P9", F.concat(F.lit('"'), "p_brand", F.lit('"')), "string"))).otherwise("{}")
    precision = F.concat(size, F.when(F.col("p_partkey") % 2 == 0, "").otherwise(".5"))
    reference = F.concat(*typed("P8", F.concat(F.lit('{"time":"+2001","precision":'), precision, F.lit("}")), "time"))
    references = F.array_join(F.array_repeat(reference, (F.col("p_partkey") % 3).cast("int")), ",")
    rest = [F.lit(',"rank":"normal","references":['), references, F.lit('],"qualifiers":'), qualifiers, F.lit("}]}")]
    claims = F.concat(F.lit('{"'), prop, F.lit('":['), *snak, *rest)
    return part.select(F.concat(F.lit("Q"), key).alias("id"), claims.alias("claims"))


#: The statements of ``claim_entities`` as flat SQL: one row for each part and language, with its rules' inputs.
CLAIM_ROWS = f"""
select 'Q' || p_partkey as id, 'P' || (p_partkey % 50) as property, p_partkey % 8 as kind, language, p_size, p_name, p_brand,
    (p_partkey + i) % 3 <> 0 as has_name, (p_size + i) % 2 = 0 as has_label, i = p_size % 4 as is_text,
    case p_partkey % 8 when 0 then 'wikibase-item' when 1 then 'wikibase-property' when 2 then 'quantity' when 3 then 'quantity'
        when 4 then 'string' when 5 then 'time' when 6 then 'monolingualtext' else 'no-such-type' end as datatype
from part cross join {LANGS}
"""


def union_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, datatype, value): JSON of a bare string, an object, and precisions that are whole or broken."""
    part = spread(table(spark, sf_dir, "part"), "p_partkey")
    kind, key = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    value = (
        F.when(kind == 0, F.concat(F.lit('"{'), "p_name", F.lit('"')))
        .when(kind == 1, F.concat(F.lit('{"id":"Q'), key, F.lit('"}')))
        .when(kind == 2, F.concat(F.lit('{"time":"+1'), key, F.lit('","precision":'), F.col("p_size").cast("string"), F.lit("}")))
        .otherwise(F.concat(F.lit('{"amount":"+'), key, F.lit('","precision":'), F.col("p_size").cast("string"), F.lit(".5}")))
    )
    datatype = F.element_at(F.array(*map(F.lit, ("string", "wikibase-item", "time", "quantity"))), (kind + 1).cast("int"))
    return part.select(F.concat(F.lit("Q"), key).alias("id"), datatype.alias("datatype"), value.alias("value"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source file an order: its name, size, and last and earlier steps."""
    orders = table(spark, sf_dir, "orders")
    name = F.format_string("chunk_%d-%05d-of-99999", F.col("o_custkey") % 113, F.col("o_orderkey"))
    size = (F.col("o_orderkey") * 1000 + F.col("o_custkey")).alias("size")
    return orders.select("o_orderkey", name.alias("stem"), F.concat(name, F.lit(".parquet")).alias("file"), size, (F.col("o_orderkey") % 7).alias("step"))


FILES = """
select o_orderkey, 'chunk_' || (o_custkey % 113) || '-' || lpad(o_orderkey::varchar, greatest(5, length(o_orderkey::varchar))::int, '0') || '-of-99999' as stem,
    o_custkey % 113 as chunk, o_orderkey * 1000 + o_custkey as size, o_orderkey % 7 as step
from orders
"""


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended ledger rows: every step up to the last one, in order."""
    rows = files(spark, sf_dir).select(F.concat("stem", F.lit(".jsonl")).alias("file"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("step"))).alias("step"))
    return rows.withColumn("seq", F.col("step"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state without its history, for the queries that start from it."""
    rows = files(spark, sf_dir).select(F.concat("stem", F.lit(".jsonl")).alias("file"), "step", "size", "o_orderkey")
    return rows.withColumn("chunk", chunk("file"))


def presence(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """For each table the files that it has, each twice as it would be for two languages."""
    found = files(spark, sf_dir)
    out = {}
    for t, name in enumerate(TABLES):
        rows = found.where((F.col("o_orderkey") + t) % (t + 3) != 0).select("file")
        out[name] = reduce(DataFrame.unionAll, [rows, rows])
    return out
