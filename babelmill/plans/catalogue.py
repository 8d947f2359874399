"""All queries by name, and the SQL that gives the same rows.

Each query builds its nested input from a star-schema table (see ``recipes``), runs one operator over the whole table
and returns scalar columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, normalise
from ..operators import analytics, audit, claims, flatten, ledger, planning, sink
from ..session import scratch
from ..sources import files as sources
from . import recipes, run
from .recipes import CLAIM_ROWS, FILES, LANGS, TABLES, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _map(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.select("id", F.explode(name).alias("key", "v")).select("id", "key", "v.*")


# Terms and site links

LABEL_SQL = f"select 'Q' || doc_id as id, language, source || ':' || language as value from documents cross join {LANGS} where (doc_id + i) % 3 <> 0"
DESCRIPTION_SQL = f"select 'Q' || doc_id as id, language, language || '/' || n_chars as value from documents cross join {LANGS} where (doc_id + i) % 2 = 0"
ALIAS_SQL = "select 'Q' || doc_id as id, lang as language, source || '-' || k as value from documents cross join (values (0), (1)) as a(k) where k < doc_id % 3"
LINK_SQL = "select 'P' || page_id as id, regexp_extract(html, '<html lang=\"(\\w+)\"', 1) || 'wiki' as site, url as title from pages"


@query(f"select id, language as key, language, value from ({LABEL_SQL})")
def normalise_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map("labels")(normalise.processed(recipes.term_entities(spark, sf_dir), "labels"))


@query(f"select id, language as key, language, value from ({DESCRIPTION_SQL})")
def normalise_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map("descriptions")(normalise.processed(recipes.term_entities(spark, sf_dir), "descriptions"))


@query("select 'Q' || doc_id as id, lang as key, doc_id % 3 as n, case when doc_id % 3 = 0 then null else source || '-' || (doc_id % 3 - 1) end as last from documents")
def normalise_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = normalise.processed(recipes.term_entities(spark, sf_dir), "aliases").select("id", F.explode("aliases").alias("key", "v"))
    return lists.select("id", "key", F.size("v").cast("long").alias("n"), F.try_element_at("v", F.lit(-1))["value"].alias("last"))


@query(f"select id, site as key, site, title from ({LINK_SQL})")
def normalise_sitelinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map("sitelinks")(normalise.processed(recipes.site_entities(spark, sf_dir), "sitelinks"))


@query(LABEL_SQL)
def flatten_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten(normalise.processed(recipes.term_entities(spark, sf_dir), "labels"), "labels")


@query(DESCRIPTION_SQL)
def flatten_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten(normalise.processed(recipes.term_entities(spark, sf_dir), "descriptions"), "descriptions")


@query(f"{ALIAS_SQL} union all select 'Q' || doc_id, null, null from documents where doc_id % 3 = 0")
def flatten_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten(normalise.processed(recipes.term_entities(spark, sf_dir), "aliases"), "aliases")


@query(LINK_SQL)
def flatten_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten(normalise.processed(recipes.site_entities(spark, sf_dir), "sitelinks"), "links")


def _flat_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recipes.term_entities(spark, sf_dir).select(F.struct("id", "file").alias("id"), "labels")
    out = flatten.flatten(normalise.processed(rows, "labels"), "labels")
    return out.select(F.col("id.file").alias("source_file"), F.col("id.id").alias("id"), "language", "value")


AUDIT_SQL = f"""
select 'chunk_' || (doc_id % 7) || '-00000-of-00001.parquet' as source_file, 'labels' as "table", language as key,
    count(*) as rows, min('Q' || doc_id) as min_id, max('Q' || doc_id) as max_id
from documents cross join {LANGS} where (doc_id + i) % 3 <> 0 group by all
"""


@query(AUDIT_SQL)
def audit_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sink.sidecar(_flat_labels(spark, sf_dir), "labels", "language")


@query(f"select 'chunk_' || (doc_id % 7) || '-00000-of-00001.parquet' as source_file, 'Q' || doc_id as id, language, source || ':' || language as value from documents cross join {LANGS} where (doc_id + i) % 3 <> 0")
def partitions_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label table as it reads back from its partitions."""
    target = scratch(spark)
    sink.write_partitions(_flat_labels(spark, sf_dir), "language", target)
    return sink.read_partitions(spark, target).select("source_file", "id", "language", "value")


@query(
    f"with a as ({AUDIT_SQL}) select source_file, \"table\", key, rows as rows_before, case when source_file like 'chunk_3-%' then nullif(rows - 1, 0) end as rows_after"
    " from a where key = 'fr' and source_file like 'chunk_3-%' or source_file like 'chunk_5-%'"
)
def postcheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are written and published; the published table then loses a row of one partition and all of one source file."""
    target, remote = scratch(spark), scratch(spark)
    sink.write_partitions(_flat_labels(spark, sf_dir), "language", target)
    before = sink.sidecar(sink.read_partitions(spark, target), "labels", "language")
    sink.publish(spark, target, remote)
    sink.remove_files(spark, remote, ["chunk_5-00000-of-00001.parquet"])
    one = (F.col("language") == "fr") & F.col("source_file").startswith("chunk_3-")
    rows = sink.read_partitions(spark, target).where(one)
    first = rows.agg(F.min("id").alias("first"))
    sink.remove_files(spark, remote, ["chunk_3-00000-of-00001.parquet"])
    whole = sink.read_partitions(spark, target).where(F.col("source_file").startswith("chunk_3-") & (F.col("language") != "fr"))
    lacking = rows.crossJoin(F.broadcast(first)).where("id <> first").drop("first")
    sink.write_partitions(whole.unionByName(lacking), "language", remote)
    return sink.post_check(before, sink.sidecar(sink.read_partitions(spark, remote), "labels", "language"))


@query(f"select (select count(*) from documents) as ids_before, (select count(distinct doc_id) from documents cross join {LANGS} where (doc_id + i) % 2 = 0) as ids_after, 0::bigint as lost")
def id_preservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = recipes.term_entities(spark, sf_dir)
    return audit.id_preservation(entities, flatten.flatten(normalise.processed(entities, "descriptions"), "descriptions"))


@query(f"select language, count(*) as rows from ({LABEL_SQL}) group by language")
def language_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.distribution(flatten_labels(spark, sf_dir), "language")


@query(f"select language, count(*) as rows, count(*) * 100.0::double / sum(count(*)) over () as percent from ({DESCRIPTION_SQL}) group by language")
def language_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.share(flatten_descriptions(spark, sf_dir), "language")


@query(f"select language, count(*) as rows from ({LABEL_SQL}) group by language order by rows desc, language limit 3")
def top_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top(flatten_labels(spark, sf_dir), "language", 3)


@query("select url from pages order by url limit 20 offset 10")
def page_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("url").orderBy("url").offset(10).limit(20)


# Claims


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements without the snaks of qualifiers and references, which the matching never reads."""
    entities = recipes.claim_entities(spark, sf_dir)
    return flatten.statements(entities.select("id", normalise.claims("claims", nested=False).alias("claims")))


@query(
    "select 'Q' || p_partkey as id, 'P' || (p_partkey % 50) as property, 1::bigint as statements, (p_partkey % 3)::bigint as refs, case when p_partkey % 4 <> 0 then 1 else 0 end::bigint as qualifiers,"
    " case when p_partkey % 4 <> 0 then p_brand end as qualifier, case when p_partkey % 3 > 0 and p_partkey % 2 = 0 then p_size::bigint end as whole,"
    " case when p_partkey % 3 > 0 and p_partkey % 2 = 1 then p_size + 0.5::double end as broken from part"
)
def normalise_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    # outer, as an inner explode puts a filter on the decoded map below the exchange: claims would be decoded twice, once by the scan's few tasks
    found = normalise.processed(recipes.claim_entities(spark, sf_dir), "claims").select("id", F.explode_outer("claims").alias("property", "v")).where("property is not null")
    first = F.col("v")[0]
    qualifier = F.try_element_at(first["qualifiers"], F.lit("P9"))[0]["datavalue"]["datavalue__string"]
    precision = F.try_element_at(F.try_element_at(first["references"], F.lit(-1)), F.lit("P8"))[0]["datavalue"]["precision"]
    sizes = [F.size("v").cast("long").alias("statements"), F.size(first["references"]).cast("long").alias("refs"), F.size(first["qualifiers"]).cast("long").alias("qualifiers")]
    values = [qualifier.alias("qualifier"), precision["precision__integer"].alias("whole"), precision["precision__number"].alias("broken")]
    return found.select("id", "property", *sizes, *values)


@query(f"select id, any_value(property) as property, any_value(datatype) as datatype, 'normal' as rank, count_if(has_name) as names from ({CLAIM_ROWS}) group by id")
def claims_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statements(spark, sf_dir).select("id", "property", "datatype", "rank", F.size("`property-labels`").cast("long").alias("names"))


ITEM_SQL = f"select id, property, language, p_brand || ':' || language as property_label, p_name || ':' || language as datavalue_label from ({CLAIM_ROWS}) where kind < 2 and has_name and has_label"
ITEM_COLUMNS = ("id", "property", "language", "property_label", "datavalue_label")


@query(ITEM_SQL)
def claims_wikibase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.items(_statements(spark, sf_dir)).select(*ITEM_COLUMNS)


@query(ITEM_SQL)
def claims_wikibase_cartesian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.items_by_cartesian(_statements(spark, sf_dir)).select(*ITEM_COLUMNS)


@query(ITEM_SQL)
def claims_wikibase_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.items_by_lookup(_statements(spark, sf_dir)).select(*ITEM_COLUMNS)


@query(ITEM_SQL)
def claims_wikibase_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.items_by_join(_statements(spark, sf_dir)).select(*ITEM_COLUMNS)


NAMED = "kind = 2 and p_size % 5 <> 0"


@query(
    f"select id, language, p_brand || ':' || language as property_label, case when {NAMED} then p_name || ':' || language end as unit_label, '+' || p_size as amount"
    f" from ({CLAIM_ROWS}) where kind in (2, 3) and has_name and (has_label or not ({NAMED}))"
)
def claims_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.quantities(_statements(spark, sf_dir)).select("id", "language", "property_label", "unit_label", "datavalue.amount")


@query(f"select id, datatype, language, p_brand || ':' || language as property_label from ({CLAIM_ROWS}) where kind in (4, 5) and has_name")
def claims_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.scalars(_statements(spark, sf_dir)).select("id", "datatype", "language", "property_label")


@query(f"select id, language, p_brand || ':' || language as property_label, p_name as text from ({CLAIM_ROWS}) where kind = 6 and has_name and is_text")
def claims_monolingual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.texts(_statements(spark, sf_dir)).select("id", "language", "property_label", "datavalue.text")


ALL_SQL = f"""
select id, property, datatype, language, p_brand || ':' || language as property_label, 'normal' as rank,
    case when kind < 2 then p_name || ':' || language end as datavalue_label,
    case when {NAMED} then p_name || ':' || language end as unit_label
from ({CLAIM_ROWS})
where has_name and case when kind < 2 or {NAMED} then has_label when kind = 6 then is_text else kind <> 7 end
"""
ALL_COLUMNS = ("id", "property", "datatype", "language", "property_label", "rank", "datavalue_label", "unit_label")


@query(ALL_SQL)
def claims_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.match_languages(_statements(spark, sf_dir)).select(*ALL_COLUMNS)


@query(ALL_SQL)
def union_diagonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.match_by_union(_statements(spark, sf_dir)).select(*ALL_COLUMNS)


@query(f"select datatype, count(distinct id) as rows from ({CLAIM_ROWS}) group by datatype")
def datatype_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.distribution(_statements(spark, sf_dir), "datatype")


@query("select 'no-such-type' as datatype, count(*) as count from part where p_partkey % 8 = 7 having count(*) > 0")
def unknown_datatypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.unknown_datatypes(_statements(spark, sf_dir))


@query(f"select id, language from ({CLAIM_ROWS}) where kind < 2 and has_name and not has_label")
def unmatched_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.lost_languages(_statements(spark, sf_dir)).select("id", F.explode("lost").alias("language"))


@query(f"select id, count_if(has_label) as n, coalesce(string_agg(language, ',' order by language) filter (has_label), '') as languages from ({CLAIM_ROWS}) where kind < 2 group by id")
def label_langs(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = F.map_keys(claims.VALUE_LABELS)
    items = _statements(spark, sf_dir).where("datatype like 'wikibase-%'")
    return items.select("id", F.size(keys).cast("long").alias("n"), F.array_join(F.array_sort(keys), ",").alias("languages"))


@query(f"select id, language, has_label as known from ({CLAIM_ROWS}) where kind < 2 and has_name")
def lang_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _statements(spark, sf_dir).where("datatype like 'wikibase-%'")
    rows = items.select("id", F.map_keys(claims.VALUE_LABELS).alias("langs"), F.explode(claims.LABELS).alias("language", "label"))
    return rows.select("id", "language", F.array_contains("langs", F.col("language")).alias("known"))


VALUE_SQL = """
select 'Q' || p_partkey as id, case p_partkey % 4 when 0 then '{' || p_name end as string, case p_partkey % 4 when 1 then 'Q' || p_partkey end as record,
    case p_partkey % 4 when 2 then p_size::bigint end as whole, case p_partkey % 4 when 3 then p_size + 0.5::double end as broken from part
"""


@query(VALUE_SQL)
def scalar_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = recipes.union_values(spark, sf_dir).select("id", normalise.promote(F.parse_json("value")).alias("d"))
    return v.select("id", F.col("d.datavalue__string").alias("string"), F.col("d.id").alias("record"), F.col("d.precision.precision__integer").alias("whole"), F.col("d.precision.precision__number").alias("broken"))


@query("select 'Q' || p_partkey as id, case p_partkey % 4 when 0 then '{' || p_name when 1 then 'Q' || p_partkey when 2 then '+1' || p_partkey else '+' || p_partkey end as value from part")
def coalesce_datavalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = recipes.union_values(spark, sf_dir).select("id", "datatype", normalise.promote(F.parse_json("value")).alias("d"))
    return v.select("id", normalise.plain_value("d", "datatype").alias("value"))


@query("select distinct 'claims' as field, '$.P' || (p_partkey % 50) || '[].rang: not declared' as misfit from part where p_partkey % 97 = 5")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some statements have a field that isn't declared."""
    claims_ = F.when(F.col("id").substr(2, 20).cast("long") % 97 == 5, F.replace("claims", F.lit('"rank":'), F.lit('"rang":1,"rank":'))).otherwise(F.col("claims"))
    return run.misfits(recipes.claim_entities(spark, sf_dir).select(claims_.alias("claims"))).withColumnRenamed("column", "field")


# Files, ledger and plans


@query(f"select stem || '.parquet' as file, chunk, o_orderkey as part from ({FILES})")
def chunk_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.files(spark, sf_dir).select("file", names.chunk("file").alias("chunk"), names.part("file").alias("part"))


@query("select page_id, split_part(url, '/', -1) as name from pages")
def basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", names.basename("url").alias("name"))


@query(f"select o_orderkey, round_even(size / 1073741824.0::double, 3) as size_gb from ({FILES})")
def size_gb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.files(spark, sf_dir).select("o_orderkey", names.gigabytes("size").alias("size_gb"))


@query(f"select stem || '.jsonl' as file, chunk, o_orderkey as part, step from ({FILES})")
def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.state(recipes.ledger_rows(spark, sf_dir))


@query(f"select min(chunk) as chunk from ({FILES}) where step < 6")
def next_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.next_chunk(recipes.ledger(spark, sf_dir))


@query(f"select stem || '.parquet' as file from ({FILES}) where chunk = 5 and step <= 1")
def files_to_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.files_to_pull(recipes.ledger(spark, sf_dir), 5)


@query(f"select chunk, min(step) as least, min(step) >= 3 as partitioned, min(step) = 6 as complete from ({FILES}) group by chunk")
def chunk_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.gates(recipes.ledger(spark, sf_dir))


@query(f"select stem || '.jsonl' as file from ({FILES}) where step >= 3")
def files_at_or_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.at_or_past(recipes.ledger(spark, sf_dir), ledger.Step.PARTITION).select("file")


@query(f"select stem || '.parquet' as file, case when o_orderkey % 11 <> 0 then step end as step, o_orderkey % 11 <> 0 and step >= 3 as reached from ({FILES})")
def file_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = recipes.ledger(spark, sf_dir).where(F.col("o_orderkey") % 11 != 0)
    return ledger.step_of(known, recipes.files(spark, sf_dir).select("file"), ledger.Step.PARTITION)


@query(f"select stem || '.jsonl' as file from ({FILES}) where o_orderkey % 11 = 0")
def files_to_enter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recipes.ledger(spark, sf_dir)
    return ledger.unknown(found, found.where(F.col("o_orderkey") % 11 != 0))


@query(f"select stem || '.parquet' as file from ({FILES}) where regexp_matches(stem, '_1[0-9]*-0*[1-9]*5-of')")
def files_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.files(spark, sf_dir).where(F.col("file").rlike("_1[0-9]*-0*[1-9]*5-of")).select("file")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing that lacks every eleventh file."""
    rows = recipes.files(spark, sf_dir).where(F.col("o_orderkey") % 11 != 0)
    return rows.select(F.concat("stem", F.lit(".jsonl")).alias("file"), "size")


@query(f"select stem || '.jsonl' as file, step, case when o_orderkey % 11 <> 0 then size end as size from ({FILES})")
def ledger_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.with_sizes(recipes.ledger(spark, sf_dir).drop("size"), _sizes(spark, sf_dir)).select("file", "step", "size")


@query(f"select stem || '.jsonl' as file, step from ({FILES}) where o_orderkey % 11 = 0")
def ledger_without_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.without_size(recipes.ledger(spark, sf_dir), _sizes(spark, sf_dir)).select("file", "step")


@query(f"select stem || '.parquet' as file, size, case when o_orderkey % 11 <> 0 then size + (o_orderkey % 13 = 0)::int end as found_size, o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0 as ok from ({FILES})")
def verify_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = recipes.files(spark, sf_dir)
    found = expected.where(F.col("o_orderkey") % 11 != 0).select("file", (F.col("size") + F.when(F.col("o_orderkey") % 13 == 0, 1).otherwise(0)).alias("size"))
    return audit.verify_sizes(expected, found)


PRESENT = [f"(o_orderkey + {t}) % {t + 3} <> 0" for t in range(len(TABLES))]


@query(f"select stem || '.parquet' as file, {', '.join(f'{p} as {n}' for n, p in zip(TABLES, PRESENT))}, {' and '.join(PRESENT)} as already_pushed from ({FILES})")
def present_in_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.present_in_all(recipes.files(spark, sf_dir), recipes.presence(spark, sf_dir))


@query(" union all ".join(f"select '{n}' as \"table\", stem || '.parquet' as file from ({FILES}) where not ({p})" for n, p in zip(TABLES, PRESENT)))
def missing_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recipes.presence(spark, sf_dir)
    present = None
    for name, df in found.items():
        rows = df.select(F.lit(name).alias("table"), "file")
        present = rows if present is None else present.unionAll(rows)
    return audit.missing_outputs(recipes.files(spark, sf_dir), list(TABLES), present)


@query(
    f"select stem || '.parquet' as file, case when o_orderkey % 4 = 0 then 'already_pushed' when o_orderkey % 3 = 0 and step = 0 then 'mark_pulled'"
    f" when o_orderkey % 3 = 0 then 'local_ok' else 'need_download' end as plan from ({FILES})"
)
def pull_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = recipes.files(spark, sf_dir).select("file", "step", (key % 4 == 0).alias("already_pushed"), (key % 3 == 0).alias("local_ok"))
    return ledger.pull_plan(rows).select("file", "plan")


@query(f"select stem || '.parquet' as file, case when o_orderkey % 5 = 0 then 3 when o_orderkey % 3 = 0 then 2 when o_orderkey % 2 = 0 then 1 else 0 end::bigint as step from ({FILES})")
def inferred_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recipes.files(spark, sf_dir)
    return ledger.inferred(found, *(found.where(F.col("o_orderkey") % m == 0) for m in (2, 3, 5)))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.files(spark, sf_dir).withColumn("chunk", names.chunk("file"))


@query(f"select chunk, sum(size)::bigint as size, count(*) as files from ({FILES}) group by chunk")
def chunk_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.chunk_totals(_chunks(spark, sf_dir))


@query(f"select chunk::varchar as chunk_index, sum(size)::bigint as total_size_bytes, round_even(sum(size)::bigint / 1073741824.0::double, 3) as total_size_gb, count(*) as file_count from ({FILES}) group by chunk")
def chunk_totals_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.rounded_totals(recipes.files(spark, sf_dir))


@query(
    f"select chunk, count(*) as expected, count_if(o_orderkey % 10 <> 0) as found, coalesce(sum(size) filter (o_orderkey % 10 <> 0), 0)::bigint as bytes,"
    f" count_if(o_orderkey % 10 = 0) = 0 as complete, count_if(o_orderkey % 10 <> 0) > 0 as any_local from ({FILES}) group by chunk"
)
def chunk_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _chunks(spark, sf_dir)
    return planning.completeness(found, found.where(F.col("o_orderkey") % 10 != 0))


@query(f"select stem || '.parquet' as file, size, round_even(size / 1073741824.0::double, 3) as size_gb from ({FILES})")
def size_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes written as CSV and read again."""
    target = scratch(spark)
    sink.write_sizes(recipes.files(spark, sf_dir).select("file", "size", names.gigabytes("size").alias("size_gb")), target)
    return sources.size_table(spark, target)


@query("select count(*) as rows, min(l_orderkey) as low, max(l_orderkey) as high from lineitem")
def footer_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sink.footer_bounds(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey")


@query("select o_orderkey, row_number() over (order by o_orderkey) - 1 as row from orders")
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.numbered(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


BUDGET = 20_000_000_000


@query(
    f"with t as (select chunk, sum(size)::bigint as size from ({FILES}) where chunk > 5 group by chunk order by chunk limit 50), r as (select chunk, size,"
    f" (sum(size) over (order by chunk))::bigint as running from t where chunk % 4 <> 0) select * from r where running <= {BUDGET}"
)
def prefetch_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = planning.chunk_totals(_chunks(spark, sf_dir))
    return planning.prefetch(totals, 5, 50, BUDGET, complete=totals.where(F.col("chunk") % 4 == 0))


@query(f"select chunk, sum(size)::bigint as size, greatest({BUDGET} - sum(size)::bigint, 0)::bigint as \"left\" from ({FILES}) group by chunk")
def budget_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.remaining(planning.chunk_totals(_chunks(spark, sf_dir)), BUDGET)


@query(f"select distinct chunk from ({FILES}) where chunk % 10 = 0 or chunk < 20 order by chunk")
def chunk_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).where((F.col("chunk") % 10 == 0) | (F.col("chunk") < 20)).select("chunk").distinct().orderBy("chunk")


# Sizes and measurements


@query("select count(p_partkey) as n, min(p_partkey) as low, max(p_partkey) as high, sum(p_partkey)::bigint as total, avg(p_partkey) as mean, median(p_partkey) as median, stddev_samp(p_partkey) as std, 0::bigint as nulls from part")
def size_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.summary(table(spark, sf_dir, "part"), "p_partkey")


@query("select unnest([0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])::double as share, unnest(quantile_cont(l_partkey::double, [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])) as value from lineitem")
def size_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.percentiles(table(spark, sf_dir, "lineitem"), "l_partkey")


RANKED = "select l_suppkey as v, row_number() over (order by l_suppkey, l_orderkey * 10 + l_linenumber) as r from lineitem"


@query(f"select count(*) as n, sum(v)::bigint as total, 2.0::double * sum(v * r)::bigint / (count(*) * sum(v)::bigint) - (count(*) + 1.0::double) / count(*) as gini from ({RANKED})")
def lorenz_gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.gini(table(spark, sf_dir, "lineitem"), "l_suppkey")


@query(f"with c as (select v, r, (sum(v) over (order by r))::bigint as running from ({RANKED})) select r as files, v as value, running from c where running * 100 >= (select sum(v) from c) * 80 order by r limit 1")
def lorenz_80pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.share_count(table(spark, sf_dir, "lineitem"), "l_suppkey")


@query("select event_id, user_id, value from events order by value desc, event_id limit 1")
def peak_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.peak(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), "value", "event_id")


@query("select event_id, (epoch_us(ts) - min(epoch_us(ts)) over ()) / 60e6 as minutes from events")
def elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.elapsed(table(spark, sf_dir, "events").select("event_id", "ts"), "ts").select("event_id", "minutes")


DEMO_ROWS, DEMO_CHUNKS = 9_000_000, 9


def _demo_sql() -> str:
    """The generator's arithmetic as SQL."""
    bounds, total = [], 0
    for language, share in sources.DEMO_SHARES.items():
        total += int(DEMO_ROWS * share + 1e-9)
        bounds.append(f"when turn < {total} then '{language}'")
    return (
        f"select id // {DEMO_ROWS // DEMO_CHUNKS} as chunk, id % {DEMO_ROWS // DEMO_CHUNKS} as place, case {' '.join(bounds)} else 'en' end as language"
        f" from (select range as id, range * {sources.stride(DEMO_ROWS)} % {DEMO_ROWS} as turn from range({DEMO_ROWS}))"
    )


@query(f"select chunk, language, count(*) as rows, min('Q' || chunk || lpad(place::varchar, 6, '0')) as first, max('Sample claim ' || place || ' in ' || language) as text from ({_demo_sql()}) group by chunk, language")
def demo_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the generator's nine million rows hold, by chunk and language."""
    groups = sources.demo_rows(spark, DEMO_ROWS, chunks=DEMO_CHUNKS).groupBy("chunk", "language")
    return groups.agg(F.count("*").alias("rows"), F.min("id").alias("first"), F.max("text").alias("text"))


@query(f"select 'chunk_' || chunk || '-0000' || chunk || '-of-0000{DEMO_CHUNKS}.parquet' as file, chunk, chunk as part, count(*) as rows, count(distinct language) as languages from ({_demo_sql()}) group by chunk")
def demo_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generator's rows as chunk files, found again by their names."""
    target = scratch(spark)
    sources.write_demo(sources.demo_rows(spark, DEMO_ROWS, chunks=DEMO_CHUNKS), target, DEMO_CHUNKS)
    found = sources.listing(spark, target, names.chunk_glob()).select("file", names.chunk("file").alias("chunk"), names.part("file").alias("part"))
    held = sources.tree(spark, target).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"), F.countDistinct("language").alias("languages"))
    return found.join(held, "file")
