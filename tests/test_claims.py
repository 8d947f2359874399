"""Claims: hand-made statements, and the formulations that must agree."""

import json
import random

import pytest
from pyspark.sql import functions as F

from babelmill.functions import drift, normalise
from babelmill.functions.schemas import CLAIMS, PARSED_CLAIMS, TERMS
from babelmill.operators import claims, flatten
from babelmill.plans import catalogue

COLUMNS = ["id", "property", "datatype", "language", "property_label", "datavalue_label", "unit_label"]


def snak(kind, value, names, prop="P1"):
    return {"property": prop, "datavalue": value, "datatype": kind, "property-labels": names}


def entity(ident, *snaks):
    statements = [{"mainsnak": s, "rank": "normal", "references": [], "qualifiers": {}} for s in snaks]
    return ident, json.dumps({"P1": statements})


def statements(spark, *entities):
    df = spark.createDataFrame(list(entities), "id string, claims string")
    return flatten.statements(df.select("id", normalise.claims("claims").alias("claims")))


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_rules(spark):
    two = {"en": "e", "fr": "f"}
    df = statements(
        spark,
        entity("a", snak("wikibase-item", {"id": "Q1", "labels": {"en": "x", "de": "y"}}, two)),
        entity("b", snak("quantity", {"amount": "+1", "unit-labels": {"en": "m"}}, two), snak("quantity", {"amount": "+2", "unit-labels": {}}, two), snak("quantity", {"amount": "+3"}, two)),
        entity("c", snak("monolingualtext", {"text": "t", "language": "fr"}, two), snak("monolingualtext", {"text": "t", "language": "xx"}, two), snak("monolingualtext", {"text": "t"}, two)),
        entity("d", snak("string", "plain", two), snak("string", "plain", {})),
        entity("e", snak("other", {"id": "Q1"}, two)),
    )
    got = rows(claims.match_languages(df), "id", "language", "datavalue_label", "unit_label")
    assert got == sorted([("a", "en", "x", None), ("b", "en", None, "m"), ("b", "en", None, None), ("b", "en", None, None), ("b", "fr", None, None), ("b", "fr", None, None), ("c", "fr", None, None), ("d", "en", None, None), ("d", "fr", None, None), ("d", None, None, None)], key=str)
    assert rows(claims.unknown_datatypes(df), "datatype", "count") == [("other", 1)]
    assert rows(claims.lost_languages(df), "id", "lost") == [("a", ["fr"])]


def test_a_label_that_is_null_is_matched(spark):
    df = statements(spark, entity("a", snak("wikibase-item", {"id": "Q1", "labels": {"en": None}}, {"en": "e"})))
    for form in (claims.items, claims.items_by_cartesian, claims.items_by_lookup, claims.items_by_join, claims.match_languages):
        assert rows(form(df), "language", "datavalue_label") == [("en", None)]


def test_formulations_agree_with_a_model(spark):
    rng = random.Random(11)
    langs = ["en", "fr", "de", "zh-hant", "01"]
    pick = lambda tag: {x: f"{tag}:{x}" for x in langs if rng.random() < 0.5}
    made, want = [], []
    for i in range(120):
        kind = rng.choice(["wikibase-item", "wikibase-property", "quantity", "string", "time", "monolingualtext", "no-such"])
        names, labels = pick("p"), pick("v")
        value = {"wikibase-item": {"id": "Q", "labels": labels}, "wikibase-property": {"id": "P", "labels": labels}, "quantity": {"amount": "+1", **({} if rng.random() < 0.3 else {"unit-labels": labels})}, "string": "s", "time": {"time": "+2000"}, "monolingualtext": {"text": "t", "language": rng.choice(langs)}, "no-such": {}}[kind]
        made.append(entity(f"Q{i}", snak(kind, value, names)))
        units = value.get("unit-labels") if kind == "quantity" else None
        for lang, name in names.items() or {None: None}.items():
            item = kind.startswith("wikibase")
            allowed = labels if item else units if units else [value["language"]] if kind == "monolingualtext" else None
            if kind != "no-such" and (allowed is None or lang in allowed):
                want.append((f"Q{i}", "P1", kind, lang, name, labels.get(lang) if item else None, units.get(lang) if units else None))
    df = statements(spark, *made)
    want.sort(key=str)
    assert rows(claims.match_languages(df), *COLUMNS) == want
    assert rows(claims.match_by_union(df), *COLUMNS) == want
    forms = [rows(f(df), "id", "language", "property_label", "datavalue_label") for f in (claims.items, claims.items_by_cartesian, claims.items_by_lookup, claims.items_by_join)]
    assert forms[0] and all(f == forms[0] for f in forms)


def test_one_pass_needs_one_scan_and_no_exchange(spark, tmp_path):
    spark.createDataFrame([entity("a", snak("string", "x", {"en": "e"}))], "id string, claims string").write.parquet(f"{tmp_path}/e")
    df = spark.read.parquet(f"{tmp_path}/e").select("id", normalise.claims("claims").alias("claims"))
    plan = claims.match_languages(flatten.statements(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_promotion(spark):
    cases = {
        "text": ('"abc"', {"datavalue__string": "abc"}),
        "brace": ('"{x"', {"datavalue__string": "{x"}),
        "record": ('{"id":"Q1","labels":{"en":"a"}}', {"id": "Q1", "labels": {"en": "a"}}),
        "place": ('{"latitude":1,"longitude":-2.5,"precision":1e-5,"altitude":null}', {"latitude": (None, 1), "longitude": (-2.5, None), "precision": (None, 1e-5)}),
        "time": ('{"time":"+2001-00-00","precision":11,"timezone":0}', {"time": "+2001-00-00", "precision": (11, None), "timezone": 0}),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()] + [("none", None), ("null", "null")], "k string, j string")
    got = {r["k"]: r["d"] for r in df.select("k", normalise.promote(F.parse_json("j")).alias("d")).collect()}
    assert got["none"] is None and got["null"] is None
    for name, (_, fields) in cases.items():
        found = {k: tuple(v) if isinstance(v, tuple) and not isinstance(v, str) else v for k, v in got[name].asDict().items() if v is not None}
        assert found == fields
    schema = df.select(normalise.promote(F.parse_json("j")).alias("d")).schema["d"].dataType
    declared = spark.createDataFrame([], f"c {CLAIMS}").schema["c"].dataType.valueType.elementType["mainsnak"].dataType["datavalue"].dataType
    assert drift.same_schema(schema, declared)


def test_qualifiers_and_references_are_kept(spark):
    inner = {"P2": [snak("string", "q", {"en": "e"}, "P2")]}
    record = json.dumps({"P1": [{"mainsnak": snak("string", "s", {"en": "e"}), "rank": "normal", "references": [inner], "qualifiers": inner}]})
    row = statements(spark, ("a", record)).first()
    assert row["qualifiers"]["P2"][0]["datavalue"]["datavalue__string"] == "q" and row["references"][0]["P2"][0]["property"] == "P2"


@pytest.mark.parametrize(("json_text", "want"), [("{}", [(None, None)]), (None, []), ("[]", []), ("null", []), ("{broken", []), ('{"en":{"language":"en","value":"a"},"en":{"language":"en","value":"b"}}', [("en", "b")])])
def test_terms(spark, json_text, want):
    df = normalise.processed(spark.createDataFrame([("a", json_text)], "id string, labels string"), "labels")
    assert rows(flatten.flatten(df, "labels"), "language", "value") == want


def test_alias_lists(spark):
    text = '{"en":[{"language":"en","value":"a"},{"language":"en","value":"b"}],"fr":[]}'
    df = normalise.processed(spark.createDataFrame([("a", text)], "id string, aliases string"), "aliases")
    assert rows(flatten.flatten(df, "aliases"), "id", "language", "value") == [("a", "en", "a"), ("a", "en", "b"), ("a", None, None)]


def test_drift(spark):
    df = lambda *x: spark.createDataFrame([(v,) for v in x], "j string")
    drift.check(df('{"en":{"language":"en","value":"x"}}', "{}", None, '{"fr":{"language":"fr"}}'), "j", TERMS)
    for bad in ('{"en":{"language":"en","value":"x","more":1}}', '{"en":{"language":1}}', '{"en":"x"}'):
        with pytest.raises(drift.SchemaDriftError):
            drift.check(df(bad), "j", TERMS)
    good = entity("a", snak("string", "x", {"en": "e"}), snak("wikibase-item", {"id": "Q", "labels": {"a b": "x"}}, {"zh-hant": "z"}))[1]
    drift.check(df(good), "j", PARSED_CLAIMS)
    with pytest.raises(drift.SchemaDriftError):
        drift.check(df(good.replace('"rank"', '"place"')), "j", PARSED_CLAIMS)


@pytest.mark.parametrize("name", ["normalise_claims", "claims_wikibase_join"])
def test_claims_of_a_small_file_are_decoded_by_all_cores_and_once(spark, tmp_path, name):
    part = [(i, f"name {i}", f"brand {i % 5}", f"type {i % 7}", i % 50 + 1) for i in range(1, 400)]
    spark.createDataFrame(part, "p_partkey int, p_name string, p_brand string, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    df = catalogue.QUERIES[name](spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression") :]
    assert plan.count("from_json") == plan.count("RepartitionByExpression") and "from_json" not in below.split("\n", 1)[1].split("RepartitionByExpression")[-1]
    assert df.count() > 50
