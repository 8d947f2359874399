"""Sources, ledger, sinks, audits, planning and the runners on small files."""

import json
import os
import random

import pytest

from babelmill.functions import names
from babelmill.functions.drift import SchemaDriftError
from babelmill.functions.schemas import KEYS, Step
from babelmill.operators import analytics, audit, ledger, planning, sink
from babelmill.plans import run
from babelmill.sources import files
from babelmill.streaming.incremental import follow


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


def write_entities(spark, folder, chunk=0, parts=2):
    for part in range(parts):
        made = []
        for i in range(6):
            term = {x: {"language": x, "value": f"v{i}"} for x in ("en", "fr", "zh-hant", "01", "a/b")[: i % 5 + 1]}
            claim = {"P1": [{"mainsnak": {"property": "P1", "datavalue": "s", "datatype": "string", "property-labels": {"en": "e", "fr": "f"}}, "rank": "normal", "references": [], "qualifiers": {}}]}
            site = {"enwiki": {"site": "enwiki", "title": f"T{i}", "badges": []}}
            made.append((f"Q{part}{i}", json.dumps(term), json.dumps(term if i else {}), json.dumps({k: [v, v] for k, v in term.items()}), json.dumps(site), json.dumps(claim)))
        df = spark.createDataFrame(made, "id string, labels string, descriptions string, aliases string, sitelinks string, claims string")
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}-tmp")
        found = next(f for f in os.listdir(f"{folder}-tmp") if f.endswith(".parquet"))
        os.makedirs(folder, exist_ok=True)
        os.rename(f"{folder}-tmp/{found}", f"{folder}/chunk_{chunk}-{part:05d}-of-{parts:05d}.parquet")


def test_names(spark):
    df = spark.createDataFrame([("d/chunk_12-00003-of-00546.jsonl", 1610612736), ("other", 0), (None, None)], "f string, n long")
    out = df.select(names.chunk("f").alias("c"), names.part("f").alias("p"), names.basename("f").alias("b"), names.to_parquet("f").alias("q"), names.gigabytes("n").alias("g"), names.between("f").alias("t"))
    assert [tuple(r) for r in out.collect()] == [(12, 3, "chunk_12-00003-of-00546.jsonl", "d/chunk_12-00003-of-00546.parquet", 1.5, "12"), (None, None, "other", "other", 0.0, None), (None,) * 6]
    assert names.chunk_glob() == "chunk_*-*.parquet" and names.chunk_glob(3) == "chunk_3-*.parquet"


def test_sources(spark, tmp_path):
    write_entities(spark, f"{tmp_path}/in", 0)
    write_entities(spark, f"{tmp_path}/in", 1, 1)
    assert files.entities(spark, f"{tmp_path}/in").count() == 18
    assert {r["chunk"] for r in files.entities(spark, f"{tmp_path}/in", 1).collect()} == {1}
    listing = files.listing(spark, f"{tmp_path}/in")
    assert {(r["file"], r["size"]) for r in listing.collect()} == {(f, os.path.getsize(f"{tmp_path}/in/{f}")) for f in os.listdir(f"{tmp_path}/in") if f.endswith(".parquet")}
    assert files.listing(spark, f"{tmp_path}/nothing").count() == 0
    assert files.tree(spark, str(tmp_path)).count() >= 18
    os.makedirs(f"{tmp_path}/state")
    for i in range(3):
        with open(f"{tmp_path}/state/chunk_0-{i:05d}-of-3.jsonl", "w") as f:
            f.write(json.dumps({"step": i}) + "\n")
    assert rows(files.states(spark, f"{tmp_path}/state/*.jsonl"), "step") == [(0,), (1,), (2,)]
    assert files.states(spark, f"{tmp_path}/none/*.jsonl").columns == ["file", "step"]
    sink.write_sizes(spark.createDataFrame([("a", 1, 0.5)], files.LISTING), f"{tmp_path}/sizes")
    assert rows(files.size_table(spark, f"{tmp_path}/sizes")) == [("a", 1, 0.5)]


def test_demo_rows_have_exact_shares(spark, tmp_path):
    assert len(files.DEMO_SHARES) == 37
    demo = files.demo_rows(spark, 20_000, chunks=4)
    share = {r["language"]: r["rows"] for r in analytics.distribution(demo, "language").collect()}
    assert share == {k: int(20_000 * v + 1e-9) for k, v in files.DEMO_SHARES.items() if k != "en"} | {"en": 20_000 - sum(int(20_000 * v + 1e-9) for k, v in files.DEMO_SHARES.items() if k != "en")}
    first = [r["language"] for r in demo.where("chunk = 0").limit(100).collect()]
    assert len(set(first)) > 15 and demo.select("id").distinct().count() == 20_000
    files.write_demo(demo, f"{tmp_path}/demo", 4)
    assert sorted(os.listdir(f"{tmp_path}/demo"))[-1] == "chunk_3-00003-of-00004.parquet"
    assert rows(spark.read.parquet(f"{tmp_path}/demo").groupBy("chunk").count()) == [(i, 5000) for i in range(4)]
    assert files.demo_rows(spark, 0).count() == 0 and files.demo_rows(spark, 7, {"fr": 1 / 7}, 2).where("language = 'fr'").count() == 1


def test_chunks_run_once_and_again(spark, tmp_path):
    source, target, remote = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/remote"
    write_entities(spark, source, 0)
    write_entities(spark, source, 1, 1)
    assert run.run_all(spark, source, target) == [0, 1] and run.run_all(spark, source, target) == []
    read = lambda t: rows(sink.read_partitions(spark, f"{target}/flat/{t}"), "id", KEYS[t], "source_file")
    before = {t: read(t) for t in KEYS}
    assert {k for _, k, _ in before["labels"]} == {"en", "fr", "zh-hant", "01", "a/b"}
    assert len(before["claims"]) == 18 * 2 and len(before["links"]) == 18
    bad = run.run_chunk(spark, source, target, 0)
    assert bad == {"labels": 0, "descriptions": 2, "aliases": 0, "links": 0, "claims": 0}
    assert {t: read(t) for t in KEYS} == before
    assert run.check_chunk(spark, target, 0).count() == 0
    one = sink.read_partitions(spark, f"{target}/flat/labels").where("language = 'en'")
    assert "PartitionFilters: [isnotnull(language" in one._jdf.queryExecution().executedPlan().toString()
    assert run.run_all(spark, source, target, remote) == [0, 1] and run.run_all(spark, source, target, remote) == []
    state = ledger.state(ledger.history(spark, f"{target}/ledger"))
    assert rows(state.groupBy("step").count()) == [(int(Step.COMPLETE), 3)]
    assert rows(spark.read.parquet(f"{remote}/links"), "id") == rows(spark.read.parquet(f"{target}/flat/links"), "id")
    kept = sink.read_partitions(spark, f"{target}/flat/labels").where("language = 'fr' and source_file like 'chunk_0-00000%'")
    sink.write_partitions(kept.orderBy("id").limit(1).select("id", "language", "value", "source_file"), "language", f"{target}/flat/labels")
    assert rows(run.check_chunk(spark, target, 0), "table", "key", "rows_before", "rows_after") == [("labels", "fr", 4, 1)]
    assert run.check_chunk(spark, target, 1).count() == 0


def test_a_new_file_leaves_the_others_alone(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    write_entities(spark, source, 0, 1)
    assert run.run_all(spark, source, target) == [0]
    old = {f: os.stat(os.path.join(at, f)).st_mtime_ns for at, _, found in os.walk(f"{target}/flat") for f in found if f.endswith(".parquet")}
    os.rename(f"{source}/chunk_0-00000-of-00001.parquet", f"{tmp_path}/kept")
    write_entities(spark, source, 0, 2)
    os.replace(f"{tmp_path}/kept", f"{source}/chunk_0-00000-of-00001.parquet")
    os.remove(f"{source}/chunk_0-00000-of-00002.parquet")
    assert run.run_all(spark, source, target) == [0]
    now = {f: os.stat(os.path.join(at, f)).st_mtime_ns for at, _, found in os.walk(f"{target}/flat") for f in found if f.endswith(".parquet")}
    assert old.items() <= now.items() and len(now) > len(old)
    assert run.check_chunk(spark, target, 0).count() == 0


def test_partitions_that_a_file_no_longer_has_go(spark, tmp_path):
    target = f"{tmp_path}/t"
    first = spark.createDataFrame([("a b%", "Q1", "en"), ("a b%", "Q2", "fr"), ("g", "Q3", "fr"), ("a b%", "Q4", "")], "source_file string, id string, language string")
    found, bad = sink.write_audited(first, "labels", "language", target, ["a b%", "g", "none"])
    assert bad == 1 and rows(found, "source_file", "key", "rows") == [("a b%", "en", 1), ("a b%", "fr", 1), ("g", "fr", 1), ("none", None, 0)]
    found, _ = sink.write_audited(first.where("language = 'en'"), "labels", "language", target, ["a b%"])
    assert rows(found, "key", "rows") == [("en", 1)]
    assert rows(sink.read_partitions(spark, target), "source_file", "language") == [("a b%", "en"), ("g", "fr")]


def test_publishing_is_taken_up_again(spark, tmp_path):
    here, there = f"{tmp_path}/here", f"{tmp_path}/there it is"
    spark.range(100).selectExpr("id", "id % 3 as language").write.partitionBy("language").parquet(here)
    assert sink.publish(spark, here, there) > 0 and sink.publish(spark, here, there) == 0
    found = [os.path.join(at, f) for at, _, names in os.walk(there) for f in names if f.endswith(".parquet")]
    with open(found[0], "w") as f:
        f.write("cut")
    with open(f"{there}/old.parquet", "w") as f:
        f.write("old")
    assert sink.publish(spark, here, there) == 1
    assert spark.read.parquet(there).count() == 100 and not os.path.exists(f"{there}/old.parquet")


def test_drift_stops_a_run(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    write_entities(spark, source, 0, 1)
    df = spark.createDataFrame([("Q9", json.dumps({"en": {"language": "en", "value": "v", "fresh": 1}}), "{}", "{}", "{}", "{}")], "id string, labels string, descriptions string, aliases string, sitelinks string, claims string")
    df.coalesce(1).write.parquet(f"{tmp_path}/odd")
    os.rename(next(f"{tmp_path}/odd/{f}" for f in os.listdir(f"{tmp_path}/odd") if f.endswith(".parquet")), f"{source}/chunk_1-00000-of-00001.parquet")
    with pytest.raises(SchemaDriftError, match="fresh"):
        run.run_all(spark, source, target)
    state = {r["chunk"]: r["step"] for r in ledger.state(ledger.history(spark, f"{target}/ledger")).collect()}
    assert state == {0: int(Step.PARTITION), 1: int(Step.PULL)}


def test_sizes_must_agree(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    write_entities(spark, source, 0, 1)
    expected = files.listing(spark, source).withColumn("size", files.F.col("size") + 1)
    with pytest.raises(sink.AuditError, match="size"):
        run.run_all(spark, source, target, sizes=expected)


def test_files_are_followed(spark, tmp_path):
    source, target, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    write_entities(spark, source, 0)
    follow(spark, source, target, "labels", state, 1).awaitTermination()
    first = sink.read_partitions(spark, f"{target}/flat/labels").count()
    write_entities(spark, source, 1)
    follow(spark, source, target, "labels", state, 1).awaitTermination()
    assert sink.read_partitions(spark, f"{target}/flat/labels").count() == 2 * first > 0


def test_ledger(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    assert ledger.history(spark, path).count() == 0
    for seq, step in enumerate((Step.INIT, Step.PULL, Step.COMPLETE)):
        ledger.append(spark, path, ["chunk_0-00000-of-2.jsonl"], step, seq)
    ledger.append(spark, path, ["chunk_0-00001-of-2.jsonl", "chunk_3-00000-of-1.jsonl"], Step.PULL, 0)
    now = ledger.state(ledger.history(spark, path))
    assert rows(now, "chunk", "part", "step") == [(0, 0, 6), (0, 1, 1), (3, 0, 1)]
    assert rows(ledger.next_chunk(now)) == [(0,)]
    assert rows(ledger.next_chunk(now.where("step = 6"))) == [(None,)]
    assert rows(ledger.files_to_pull(now, 0)) == [("chunk_0-00001-of-2.parquet",)]
    assert ledger.seed(spark, path, ["chunk_0-00000-of-2.jsonl", "chunk_9-00000-of-1.jsonl"]) == ["chunk_9-00000-of-1.jsonl"]
    ledger.append(spark, path, ["chunk_3-00000-of-1.jsonl"], Step.INIT)  # later runs come after earlier ones
    again = ledger.state(ledger.history(spark, path))
    assert rows(again.where("chunk >= 3"), "chunk", "step") == [(3, 0), (9, 0)]
    asked = spark.createDataFrame([("chunk_0-00000-of-2.parquet",), ("chunk_0-00001-of-2.jsonl",), ("nowhere.jsonl",)], "file string")
    assert rows(ledger.step_of(now, asked, Step.PROCESS), "step", "reached") == sorted([(6, True), (1, False), (None, False)], key=str)
    assert rows(ledger.gates(now)) == [(0, 1, False, False), (3, 1, False, False)]


def test_audits(spark):
    f = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "file string, size long")
    found = spark.createDataFrame([("a", 1), ("b", 5)], "file string, size long")
    assert rows(audit.verify_sizes(f, found)) == [("a", 1, 1, True), ("b", 2, 5, False), ("c", 3, None, False)]
    twice = found.unionAll(found)
    assert rows(audit.present_in_all(f, {"x": twice, "y": found.where("file = 'a'")})) == [("a", True, True, True), ("b", True, False, False), ("c", False, False, False)]
    present = found.selectExpr("'x' as table", "file")
    assert rows(audit.missing_outputs(f, ["x", "y"], present), "table", "file") == [("x", "c"), ("y", "a"), ("y", "b"), ("y", "c")]
    a = spark.createDataFrame([("1",), ("2",)], "id string")
    assert rows(audit.id_preservation(a, a.where("id = '1'"))) == [(2, 1, 1)]
    side = sink.sidecar(spark.createDataFrame([("f", "en", "Q1"), ("f", "en", "Q2"), ("f", None, "Q3")], "source_file string, language string, id string"), "labels", "language")
    assert rows(side) == [("f", "labels", "en", 2, "Q1", "Q2"), ("f", "labels", None, 1, "Q3", "Q3")]
    assert sink.post_check(side, side).count() == 0
    assert rows(sink.post_check(side, side.where("key is not null")), "key", "rows_before", "rows_after") == [(None, 1, None)]


def test_plans(spark):
    key = [(p, q, s) for p in (True, False) for q in (True, False) for s in (0, 1)]
    df = spark.createDataFrame(key, "already_pushed boolean, local_ok boolean, step long")
    assert rows(ledger.pull_plan(df).groupBy("plan").count()) == [("already_pushed", 4), ("local_ok", 1), ("mark_pulled", 1), ("need_download", 2)]
    totals = spark.createDataFrame([(i, 10) for i in range(10)], "chunk long, size long")
    done = totals.where("chunk = 4")
    assert rows(planning.prefetch(totals, 2, 5, 30, done)) == [(3, 10, 10), (5, 10, 20), (6, 10, 30)]


def test_analytics_against_a_model(spark):
    rng = random.Random(3)
    values = [rng.choice([1, 5, 5, 9, rng.randrange(1, 400)]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "k long, v long")
    order = sorted(values)
    got = rows(analytics.cumulative(df.unionAll(spark.createDataFrame([(None, None)], df.schema)), "v", 7))
    assert got == sorted(((v, order.count(v), order.index(v), sum(order[: order.index(v)])) for v in set(order)), key=str)
    want = [(v, i, sum(order[:i])) for i, v in enumerate(order, 1)]
    n, total, gini = rows(analytics.gini(df, "v"))[0]
    lorenz = [0] + [w[2] / total for w in want]
    area = sum((a + b) / 2 / n for a, b in zip(lorenz, lorenz[1:]))
    assert gini == pytest.approx(1 - 2 * area)
    for percent in (1, 50, 80, 99, 100):
        share = rows(analytics.share_count(df, "v", percent))[0]
        at = next(w for w in want if w[2] * 100 >= total * percent)
        assert share == (at[1], at[0], at[2])
    assert rows(analytics.numbered(df, "k").select("k", "row")) == sorted(((i, i) for i in range(500)), key=str)
    assert rows(analytics.peak(df, "v", "k")) == [min((-v, k) for k, v in enumerate(values))[::-1][:1] + (max(values),)]
    assert [r["v"] for r in analytics.top(df, "v", 2).collect()] == sorted(set(values), key=lambda v: (-values.count(v), v))[:2]
