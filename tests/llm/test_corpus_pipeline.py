"""The pipeline's stages on a small corpus, one after another."""

import random

import corpus_pipeline
import __spark_entry__ as entry
from babelmill.llm import jaccard, lines, private

from .rows import words


def make(tmp_path, spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(160):
        body = words(40, i)
        kind = i % 4
        if kind == 0:
            body = " ".join(w + "%%%" for w in body.split())
        if kind == 1:
            body += f"\nwrite to u{i}@mail.example.com today"
        if i in (30, 50, 70):
            body = rows[14][1].replace("w", "w", 1) + f" extra{i}"
        rows.append((i, body + "\nA line that all of them share, word for word.", "en", "s", len(body)))
        labels.append((i, int(kind > 0), 0))
    rows += [(500, None, "en", "s", None), (501, "", "en", "s", 0)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")


def test_stages(spark, tmp_path):
    make(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        seen.append({r["doc_id"]: r for r in docs.collect()})
        if number < 4:
            assert docs.columns == columns
    graded, lined, single, clear, packed = seen
    assert {i for i in graded if i < 500} == {i for i in range(160) if i % 4} and 500 not in graded
    left = [line for r in lined.values() for line in r["text"].split("\n") if line.strip()]
    assert sum(line.startswith("A line that all") for line in left) == 1
    sets = [lines.line_shingles(x) for x in left]
    assert not any(len(a & b) >= lines.LEAST * len(a | b) for k, a in enumerate(sets) for b in sets[:k])
    grams = {i: jaccard.word_ngrams(r["text"]) for i, r in single.items()}
    assert not any(grams[a] and len(grams[a] & grams[b]) >= jaccard.LEAST * len(grams[a] | grams[b]) for a in grams for b in grams if a < b)
    assert not any("@mail" in r["text"] for r in clear.values()) and sum(private.MARK in r["text"] for r in clear.values()) >= 30
    assert set(packed) == {i for i, r in clear.items() if r["text"].split()}


def test_queries_are_registered():
    found = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert found["pipeline"] is corpus_pipeline.run
    assert set(entry.oracle_sql()) <= set(found)
