"""Personal identifiers by bootstrapped contextual extraction.

Candidates are spans with a digit or an at sign; after a secret's name, the whole value up to a blank or quote. Each has
lexical patterns: its exact shape (digits 9, letters a and A), its collapsed shape, and the whole words beside it in its
line together with that shape. Seeds are candidates that a validator
accepts (mail addresses, dotted quads in range, numbers with a valid checksum or a card issuer's range, telephone numbers of the numbering
plan, long values with a digit that are assigned to a secret's name) or rejects (short numbers). From the seeds Spark scores the bipartite
graph of patterns and instances in turns: a pattern's confidence is the share of its instances that are identifiers,
an instance's score is the best confidence among its patterns. Confident patterns so find identifiers that no
validator knows: area codes outside the plan, card-like numbers of no issuer whose checksum fails, secrets without a name.

Contract of ``find_identifiers``: a row (doc_id, start, end, kind, score) for each span; offsets count characters;
``kind`` is the collapsed shape. The text of an identifier isn't in the result.

* NULL text takes no part, empty text has no spans; spans in rows with a NULL id are found, with a NULL doc_id.
* rows that repeat give repeated spans; spans of one text don't overlap; ties of confidence don't matter (the best counts).
* very long texts are scanned whole; an empty table gives an empty table; only id and text are read.

Contract of ``redact``: the input rows, all columns, with each span replaced by ``MARK``; a column ``n_chars`` is set
to the new length where there is one; rows without spans, NULL texts among them, are unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .blobs import named, tune, unused
from .text import codes, prefix, span_hash

MARK = "[PRIVATE]"
TURNS = 4
UNKNOWN = 0.03  # how much an instance of unknown kind counts against its pattern
PRIOR = 0.5  # added to the count against every pattern, so that one instance proves little
LEAST = 0.6
SUPPORT = 2  # identifiers that a pattern must have to be believed

REGION = re.compile(r"\S*[0-9@]\S*(?:[ \t]+\S*[0-9@]\S*)*")
HOT = re.compile(r"[0-9@]")
SPAN = re.compile(
    r"[\w.+%-]+@[\w-]+(?:\.[\w-]+)+"
    r"|(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w.][\w])"
    r"|(?<!\w)(?:\+?[0-9]{1,2}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?!\w)"
    r"|(?<!\w)\+?\(?[0-9](?:[0-9().:/-]|(?<![0-9]{7})[ ](?=[(0-9]))*[0-9](?!\w)"
    r"|\w*[0-9]\w*"
)
MAIL = re.compile(r"[\w.+%-]+@(?:[\w-]+\.)+[a-z]{2,12}", re.I)
QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
PHONE = re.compile(r"(?:\+1[ .-]?)?\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}")
BANK = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
ISSUER = re.compile(r"4[0-9]{15}|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|6(?:011|5[0-9]{2})[0-9]{12}")
WORDS = 4  # words before a candidate that its seed rule and patterns may look at
VALUE = re.compile(r"[\w/+=~.-]+")
SECRET = re.compile(r"(?:token|secret|passwo?r?d|api[_ -]?key|credential)\w*\s*[=:]+\s*[\"']?$", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def seed(value: str, before: str) -> int:
    """1 for a validated identifier, -1 for what can't be one, 0 for what isn't known."""
    digits = re.sub(r"\D", "", value)
    if "@" in value:
        return 1 if MAIL.fullmatch(value) else 0
    if QUAD.fullmatch(value):
        return 1 if all(int(x) < 256 for x in value.split(".")) else 0
    if PHONE.fullmatch(value):
        return 1
    if len(value) >= 16 and VALUE.fullmatch(value) and not value.isdigit() and SECRET.search(before):
        return 1
    if BANK.fullmatch(value):
        return 1 if int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1 else 0
    if 13 <= len(digits) <= 19 and re.fullmatch(r"[0-9 -]+", value):
        return 1 if luhn(digits) or ISSUER.fullmatch(digits) else 0
    return -1 if len(value) < 7 or len(digits) < 4 else 0


def shapes(value: str) -> tuple[str, str]:
    """The exact and the collapsed shape; hexadecimal strings are one shape for each length."""
    if len(value) >= 16 and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) and not value.isdigit():
        return f"hex{len(value)}", f"hex{len(value)}"
    exact = "".join("9" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c for c in value)
    collapsed = re.sub(r"[aA]+", "a", exact)
    return exact, re.sub(r"9+", "9", collapsed) if re.search(r"\D", value) else f"9{{{len(value)}}}"


def beside(text: str, at: int, step: int, count: int) -> str:
    """What stands before (step -1) or after (1) a place in its line: as much as holds that many whole words, or all."""
    width = 40
    while True:
        part = text[max(0, at - width) : at].rpartition("\n") if step < 0 else text[at : at + width].partition("\n")
        found, whole = (part[2], part[1] or at <= width) if step < 0 else (part[0], part[1] or at + width >= len(text))
        if whole or len(found.split()) > count:
            return found
        width *= 2


def whole_value(text: str, a: int, b: int) -> tuple[int, int]:
    """The span widened to the blank-free value around it."""
    while a and VALUE.match(text, a - 1, a) and text[a - 1] != "=":
        a -= 1
    return a, VALUE.match(text, b - 1).end()


def scan(text: str) -> Iterator[tuple[int, int, str, int, list[str]]]:
    """(start, end, kind, seed, patterns) of every candidate in a text."""
    at = 0
    while hot := HOT.search(text, at):
        start = hot.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        region = REGION.match(text, start)
        if region is None:
            at = hot.end()
            continue
        done = region.start()
        for found in SPAN.finditer(text, region.start(), region.end()):
            a, b = found.span()
            if a < done:
                continue
            wide = whole_value(text, a, b) if VALUE.match(text, b - 1, b) else (a, b)
            before = beside(text, wide[0], -1, WORDS)
            if wide != (a, b) and wide[0] >= done and SECRET.search(before):
                a, b = wide
            elif wide[0] != a:
                before = beside(text, a, -1, WORDS)
            value, done = text[a:b], b
            while value[-1] in ".:/-_" and len(value) > 1:
                value, b = value[:-1], b - 1
            if not HOT.search(value):
                continue
            after = beside(text, b, 1, 1)
            exact, kind = shapes(value)
            left, right = before.lower().split(), after.lower().split()
            patterns = ["=" + exact, "~" + kind]
            if left:
                patterns += [f"<{' '.join(left[-2:])}|{kind}", f"<{left[-1]}|{kind}"]
            if right:
                patterns.append(f">{right[0]}|{kind}")
            yield a, b, kind, seed(value, before), patterns
        at = max(region.end(), hot.end())


OCCURRENCES = "doc long, h long, start int, stop int, kind string, instance long, seed int, patterns array<string>"


def occurrences(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    tune(df.sparkSession)
    text = F.col(text_column).cast("string")
    docs = df.select(F.col(id_column).cast("long").alias("doc"), text.alias("text"), F.xxhash64(text).alias("h")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = [], []
            for doc, text, h in zip(*(c.to_pylist() for c in batch.columns)):
                for a, b, kind, known, patterns in scan(text):
                    values.append(text[a:b].lower())
                    rows.append((doc, h, a, b, kind, known, patterns))
            if rows:
                c, offsets = codes(values)
                instance = span_hash(prefix(c), offsets[:-1], offsets[1:]).view(np.int64)
                doc, h, a, b, kind, known, patterns = zip(*rows)
                columns = [pa.array(doc, pa.int64()), pa.array(h, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(kind), pa.array(instance), pa.array(known, pa.int32()), pa.array(patterns, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "h", "start", "stop", "kind", "instance", "seed", "patterns"])

    return docs.mapInArrow(run, OCCURRENCES)


def score(found: DataFrame, turns: int = TURNS) -> DataFrame:
    """(instance, score) of the instances that are identifiers, by turns over the pattern-instance graph."""
    seeds = found.groupBy("instance").agg(F.max("seed").alias("top"), F.min("seed").alias("low"))
    seeds = seeds.select("instance", F.when(F.col("top") == 1, 1).when(F.col("low") == -1, -1).otherwise(0).alias("seed"))
    edges = found.select("instance", F.explode("patterns").alias("pattern")).distinct().join(seeds, "instance")
    edges = cut(edges.select("instance", "seed", F.xxhash64("pattern").alias("pattern")))
    now = edges.select("instance", "pattern", "seed", (F.col("seed") == 1).cast("double").alias("score"))
    for _ in range(turns):
        good = F.sum(F.col("score"))
        against = F.sum(F.when(F.col("seed") == -1, 1.0).when(F.col("seed") == 0, UNKNOWN * (1 - F.col("score"))).otherwise(0.0))
        sure = F.sum((F.col("score") >= LEAST).cast("int"))
        believed = now.groupBy("pattern").agg((good / (good + against + PRIOR)).alias("confidence"), sure.alias("sure"))
        believed = believed.where((F.col("sure") >= SUPPORT) & (F.col("confidence") >= LEAST)).select("pattern", "confidence")
        best = edges.join(believed, "pattern").groupBy("instance").agg(F.max("confidence").alias("best"))
        new = F.when(F.col("seed") == 1, 1.0).when(F.col("seed") == -1, 0.0).otherwise(F.coalesce("best", F.lit(0.0)))
        now = cut(edges.join(best, "instance", "left").select("instance", "pattern", "seed", new.alias("score")))
    return now.groupBy("instance").agg(F.max("score").alias("score")).where(F.col("score") >= LEAST)


def spans(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc, h, start, stop, kind, score): h is the hash of the text that the span is in."""
    found = cut(occurrences(df, id_column, text_column))
    return found.join(score(found), "instance").select("doc", "h", "start", "stop", "kind", "score")


def find_identifiers(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every identifier of every document. One scan of the texts; the graph holds only its candidates."""
    return spans(df, id_column, text_column).select(F.col("doc").alias("doc_id"), "start", F.col("stop").alias("end"), "kind", "score")


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with every identifier replaced by MARK."""
    listed, key = unused(docs, "_spans"), unused(docs, "_hash")
    hits = spans(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_column).alias("text")))
    lists = hits.groupBy(F.col("h").alias(key)).agg(F.collect_set(F.struct("start", "stop")).alias(listed))
    joined = docs.join(lists, F.xxhash64(F.col(text_column).cast("string")) == F.col(key), "left").drop(key)
    at, length = named(docs, text_column), named(docs, "n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[:-1])
            texts = columns[at].to_pylist()
            changed = {}
            for i, found in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if found and texts[i] is not None:
                    parts, done = [], 0
                    for span in sorted((s["start"], s["stop"]) for s in found):
                        parts += [texts[i][done : span[0]], MARK]
                        done = span[1]
                    texts[i] = "".join([*parts, texts[i][done:]])
                    changed[i] = len(texts[i])
            columns[at] = pa.array(texts, columns[at].type)
            if length is not None:
                columns[length] = pa.array([changed.get(i, n) for i, n in enumerate(columns[length].to_pylist())], columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
