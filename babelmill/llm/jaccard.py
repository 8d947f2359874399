"""N-gram Jaccard join of documents over parity sketches.

A document is the set of its word n-grams. A sketch flips one parity bit for every n-gram, chosen by its hash. XOR
cancels what two sets share, so the Hamming distance of two sketches is at most the size of their symmetric difference,
which a Jaccard index of t bounds by D = (1-t)/(1+t) (|A|+|B|).

* Two sets of index t and more share an n-gram of both prefixes: of x n-grams, from rare to frequent, the first
  x - ceil(t x) + 1. Those are the keys (see ``candidates``), so no pair at the threshold is left out at any size.
* Candidates are pruned by the Hamming bound on folded, dense sketches, then verified by the exact Jaccard index.

Contract of ``duplicate_groups``: a row (doc_id, group_id, links, partner_id, jaccard) for each document of each group of
two and more. group_id is the smallest doc_id of the group; links is the number of documents, copies included, with
which its Jaccard index is at least t; partner_id is the closest of them, jaccard that index. Groups are the connected
components of the join at threshold t. All different texts of a group are compared, so within groups no link is lost
and none listed; the index of links and partners is that of 44-bit hashes of n-grams, groups are verified on the words.

* NULL ids and NULL texts take no part; texts without words (empty ones) match nothing, not even each other; a text
  of fewer than n words is one n-gram.
* rows that repeat an id are one document, represented by the text of the smallest hash; equal texts under different ids
  are partners with index 1; ties of the index are resolved to the smallest partner.
* an empty table gives an empty table; only id and text are read.

Contract of ``keep_one``: the input rows, all columns, but for documents whose doc_id isn't the smallest of its group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, release
from .blobs import by_text, tune, unused
from .candidates import Sets, matched, prefix_pairs, within
from .grams import N, gram_sets, word_ngrams
from .text import U, mix
from .tiles import compared

LEAST = 0.55


def dense_sketch(gram: np.ndarray, t: float) -> np.ndarray:
    """A packed parity sketch of 2**w bits, at least 2 a possible differing n-gram; halves fold onto each other by XOR."""
    width = 1 << max(8, math.ceil(math.log2(2 * max(len(gram), 1) * (1 - t) / (1 + t) * (1 + 1 / t))))
    bits = np.bincount((mix(gram, 6) & U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8))


def hamming(a: pa.BinaryArray, b: pa.BinaryArray) -> np.ndarray:
    """The distances of packed sketches, row by row, at the width of the shorter one."""

    def parts(x: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, offsets, data = x.buffers()
        at = np.frombuffer(offsets, np.int32)[x.offset : x.offset + len(x) + 1].astype(np.int64)
        return np.frombuffer(data, np.uint8), at[:-1], np.diff(at)

    def fold(data: np.ndarray, begin: np.ndarray, size: int, to: int) -> np.ndarray:
        rows = data[begin[:, None] + np.arange(size)]
        return np.bitwise_xor.reduce(rows.reshape(len(begin), size // to, to), axis=1)

    (da, sa, la), (db, sb, lb) = parts(a), parts(b)
    out = np.zeros(len(a), np.int64)
    for x, y in np.unique(np.stack([la, lb], axis=1), axis=0).tolist():
        rows = np.flatnonzero((la == x) & (lb == y))
        for low in range(0, len(rows), 4096):
            i = rows[low : low + 4096]
            to = min(x, y)
            out[i] = np.bitwise_count(fold(da, sa[i], x, to) ^ fold(db, sb[i], y, to)).sum(axis=1)
    return out


def contents(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text, h, check): the rows that take part, with two hashes of the text."""
    docs = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return docs.where("id is not null").where(F.col("text").rlike(r"[^ \t\n\x0B\f\r]")).withColumns({"h": F.xxhash64("text"), "check": F.xxhash64("text", F.lit(1))})


def classes(docs: DataFrame) -> DataFrame:
    """(id, h): of each document the hash of its text. Of texts that share ``h`` but not ``check`` one alone has a class."""
    one = docs.groupBy("id").agg(F.min(F.struct("h", "check")).alias("t")).select("id", "t.h", "t.check")
    kept = one.groupBy("h").agg(F.min("check").alias("check"))
    return cut(one.join(kept, ["h", "check"]).select("id", "h"))


def alike(docs: DataFrame, least: float = LEAST, n: int = N) -> DataFrame:
    """(node, root) over text hashes: the components of two and more different texts, from (id, text, h, check) rows.

    Equal texts are one member of every key group, so that copies cost no comparisons. Texts travel only where sketches
    leave a pair of them to be verified.
    """
    partitions = tune(docs.sparkSession)
    texts = docs.select(F.col("h").alias("id"), "text")
    several = docs.groupBy("h").agg(F.min("check").alias("x"), F.max("check").alias("y")).where("x <> y").select("h", "x").collect()
    for h, check in several:  # different texts of one hash, of which one alone has a class
        docs = docs.where((F.col("h") != h) | (F.col("check") == check))
        texts = docs.select(F.col("h").alias("id"), "text")

    def sketch(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        text, gram = gram_sets(texts, n)
        parts = np.split(gram, np.cumsum(np.bincount(text, minlength=len(texts)))[:-1])
        sketches = [dense_sketch(part, least).tobytes() for part in parts]
        columns = [pa.array(ids, pa.int64()), pa.array([len(x) for x in parts], pa.int32()), pa.array(sketches, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "grams", "sketch"])

    def elements(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text, gram = gram_sets(texts, n)
        return text, mix(gram, 13)

    found = prefix_pairs(texts, partitions, elements, least)
    release(docs.sparkSession)
    needed = found.select(F.col("a").alias("id")).unionAll(found.select("b")).distinct()
    sketches = cut(within(texts, needed).mapInArrow(by_text(sketch), "id long, grams int, sketch binary").dropDuplicates(["id"]))
    left = sketches.select(F.col("id").alias("a"), F.col("grams").alias("grams_a"), F.col("sketch").alias("sketch_a"))
    right = sketches.select(F.col("id").alias("b"), F.col("grams").alias("grams_b"), F.col("sketch").alias("sketch_b"))
    ratio = (1 - least) / (1 + least)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y, both = (batch.column(name) for name in ("a", "b", "sketch_a", "sketch_b", "both"))
            kept = np.flatnonzero(hamming(x, y) <= both.to_numpy() * ratio + 1e-6)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).take(pa.array(kept))

    def prune(pairs: DataFrame) -> DataFrame:
        sized = pairs.join(left, "a").join(right, "b").where(F.least("grams_a", "grams_b") >= least * F.greatest("grams_a", "grams_b"))
        return sized.select("a", "b", "sketch_a", "sketch_b", (F.col("grams_a") + F.col("grams_b")).alias("both")).mapInArrow(near, "a long, b long")

    def items(ids: DataFrame) -> DataFrame:
        return within(texts, ids).dropDuplicates(["id"])

    return matched(found, items, partitions, Sets(lambda text: word_ngrams(text, n), elements), least, prune)


def duplicate_groups(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = LEAST, n: int = N) -> DataFrame:
    """Every document that has a partner, with its group, its links and the closest partner of all.

    The links of different texts are counted in tiles (see ``tiles``): all texts of a group are compared, none listed.
    """
    docs = contents(df, id_column, text_column)
    owned = classes(docs)
    ranked = owned.withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("id"))).where("rank <= 2")
    firsts = ranked.groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("second"))
    sizes = owned.groupBy("h").agg(F.count("*").alias("copies"))
    joined = alike(docs, least, n)
    known = firsts.join(sizes, "h").join(joined, F.col("h") == F.col("node"), "left").where("node is not null or copies > 1")
    texts = cut(known.select("h", "first", "second", "copies", F.coalesce("root", "h").alias("root")))
    roots = texts.groupBy("root").agg(F.min("first").alias("group_id"), F.count("*").alias("texts"))
    group = texts.join(roots.where("texts > 1"), "root").select(F.col("first").alias("node"), "root", F.col("copies").alias("weight"), F.col("h").alias("hash"))
    asked = group.select(F.col("node").alias("id"), "hash")
    sized = within(docs, asked).select("id", "text", "h", F.octet_length("text").alias("size"))
    own = F.col("h").bitwiseXOR(F.col("hash")) == 0  # no key of the join: texts stay where the next join, by id, needs them
    spelt = sized.join(asked, "id").where(own).select("id", "text", "size")  # a semi join would be moved before the sieve
    release(df.sparkSession)
    found = compared(spelt, group.drop("hash"), tune(df.sparkSession), n, 1, least)
    best = found.groupBy("a").agg(F.max(F.struct("similarity", (-F.col("b")).alias("minus"))).alias("best"), F.sum("links").alias("links"))
    other = texts.join(roots, "root").join(best, F.col("first") == F.col("a"), "left")
    rows = owned.join(other, "h")
    near = F.when(F.col("best.similarity").isNotNull(), F.struct(F.col("best.similarity").alias("jaccard"), F.col("best.minus").alias("minus")))
    twin = F.when(F.col("copies") > 1, F.struct(F.lit(1.0).alias("jaccard"), (-F.when(F.col("id") == F.col("first"), F.col("second")).otherwise(F.col("first"))).alias("minus")))
    links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    out = rows.select("id", "group_id", links.alias("links"), F.greatest(near, twin).alias("partner"))
    return out.select(F.col("id").alias("doc_id"), "group_id", "links", (-F.col("partner.minus")).alias("partner_id"), F.col("partner.jaccard").alias("jaccard"))


def keep_one(docs: DataFrame, least: float = LEAST, n: int = N) -> DataFrame:
    """The documents without those that a smaller doc_id of their group stands for."""
    found = contents(docs, "doc_id", "text")
    owned = classes(found)
    rooted = owned.join(alike(found, least, n), F.col("h") == F.col("node"), "left").select("id", F.coalesce("root", "h").alias("root"))
    first = rooted.groupBy("root").agg(F.min("id").alias("first"))
    name = unused(docs, "_other")
    others = rooted.join(first, "root").where("id <> first").select(F.col("id").alias(name))
    return docs.join(others, F.col("doc_id").cast("long") == F.col(name), "left_anti")
