"""Packing of related documents into windows, along paths of a nearest-neighbour graph.

1. MinHash signatures of word n-gram sets. Documents that share the minimum of a tree meet in one bucket, where any two
   whose whole signatures agree are linked, or connected by links, however many the bucket holds. The links only say
   which documents form a group: those connected by them.
2. In each group all documents are compared by the exact Jaccard index of their n-gram hashes. Large groups are split
   into chunks, and each pair of chunks is a tile of its own. Each document keeps its ``NEAREST`` most similar partners
   of at least ``LEAST``: the nearest-neighbour graph.
3. Each connected component is walked greedily (with its edges in files beyond ``PIECE`` documents, see below): start at the unvisited document of least degree, go on to the most
   similar unvisited neighbour, start again where there is none.
4. Paths are laid end to end, by component and step, and cut into windows of ``WINDOW`` words.

Contract of ``pack_documents``: rows (window_id, place, doc_id, start_word, end_word): words [start_word, end_word) of
the document fill the window from word ``place`` on. Every word of every document is in exactly one window; every
window but the last is full; window ids count from 0.

* NULL ids, NULL texts and texts without words take no part. Words are runs without ASCII white space.
* rows that repeat an id are packed each (in the order of their texts' lengths and hashes); the graph sees the id once,
  with the n-grams of all its rows.
* ties of similarity go to the smaller id, ties of degree to the smaller id.
* a group of more than ``PIECE`` documents is walked as a whole, like any other, by one task that keeps its edges in files.
* a text longer than a window fills several; an empty table gives an empty table; only id and text are read.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .blobs import by_text, exchange, pack, schema, tune, unpack
from .components import components
from .grams import gram_sets
from .text import U, mix, runs
from .tiles import compared

TREES = 20  # a pair of LEAST shares none of their minima with a probability of 0.0008
SIGNATURE = 64
SMALL = 16  # documents of a bucket of which all pairs are listed; in larger ones enough to connect them
LINK = 0.22  # agreement of signatures, below LEAST as it is an estimate: a lone pair of LEAST has less with a probability of about 0.1
NEAREST = 8
LEAST = 0.3
PIECE = 50_000  # documents of a group from which its walk keeps the edges in files
WINDOW = 2048
N = 3

FIELDS = {"key": "<u8", "doc": "<i8", "signature": f"<V{SIGNATURE}"}


def signatures(texts: list[str], n: int = N, size: int = SIGNATURE) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the texts with words, their (texts, size) minima of 32 bits)."""
    text, gram = gram_sets(texts, n)
    if not len(text):
        return np.zeros(0, np.int64), np.zeros((0, size), np.uint32)
    begin = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    base = (mix(gram, 8) >> U(32)).astype(np.uint32)
    draws = np.random.default_rng(6)
    flips, factors = draws.integers(0, 1 << 32, size, dtype=np.uint32), draws.integers(0, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    out = np.empty((len(begin), size), np.uint32)
    for i in range(size):
        out[:, i] = np.minimum.reduceat((base ^ flips[i]) * factors[i], begin)
    return text[begin], out


def spanning(signature: np.ndarray, least: float = LINK) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): pairs of rows that agree, enough to connect all that a chain of such pairs connects."""
    left, found = np.arange(len(signature)), []
    while len(left):
        reached, left = [int(left[0])], left[1:]
        for i in reached:  # grows
            if not len(left):
                break
            near = np.concatenate([(signature[left[low : low + (1 << 15)]] == signature[i]).mean(axis=1) >= least for low in range(0, len(left), 1 << 15)])
            j, left = left[near], left[~near]
            reached += j.tolist()
            found.append((np.full(len(j), i), j))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def links(docs: DataFrame) -> DataFrame:
    """(a, b): enough pairs of alike documents to connect those of a group."""
    partitions = tune(docs.sparkSession)

    def send(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        which, minima = signatures(texts)
        doc = np.array(ids, np.int64)[which] if len(which) else which
        coarse = np.ascontiguousarray((minima & np.uint32(255)).astype(np.uint8)).view(f"V{SIGNATURE}").ravel()
        key = np.concatenate([mix(minima[:, t].astype(U), 40 + t) for t in range(TREES)])
        yield pack(key, partitions, {"key": key, "doc": np.tile(doc, TREES), "signature": np.tile(coarse, TREES)})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for _, x in unpack(batches, FIELDS):
            order = np.lexsort((x["doc"], x["key"]))
            key, doc = x["key"][order], x["doc"][order]
            again = np.append(key[1:] == key[:-1], False)[: len(key)]
            order = order[again | np.append(False, again)[: len(key)]]  # those that are alone in a bucket have no partner there
            key, doc, signature = x["key"][order], x["doc"][order], x["signature"][order].view("u1").reshape(-1, SIGNATURE)
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
            size = np.diff(np.append(first, len(key)))
            small = np.repeat(size <= SMALL, size)
            for ahead in range(1, SMALL):
                i = np.flatnonzero((key[:-ahead] == key[ahead:]) & small[ahead:]) if len(key) > ahead else np.zeros(0, np.int64)
                for low in range(0, len(i), 1 << 15):
                    p = i[low : low + (1 << 15)]
                    p = p[(signature[p] == signature[p + ahead]).mean(axis=1) >= LINK]
                    yield pairs(doc[p], doc[p + ahead])
            for begin, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist()):
                own = doc[begin : begin + n]
                i, j = spanning(signature[begin : begin + n])
                yield pairs(own[i], own[j])

    sent = docs.mapInArrow(by_text(send), schema(FIELDS))
    return exchange(sent, partitions).mapInArrow(meet, "a long, b long").where("a <> b").distinct()


def grouped_documents(docs: DataFrame) -> DataFrame:
    """(node, root, weight) of the documents that are linked with another."""
    return components(links(docs)).withColumn("weight", F.lit(1).cast("long"))


def graph(docs: DataFrame, nearest: int = NEAREST, least: float = LEAST, group: DataFrame | None = None) -> DataFrame:
    """(root, a, b, similarity): for each document a of a group its nearest partners b, at most ``nearest``."""
    group = grouped_documents(docs) if group is None else group
    pairs = compared(docs, group, tune(docs.sparkSession), N, nearest, least)
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b")))
    return ranked.where(F.col("rank") <= nearest).drop("rank", "links")


def neighbours(docs: DataFrame, nearest: int = NEAREST, least: float = LEAST) -> DataFrame:
    """(a, b, similarity): for each document a its nearest partners b, at most ``nearest``."""
    return graph(docs, nearest, least).drop("root")


def parts(edges: list[tuple[int, int, float]]) -> dict[int, list[tuple[int, int, float]]]:
    """The edges of each connected component, by its smallest node."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b, _ in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    out: dict[int, list[tuple[int, int, float]]] = {}
    for edge in edges:
        out.setdefault(find(edge[0]), []).append(edge)
    return out


def walk(edges: list[tuple[int, int, float]]) -> list[int]:
    """The nodes of a component in the order of greedy walks that start at the least degree."""
    near: dict[int, dict[int, float]] = {}
    for a, b, similarity in edges:
        near.setdefault(a, {})[b] = similarity
        near.setdefault(b, {})[a] = similarity
    seen: set[int] = set()
    order: list[int] = []
    for start in sorted(near, key=lambda x: (len(near[x]), x)):
        at: int | None = start
        while at is not None and at not in seen:
            seen.add(at)
            order.append(at)
            at = min((x for x in near[at] if x not in seen), key=lambda x: (-near[at][x], x), default=None)
    return order


def walk_files(near: Iterator[tuple[np.ndarray, np.ndarray]], folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, root, step) of all components of a group, walked as by ``walk``, with the edges in files of the folder.

    near: (a, b) arrays of both directions of all edges, by a, then falling similarity, then b. Memory holds some
    numbers a document and none an edge.
    """
    begins, nodes, done, last = [], [], 0, (None, None)
    with open(f"{folder}/b", "wb") as out:
        for a, b in near:
            new = np.append((a[0], b[0]) != last, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            before, last = last[0], (a[-1], b[-1])
            a, b = a[new], b[new]
            if len(a):
                head = np.flatnonzero(np.append(a[0] != before, a[1:] != a[:-1]))
                begins.append(head + done)
                nodes.append(a[head])
                b.astype(np.int64).tofile(out)
                done += len(a)
    node, begin = np.concatenate(nodes), np.append(np.concatenate(begins), done)
    target = np.memmap(f"{folder}/b", np.int64, "r+")
    for low in range(0, done, 1 << 20):
        target[low : low + (1 << 20)] = np.searchsorted(node, target[low : low + (1 << 20)])
    n = len(node)
    root = np.full(n, -1, np.int64)
    for start in range(n):  # nodes ascend, so the first of a component is its smallest
        if root[start] < 0:
            root[start], stack = start, [start]
            while stack:
                at = stack.pop()
                free = target[begin[at] : begin[at + 1]]
                free = free[root[free] < 0]
                root[free] = start
                stack += free.tolist()
    seen, order = bytearray(n), []
    for start in np.argsort(np.diff(begin), kind="stable"):
        at = int(start)
        while at >= 0 and not seen[at]:
            seen[at] = 1
            order.append(at)
            at = next((x for x in target[begin[at] : begin[at + 1]].tolist() if not seen[x]), -1)
    order = np.array(order, np.int64)
    order = order[np.argsort(root[order], kind="stable")]
    return node[order], node[root[order]], runs(np.bincount(root)[np.unique(root)])


def paths(docs: DataFrame, most: int = PIECE) -> DataFrame:
    """(node, root, step) of every document that has a neighbour."""
    partitions = tune(docs.sparkSession)
    group = grouped_documents(docs)
    edges = graph(docs, group=group).select("root", "a", "b", "similarity")
    sizes = group.groupBy("root").count().where(F.col("count") > most).select("root")
    names = ["node", "root", "step"]
    big = cut(sizes)
    small = edges
    if not big.isEmpty():
        edges = cut(edges)
        small = edges.join(big, "root", "left_anti").select("root", "a", "b", "similarity")
    ready = small.repartition(partitions, "root").sortWithinPartitions("root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(edges: list) -> list[tuple[int, int, int]]:
            return [(node, least, step) for least, own in parts(edges).items() for step, node in enumerate(walk(own))]

        current, edges, out = None, [], []
        for batch in batches:
            for root, a, b, similarity in zip(*(c.to_pylist() for c in batch.columns)):
                if root != current:
                    out += done(edges)
                    current, edges = root, []
                edges.append((a, b, similarity))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)
                out = []
        out += done(edges)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)

    def run_large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for batch in batches:
                root, a, b = (batch.column(name).to_numpy() for name in ("root", "a", "b"))
                cuts = [0, *(np.flatnonzero(root[1:] != root[:-1]) + 1).tolist(), len(root)]
                yield from ((int(root[i]), a[i:j], b[i:j]) for i, j in zip(cuts, cuts[1:]) if j > i)

        for _, own in groupby(spans(), lambda x: x[0]):
            with tempfile.TemporaryDirectory() as folder:
                found = walk_files(((a, b) for _, a, b in own), folder)
            for low in range(0, len(found[0]), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(x[low : low + (1 << 18)]) for x in found], names=names)

    walked = ready.mapInArrow(run, "node long, root long, step long")
    if big.isEmpty():
        return walked
    wide = edges.join(big, "root", "left_semi").select("root", "a", "b", "similarity")
    both = wide.unionAll(wide.select("root", F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    sorted_ = both.repartition(partitions, "root").sortWithinPartitions("root", "a", F.desc("similarity"), "b")
    return walked.unionAll(sorted_.mapInArrow(run_large, "node long, root long, step long"))


def pack_documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """Windows of related documents. What the driver gathers is one number a partition: the words before it."""
    docs = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    order = paths(docs, piece)
    sized = docs.select("id", F.regexp_count("text", F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long").alias("n"), F.xxhash64("text").alias("h")).where("id is not null and n > 0")
    placed = sized.join(order, sized["id"] == order["node"], "left").select("id", "n", "h", F.coalesce("root", "id").alias("root"), F.coalesce("step", F.lit(0)).alias("step"))
    laid = cut(placed.orderBy("root", "step", "id", "n", "h").select("id", "n", F.spark_partition_id().alias("part")))
    before: dict[int, int] = {}
    total = 0
    for part, words in sorted(laid.groupBy("part").agg(F.sum("n")).collect()):
        before[part], total = total, total + words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict[int, int] = {}
        for batch in batches:
            ids, n, part = (c.to_numpy() for c in batch.columns)
            for value in np.unique(part).tolist():
                own = part == value
                size = n[own]
                end = now.setdefault(value, before[value]) + np.cumsum(size)
                now[value] = int(end[-1])
                begin = end - size
                first, last = begin // window, (end - 1) // window
                pieces = last - first + 1
                which = np.repeat(np.arange(len(size)), pieces)
                number = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                low, high = np.maximum(begin[which], number * window), np.minimum(end[which], (number + 1) * window)
                columns = [number, low - number * window, ids[own][which], low - begin[which], high - begin[which]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["window_id", "place", "doc_id", "start_word", "end_word"])

    return laid.mapInArrow(run, "window_id long, place long, doc_id long, start_word long, end_word long")
