"""All pairs within groups of documents, compared exactly, without listing them.

A group is split by hash into chunks of about half the size that is bearable, and each pair of chunks is a tile of its own, so the square of a large
group is spread over tasks. In a tile the common n-grams of all documents are counted in whole arrays; what leaves it
are each document's closest partners and the number of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .grams import gram_sets
from .text import U, chunks, mix

CHUNK_BYTES, CHUNK_DOCS = 4 << 20, 1024  # of text and documents in a chunk, about; its mean is half
POOL = 256  # documents of small groups that are compared at once


def closest(tile: np.ndarray, side: np.ndarray, doc: np.ndarray, grams: list[np.ndarray], nearest: int, least: float, weight: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(tile, a, b, similarity, links): the nearest partners b of each document a in its tile by the Jaccard index of their
    n-gram hashes, ties to the smaller b; links: the weight of all partners that reach ``least``, in a's first row, else 0.

    Documents with a side of 0 or 1 are compared with those of the other side, those of side -1 with all.
    """
    order = np.lexsort((doc, tile))
    new = np.append(True, (np.diff(tile[order]) != 0) | (np.diff(doc[order]) != 0))
    head = order[new]
    tile, side, doc, n = tile[head], side[head], doc[head], len(head)
    value = np.concatenate([grams[i] for i in order.tolist()])
    who = np.repeat(np.cumsum(new) - 1, [len(grams[i]) for i in order.tolist()])
    if n < len(order):  # rows that repeat an id
        by = np.lexsort((value, who))
        value, who = value[by], who[by]
        once = np.append(True, (value[1:] != value[:-1]) | (who[1:] != who[:-1]))
        value, who = value[once], who[once]
    size = np.bincount(who, minlength=n)
    value = mix(value) ^ mix(tile.astype(U), 7)[who]  # tiles have no n-gram in common
    by = np.argsort(value, kind="stable")
    value, who = value[by], who[by]
    begin = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    holders = np.diff(np.append(begin, len(value)))
    dense = holders > max(4, n // 20)
    common = np.zeros((n, n), np.float32)
    few = np.repeat(~dense, holders)
    rest = (np.repeat(begin + holders, holders) - np.arange(len(value)) - 1) * few
    at = np.flatnonzero(rest)
    upto = np.cumsum(rest[at])
    total = int(upto[-1]) if len(at) else 0
    flat = common.reshape(-1)
    for low in range(0, total, 1 << 20):
        pair = np.arange(low, min(low + (1 << 20), total))
        which = np.searchsorted(upto, pair, "right")
        np.add.at(flat, who[at[which]] * n + who[at[which] + upto[which] - pair], np.float32(1))
    common += common.T.copy()
    column, holder = np.repeat(np.cumsum(dense) - 1, holders)[~few], who[~few]
    for low in range(0, int(dense.sum()), 1024):
        a, b = np.searchsorted(column, (low, low + 1024))
        held = np.zeros((n, min(1024, int(dense.sum()) - low)), np.float32)
        held[holder[a:b], column[a:b] - low] = 1
        common += held @ held.T
    np.fill_diagonal(common, 0)
    weight = np.ones(n) if weight is None else weight[head].astype(np.float64)
    found: list[tuple[np.ndarray, ...]] = []
    for low in range(0, n, 256):
        both = common[low : low + 256].astype(np.float64)
        rows = np.arange(len(both))
        index = both / (size[low : low + 256, None] + size[None, :] - both)
        index[(side[low : low + 256, None] == side[None, :]) & (side[None, :] >= 0)] = -1
        links = ((index >= least) @ weight).astype(np.int64)
        for turn in range(min(nearest, n - 1)):
            best = index.argmax(axis=1)  # the first, so the smallest id
            top = index[rows, best]
            ok = np.flatnonzero(top >= least)
            if not len(ok):
                break
            found.append((tile[low + ok], doc[low + ok], doc[best[ok]], top[ok], links[ok] if turn == 0 else np.zeros(len(ok), np.int64)))
            index[rows, best] = -1
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3 + (np.zeros(0), np.zeros(0, np.int64))


def compared(docs: DataFrame, group: DataFrame, partitions: int, n: int, nearest: int, least: float) -> DataFrame:
    """(root, a, b, similarity, links) rows: for each document a of each tile its nearest partners there, and its links.

    docs: (id, text), or (id, text, size) with the octets of text, if it's joined: a size that is known before spares texts
    a shuffle. group: (node, root, weight) of the documents that are compared, those of a root with each other.
    """
    octets = F.col("size") if "size" in docs.columns else F.octet_length("text")
    sizes = docs.groupBy("id").agg(F.sum(octets).alias("size"))
    cost = F.greatest("size", F.lit(CHUNK_BYTES // CHUNK_DOCS))
    placed = cut(group.join(sizes, group["node"] == sizes["id"]).select("node", "root", "weight", cost.alias("cost")))  # read twice
    total = placed.groupBy("root").agg(F.sum("cost").alias("total"))
    several = F.when(F.col("total") > CHUNK_BYTES, F.ceil(2 * F.col("total") / CHUNK_BYTES) - 1).otherwise(0).cast("int")
    placed = placed.join(total, "root").withColumn("last", several)
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("last") + 1).cast("int"))
    member = docs.join(placed, docs["id"] == placed["node"]).where("text is not null").select("id", "text", "root", "weight", "chunk", "last")
    names = ["root", "i", "j", "side", "doc", "weight", "grams"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, root, weight, chunk, last = (c.to_pylist() for c in batch.columns)
            for low, high in chunks(texts):
                text, gram = gram_sets(texts[low:high], n)
                begin = np.searchsorted(text, np.arange(high - low + 1)).tolist()
                out, held = [], 0
                for k in range(low, high):
                    own = gram[begin[k - low] : begin[k - low + 1]].tobytes()
                    c = chunk[k]
                    for other in range(last[k] + 1) if own else ():
                        out.append((root[k], min(c, other), max(c, other), -1 if c == other else int(c > other), ids[k], weight[k], own))
                        held += len(own)
                        if held > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)
                            out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots: list[int] = []
        rows: list[tuple] = []

        def done() -> pa.RecordBatch:
            tile, side, doc, weight = (np.array(x, np.int64) for x in list(zip(*rows))[:4])
            tile, *found = closest(tile, side, doc, [np.frombuffer(r[4], U) for r in rows], nearest, least, weight)
            return pa.RecordBatch.from_arrays([pa.array(np.array(roots, np.int64)[tile]), *map(pa.array, found)], names=["root", "a", "b", "similarity", "links"])

        current, held = None, 0
        for batch in batches:
            for root, i, j, side, doc, weight, grams in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, i, j) != current:
                    if len(rows) >= POOL or held > 1 << 23:
                        yield done()
                        roots, rows, held = [], [], 0
                    current = (root, i, j)
                    roots.append(root)
                rows.append((len(roots) - 1, side, doc, weight, grams))
                held += len(grams)
        if rows:
            yield done()

    sent = member.mapInArrow(send, "root long, i int, j int, side int, doc long, weight long, grams binary")
    tiles = sent.repartition(partitions, "root", "i", "j").sortWithinPartitions("root", "i", "j")
    return tiles.mapInArrow(meet, "root long, a long, b long, similarity double, links long")
