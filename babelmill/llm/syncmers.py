"""Document fingerprints from closed syncmers, and matches of documents by the places of shared anchors.

A k-mer (k characters, case folded) is chosen when the smallest hash among its s-mers is that of its first or last
one. The choice looks at the k-mer alone, so a passage yields the same anchors wherever it stands; of the
k - s + 1 places a minimum can take two are edges, so about 2 / (k - s + 1) of all k-mers are chosen.

Contract of ``fingerprints``: one row for each input row with (id, positions, hashes): the character offsets of the
anchors in ascending order and the 64-bit hashes of their k-mers.

* NULL text: NULL positions and hashes; a text of fewer than k characters, the empty one too: empty lists.
* a k-mer that recurs within a text counts at each of its places; ties among equal s-mers count for either edge.
* NULL ids and repeated rows are kept; an empty table gives an empty table; only id and text are read.

Contract of ``match_positions``: for every document and every earlier document that it shares anchors with, where the
earlier one is the smallest id that holds the anchor: (id, source_id, shift, anchors, start, end), one row a shift.
Each place of an anchor in the document is matched to each of its places in the source, so a passage that recurs in
either has a row for every shift. The list doesn't grow with the square of a group of copies, as all copies of a passage
name the same source; within two periodic texts the matches grow with the product of the places of one anchor.
Rows with a NULL id take no part; repeated rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import by_text, exchange, pack, schema, tune, unpack
from .ordinal import tables
from .text import CHUNK, chunks, codes, prefix, sliding_min, span_hash

K, S = 100, 20


def places(texts: list[str], k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, character offset, k-mer hash) of every place of the anchors of each text, by text and offset."""
    c, offsets = codes(texts)
    c = tables()[0][c]
    n = len(c) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = prefix(c)
    begin = np.arange(len(c) - s + 1)
    h = span_hash(sums, begin, begin + s)
    least = sliding_min(h, k - s + 1)
    chosen = np.flatnonzero((h[:n] == least) | (h[k - s : k - s + n] == least))
    text = np.searchsorted(offsets, chosen, "right") - 1
    inside = chosen + k <= offsets[text + 1]
    chosen, text = chosen[inside], text[inside]
    return text, chosen - offsets[text], span_hash(sums, chosen, chosen + k)


def anchors(texts: list[str], k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of each text as a set: of ``places``, the first of each k-mer."""
    text, place, hashes = places(texts, k, s)
    order = np.lexsort((place, hashes, text))
    a, b = hashes[order], text[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.sort(order[new])
    return text[first], place[first], hashes[first]


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = K, s: int = S) -> DataFrame:
    """The anchors of every text; a single narrow stage."""
    tune(df.sparkSession)
    kept = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            for low, high in chunks([t or "" for t in rows]):
                part = rows[low:high]
                text, place, hashes = places([t or "" for t in part], k, s)
                offsets = pa.array(np.append(0, np.cumsum(np.bincount(text, minlength=len(part)))).astype(np.int32))
                missing = pa.array([t is None for t in part])
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x), mask=missing) for x in (place.astype(np.int32), hashes.view(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *lists], names=["id", "positions", "hashes"])

    return kept.mapInArrow(run, "id long, positions array<int>, hashes array<long>").withColumnRenamed("id", id_column)


FIELDS = {"h": "<u8", "doc": "<i8", "at": "<i4"}


def match_positions(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Shared anchors grouped by document, source and shift. Two exchanges: packed anchors by hash, matches by pair."""
    partitions = tune(df.sparkSession)
    kept = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))

    def send(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        text, place, hashes = places(texts, k, s)
        yield pack(hashes, partitions, {"h": hashes, "doc": np.array(ids, np.int64)[text], "at": place.astype(np.int32)})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in unpack(batches, FIELDS):
            order = np.lexsort((x["at"], x["doc"], x["h"]))
            h, doc, at = x["h"][order], x["doc"][order], x["at"][order].astype(np.int64)
            repeat = np.zeros(len(h), bool)  # the same place of a row that repeats
            repeat[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])
            h, doc, at = h[~repeat], doc[~repeat], at[~repeat]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(h) else np.zeros(0, np.int64)
            other = doc != doc[first]
            held = np.bincount(first[~other], minlength=len(h))  # places of the anchor in its source
            use = np.flatnonzero(other)
            upto = np.cumsum(held[first[use]])
            total = int(upto[-1]) if len(upto) else 0
            for low in range(0, total, 1 << 18):
                pair = np.arange(low, min(low + (1 << 18), total))
                which = np.searchsorted(upto, pair, "right")
                i = use[which]
                source = first[i] + pair - (upto[which] - held[first[i]])
                columns = [doc[i], doc[source], at[i] - at[source], at[i]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "source_id", "shift", "at"])

    sent = kept.mapInArrow(by_text(send, CHUNK), schema(FIELDS))
    pairs = exchange(sent, partitions).mapInArrow(meet, "id long, source_id long, shift long, at long")
    found = pairs.groupBy("id", "source_id", "shift").agg(F.count("*").alias("anchors"), F.min("at").alias("start"), (F.max("at") + k).alias("end"))
    return found.withColumnRenamed("id", id_column)
