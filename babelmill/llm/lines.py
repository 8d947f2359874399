"""Fuzzy line dedup: of all lines that are alike, across all documents, one stays.

Character shingles give each distinct line a MinHash signature; bands of it are keys; lines that share a key are
compared by the exact Jaccard index of their shingle sets; distributed union-find joins what holds, and the first
line (smallest document id, then line number) of each component is kept.

Contract of ``duplicate_lines``: a row (doc_id, line_no, keeper_doc_id, keeper_line_no, line_hash) for each line that
goes; line numbers count from 0 at line feeds; line_hash is that of the line's characters.

* blank lines (ASCII white space alone; a no-break space is wording) are never duplicates and always stay; a line of fewer than ``k`` characters has
  itself as its one shingle, so it matches only lines equal to it.
* NULL ids and NULL texts take no part; an empty text has one blank line.
* rows that repeat an id and a text count once; ties can't occur among (id, line number) places.
* very long lines and texts are handled whole; an empty table gives an empty table; only id and text are read.

Contract of ``drop_duplicate_lines``: the input rows, all columns, without those lines; texts that lose every line
that isn't blank are left out, as all they said stands elsewhere; rows with a NULL id or text stay as they are, and
so do texts that held no line to begin with. A column ``n_chars`` is set to the new length where there is one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .blobs import by_text, named, pack, schema, tune, unused
from .candidates import FIELDS, Sets, grouped, key_groups
from .text import U, codes, mix, prefix, powers, runs, span_hash, BASE, INVERSE

K = 8
BANDS, ROWS = 12, 4  # at a Jaccard index of 0.7 a pair shares a band with probability 0.96
LEAST = 0.7
BLOCK = 1 << 15  # shingles that are hashed at once
BLANKS = " \t\n\v\f\r"


def split_lines(c: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, text index, number and blankness of every line of texts laid end to end."""
    feeds = np.flatnonzero(c == 10)
    starts = np.concatenate([offsets[:-1], feeds + 1])
    which = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1])
    order = np.argsort(which, kind="stable")
    starts, which = starts[order], which[order]
    counts = np.bincount(which, minlength=len(offsets) - 1)
    ends = np.concatenate([starts[1:] - 1, [len(c)]])[: len(starts)]
    last = np.cumsum(counts) - 1
    ends[last] = offsets[1:]
    solid = np.append(np.flatnonzero((c != 32) & ((c - np.uint32(9)) >= 5)), len(c))
    return starts, ends, which, runs(counts), solid[np.searchsorted(solid, starts)] >= ends


def line_hashes(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Code points, prefix sums, then starts, ends, text index, number and content hash of the lines that aren't blank."""
    c, offsets = codes(texts)
    starts, ends, which, number, blank = split_lines(c, offsets)
    sums = prefix(c)
    kept = ~blank
    starts, ends, which, number = starts[kept], ends[kept], which[kept], number[kept]
    return c, sums, starts, ends, which, number, span_hash(sums, starts, ends)


def band_keys(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray, k: int = K, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A (lines, bands) array of keys from the MinHash signatures of the lines' character shingles."""
    if not len(starts):
        return np.zeros((0, bands), U)
    length, inverse = ends - starts, powers(INVERSE, len(sums))
    short = length < k
    count = np.where(short, 1, length - k + 1)
    upto = np.cumsum(count)
    draws = np.random.default_rng(20)
    flips, factors = draws.integers(0, 1 << 32, bands * rows, dtype=np.uint32), draws.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    least = np.empty((bands * rows, len(starts)), np.uint32)
    low = 0
    while low < len(starts):  # a block of lines at a time, so that its arrays stay in the processor's cache
        high = max(int(np.searchsorted(upto, (upto[low - 1] if low else 0) + BLOCK, "right")), low + 1)
        own, brief = count[low:high], short[low:high]
        begin = np.cumsum(own) - own
        place = np.repeat(starts[low:high] - begin, own) + np.arange(begin[-1] + own[-1])
        place[begin[brief]] = 0  # of no use, but a place
        values = (mix((sums[np.minimum(place + k, len(sums) - 1)] - sums[place]) * inverse[place] + U(k)) >> U(32)).astype(np.uint32)
        values[begin[brief]] = (whole[low:high][brief] >> U(32)).astype(np.uint32)
        work = np.empty_like(values)
        for i in range(bands * rows):
            np.bitwise_xor(values, flips[i], out=work)
            np.multiply(work, factors[i], out=work)
            np.minimum.reduceat(work, begin, out=least[i, low:high])
        low = high
    keys = np.empty((len(starts), bands), U)
    for band in range(bands):
        key = np.full(len(starts), band, U)
        for i in range(band * rows, (band + 1) * rows):
            key = mix(key ^ least[i].astype(U) * U(BASE), i)
        keys[:, band] = key
    return keys


def line_shingles(line: str, k: int = K) -> set:
    return {line[i : i + k] for i in range(len(line) - k + 1)} or {line}


def hashed_shingles(texts: list[str], k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(line index, hash of a shingle), each once; lines of fewer than k characters have none, as they match no other."""
    c, offsets = codes(texts)
    n = len(c) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    begin = np.arange(n)
    which = np.searchsorted(offsets, begin, "right") - 1
    inside = begin + k <= offsets[which + 1]
    begin, which = begin[inside], which[inside]
    h = span_hash(prefix(c), begin, begin + k)
    order = np.lexsort((h, which))
    h, which = h[order], which[order]
    once = np.append(True, (h[1:] != h[:-1]) | (which[1:] != which[:-1]))[: len(h)]
    return which[once], h[once]


def packed_shingles(line: str, k: int = K) -> tuple[np.ndarray, frozenset]:
    """The exact shingle set in two parts: eight characters of one byte each are packed into a whole number (sorted, each
    once); shingles with a wider character, those of other lengths and short lines stay text."""
    n = len(line) - k + 1
    if n < 1 or k != 8:
        return np.zeros(0, U), frozenset(line_shingles(line, k))
    try:
        raw = line.encode("latin-1")
    except UnicodeEncodeError:
        parts = line_shingles(line, k)
        wide = frozenset(p for p in parts if max(p) > "\xff")
        return np.sort(np.array([int.from_bytes(p.encode("latin-1"), "little") for p in parts - wide], U)), wide
    out = np.empty(n, U)
    for shift in range(min(8, n)):
        out[shift::8] = np.frombuffer(raw, "<u8", (len(raw) - shift) // 8, shift)
    out.sort()
    fresh = np.ones(n, bool)
    np.not_equal(out[1:], out[:-1], out=fresh[1:])
    return out[fresh], frozenset()


def packed_size(x: tuple[np.ndarray, frozenset]) -> int:
    return len(x[0]) + len(x[1])


def packed_overlap(x: tuple[np.ndarray, frozenset], y: tuple[np.ndarray, frozenset]) -> int:
    both = np.concatenate([x[0], y[0]])
    both.sort()
    return int((both[1:] == both[:-1]).sum()) + (len(x[1] & y[1]) if x[1] and y[1] else 0)


def like_lines(docs: DataFrame, least: float = LEAST, k: int = K, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, root) over content hashes of lines: the components of two and more different lines that are alike."""
    partitions = tune(docs.sparkSession)

    def send(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        _, sums, starts, ends, _, _, whole = line_hashes(texts)
        whole, first = np.unique(whole, return_index=True)
        keys = band_keys(sums, starts[first], ends[first], whole, k, bands, rows)
        yield pack(keys.ravel(), partitions, {"key": keys.ravel(), "member": np.repeat(whole.view(np.int64), bands)})

    def spell(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        _, _, starts, ends, _, _, whole = line_hashes(texts)
        joined = "".join(texts)
        whole, first = np.unique(whole, return_index=True)
        lines = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), pa.array(lines, pa.string())], names=["id", "text"])

    groups = key_groups(docs.mapInArrow(by_text(send), schema(FIELDS)), partitions)
    needed = groups.select(F.col("member").alias("id")).distinct()
    lines = docs.mapInArrow(by_text(spell), "id long, text string").join(needed, "id", "left_semi")
    items = cut(lines.groupBy("id").agg(F.min("text").alias("text")))
    return grouped(groups, items, partitions, Sets(lambda line: packed_shingles(line, k), lambda lines: hashed_shingles(lines, k), packed_size, packed_overlap), least)


def duplicate_lines(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = LEAST, k: int = K, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The lines that go, each with the line that stands for it. Every line of every text is compared."""
    docs = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    alike = like_lines(docs, least, k, bands, rows)

    def place(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        _, _, _, _, which, number, whole = line_hashes(texts)
        columns = [whole.view(np.int64), np.array(ids, np.int64)[which], number.astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "doc", "line"])

    places = docs.mapInArrow(by_text(place), "node long, doc long, line int")
    rooted = places.join(alike, "node", "left").select(F.coalesce("root", "node").alias("root"), "doc", "line", "node").distinct()
    first = rooted.groupBy("root").agg(F.min(F.struct("doc", "line", "node")).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = rooted.join(first, "root").where("struct(doc, line, node) <> first")
    return gone.select(
        F.col("doc").alias("doc_id"),
        F.col("line").alias("line_no"),
        F.col("first.doc").alias("keeper_doc_id"),
        F.col("first.line").alias("keeper_line_no"),
        F.col("node").alias("line_hash"),
    )


def drop_duplicate_lines(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents without the lines that ``duplicate_lines`` names."""
    gone_name, owner = unused(docs, "_gone"), unused(docs, "_owner")
    gone = duplicate_lines(docs, least=least)
    lists = gone.groupBy(F.col("doc_id").alias(owner)).agg(F.collect_list(F.struct("line_no", "line_hash")).alias(gone_name))
    joined = docs.join(lists, F.col("doc_id").cast("long") == F.col(owner), "left").drop(owner)
    out = docs.schema
    at, length = named(docs, "text"), named(docs, "n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = batch.column(at).to_pylist(), []
            for i, (text, gone) in enumerate(zip(texts, batch.column(batch.num_columns - 1).to_pylist())):
                if gone and text is not None:
                    dropped = {(g["line_no"], g["line_hash"]) for g in gone}
                    _, _, _, _, _, number, whole = line_hashes([text])
                    hit = {n for n, h in zip(number.tolist(), whole.view(np.int64).tolist()) if (n, h) in dropped}
                    left = [line for n, line in enumerate(text.split("\n")) if n not in hit]
                    if not any(line.strip(BLANKS) for line in left):
                        continue
                    texts[i] = "\n".join(left)
                kept.append(i)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            if length is not None:
                sizes = [old if new is None else len(new) for old, new in zip(columns[length].to_pylist(), texts)]
                columns[length] = pa.array(sizes, columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1]).take(pa.array(kept, pa.int64()))

    return joined.mapInArrow(run, out)
