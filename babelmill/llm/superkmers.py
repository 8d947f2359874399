"""Exact repeated passages by super-k-mer partitioning.

Every window of k words belongs to the bucket of its minimiser, the least hash among its runs of m words.
Consecutive windows with one minimiser travel as one packed string, their words once each, so the exchange carries
about three words a window and not k. In a bucket the windows of strings that share a minimiser are sorted; equal
neighbours are counted after their words have been compared.

A first scan counts strings by minimiser in a fixed number of slots. Minimisers of a slot that holds more than half of
what a bucket holds on average are hot: a passage that much of a corpus shares would fill one task. The windows of hot
minimisers go by themselves, as 128-bit hashes of their words with their places, to aggregates that combine before their
exchange and a join that AQE splits. All windows of the same words have the same minimiser, so each is counted in one way.

Contract of ``repeated_spans``: a row (doc_id, start_word, end_word, copies, kept) for each maximal span of words of a
document that is covered by windows occurring at least twice (in whichever documents). Words are runs without ASCII
white space, counted from 0; ``copies`` is the largest number of places any window of the span has; ``kept`` is true
where the windows are the first of their kind (smallest doc_id, then place), false where they repeat.

* NULL ids and texts take no part; texts of fewer than k words, the empty one too, have no window.
* rows that repeat an id and a text count once; places are distinct, so there are no ties.
* texts of any length are handled whole; an empty table gives an empty table; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .blobs import by_text, exchange, tune
from .candidates import SLOTS, Sets, frequencies
from .text import CHUNK, U, codes, mix, prefix, rolling, runs, sliding_min, span_hash, words

K, M = 50, 8
FINER = 4  # buckets a shuffle partition
HOT = 5000  # strings that are never too many for a task

SENT = "bucket int, key binary, doc binary, at binary, size binary, twice binary, packed binary"


def stretches(texts: list[str], k: int = K, m: int = M) -> tuple[np.ndarray, ...]:
    """(minimiser, text index, first word, its place in the text, last window's first word, whether the minimiser occurs
    twice) of the super-k-mers of every text, and the starts and ends of all words."""
    c, offsets = codes(texts)
    starts, ends, which = words(c, offsets)
    n = len(starts) - k + 1
    if n <= 0:
        return np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, bool), starts, ends
    short = rolling(span_hash(prefix(c), starts, ends), m)
    least = sliding_min(short, k - m + 1)
    inside = which[:n] == which[k - 1 : k - 1 + n]
    at = np.flatnonzero(inside)
    new = np.ones(len(at), bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (which[at[1:]] != which[at[:-1]])
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
    base = np.searchsorted(which, which[first])
    inner = last - first + k - m + 1
    same = short[np.repeat(first, inner) + runs(inner)] == np.repeat(least[first], inner)
    twice = np.add.reduceat(same, np.cumsum(inner) - inner, dtype=np.int64) > 1 if len(first) else np.zeros(0, bool)
    return least[first], which[first], first, first - base, last, twice, starts, ends


def slots(key: np.ndarray) -> np.ndarray:
    """The slot of each minimiser, one of SLOTS."""
    return (mix(key, 10) >> U(44)).astype(np.int64)


def super_kmers(texts: list[str], k: int = K, m: int = M, hot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(minimiser, text index, first word, whether the minimiser occurs twice, packed words) of the super-k-mers of every
    text, but for those of hot slots."""
    key, which, first, place, last, twice, starts, ends = stretches(texts, k, m)
    if hot is not None:
        cold = ~hot[slots(key)]
        key, which, first, place, last, twice = (x[cold] for x in (key, which, first, place, last, twice))
    joined = "".join(texts)
    packed = [b" ".join(joined[a:b].encode().split()) for a, b in zip(starts[first].tolist(), ends[last + k - 1].tolist())]
    return key, which, place, twice, packed


def hot_windows(ids: list, texts: list[str], hot: np.ndarray, k: int, m: int) -> Iterator[pa.RecordBatch]:
    """(h, g, doc, low) of every window of a hot minimiser: two halves of the hash of its words, and its place."""
    key, which, first, place, last, _, starts, ends = stretches(texts, k, m)
    wanted = np.flatnonzero(hot[slots(key)])
    joined = "".join(texts)
    doc = np.array(ids, np.int64)
    for low in range(0, len(wanted), 1 << 12):
        i = wanted[low : low + (1 << 12)]
        count = last[i] - first[i] + 1
        word = np.repeat(first[i], count) + runs(count)
        digests = b"".join([xxhash.xxh3_128_digest(b" ".join(joined[a:b].encode().split())) for a, b in zip(starts[word].tolist(), ends[word + k - 1].tolist())])
        halves = np.frombuffer(digests, ">i8").reshape(-1, 2).astype(np.int64)
        columns = [halves[:, 0], halves[:, 1], np.repeat(doc[which[i]], count), np.repeat(place[i], count) + runs(count)]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["h", "g", "doc", "low"])


def pack(ids: list, texts: list[str], count: int, k: int, m: int, hot: np.ndarray | None = None) -> pa.RecordBatch:
    key, text, at, twice, packed = super_kmers(texts, k, m, hot)
    key = mix(key, 9)
    bucket = ((key >> U(32)) * U(count) >> U(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else np.zeros(0, np.int64)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    doc = np.array(ids, np.int64)[text] if len(text) else text
    rows = []
    for a, b in zip(bounds.tolist(), [*bounds.tolist()[1:], len(order)]):
        i = order[a:b]
        strings = [packed[j] for j in i.tolist()]
        sizes = np.fromiter(map(len, strings), np.int32, len(strings))
        rows.append((int(bucket[i[0]]), key[i].tobytes(), doc[i].tobytes(), at[i].astype(np.int32).tobytes(), sizes.tobytes(), twice[i].tobytes(), squeeze(b"".join(strings))))
    columns = list(zip(*rows)) if rows else [()] * 7
    names = ["bucket", "key", "doc", "at", "size", "twice", "packed"]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(x, pa.binary()) for x in columns[1:])], names=names)


def count_windows(strings: list[bytes], group: np.ndarray, doc: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(doc, first word, last window's first word, copies, kept) of runs of repeated windows in whole minimiser groups."""
    whole = b" ".join(strings)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    begin = np.cumsum(lengths + 1) - lengths - 1
    raw = np.frombuffer(whole, np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(raw))
    hashes = span_hash(prefix(raw), starts, ends)
    first = np.searchsorted(starts, begin)
    count = np.diff(np.append(first, len(starts))) - k + 1
    string = np.repeat(np.arange(len(strings)), count)
    offset = runs(count)
    word = first[string] + offset
    h = span_hash(prefix(hashes), word, word + k)
    place = at[string] + offset
    order = np.lexsort((place, doc[string], h, group[string]))
    g, s, w, p = group[string][order], string[order], word[order], place[order]
    h, d = h[order], doc[s]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    again = np.zeros(len(h), bool)  # the same window of a row that repeats
    again[1:] = ~fresh[1:] & (d[1:] == d[:-1]) & (p[1:] == p[:-1])
    h, g, s, w, p, d, fresh = (x[~again] for x in (h, g, s, w, p, d, fresh))
    leader = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.append(np.flatnonzero(fresh), len(h)))
    copies = np.repeat(size, size)
    if not (copies > 1).any():
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    follower = np.flatnonzero((copies > 1) & ~fresh)
    by_place = follower[np.lexsort((w[follower], s[follower]))]
    mine, theirs = w[by_place], w[leader[by_place]]
    cut = np.ones(len(by_place), bool)
    cut[1:] = (s[by_place][1:] != s[by_place][:-1]) | (s[leader[by_place]][1:] != s[leader[by_place]][:-1]) | (np.diff(mine) != 1) | (np.diff(theirs) != 1)
    heads = np.flatnonzero(cut)
    tails = np.append(heads[1:], len(by_place)) - 1
    spans = zip(starts[mine[heads]].tolist(), ends[mine[tails] + k - 1].tolist(), starts[theirs[heads]].tolist(), ends[theirs[tails] + k - 1].tolist())
    differ = [i for i, (a, b, x, y) in enumerate(spans) if whole[a:b] != whole[x:y]]
    if differ:  # two windows of one hash but other words: count these groups by their words
        keys = [whole[a:b] for a, b in zip(starts[w].tolist(), ends[w + k - 1].tolist())]
        seen: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(g.tolist(), keys)):
            seen.setdefault(key, []).append(i)
        fresh = np.zeros(len(h), bool)
        for places in seen.values():
            copies[places] = len(places)
            fresh[places[0]] = True
    hit = np.flatnonzero(copies > 1)
    hit = hit[np.lexsort((p[hit], s[hit], fresh[hit]))]
    new = np.ones(len(hit), bool)
    new[1:] = (s[hit][1:] != s[hit][:-1]) | (np.diff(p[hit]) != 1) | (fresh[hit][1:] != fresh[hit][:-1])
    heads = np.flatnonzero(new)
    last = np.append(heads[1:], len(hit)) - 1
    return d[hit[heads]], p[hit[heads]], p[hit[last]], np.maximum.reduceat(copies[hit], heads), fresh[hit[heads]].astype(np.int64)


def repeated_spans(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = K, m: int = M, most: int = HOT) -> DataFrame:
    """Spans of words that stand in more than one place. Two exchanges: super-k-mers by minimiser, runs by document.

    most: strings of a slot that never make it hot.
    """
    partitions = tune(df.sparkSession)
    docs = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))

    held = frequencies(docs, partitions, Sets(len, lambda texts: (np.zeros(0, np.int64), mix(stretches(texts, k, m)[0], 10))))
    total = int(held.sum(dtype=np.int64))
    limit = max(most, total / (2 * partitions * FINER), 4 * total / SLOTS)
    found_hot = held > limit
    hot = df.sparkSession.sparkContext.broadcast(found_hot) if found_hot.any() else None  # SLOTS bytes, whatever the input

    def send(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        yield pack(ids, texts, partitions * FINER, k, m, hot and hot.value)

    def alone(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        return hot_windows(ids, texts, hot.value, k, m)

    def sort(held: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        key = np.frombuffer(b"".join(held["key"]), U)
        doc, at = np.frombuffer(b"".join(held["doc"]), np.int64), np.frombuffer(b"".join(held["at"]), np.int32).astype(np.int64)
        sizes = [np.frombuffer(x, np.int32) for x in held["size"]]
        blob_of = np.repeat(np.arange(len(sizes)), [len(x) for x in sizes])
        within = np.concatenate([np.cumsum(x) - x for x in sizes])
        size = np.concatenate(sizes)
        grow = zstandard.ZstdDecompressor().decompress
        order = np.argsort(key, kind="stable")
        bounds = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        many = np.diff(np.append(bounds, len(order)))
        # a lone string can repeat a window only where its minimiser recurs within it
        twice = np.frombuffer(b"".join(held["twice"]), bool)
        keep = np.repeat((many > 1) | twice[order][bounds], many)
        order = order[keep]
        if not len(order):
            return
        blobs = {b: grow(held["packed"][b]) for b in np.unique(blob_of[order]).tolist()}
        group = np.cumsum(np.append(True, key[order][1:] != key[order][:-1])) - 1
        filled = np.cumsum(size[order])
        low = 0
        ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(order)).tolist()
        for i, end in enumerate(ends):
            if end < len(order) and filled[ends[i + 1] - 1] - (filled[low - 1] if low else 0) <= CHUNK:
                continue
            part = order[low:end]
            strings = [blobs[b][w : w + n] for b, w, n in zip(blob_of[part].tolist(), within[part].tolist(), size[part].tolist())]
            found = count_windows(strings, group[low:end], doc[part], at[part], k)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], names=["doc", "low", "high", "copies", "kept"])
            low = end

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "doc", "at", "size", "twice", "packed")
        held: dict[str, list[bytes]] = {n: [] for n in names}
        current = None
        for batch in batches:
            for bucket, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != current:
                    if current is not None:
                        yield from sort(held)
                    current, held = bucket, {n: [] for n in names}
                for n, v in zip(names, values):
                    held[n].append(v)
        if current is not None:
            yield from sort(held)

    sent = docs.mapInArrow(by_text(send), SENT)
    found = exchange(sent, partitions).mapInArrow(meet, "doc long, low long, high long, copies long, kept long")
    if hot is not None:
        windows = cut(docs.mapInArrow(by_text(alone), "h long, g long, doc long, low long").distinct())
        several = windows.groupBy("h", "g").agg(F.count("*").alias("copies"), F.min(F.struct("doc", "low")).alias("first")).where("copies > 1")
        kept = (F.struct("doc", "low") == F.col("first")).cast("long").alias("kept")
        found = found.unionAll(windows.join(several, ["h", "g"]).select("doc", "low", F.col("low").alias("high"), "copies", kept))
    by_doc = Window.partitionBy("doc", "kept").orderBy("low", "high")
    reach = F.max("high").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("new", F.coalesce(F.col("low") > reach + k, F.lit(True)).cast("int"))
    islands = marked.withColumn("island", F.sum("new").over(by_doc))
    spans = islands.groupBy("doc", "kept", "island").agg(F.min("low").alias("start_word"), (F.max("high") + k).alias("end_word"), F.max("copies").alias("copies"))
    return spans.select(F.col("doc").alias("doc_id"), "start_word", "end_word", "copies", (F.col("kept") == 1).alias("kept"))


ORACLE = """
with w as (
    select doc_id, list_filter(string_split_regex(text, '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') as words
    from (select distinct doc_id, text from documents where doc_id is not null and text is not null)
), n as (
    select doc_id, pos, array_to_string(list_slice(words, pos + 1, pos + 50), ' ') as win
    from (select doc_id, words, unnest(range(0, len(words) - 49)) as pos from w where len(words) >= 50) as x
), c as (
    select doc_id, pos, count(*) over (partition by win) as copies,
        row_number() over (partition by win order by doc_id, pos) = 1 as kept
    from n
), r as (
    select *, case when pos > max(pos) over (partition by doc_id, kept order by pos
        rows between unbounded preceding and 1 preceding) + 50 then 1 else 0 end as fresh
    from c where copies > 1
), i as (select *, sum(fresh) over (partition by doc_id, kept order by pos) as island from r)
select doc_id, min(pos) as start_word, max(pos) + 50 as end_word, max(copies) as copies, kept
from i group by doc_id, kept, island
"""
