"""From shared keys to verified groups, without listing the square of a key's holders.

Keys are those of the callers, or elements of the sets themselves (``prefix_pairs``), which miss no pair.

Texts that share a key form a key group. First every member is compared with the group's smallest member; the pairs
that hold are joined into components. What then remains are key groups whose members lie in different components.

* In a group of at most ``SMALL`` members all pairs of different components are compared: at most SMALL / 2 a member.
* The members of larger groups are matched by prefixes: ordered from rare to frequent, two sets with a Jaccard index of
  t and sizes x and y must meet in the first x - ceil(t x) + 1 elements of one and y - ceil(t y) + 1 of the other, and
  where they meet first, enough of both must be left to reach the overlap that the index needs. So texts made from one
  template, of which all share the template and few anything else, are paired by what they alone hold, and the pairs
  grow with the texts. That test is exact: only pairs between the threshold and what the bounds can tell apart from
  it are compared in vain.

``prefix_pairs`` lists the pairs of a key group that sizes and places of the key don't rule out, at most SMALL / 2 a
member; groups of more are kept as groups. ``matched`` then goes the same way from there.

Long texts share a rare element by chance, in numbers that grow with the square of the texts. So a pair must share more
than one: where both look e places further than they must, a pair that reaches the index shares e + 1 (see ``demand``).
Pairs that share fewer are dropped as soon as their keys are counted, before anything but two numbers travels for them.

So two texts that share a key end in one component exactly if a chain of verified pairs joins them, while a group of n
near copies costs about n comparisons a key, not n squared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, release
from .blobs import by_text, exchange, pack, schema, unpack
from .components import components
from .text import U, mix, runs

@dataclass(frozen=True)
class Sets:
    """How a text becomes an exact set, and the sizes that a Jaccard index needs."""

    make: Callable[[str], Any]
    elements: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]  # (text index, hash of an element), each once
    size: Callable[[Any], int] = len
    overlap: Callable[[Any, Any], int] = lambda x, y: len(x & y)


FIELDS = {"key": "<u8", "member": "<i8"}
PER_SALT = 4000  # members of one leader that a task compares
SMALL = 16  # members of a key group of which all pairs are compared
PLACED = {"key": "<u4", "member": "<i8", "size": "<u4", "part": "<u1"}  # buckets go by the other half of the key; equal halves by chance cost a comparison
FURTHER = 128  # of so many elements of two sets, each looks one place further than it must, and one more element must be shared
STEPS = 256  # a place in a prefix is told in so many steps, rounded to the front
BITS = 1 << 25  # of the sieve of ids, which every executor holds: 4 MB
SAMPLE, OFTEN, KNOWN = 40_000, 2, 1 << 20  # texts whose elements are counted; least count and number of elements that are told
SLOTS, PARTS = 1 << 20, 64  # counters of elements, which order them by frequency; and the rows that they are summed in


def key_groups(sent: DataFrame, partitions: int, fields: dict[str, str] = FIELDS) -> DataFrame:
    """(gid, member, leader) rows of the distinct sets of at least two members that share a key; written once."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in unpack(batches, fields):
            order = np.lexsort((x["member"], x["key"]))
            key, member = x["key"][order], x["member"][order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
            key, member = key[new], member[new]
            again = np.append(key[1:] == key[:-1], False)[: len(key)]
            shared = again | np.append(False, again)[: len(key)]
            key, member = key[shared], member[shared]
            first = np.flatnonzero(np.concatenate([[len(key) > 0], key[1:] != key[:-1]])[: len(key)])
            size = np.diff(np.append(first, len(key)))
            if not len(first):
                continue
            gid = np.add.reduceat(mix(member.view(np.uint64), 11), first) ^ mix(size.astype(np.uint64), 12)
            _, once = np.unique(gid, return_index=True)
            keep = np.zeros(len(first), bool)
            keep[once] = True
            rows = np.repeat(keep, size)
            out = [np.repeat(gid, size)[rows].view(np.int64), member[rows], np.repeat(member[first], size)[rows]]
            for low in range(0, len(out[0]), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(o[low : low + (1 << 18)]) for o in out], names=["gid", "member", "leader"])

    rows = exchange(sent, partitions).mapInArrow(meet, "gid long, member long, leader long")
    return cut(rows.groupBy("gid", "member").agg(F.min("leader").alias("leader")))


def verified(pairs: DataFrame, items: DataFrame, partitions: int, sets: Sets, least: float) -> DataFrame:
    """(a, b, jaccard) of the pairs whose shingle sets have a Jaccard index of at least ``least``.

    items: (id, text). A leader's text travels once to each task that holds some of its members; leaders of very many
    members are spread over several.
    """
    fan = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_SALT).cast("int").alias("fan"))
    members = pairs.join(fan, "a").select(F.col("a").alias("lead"), F.col("b").alias("id"), F.pmod(F.hash("b"), F.col("fan")).alias("salt"), F.lit(1).alias("rank"))
    leaders = fan.select(F.col("a").alias("lead"), F.col("a").alias("id"), F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("salt"), F.lit(0).alias("rank"))
    rows = members.unionAll(leaders).join(items, "id").select("lead", "salt", "rank", "id", "text")
    ready = rows.repartition(partitions, "lead", "salt").sortWithinPartitions("lead", "salt", "rank", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own, here = None, None, 0
        for batch in batches:
            found: list[tuple[int, int, float]] = []
            for lead, salt, rank, one, text in zip(*(c.to_pylist() for c in batch.columns)):
                if rank == 0:
                    current, own = (lead, salt), sets.make(text)
                    here = sets.size(own)
                elif current == (lead, salt):
                    other = sets.make(text)
                    low, high = sorted((here, sets.size(other)))
                    if low >= least * high and low:
                        both = sets.overlap(own, other)
                        index = both / (low + high - both)
                        if index >= least:
                            found.append((lead, one, index))
            if found:
                a, b, j = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(j, pa.float64())], names=["a", "b", "jaccard"])

    return ready.mapInArrow(run, "a long, b long, jaccard double")


def frequencies(items: DataFrame, partitions: int, sets: Sets) -> np.ndarray:
    """How often elements occur, by the slot of their hash: SLOTS counters, whatever the size of the input.

    The counters only set an order of elements, so that elements that share a slot cost comparisons and lose nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)

        def add(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal total
            total += np.bincount((sets.elements(texts)[1] >> U(44)).astype(np.int64), minlength=SLOTS)
            return iter(())

        for _ in by_text(add)(batches):
            pass
        parts = total.reshape(PARTS, -1)
        held = np.flatnonzero(parts.any(axis=1))
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array([parts[i].tobytes() for i in held.tolist()])], names=["part", "counts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns)):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()])], names=["part", "counts"])

    counted = items.mapInArrow(count, "part int, counts binary").repartition(min(partitions, PARTS), "part").mapInArrow(add_up, "part int, counts binary")
    out = np.zeros((PARTS, SLOTS // PARTS), np.int64)
    for row in counted.collect():
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(out.ravel(), np.iinfo(np.uint32).max).astype(np.uint32)


def prefixes(text: np.ndarray, element: np.ndarray, frequency: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """(text, element, place, size) of the elements in the prefix of each set, from the rarest on; places count from 0."""
    order = np.lexsort((element, frequency, text))
    text, element = text[order], element[order]
    sizes = np.bincount(text)
    sizes = sizes[sizes > 0]
    place, size = runs(sizes), np.repeat(sizes, sizes)
    kept = place <= size - np.ceil(least * size - 1e-9)
    return text[kept], element[kept], place[kept], size[kept]


def common(docs: DataFrame, partitions: int, elements: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(halves of elements, counts) that occur often in a sample of about ``SAMPLE`` of the (id, text) rows, at most ``KNOWN``.

    The counts only set an order of elements: whatever the sample misses costs comparisons and loses nothing.
    """
    every = max(1, -(-docs.select("id").count() // SAMPLE))

    def send(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        _, element = elements(texts)
        yield pack(element, partitions, {"element": element.astype(np.uint32)})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in unpack(batches, {"element": "<u4"}):
            value = np.sort(x["element"])
            first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            count = np.diff(np.append(first, len(value)))
            kept = np.flatnonzero(count >= OFTEN)
            kept = kept[np.argsort(-count[kept], kind="stable")[: 1 + 2 * KNOWN // partitions]]
            columns = [value[first[kept]].tobytes(), count[kept].astype(np.uint32).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["value", "count"])

    sampled = docs.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).mapInArrow(by_text(send), schema({"element": "<u4"}))
    rows = exchange(sampled, partitions).mapInArrow(meet, "value binary, count binary").collect()
    value, count = np.frombuffer(b"".join(r[0] for r in rows), np.uint32), np.frombuffer(b"".join(r[1] for r in rows), np.uint32)
    most = np.lexsort((value, -count.astype(np.int64)))[:KNOWN]
    order = most[np.argsort(value[most], kind="stable")]
    return value[order], count[order]


def demand(x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(reach, asked): sets of x and y elements that reach the index share at least ``asked`` of those elements at and after
    which at least ``reach`` of either set come; such elements are in the prefixes.

    An index of t needs an overlap of n. Let both sets end where n - e elements are left, the last one included; of the
    one that ends first in the common order n - e - 1 come later, so e + 1 of the overlap lie before, in both parts.
    """
    n = np.ceil(least / (1 + least) * (x + y) - 1e-6).astype(np.int64)
    spare = n - np.ceil(least * np.maximum(x, y) - 1e-9).astype(np.int64)  # as far as the prefix of either goes
    e = np.clip(spare, 0, 1 + (x + y) // FURTHER)
    return n - e, e + 1


def listed(key: np.ndarray, member: np.ndarray, size: np.ndarray, reach: np.ndarray, least: float, times: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(gid, a, b): of each key group, rows sorted by key and member, the pairs a < b that may reach the index, with gid 0.

    size: elements of the member's set; reach: at most so many of them come at and after the key. A group with more than
    SMALL / 2 such pairs a member is given as a whole, with a gid of its own: a is its smallest member, b each of the others.

    With times, of so many elements of the set with the key, also (shared, asked): in so many keys here the pair meets, and
    in so many in all it must (see ``demand``); nothing is asked of groups.
    """
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))

    def may(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        both = np.minimum(size[x], size[y]) >= least * np.maximum(size[x], size[y]) - 1e-6
        if times is None:
            return both & (np.minimum(reach[x], reach[y]) >= least / (1 + least) * (size[x] + size[y]) - 1e-6)
        x, y = (z[both] for z in np.broadcast_arrays(x, y))
        both[both] = np.minimum(reach[x], reach[y]) >= demand(size[x], size[y], least)[0]
        return both

    out: list[tuple[np.ndarray, np.ndarray]] = []
    at = np.flatnonzero(np.repeat(count <= SMALL, count))
    last = np.repeat(first + count, count)
    for gap in range(1, SMALL):
        at = at[at + gap < last[at]]
        kept = at[may(at, at + gap)]
        out.append((kept, kept + gap))
    whole: list[tuple[int, int]] = []
    for low, n in zip(first[count > SMALL].tolist(), count[count > SMALL].tolist()):
        here: list[tuple[np.ndarray, np.ndarray]] = []
        total, rows = 0, np.arange(low, low + n)
        for x in range(0, n, 256):  # a few rows of the square at once, no more of them once it's clear that there are too many
            i, j = np.nonzero(may(rows[x : x + 256, None], rows[None, :]))
            upper = i + x < j
            here.append((rows[i[upper] + x], rows[j[upper]]))
            total += int(upper.sum())
            if total > SMALL // 2 * n:
                whole.append((low, n))
                break
        else:
            out += here
    a, b = (np.concatenate([x[i] for x in out]) for i in (0, 1))
    shared = np.ones(len(a), np.int64) if times is None else np.minimum(times[a], times[b])
    asked = demand(size[a], size[b], least)[1]
    a, b = member[a], member[b]
    order = np.lexsort((b, a))
    a, b, shared, asked = a[order], b[order], shared[order], asked[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    begin = np.flatnonzero(new)
    total = np.add.reduceat(shared, begin) if len(begin) else shared
    parts, seen = [(np.zeros(len(begin), np.int64), a[new], b[new], total.astype(np.int32), asked[new].astype(np.int32))], set()
    for low, n in whole:
        own = member[low : low + n]
        gid = int((np.bitwise_xor.reduce(mix(own.view(U), 11)) ^ mix(np.array([n], U), 12)[0]) | U(1))
        if gid not in seen:
            seen.add(gid)
            parts.append((np.full(n - 1, gid, U).view(np.int64), np.full(n - 1, own[0]), own[1:], np.ones(n - 1, np.int32), np.zeros(n - 1, np.int32)))
    return tuple(np.concatenate([x[i] for x in parts]) for i in range(3 if times is None else 5))


def prefix_pairs(docs: DataFrame, partitions: int, elements: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], least: float) -> DataFrame:
    """(gid, a, b, shared) rows in which any two sets of (id, text) rows meet whose Jaccard index is at least ``least``; written
    once. shared: in so many keys they meet.

    The keys of a set are the elements of its prefix: two sets that reach the index share one of them, whatever the order.
    A key travels with the size of its set and its place in the prefix, so that only pairs leave a bucket that these
    don't rule out; groups of very many such pairs leave it as groups (see ``listed``). A pair that meets in no such group
    has all its keys counted, and goes if they are too few; one that does is found in the group.
    """
    often = docs.sparkSession.sparkContext.broadcast(common(docs, partitions, elements))

    def send(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        text, element = elements(texts)
        value, count = often.value
        frequency = np.zeros(len(element), np.uint32)
        if len(value):
            half = element.astype(np.uint32)
            at = np.minimum(np.searchsorted(value, half), len(value) - 1)
            frequency = np.where(value[at] == half, count[at], 0)
        text, element, place, size = prefixes(text, element, frequency, least)
        key = mix(element, 14)
        part = place * STEPS // held_back(size, least)
        yield pack(key, partitions, {"key": key.astype(np.uint32), "member": np.array(ids, np.int64)[text], "size": size.astype(np.uint32), "part": part.astype(np.uint8)})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in unpack(batches, PLACED):
            order = np.lexsort((x["part"], x["member"], x["key"]))  # of elements of one set with equal keys the first counts
            key, member = x["key"][order], x["member"][order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
            times = np.diff(np.append(np.flatnonzero(new), len(new)))
            order, key = order[new], key[new]
            again = np.append(key[1:] == key[:-1], False)[: len(key)]
            shared = again | np.append(False, again)[: len(key)]
            order, key, times = order[shared], key[shared], times[shared]
            size = x["size"][order].astype(np.int64)
            before = -(-x["part"][order].astype(np.int64) * held_back(size, least) // STEPS)
            out = listed(key, x["member"][order], size, size - before, least, times)
            for low in range(0, len(out[0]), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(o[low : low + (1 << 18)]) for o in out], names=["gid", "a", "b", "shared", "asked"])

    rows = exchange(docs.select("id", "text").mapInArrow(by_text(send), schema(PLACED)), partitions)
    met = rows.mapInArrow(meet, "gid long, a long, b long, shared int, asked int")
    return cut(met.groupBy("gid", "a", "b").agg(F.sum("shared").alias("shared"), F.max("asked").alias("asked")).where("shared >= asked").drop("asked"))


def held_back(size: np.ndarray, least: float) -> np.ndarray:
    """The number of elements in the prefixes of sets of these sizes."""
    return (size - np.ceil(least * size - 1e-9) + 1).astype(np.int64)


def within(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is one of ids (id), and few others: a sieve of BITS bits, so that few texts travel to a join."""
    slots = ids.select(F.pmod(F.xxhash64("id"), F.lit(BITS)).alias("s"))
    held = slots.groupBy(F.bitmap_bucket_number("s").alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("_held"))
    asked = rows.withColumn("_slot", F.pmod(F.xxhash64("id"), F.lit(BITS))).withColumn("_bit", F.bitmap_bit_position("_slot"))
    met = asked.join(F.broadcast(held), F.bitmap_bucket_number("_slot") == F.col("_part"))
    byte = "cast(conv(hex(substring(_held, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
    return met.where(F.expr(f"getbit({byte}, cast(_bit % 8 as int)) = 1")).select(*rows.columns)


def by_prefix(members: DataFrame, items: DataFrame, partitions: int, sets: Sets, least: float) -> DataFrame:
    """(a, b) pairs of members (member, root) of different roots that may reach the index; misses none that does."""
    own = cut(members.join(items.select("id", "text"), members["member"] == items["id"]).select("id", "text", "root"))
    frequency = items.sparkSession.sparkContext.broadcast(frequencies(own.select("id", "text"), partitions, sets))

    def send(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        text, element = sets.elements(texts)
        text, element, place, size = prefixes(text, element, frequency.value[(element >> U(44)).astype(np.int64)], least)
        columns = [np.array(ids, np.int64)[text], element.view(np.int64), place.astype(np.int32), size.astype(np.int32)]
        for low in range(0, len(text), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[low : low + (1 << 16)]) for c in columns], names=["id", "element", "place", "size"])

    found = own.select("id", "text").mapInArrow(by_text(send), "id long, element long, place int, size int")
    rows = cut(found.join(own.select("id", "root"), "id"))
    mixed = rows.groupBy("element").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("element")
    left = rows.join(mixed, "element", "left_semi")
    a = left.select("element", F.col("id").alias("a"), F.col("root").alias("root_a"), F.col("place").alias("place_a"), F.col("size").alias("size_a"))
    b = left.select("element", F.col("id").alias("b"), F.col("root").alias("root_b"), F.col("place").alias("place_b"), F.col("size").alias("size_b"))
    reach = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    enough = F.least("size_a", "size_b") >= least * F.greatest("size_a", "size_b") - 1e-6
    met = a.join(b, "element").where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & enough)
    both, larger = F.col("size_a") + F.col("size_b"), F.greatest("size_a", "size_b")  # as in ``demand``
    n = F.ceil(least / (1 + least) * both - 1e-6)
    e = F.least(F.greatest(n - F.ceil(least * larger - 1e-9), F.lit(0)), F.floor(both / FURTHER) + 1)
    counts = met.where(reach >= n - e).groupBy("a", "b").agg(F.count("*").alias("shared"), F.max(e + 1).alias("asked"))
    return counts.where("shared >= asked").select("a", "b")


def rest(groups: DataFrame, joined: DataFrame, items: DataFrame, partitions: int, sets: Sets, least: float) -> DataFrame:
    """(a, b) pairs of texts of mixed key groups that lie in different components and may reach the index."""
    labelled = groups.join(joined.withColumnRenamed("node", "member"), "member", "left").withColumn("root", F.coalesce("root", "member"))
    mixed = labelled.groupBy("gid").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n")).where("x <> y and n > 2").select("gid", "n")
    left = cut(labelled.where("member <> leader").join(mixed, "gid").select("gid", "member", "root", "n"))
    few = left.where(F.col("n") <= SMALL)
    right = few.select("gid", F.col("member").alias("b"), F.col("root").alias("root_b"))
    pairs = few.select("gid", F.col("member").alias("a"), F.col("root").alias("root_a")).join(right, "gid")
    pairs = pairs.where("a < b and root_a <> root_b").select("a", "b")
    many = left.where(F.col("n") > SMALL).select("member", "root").distinct()
    if many.isEmpty():
        return pairs.distinct()
    return pairs.unionAll(by_prefix(many, items, partitions, sets, least)).distinct()


def grouped(groups: DataFrame, items: DataFrame, partitions: int, sets: Sets, least: float) -> DataFrame:
    """(node, root) of the verified components."""
    stars = groups.where("member <> leader").select(F.col("leader").alias("a"), F.col("member").alias("b")).distinct()
    first = cut(verified(stars, items, partitions, sets, least))
    joined = components(first)
    others = cut(rest(groups, joined, items, partitions, sets, least))
    if others.isEmpty():
        return joined
    return components(first.unionAll(cut(verified(others, items, partitions, sets, least))))


def matched(found: DataFrame, items: Callable[[DataFrame], DataFrame], partitions: int, sets: Sets, least: float, prune: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, root) of the verified components of the rows of ``prefix_pairs``.

    items: (id, text) of at least the ids of a table. First each text is compared with one of its partners, that of most
    keys in common. Of the other pairs, and of the members of whole groups, by finer prefixes, those in different
    components are left; of these again one for each text comes first. So the pairs of a cluster are pruned and compared
    about once a text, and its square costs two numbers a listed pair.
    """

    def compare(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct()
        return cut(verified(pairs, items(ends), partitions, sets, least))

    def apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
        a, b = (joined.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b"))
        split = pairs.join(a, "a", "left").join(b, "b", "left")
        return split.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")

    turn = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("shared"), "a"))
    pairs = cut(found.repartition("b").groupBy("a", "b").agg(F.sum("shared").alias("shared")).select("a", "b", turn.alias("turn")))
    first = compare(cut(prune(pairs.where("turn = 1").select("a", "b"))))
    release(found.sparkSession)
    joined = components(first)
    others = apart(pairs.where("turn > 1").select("a", "b"), joined)
    groups = found.where("gid <> 0")
    if not groups.isEmpty():
        members = groups.select("gid", F.col("b").alias("member"), F.col("a").alias("leader"))
        members = members.unionAll(groups.select("gid", F.col("a").alias("member"), F.col("a").alias("leader")).distinct())
        held = items(members.select(F.col("member").alias("id")).distinct())
        others = others.unionAll(cut(rest(members, joined, held, partitions, sets, least))).distinct()
    near = cut(prune(cut(others)))
    if near.isEmpty():
        return joined
    release(found.sparkSession)
    first = first.unionAll(compare(cut(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))))
    joined = components(first)
    others = cut(apart(near, joined))
    if others.isEmpty():
        return joined
    return components(first.unionAll(compare(others)))
