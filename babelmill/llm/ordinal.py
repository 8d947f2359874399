"""Quality selection by cumulative-link regression on graded ratings, over hashed text.

Grades are ordered: 0 poor, 1 fluent but toxic, 2 good. One weight a hashed feature gives a text its score s, and
ordered thresholds t0 < t1 cut the line of scores: P(grade > j) = sigmoid(s - tj). The likelihood weighs each grade by
its frequency among all ratings, so that a text without evidence has about that frequency of being good. The model is fitted on the driver
from a sample of at most ``per_grade`` labelled texts of each grade, those whose hashed ids are smallest; scoring is
one narrow stage over all texts.

Contract:

* ``grades``: a label row with a NULL id, quality or toxic is left out; of several rows for one id the lowest grade counts.
* ``select_documents``: a row for each input row whose P(grade = best) is at least ``least``, with (id, expected_grade,
  tail_probability). NULL text is never selected; empty text is scored from its length features; repeated rows give
  repeated rows; NULL ids are scored like others; a tie at ``least`` is selected.
* with fewer than two grades among the labels nothing can be learned: every row with a text is selected, with NULL figures.
* an empty table gives an empty table; only id and text are read, so further columns can't clash.
* ``keep_selected`` returns the selected input rows unchanged, all columns included, whatever they are called; doc_id and
  text are found in any spelling of capitals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .blobs import named, tune, unused
from .text import chunks, codes, distinct, mix, prefix, span_hash

BITS = 18
PER_GRADE = 4000
LEAST = 0.65
DECAY = 1e-4
STEM = 5  # letters of a word that make its stem
SURPRISE = 5.0  # standard deviations between grades that a feature must show to get a weight


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point its lower case, and its class: 0 letter or digit, 1 white space, 2 other, 3 upper case."""
    lower, kind = np.arange(0x110000, dtype=np.uint32), np.full(0x110000, 2, np.uint8)
    for i in range(0x110000):
        x = chr(i)
        if x.isalnum():
            kind[i] = 3 if x.isupper() else 0
            if len(y := x.lower()) == 1:
                lower[i] = ord(y)
        elif x.isspace():
            kind[i] = 1
    return lower, kind


def features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) pairs, each once: which words, word stems and punctuation runs a text has, and its proportions in tenths."""
    lower, kinds = tables()
    c, offsets = codes(texts)
    kind = kinds[c]
    n = len(texts)
    solid = np.where(kind == 3, 0, kind)
    begins = np.zeros(len(c) + 1, bool)
    begins[offsets] = True
    begins[1:-1] |= solid[1:] != solid[:-1]
    at = np.flatnonzero(begins)
    starts, ends = at[:-1], at[1:]
    kept = solid[starts] != 1 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[kept], ends[kept]
    text = np.searchsorted(offsets, starts, "right") - 1
    word = solid[starts] == 0 if len(starts) else np.zeros(0, bool)
    mask, sums = np.uint64((1 << bits) - 1), prefix(lower[c])
    pairs = distinct(text.astype(np.uint64) << np.uint64(bits) | span_hash(sums, starts, ends) & mask)
    long = word & (ends - starts > STEM)
    stems = mix(span_hash(sums, starts[long], starts[long] + STEM), 3) & mask
    words = np.bincount(text[word], minlength=n)
    marks = np.bincount(text[~word], minlength=n)
    different = np.bincount((pairs >> np.uint64(bits)).astype(np.int64), minlength=n)
    upper = np.bincount(np.searchsorted(offsets, np.flatnonzero(kind == 3), "right") - 1, minlength=n)
    letters = np.bincount(text[word], (ends - starts)[word], minlength=n)
    shares = [
        np.log2(words + 1),
        10 * different / np.maximum(words + marks, 1),
        10 * upper / np.maximum(letters, 1),
        10 * marks / np.maximum(words + marks, 1),
        np.minimum(letters / np.maximum(words, 1), 30),
    ]
    dense = [mix((share.astype(np.int64) + 64 * g).astype(np.uint64), 7) & np.uint64((1 << bits) - 1) for g, share in enumerate(shares)]
    who = np.tile(np.arange(n), len(dense))
    pairs = distinct(np.concatenate([pairs, text[long].astype(np.uint64) << np.uint64(bits) | stems]))
    return np.concatenate([(pairs >> np.uint64(bits)).astype(np.int64), who]), np.concatenate([pairs & np.uint64((1 << bits) - 1), *dense]).astype(np.int64)


@dataclass
class Model:
    """Shared weights and ordered thresholds; ``grades`` are the rating values in order."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]
    bits: int

    def tails(self, texts: list[str]) -> np.ndarray:
        """P(grade > j) for each text (row) and threshold j (column)."""
        score = np.zeros(len(texts))
        for low, high in chunks(texts):
            who, which = features(texts[low:high], self.bits)
            score[low:high] = np.bincount(who, self.weights[which], minlength=high - low)
        return sigmoid(score[:, None] - self.thresholds[None, :])

    def expected(self, tails: np.ndarray) -> np.ndarray:
        steps = np.diff(np.array(self.grades, float))
        return self.grades[0] + tails @ steps


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def telling(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which features' shares of texts differ across a cut between grades by more than chance.

    counts: (grades, features) texts that have each feature; sizes: texts of each grade.
    """
    out = np.zeros(counts.shape[1], bool)
    n = sizes.sum()
    pooled = counts.sum(axis=0) / n
    for cut_ in range(1, len(sizes)):
        n0, n1 = sizes[:cut_].sum(), sizes[cut_:].sum()
        spread = np.sqrt(np.maximum(pooled * (1 - pooled), 0.5 / n) * (1 / n1 + 1 / n0))
        out |= np.abs(counts[cut_:].sum(axis=0) / n1 - counts[:cut_].sum(axis=0) / n0) > SURPRISE * spread
    return out


def fit(rows: list[np.ndarray], ratings: list[int], bits: int = BITS, epochs: int = 300, rate: float = 0.2, decay: float = DECAY, frequency: dict[int, int] | None = None) -> Model:
    """Maximum likelihood by Adam over all rows at once.

    frequency: how frequent each grade is where the sample was drawn from, which weights its rows; else all grades weigh
    the same. rows: the telling features of each text; ratings: its grade. The thresholds stay ordered as the gaps are exponentials.
    """
    grades = sorted(set(ratings))
    y = np.searchsorted(grades, ratings)
    n, m = len(rows), len(grades) - 1
    who = np.repeat(np.arange(n), [len(r) for r in rows])
    flat = np.concatenate(rows)
    used, which = np.unique(flat, return_inverse=True)
    parts = np.array([(frequency or {}).get(g, 1) for g in grades], float)
    share = (parts / parts.sum() / np.bincount(y))[y]
    w, free = np.zeros(len(used)), np.zeros(m)
    moments = [np.zeros_like(x) for x in (w, w, free, free)]
    for step in range(1, epochs + 1):
        cuts = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
        s = np.bincount(who, w[which], minlength=n)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        above, below = sigmoid(s - edges[y]), sigmoid(s - edges[y + 1])
        p = np.maximum(above - below, 1e-9)
        slope = share * (1 - above - below)
        lift, sink = share * above * (1 - above) / p, share * below * (1 - below) / p
        by_cut = np.zeros(m)
        np.add.at(by_cut, y[y > 0] - 1, -lift[y > 0])
        np.add.at(by_cut, y[y < m], sink[y < m])
        by_free = np.concatenate([[by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(free[1:])])
        by_w = np.bincount(which, slope[who], minlength=len(used)) - decay * w
        for x, g, a, b in ((w, by_w, moments[0], moments[1]), (free, by_free, moments[2], moments[3])):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            x += rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << bits, np.float32)
    weights[used] = w
    return Model(weights, free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))]), grades, bits)


def grades(labels: DataFrame) -> DataFrame:
    """(id, grade) from quality and toxic: 0 if the quality is 0, else 1 if toxic, else 2."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return known.select(F.col("doc_id").cast("long").alias("id"), grade.alias("grade")).groupBy("id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, rated: DataFrame, per_grade: int = PER_GRADE, bits: int = BITS) -> Model | None:
    """A model from at most ``per_grade`` texts of each grade; None if the ratings hold fewer than two grades.

    The sample is chosen among the ratings alone and is bounded, so it is broadcast to the one scan of the texts. Which
    features tell grades apart is counted by Spark; the driver gathers those features of the sample only.
    """
    tune(docs.sparkSession)
    order = F.xxhash64("id")
    picks = [rated.where(F.col("grade") == g).orderBy(order, "id").limit(per_grade) for g in (0, 1, 2)]
    sample = reduce(DataFrame.unionAll, picks)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text")).where("id is not null and text is not null")
    joined = texts.join(F.broadcast(sample), "id").select("grade", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = batch.column(1).to_pylist(), batch.column(0)
            for low, high in chunks(texts):
                who, which = features(texts[low:high], bits)
                order = np.argsort(who, kind="stable")
                offsets = np.append(0, np.cumsum(np.bincount(who, minlength=high - low))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(which[order].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([kept.slice(low, high - low), lists], names=["grade", "found"])

    found = cut(joined.mapInArrow(run, "grade int, found array<int>"))
    sizes = {r["grade"]: r["count"] for r in found.groupBy("grade").count().collect()}
    if len(sizes) < 2:
        return None
    order = sorted(sizes)
    each = found.select("grade", F.explode("found").alias("f"))
    by_grade = each.groupBy("f").agg(*(F.count_if(F.col("grade") == g).alias(f"g{g}") for g in order), F.count("*").alias("n"))
    # a feature of n texts, all on the smaller side of a cut, differs by about sqrt(n * larger / smaller) deviations
    sides = [(sum(sizes[g] for g in order[:i]), sum(sizes[g] for g in order[i:])) for i in range(1, len(order))]
    fewest = 0.8 * SURPRISE**2 / max(max(x) / min(x) for x in sides)
    seen = by_grade.where(F.col("n") >= fewest).drop("n").toArrow()
    counts = np.zeros((len(order), 1 << bits))
    for row, g in enumerate(order):
        counts[row, seen.column("f").to_numpy()] = seen.column(f"g{g}").to_numpy()
    kept = telling(counts, np.array([sizes[g] for g in order]))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[f for f in row if kept[f]] for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["grade", "found"])

    told = found.mapInArrow(narrow, "grade int, found array<int>").toArrow()
    ratings, lists = told.column("grade").to_pylist(), told.column("found").to_pylist()
    ordered = sorted(range(len(lists)), key=lambda i: (ratings[i], lists[i]))
    frequency = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect()}
    return fit([np.array(lists[i], np.int64) for i in ordered], [ratings[i] for i in ordered], bits, frequency=frequency)


def scored(df: DataFrame, model: Model | None, text_column: str, names: tuple[str, str], least: float) -> DataFrame:
    """The selected rows of df with two further columns: expected grade and P(best grade)."""
    tune(df.sparkSession)
    if model is None:
        return df.where(F.col(text_column).isNotNull()).withColumns({n: F.lit(None).cast("double") for n in names})
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    place = named(df, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(place).is_valid())
            tails = model.tails(batch.column(place).cast(pa.string()).to_pylist())
            best = tails[:, -1]
            columns = [*batch.columns, pa.array(model.expected(tails)), pa.array(best)]
            out = pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])
            yield out.filter(pa.array(best >= least))

    return df.mapInArrow(run, schema)


def select_documents(docs: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE, least: float = LEAST) -> DataFrame:
    """(doc_id, expected_grade, tail_probability) of the documents that the classifier keeps."""
    model = train(docs, grades(labels), per_grade)
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(kept, model, "text", ("expected_grade", "tail_probability"), least).drop("text")


def keep_selected(docs: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE, least: float = LEAST) -> DataFrame:
    """The input rows that the classifier keeps."""
    model = train(docs, grades(labels), per_grade)
    names = (unused(docs, "_expected"), unused(docs, "_tail"))
    return scored(docs, model, "text", names, least).drop(*names)
