"""Byte-level BPE encoding and decoding through a sentencepiece model that is written, not trained.

The model is serialised straight from a rank file: every token's bytes are spelled with one printable character a
byte, its score is its negative rank, and the normaliser is the identity. sentencepiece merges the pair whose joined
piece scores highest, leftmost first, which is the merge order of the ranks; so its ids are the ranks themselves.

Contract of ``encode_documents``: one row for each input row with columns (id, token_ids, n_tokens, exact).

* NULL text: token_ids, n_tokens and exact are NULL; NULL id: the row is kept, with a NULL id.
* empty text: no tokens, n_tokens 0, exact true. Texts of any length are encoded whole.
* repeated rows give repeated rows; ties can't occur (ranks are distinct); an empty table gives an empty table.
* only the two named columns are read, so further columns can't clash.
* ``exact`` says that decoding the ids gives the text back, byte for byte; it is computed for every row, so that a
  collision of the 64-bit hashes that pre-tokens are looked up by would show.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import tune
from .text import chunks, codes, prefix, runs, span_hash

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 300_000  # distinct pre-tokens that a worker remembers before it starts afresh


def default_vocabulary() -> str:
    """The rank file of the installed public tokenizers; any other path can be given instead."""
    folder = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
    if not os.path.isdir(folder) and (found := importlib.util.find_spec("public_tokenizers")):
        folder = os.path.dirname(found.origin)
    return os.path.join(folder, "byte_bpe_50k.tiktoken")


def byte_letters() -> list[str]:
    """A printable character for each of the 256 bytes: itself where it prints, else one from U+0100 on."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(spare)) for b in range(256)]


LETTERS = byte_letters()
TO_LETTERS = {b: LETTERS[b] for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of base64 tokens and ranks, which must be 0, 1, 2, ..."""
    ranked: dict[int, bytes] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranked[int(rank)] = base64.b64decode(token)
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranked[i] for i in range(len(ranked))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float | str) -> bytes:
    """One field of a protocol buffer: bytes, text, a float or a non-negative integer."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece model file: the tokens in rank order, then the unknown piece that the format asks for."""
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = _field(1, "".join(LETTERS[b] for b in token)) + _field(2, float(-rank)) + _field(3, 1)
        out += _field(1, piece)
    out += _field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    normaliser = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out) + _field(2, trainer) + _field(3, normaliser)


@lru_cache(1)
def classes() -> np.ndarray:
    """Of each code point: 0 letter, 1 number, 2 other, 3 white space, as the pattern's properties have it."""
    import regex

    points = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    out = np.full(0x110000, 2, np.uint8)
    for kind, name in ((0, r"\p{L}"), (1, r"\p{N}"), (3, r"\s")):
        out[list(map(ord, regex.findall(name, points)))] = kind
    return out


def split_starts(c: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the matches of PATTERN begin, over texts laid end to end; the matches cover every character.

    A match is a run of one class, with the space before it if there is one. White space before a run gives all but
    its last character as one match. An apostrophe that begins a match takes the letters of a contraction.
    """
    n = len(c)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[c]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = edge[:-1].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    last_space = (kind == 3) & np.append(kind[1:] != 3, True) & ~edge[1:]  # white space right before something else
    start = begins.copy()
    start |= last_space
    joins = np.zeros(n, bool)
    joins[1:] = last_space[:-1] & (c[:-1] == 32)
    start &= ~joins
    quote = np.flatnonzero((c == 39) & start)
    quote = quote[quote + 1 < n]
    if len(quote):
        quote = quote[~edge[quote + 1]]
        one = c[quote + 1]
        two = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], c[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = ((two == 101) & ((one == 114) | (one == 118))) | ((one == 108) & (two == 108))
        for found, length in ((quote[short], 2), (quote[long & ~short], 3)):
            start[found + 1] = False
            after = found + length
            after = after[after < n]
            start[after] |= kind[after] != 3
            blank = after[(kind[after] == 3)]
            start[blank] = True
    return np.flatnonzero(start)


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, tokens: list[bytes]):
        from sentencepiece import SentencePieceProcessor

        self.tokens = tokens
        self.model = SentencePieceProcessor(model_proto=serialise_model(tokens))
        self.known: dict[int, list[int]] = {}
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one more than there are texts)."""
        c, offsets = codes(texts)
        starts = split_starts(c, offsets)
        ends = np.append(starts[1:], len(c))[: len(starts)]
        hashes, where, which = np.unique(span_hash(prefix(c), starts, ends), return_index=True, return_inverse=True)
        keys = hashes.tolist()
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        new = [i for i, key in enumerate(keys) if key not in known]
        if new:
            whole, at = "".join(texts), where[new]
            spelled = [whole[a:b].encode().decode("latin-1").translate(TO_LETTERS) for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            known.update(zip((keys[i] for i in new), self.model.encode(spelled, num_threads=1)))
        rows = [known[key] for key in keys]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter(chain.from_iterable(rows), np.int32, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        each = sizes[which]
        ids = flat[np.repeat(begin[which], each) + runs(each)]
        total = np.append(0, np.cumsum(each))
        return ids, total[np.searchsorted(starts, offsets)]

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for, in a row."""
        each = self.lengths[ids]
        return self.bytes[np.repeat(self.begins[ids], each) + runs(each)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "strict")


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(read_ranks(path))


def encode_documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Token ids of every text; a single narrow stage. ``vocabulary``: a rank file that all executors can read."""
    path = vocabulary or default_vocabulary()
    tune(df.sparkSession)
    ids = F.col(id_column).cast("long").alias("id")
    kept = df.select(ids, F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            for low, high in chunks([t or "" for t in rows]):
                texts = [t or "" for t in rows[low:high]]
                missing = np.array([t is None for t in rows[low:high]])
                ids, offsets = coder.encode(texts)
                spelled = coder.spell(ids)
                at = np.append(0, np.cumsum(coder.lengths[ids]))[offsets].tolist()
                exact = [t.encode() == spelled[a:b].tobytes() for t, a, b in zip(texts, at, at[1:])]
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids), mask=pa.array(missing))
                counts = pa.array(np.diff(offsets).astype(np.int32), mask=missing)
                columns = [batch.column(0).slice(low, high - low), lists, counts, pa.array(np.array(exact, bool), mask=missing)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "token_ids", "n_tokens", "exact"])

    out = kept.mapInArrow(run, "id long, token_ids array<int>, n_tokens int, exact boolean")
    return out.withColumnRenamed("id", id_column)


def decode_documents(df: DataFrame, id_column: str = "doc_id", ids_column: str = "token_ids", vocabulary: str | None = None) -> DataFrame:
    """Texts from token ids, by inverse mapping; NULL ids give a NULL text."""
    path = vocabulary or default_vocabulary()
    tune(df.sparkSession)
    kept = df.select(F.col(id_column).cast("long").alias("id"), F.col(ids_column).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            texts = [None if row is None else coder.decode(row) for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return kept.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_column)
