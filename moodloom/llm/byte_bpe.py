"""Byte-level BPE encoding and decoding, with the ids of a rank file.

A text is cut by a pattern, and each match (pre-token) is encoded by itself. Two tiers:

1. A minimal perfect hash over the vocabulary (n tokens, n places, one pilot for every few tokens; Belazzougui,
   Botelho and Dietzfelbinger 2009) resolves all pre-tokens of a batch at once in numpy. The token at a
   pre-token's place is compared with it byte for byte, so there are no false hits.
2. A pre-token that is no token starts as a linked list of its bytes. A heap holds the rank of each
   neighbouring pair that forms a token; the lowest rank is merged first, the leftmost of equal ones. This takes
   n log n steps for n bytes. Results are remembered per task, in a table of bounded size.

All 256 single bytes are tokens, so every text has ids and decoding gives its bytes back.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodloom.llm.spans import Buffer, same_bytes, xxhash64

KEYS_PER_PILOT = 3
PILOTS_AT_ONCE = 128
REMEMBERED = 300_000
REMEMBERED_BYTES = 64
BYTES_AT_ONCE = 2 << 20
_MIX = np.uint64(0xD6E8FEB86659FD93)


def load_ranks(rank_file: str) -> list[bytes]:
    """The tokens of a rank file (base64 token and rank on each line) in the order of their ranks.

    Read on the driver only. Ranks must be 0 to n - 1 and hold all single bytes.
    """
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0 to n - 1")
    if not {bytes([b]) for b in range(256)} <= ranks.keys():
        raise ValueError("every single byte must be a token")
    return tokens


def _places(hashes: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    mixed = (hashes ^ (pilots.astype(np.uint64) * _MIX)) * _MIX
    mixed ^= mixed >> np.uint64(32)
    return ((mixed * _MIX) >> np.uint64(11)).astype(np.int64) % n


class PerfectHash:
    """Distinct keys to the places 0 to n - 1, one key each.

    Keys fall into groups; each group has a pilot number that sends its keys to free places. Large
    groups choose first, and a group of one key just names its place (as -place - 1).
    """

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.n_groups = max(1, n // KEYS_PER_PILOT)
        size = np.array([len(k) for k in keys], np.int64)
        start = np.cumsum(size) - size
        hashes = xxhash64(Buffer(b"".join(keys)), start, size)
        group = self._group(hashes)
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(self.n_groups + 1))
        taken = np.zeros(n, bool)
        place = np.zeros(n, np.int64)
        self.pilot = np.zeros(self.n_groups, np.int64)
        for g in np.argsort(-np.diff(bounds), kind="stable").tolist():
            own = order[bounds[g] : bounds[g + 1]]
            if len(own) < 2:
                break
            low = 0
            while True:
                pilots = np.arange(low, low + PILOTS_AT_ONCE)
                to = np.sort(_places(hashes[own][None, :], pilots[:, None], n), axis=1)
                good = ~taken[to].any(axis=1) & (np.diff(to, axis=1) > 0).all(axis=1)
                if good.any():
                    break
                low += PILOTS_AT_ONCE
            self.pilot[g] = pilots[good.argmax()]
            place[own] = _places(hashes[own], self.pilot[g : g + 1], n)
            taken[place[own]] = True
        single = order[bounds[:-1][np.diff(bounds) == 1]]
        place[single] = np.flatnonzero(~taken)[: len(single)]
        self.pilot[group[single]] = -place[single] - 1
        #: The key at each place, by its number in the list, its start and its size.
        self.key = np.empty(n, np.int64)
        self.key[place] = np.arange(n)
        self.start, self.size, self.data = start[self.key], size[self.key], b"".join(keys)
        self.longest = int(size.max(initial=0))

    def _group(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(33)).astype(np.int64) % self.n_groups

    def find(self, buffer: Buffer, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number of the key that each span equals, or -1."""
        found = np.full(len(start), -1, np.int64)
        short = np.flatnonzero((size <= self.longest) & (size > 0))
        if not self.n or not len(short):
            return found
        hashes = xxhash64(buffer, start[short], size[short])
        pilot = self.pilot[self._group(hashes)]
        place = np.where(pilot < 0, -pilot - 1, _places(hashes, np.maximum(pilot, 0), self.n))
        fits = np.flatnonzero(self.size[place] == size[short])
        at = short[fits]
        same = same_bytes(buffer, start[at], self.buffer, self.start[place[fits]], size[at])
        found[at[same]] = self.key[place[fits[same]]]
        return found

    @property
    def buffer(self) -> Buffer:
        if not hasattr(self, "_buffer"):
            self._buffer = Buffer(self.data)
        return self._buffer

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_buffer"}


@dataclass
class Tokenizer:
    """What tasks need: tokens by id, the hash over them, the pattern."""

    tokens: list[bytes]
    hash: PerfectHash
    pattern: str


def build(tokens: list[bytes], pattern: str) -> Tokenizer:
    return Tokenizer(tokens, PerfectHash(tokens), pattern)


class Merger:
    """Ids of single pre-tokens."""

    def __init__(self, tokens: list[bytes]):
        self.ranks = {token: i for i, token in enumerate(tokens)}
        self.byte_pairs = [self.ranks.get(bytes(divmod(p, 256)), -1) for p in range(1 << 16)]

    def __call__(self, piece: bytes) -> list[int]:
        """Merges neighbours, lowest rank first, then leftmost."""
        n, ranks, byte_pairs = len(piece), self.ranks, self.byte_pairs
        get, pop, push = ranks.get, heapq.heappop, heapq.heappush
        after = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n - 1))  # where the part before it starts
        # The rank of the part that starts here with the next one.
        pair = [byte_pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
        pair.append(-1)
        shift = n.bit_length()
        low = (1 << shift) - 1
        heap = [rank << shift | i for i, rank in enumerate(pair) if rank >= 0]
        heapq.heapify(heap)
        while heap:
            key = pop(heap)
            i = key & low
            if pair[i] != key >> shift:
                continue  # one of the two has been merged since
            j = after[i]
            end = after[i] = after[j]
            pair[j] = pair[i] = -1
            if end < n:
                before[end] = i
                rank = get(piece[i : after[end]])
                if rank is not None:
                    pair[i] = rank
                    push(heap, rank << shift | i)
            left = before[i]
            if left >= 0:
                rank = pair[left] = get(piece[left:end], -1)
                if rank >= 0:
                    push(heap, rank << shift | left)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids


class Encoder:
    """Ids of many texts at once."""

    def __init__(self, tokenizer: Tokenizer):
        import regex

        self.split = regex.compile(tokenizer.pattern).findall
        self.hash = tokenizer.hash
        self.merge = Merger(tokenizer.tokens)
        self.known: dict[bytes, list[int]] = {}

    def _merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token that is no token."""
        known = self.known
        found = list(map(known.get, pieces))
        for i, ids in enumerate(found):
            if ids is None:
                piece = pieces[i]
                found[i] = ids = known.get(piece) or self.merge(piece)
                if len(piece) <= REMEMBERED_BYTES:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = ids
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the number of each text's."""
        split = self.split
        pieces, n_pieces = [], []
        for text in texts:
            own = split(text)
            n_pieces.append(len(own))
            pieces += own
        column = pa.array(pieces, pa.large_string())
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64)[: len(pieces) + 1] if pieces else np.zeros(1, np.int64)
        raw = data.to_pybytes()[: bounds[-1]] if data is not None else b""
        found = self.hash.find(Buffer(raw), bounds[:-1], np.diff(bounds))
        missed = np.flatnonzero(found < 0)
        lists = self._merged([raw[a:b] for a, b in zip(bounds[missed].tolist(), bounds[missed + 1].tolist())])
        counts = np.ones(len(found), np.int64)
        counts[missed] = list(map(len, lists))
        ids = np.repeat(found, counts)
        ids[ids < 0] = list(chain.from_iterable(lists))
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *n_pieces])]
        return ids.astype(np.int32), np.diff(ends)


def _parts(batch: pa.RecordBatch, column: int, most: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about so many bytes of text at most, or a single row."""
    sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column).cast(pa.large_binary())]
    low = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(low, i - low)
            low, total = i, 0
        total += size
    if low < len(sizes):
        yield batch.slice(low)


_KINDS = {"ids": "array<int>", "packed": "binary", "decoded": "binary"}


def encode(
    docs: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", columns: tuple[str, ...] = ("ids",)
) -> DataFrame:
    """(id, n_tokens, and the chosen columns) of each whole text.

    ``ids`` is an array, ``packed`` the same as little-endian unsigned 32-bit numbers, ``decoded`` the
    bytes that the ids spell. A null text counts as empty: no ids, no bytes. Strings of special
    tokens are ordinary text. Repeated rows are encoded one by one, other columns are ignored, whatever their
    names, and an empty table gives an empty result. A text of one long pre-token takes n log n steps.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)  # as large as the vocabulary
    id_type = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tokens = Encoder(shared.value), shared.value.tokens
        for batch in batches:
            for part in _parts(batch, 1):
                ids, counts = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                bounds = np.concatenate([[0], np.cumsum(counts)])
                made = [part.column(0), pa.array(counts, pa.int64())]
                rows = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                for name in columns:
                    if name == "ids":
                        made.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)))
                    elif name == "packed":
                        packed = ids.astype("<u4").tobytes()
                        made.append(pa.array([packed[4 * a : 4 * b] for a, b in rows], pa.binary()))
                    else:
                        spelled = [tokens[i] for i in ids.tolist()]
                        made.append(pa.array([b"".join(spelled[a:b]) for a, b in rows], pa.binary()))
                yield pa.RecordBatch.from_arrays(made, names=names)

    names = [id_col, "n_tokens", *columns]
    schema = ", ".join([f"`{id_col}` {id_type}", "n_tokens bigint", *[f"{c} {_KINDS[c]}" for c in columns]])
    return docs.select(F.col(id_col), F.col("text")).mapInArrow(work, schema)


def decode(rows: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``rows`` with a column ``decoded``: the bytes that the column ``ids`` spells.

    Null ids give null, no ids no bytes; null ids inside and ids outside the vocabulary spell nothing. A column
    named ``decoded`` is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(tokenizer.tokens)
    kept = rows.drop("decoded")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())])
    names = [*kept.columns, "decoded"]
    place = names.index("ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            spelled = [
                None if ids is None else b"".join([tokens[i] for i in ids if i is not None and 0 <= i < len(tokens)])
                for ids in batch.column(place).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spelled, pa.binary())], names=names)

    return kept.mapInArrow(work, schema)
