"""LM scoring by deleted interpolation of word n-grams.

The probability of a token w after h is a mixture of maximum-likelihood estimates,

    P(w | h) = l2 c(h, w) / c(h) + l1 c(w) / N + l0 / (V + 1),

with weights that depend on the frequency bucket of the context h (powers of two). The weights
are learned by expectation-maximisation on held-out counts: one fold of the training documents
is deleted from the counts, and the weights maximise its likelihood. The mixture is then
used with the counts of all training documents.

How the counts meet the tokens. Each task packs its documents into blocks of about
``BLOCK_BYTES`` of text: word hashes, and the texts as numbers of words. A block asks for the
counts of its distinct words and word pairs, with its own counts of them, by sorted, compressed
arrays, one for each hash range. A hash range adds up what all blocks sent and answers each
block with the totals, in the order asked. A frequent word thus is sent once by each block, and
the shuffles carry some bytes per distinct pair of a block. Every task holds one block or one hash range;
there is a range for each ``RANGE_TOKENS`` tokens.

Counts are kept by 64-bit hashes of words and pairs. The mixture is learned from a histogram
of the held-out tokens by bucket and estimates, rounded to a quarter of an octave, whose size
has a fixed bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import fold
from moodloom.session import materialize

BLOCK_BYTES = 4 << 20
RANGE_TOKENS = 1 << 20
BATCH_BYTES = 2 << 20
BUCKETS = 48
STEP = 4  # histogram cells per octave
NONE = -(1 << 20)
_END = b" "  # no word holds a space

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _pack(values: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, compressed; high bytes of small numbers cost nothing."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = (first * _A) ^ (second + _B)
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and each value's place among them."""
    order = np.argsort(values)
    in_order = values[order]
    new = np.ones(len(values), bool)
    new[1:] = in_order[1:] != in_order[:-1]
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(new) - 1
    return in_order[new], place


class Block:
    """Tokens of a block as places among its words and pairs, both in the order of their hashes."""

    def __init__(self, hashes: np.ndarray, numbers: np.ndarray):
        self.words, place = _distinct(hashes)
        self.word = place[numbers]
        # Word number 0 ends every document, so it also stands before the next one.
        self.before = place[np.concatenate([[0], numbers[:-1]])]
        codes, code = _distinct(self.before * len(self.words) + self.word)
        keys = _pair_keys(self.words[codes // len(self.words)], self.words[codes % len(self.words)])
        order = np.argsort(keys)
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        self.pairs, self.pair = keys[order], rank[code]


def _blocks(docs: DataFrame, id_col: str, deleted: int, folds: int, held_out: int) -> DataFrame:
    """Rows (block, deleted, ids, kinds, sizes, hashes, numbers): kinds 0 trains, 1 is the deleted fold, 2 held out."""
    id_type = docs.schema[id_col].dataType.simpleString()
    part = fold(F.col(id_col), folds)
    kind = F.when(part == held_out, 2).when(part == deleted, 1).otherwise(0)
    rows = docs.select(F.col(id_col).alias("id"), "text", kind.alias("kind"))

    class Builder:
        def __init__(self, own: bool):
            self.own, self.serial = own, 0
            self.clear()

        def clear(self):
            self.words, self.numbers, self.bytes = {_END: 0}, [], 0
            self.ids, self.kinds, self.sizes = [], [], []

        def add(self, row_id, text, kind):
            raw = text.encode() if text else b""
            words = self.words
            # bytes.lower and bytes.split know ASCII only: A-Z, and the six white-space bytes.
            own = [words.setdefault(w, len(words)) for w in raw.lower().split()]
            own.append(0)
            self.numbers.append(np.array(own, np.uint32))
            self.ids.append(row_id)
            self.kinds.append(kind)
            self.sizes.append(len(own))
            self.bytes += len(raw) + 16

        def row(self, task, id_array) -> pa.RecordBatch:
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], np.uint64)
            self.serial += 1
            columns = [
                pa.array([f"{task}-{int(self.own)}-{self.serial}"]),
                pa.array([self.own]),
                pa.array([self.ids], pa.list_(id_array)),
                pa.array([self.kinds], pa.list_(pa.int32())),
                pa.array([self.sizes], pa.list_(pa.int32())),
                pa.array([hashes.tobytes()], pa.binary()),
                pa.array([_pack(np.concatenate(self.numbers))], pa.binary()),
            ]
            self.clear()
            names = ["block", "deleted", "ids", "kinds", "sizes", "hashes", "numbers"]
            return pa.RecordBatch.from_arrays(columns, names=names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, id_array = TaskContext.get().partitionId(), pa.int64()
        builders = Builder(False), Builder(True)
        for batch in batches:
            id_array = batch.column(0).type
            for row_id, text, kind in zip(*[c for c in batch.columns]):
                kind = kind.as_py()
                builder = builders[kind == 1]
                builder.add(row_id.as_py(), text.as_py(), kind)
                if builder.bytes >= BLOCK_BYTES:
                    yield builder.row(task, id_array)
        for builder in builders:
            if builder.ids:
                yield builder.row(task, id_array)

    return rows.mapInArrow(
        build,
        f"block string, deleted boolean, ids array<{id_type}>, kinds array<int>, sizes array<int>, "
        "hashes binary, numbers binary",
    )


def _load(hashes: bytes, numbers: bytes) -> Block:
    return Block(np.frombuffer(hashes, np.uint64), _unpack(numbers).astype(np.int64))


def _ask(blocks: DataFrame, ranges: int) -> DataFrame:
    """(kind, range, block, keys, kept, deleted): each block's words (kind 0) and pairs (1) with its own counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, kinds, sizes, hashes, numbers in zip(*[c for c in batch.columns]):
                block = _load(hashes.as_py(), numbers.as_py())
                token_kind = np.repeat(kinds.values.to_numpy(), sizes.values.to_numpy())
                rows = []
                for kind, keys, place in ((0, block.words, block.word), (1, block.pairs, block.pair)):
                    kept = np.bincount(place[token_kind == 0], minlength=len(keys))
                    gone = np.bincount(place[token_kind == 1], minlength=len(keys))
                    owner = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                    ends = np.searchsorted(owner, np.arange(ranges + 1, dtype=np.uint64))
                    for r, (low, high) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                        if low < high:
                            gaps = np.diff(keys[low:high], prepend=np.uint64(0))
                            rows.append((kind, r, name.as_py(), _pack(gaps), _pack(kept[low:high]), _pack(gone[low:high])))
                kind, r, block_name, keys, kept, gone = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kind, pa.int32()),
                        pa.array(r, pa.int32()),
                        pa.array(block_name),
                        pa.array(keys, pa.binary()),
                        pa.array(kept, pa.binary()),
                        pa.array(gone, pa.binary()),
                    ],
                    names=["kind", "range", "block", "keys", "kept", "gone"],
                )

    return blocks.select("block", "kinds", "sizes", "hashes", "numbers").mapInArrow(
        ask, "kind int, range int, block string, keys binary, kept binary, gone binary"
    )


_ANSWER = [("kind", "int"), ("range", "int"), ("block", "string"), ("kept", "binary"), ("gone", "binary"),
           ("n_kept", "bigint"), ("v_kept", "bigint"), ("n", "bigint"), ("v", "bigint")]


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    types = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    columns = list(zip(*rows)) if rows else [()] * len(_ANSWER)
    arrays = [pa.array(c, types[kind]) for c, (_, kind) in zip(columns, _ANSWER)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in _ANSWER])


def _answer(asked: DataFrame) -> DataFrame:
    """(kind, range, block, kept, gone, n_kept, v_kept, n, v): totals in the order asked; the sums of a
    range of words, of the kept part and of all training, stand on its first row."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        ready: list[tuple] = []
        held = 0
        for (kind, r), group in groupby(rows, key=lambda row: row[:2]):
            names, keys, kept, gone = [], [], [], []
            for _, _, name, k, a, b in group:
                names.append(name)
                keys.append(np.cumsum(_unpack(k)))
                kept.append(_unpack(a))
                gone.append(_unpack(b))
            ends = np.cumsum([len(k) for k in keys])[:-1]
            distinct, place = _distinct(np.concatenate(keys))
            sums = [np.bincount(place, np.concatenate(c), len(distinct)).astype(np.int64) for c in (kept, gone)]
            both = sums[0] + sums[1]
            facts = (int(sums[0].sum()), int((sums[0] > 0).sum()), int(both.sum()), int((both > 0).sum()))
            out = [np.split(s[place], ends) for s in sums]
            for i, name in enumerate(names):
                first = facts if kind == 0 and i == 0 else (0, 0, 0, 0)
                ready.append((kind, r, name, _pack(out[0][i]), _pack(out[1][i]), *first))
                held += len(ready[-1][3]) + len(ready[-1][4]) + 200
                if held > BATCH_BYTES:
                    yield _answers(ready)
                    ready, held = [], 0
        yield _answers(ready)

    # Ranges of both kinds are dealt out by number; arrays of one range are read by one task.
    dealt = asked.repartition("kind", "range").sortWithinPartitions("kind", "range", "block")
    return dealt.mapInArrow(answer, ", ".join(f"{name} {kind}" for name, kind in _ANSWER))


def _estimates(word, context, pair, n: int, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Bucket of the context, estimates by pair and by word, and the uniform one."""
    bucket = np.zeros(len(context), np.int64)
    seen = context > 0
    bucket[seen] = np.minimum(np.log2(context[seen]).astype(np.int64) + 1, BUCKETS - 1)
    return bucket, pair / np.maximum(context, 1), word / max(n, 1), 1.0 / (v + 1)


def _with_answers(blocks: DataFrame, answers: DataFrame, work, schema: str) -> DataFrame:
    """``work(block row, Block, word totals, pair totals)`` for each block, its totals being (kept, gone)."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((batch, i) for batch in batches for i in range(batch.num_rows))
        for _, group in groupby(rows, key=lambda x: x[0].column(0)[x[1]].as_py()):
            head, totals = None, {0: ([], []), 1: ([], [])}
            for batch, i in group:
                kind = batch.column(1)[i].as_py()
                if kind < 0:
                    head = batch.slice(i, 1)
                else:
                    for k in (0, 1):
                        totals[kind][k].append(_unpack(batch.column(3 + k)[i].as_py()).astype(np.int64))
            block = _load(head.column(3)[0].as_py(), head.column(4)[0].as_py())
            words, pairs = ([np.concatenate(x) for x in totals[kind]] for kind in (0, 1))
            yield work(head, block, words, pairs)

    own = blocks.select(
        "block", F.lit(-1).alias("kind"), F.lit(0).alias("range"), F.col("hashes").alias("x"), F.col("numbers").alias("y"),
        "ids", "kinds", "sizes",
    )
    none = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("ids", "kinds", "sizes")]
    sent = answers.select("block", "kind", "range", F.col("kept").alias("x"), F.col("gone").alias("y"), *none)
    rows = own.unionByName(sent).repartition("block").sortWithinPartitions("block", "kind", "range")
    return rows.mapInArrow(joined, schema)


def _histogram(blocks: DataFrame, answers: DataFrame, n: int, v: int) -> DataFrame:
    """(bucket, pair, word, count) of the deleted fold's tokens; estimates as rounded logarithms over the uniform one."""

    def cell(p: np.ndarray, least: float) -> np.ndarray:
        level = np.full(len(p), NONE, np.int64)
        level[p > 0] = np.rint(np.log2(p[p > 0] / least) * STEP).astype(np.int64)
        return level

    def count(head, block, words, pairs) -> pa.RecordBatch:
        bucket, p2, p1, p0 = _estimates(words[0][block.word], words[0][block.before], pairs[0][block.pair], n, v)
        cells, counts = np.unique(np.stack([bucket, cell(p2, p0), cell(p1, p0)], 1), axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [*[pa.array(cells[:, k]) for k in range(3)], pa.array(counts)], names=["bucket", "pair", "word", "count"]
        )

    return (
        _with_answers(blocks, answers, count, "bucket bigint, pair bigint, word bigint, count bigint")
        .groupBy("bucket", "pair", "word")
        .agg(F.sum("count").alias("count"))
    )


def mixture_weights(cells: np.ndarray, rounds: int = 100) -> np.ndarray:
    """(BUCKETS, 3) weights of pair, word and uniform estimate by EM on rows (bucket, pair, word, count).

    A bucket without held-out tokens takes the weights of the next lower one that has some.
    Contexts never seen (bucket 0) get no pair weight. No other weight is zero.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    if len(cells):
        bucket, count = cells[:, 0], cells[:, 3].astype(float)
        p = np.ones((len(cells), 3))
        for k in (0, 1):
            level = cells[:, 1 + k]
            p[:, k] = np.where(level == NONE, 0.0, np.exp2(level / STEP))
        for _ in range(rounds):
            share = weights[bucket] * p
            share *= (count / share.sum(axis=1))[:, None]
            total = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], 1)
            held = total.sum(axis=1) > 0
            weights[held] = total[held] / total[held].sum(axis=1, keepdims=True)
        for b in range(2, BUCKETS):
            if not held[b]:
                weights[b] = weights[b - 1]
    weights = np.maximum(weights, 1e-6)
    weights[0, 0] = 0
    return weights / weights.sum(axis=1, keepdims=True)


def score(
    docs: DataFrame, id_col: str = "doc_id", folds: int = 7, held_out: int = 2, deleted: int = 6
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    Tokens are the A-Z lower-cased words between white space, then one end. Documents whose fold
    (crc32 of the id as text, modulo ``folds``) is not ``held_out`` train; those of the fold ``deleted``
    also set the mixture. base_score sums log10((c + 1) / (N + V + 1)), score the log10
    probabilities of the mixture. A null text is an empty one: only an end. A null id counts as
    the text ''. Repeated rows count and are scored each. Without training documents, both
    scores rest on the uniform estimate. Other columns are ignored; an empty table gives an
    empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    blocks = materialize(_blocks(docs, id_col, deleted, folds, held_out), "blocks")
    tokens = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0]
    ranges = (tokens or 0) // RANGE_TOKENS + 1
    answers = materialize(_answer(_ask(blocks, ranges)), "answers")
    facts = answers.where("kind = 0").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_kept", "v_kept", "n", "v")])
    n_kept, v_kept, n, v = facts.first()
    deleted_blocks = blocks.where("deleted")
    deleted_answers = answers.where(F.element_at(F.split("block", "-"), 2) == "1")
    cells = _histogram(deleted_blocks, deleted_answers, n_kept, v_kept).collect()
    weights = mixture_weights(np.array([tuple(r) for r in cells], np.int64).reshape(-1, 4))
    if n == 0:
        weights[:] = (0, 0, 1)

    def judge(head, block, words, pairs) -> pa.RecordBatch:
        total, pair_total = words[0] + words[1], pairs[0] + pairs[1]
        c = total[block.word]
        bucket, p2, p1, p0 = _estimates(c, total[block.before], pair_total[block.pair], n, v)
        mix = weights[bucket]
        log_p = np.log10(mix[:, 0] * p2 + mix[:, 1] * p1 + mix[:, 2] * p0)
        base = np.log10((c + 1) / (n + v + 1))
        sizes = head.column(7)[0].values.to_numpy()
        starts = np.cumsum(sizes) - sizes
        return pa.RecordBatch.from_arrays(
            [
                head.column(5)[0].values,
                pa.array(head.column(6)[0].values.to_numpy() == 2),
                pa.array(sizes.astype(np.int64)),
                pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)),
                pa.array(np.full(len(sizes), n, np.int64)),
                pa.array(np.add.reduceat(base, starts)),
                pa.array(np.add.reduceat(log_p, starts)),
            ],
            names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return _with_answers(
        blocks,
        answers,
        judge,
        f"`{id_col}` {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
