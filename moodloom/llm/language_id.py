"""Language ID by a byte convolutional network.

Filters of several widths run over the bytes of a fixed-length window, each filter keeps
its maximum, and a softmax layer turns the maxima into language probabilities. The network is
trained in numpy on the driver, on windows of a bounded sample of the labelled rows.

A whole text is cut into windows of ``WINDOW`` bytes; its probabilities are the mean over its
windows, weighted by their bytes. Windows are evaluated in batches of ``BATCH``, so memory
does not depend on the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodloom.llm.arrow_text import text_bytes

WINDOW = 256
BATCH = 64
WIDTHS = (2, 3, 4)
FILTERS = 16
UNKNOWN = "und"
# Bounds of the training sample: documents of one language, and of all. Every language has its share.
DOCS_PER_LANG = 1_500
DOCS = 60_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class ByteCnn:
    """``taps[j][k]`` holds what byte b adds, k bytes after the start of a filter of width j."""

    langs: list[str]
    taps: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: np.ndarray  # (filters of all widths,)
    weight: np.ndarray  # (filters of all widths, languages)
    offset: np.ndarray  # (languages,)

    def pair_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What the byte pairs at 0-1 and 2-3 after a start add to all filters."""
        first, second = [], []
        for taps in self.taps:
            none = np.zeros((256, taps.shape[2]), np.float32)
            tap = [taps[k] if k < len(taps) else none for k in range(4)]
            first.append((tap[0][:, None] + tap[1][None, :]).reshape(65_536, -1))
            second.append((tap[2][:, None] + tap[3][None, :]).reshape(65_536, -1))
        return np.hstack(first).astype(np.float32), np.hstack(second).astype(np.float32)

    def probabilities(self, windows: np.ndarray, tables=None) -> np.ndarray:
        """(windows, languages) from (windows, WINDOW) lower-cased, zero-filled bytes."""
        first, second = tables or self.pair_tables()
        result = np.empty((len(windows), len(self.langs)))
        for at in range(0, len(windows), BATCH):
            part = windows[at : at + BATCH].astype(np.uint16)
            pairs = (part[:, :-1] << 8) | part[:, 1:]
            peak = (first[pairs[:, :-2]] + second[pairs[:, 2:]]).max(axis=1)
            hidden = np.maximum(peak + self.bias, 0)
            result[at : at + BATCH] = _softmax(hidden @ self.weight + self.offset)
        return result


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zero-filled windows of all texts, each one's text number and byte count."""
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-lengths // WINDOW))
    flat = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    starts = (np.cumsum(counts) - counts) * WINDOW
    for start, low, high in zip(starts.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        flat[start : start + high - low] = data[low:high]
    owner = np.repeat(np.arange(len(lengths)), counts)
    filled = np.minimum(WINDOW, lengths[owner] - (np.arange(len(owner)) * WINDOW - starts[owner]))
    return _LOWER[flat].reshape(-1, WINDOW), owner, np.maximum(filled, 1)


def train(texts: list[str], langs: list[str], epochs: int = 12, seed: int = 1) -> ByteCnn:
    """Adam on the cross entropy; the gradient of a maximum goes to the bytes that made it."""
    names = sorted(set(langs))
    if not names:
        raise ValueError("no labelled text to learn from")
    encoded = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([min(len(e), WINDOW) for e in encoded])]).astype(np.int64)
    data = np.frombuffer(b"".join(e[:WINDOW] for e in encoded), np.uint8)
    windows, owner, _ = cut_windows(data, offsets)
    target = np.array([names.index(v) for v in langs])[owner]
    rng = np.random.default_rng(seed)
    shape = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
    total = FILTERS * len(WIDTHS)
    params = [shape(w, 256, FILTERS) for w in WIDTHS] + [
        np.zeros(total, np.float32),
        shape(total, len(names)),
        np.zeros(len(names), np.float32),
    ]
    moment, power, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    span = WINDOW - max(WIDTHS) + 1
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, y = windows[rows], target[rows]
            peaks, places = [], []
            for j, width in enumerate(WIDTHS):
                z = sum(params[j][k][x[:, k : k + span]] for k in range(width))
                place = z.argmax(axis=1)
                places.append(place)
                peaks.append(np.take_along_axis(z, place[:, None, :], 1)[:, 0])
            before = np.hstack(peaks) + params[-3]
            hidden = np.maximum(before, 0)
            error = _softmax(hidden @ params[-2] + params[-1])
            error[np.arange(len(y)), y] -= 1
            error = (error / len(y)).astype(np.float32)
            back = (error @ params[-2].T) * (before > 0)
            grads = []
            for j, width in enumerate(WIDTHS):
                grad = np.zeros_like(params[j])
                own = back[:, j * FILTERS : (j + 1) * FILTERS]
                for k in range(width):
                    byte = np.take_along_axis(x, places[j] + k, 1)
                    np.add.at(grad[k], (byte, np.arange(FILTERS)[None, :]), own)
                grads.append(grad)
            grads += [back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(params, grads, moment, power):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return ByteCnn(names, params[: len(WIDTHS)], *params[len(WIDTHS) :])


def has_letters(text) -> object:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample_windows(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> tuple[list[str], list[str]]:
    """Texts and languages to learn from: of about ``docs_per_lang`` documents of each language (fewer where all
    would be more than ``DOCS``), chosen by a hash of the id, one window at a random place and one short piece. Reads
    (doc_id, text, lang); only these pieces, and a count for each language, reach the driver."""
    rows = labelled.where(F.col("lang").isNotNull() & has_letters(F.col("text"))).select(
        "doc_id", "lang", "text"
    )
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return [], []
    each = max(1, min(docs_per_lang, DOCS // len(counts)))
    chances = labelled.sparkSession.createDataFrame(
        [(r["lang"], each / r["count"]) for r in counts], "lang string, chance double"
    )
    draw = F.pmod(F.xxhash64(F.lit("draw"), "doc_id"), F.lit(1_000_000)) / 1e6
    start = F.pmod(F.xxhash64(F.lit("start"), "doc_id"), F.greatest(F.length("text") - WINDOW, F.lit(1))) + 1
    start = start.cast("int")
    size = (F.pmod(F.xxhash64(F.lit("size"), "doc_id"), F.lit(60)) + 12).cast("int")
    picked = (
        rows.join(F.broadcast(chances), "lang")  # a row for each language
        .where(draw < F.col("chance"))
        .select(
            "lang",
            F.explode(
                F.array(F.substring("text", start, F.lit(WINDOW)), F.substring("text", start, size))
            ).alias("piece"),
        )
        .where(has_letters(F.col("piece")))
        # Repeated ids are drawn together; the order makes the bound take the same pieces every time.
        .orderBy(F.xxhash64("lang", "piece"), "lang", "piece")
        .limit(3 * each * len(counts))
        .collect()
    )
    picked.sort(key=lambda r: (r["lang"], r["piece"]))
    return [r["piece"] for r in picked], [r["lang"] for r in picked]


def fit(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> ByteCnn | None:
    """Network trained on a bounded sample of (doc_id, text, lang); None if nothing is labelled."""
    texts, langs = sample_windows(labelled, docs_per_lang)
    return train(texts, langs) if texts else None


def annotate(docs: DataFrame, model: ByteCnn | None) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score``: the likeliest language of each
    whole text and its probability.

    A text that is null, or has no letter, or meets no model is ``und`` with score 0. Repeated
    rows are judged one by one, ties go to the first language by name, columns named like
    the new ones are replaced, and an empty table gives an empty result.
    """
    kept = docs.drop("lang_pred", "score")
    if model is None:
        return kept.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*kept.schema.fields, *fields])
    names = schema.fieldNames()
    text, width = names.index("text"), len(kept.columns)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.pair_tables()
        langs = np.array(model.langs, dtype=object)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                windows, owner, weight = cut_windows(*text_bytes(part.column(text)))
                found = model.probabilities(windows, tables) * weight[:, None]
                sums = np.zeros((part.num_rows, len(langs)))
                np.add.at(sums, owner, found)
                sums /= sums.sum(axis=1, keepdims=True)
                best = sums.argmax(axis=1)
                known = np.asarray(part.column(width))
                lang = np.where(known, langs[best], UNKNOWN)
                score = np.where(known, sums[np.arange(len(best)), best], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], pa.array(lang, pa.string()), pa.array(np.clip(score, 0.0, 1.0))],
                    names=names,
                )

    return kept.withColumn("_letters", has_letters(F.col("text"))).mapInArrow(judge, schema)


def predict(docs: DataFrame, model: ByteCnn | None, id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score) of each row, as ``annotate`` gives them; other columns are ignored."""
    return annotate(docs.select(id_col, "text"), model).drop("text")
