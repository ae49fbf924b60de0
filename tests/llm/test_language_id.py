import numpy as np
import pytest
from pyspark.sql import functions as F

from moodloom.llm import language_id as lid
from moodloom.llm.common import fold

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return lid.fit(documents.where(fold(F.col("doc_id"), 5) != 0), docs_per_lang=60)


def test_held_out_accuracy(documents, model):
    held_out = documents.where(fold(F.col("doc_id"), 5) == 0)
    judged = lid.annotate(held_out, model).where("lang is not null")
    right, n = judged.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n >= 0.97


def test_odd_texts(spark, model):
    long = "Der und die keit " * 20_000
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the"), (5, long), (5, long), (6, "漢字"), (None, "The and of")]
    df = spark.createDataFrame([(*r, "old", 7) for r in rows], "doc_id long, text string, lang_pred string, score int")
    got = lid.annotate(df, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"] and got.count() == 8
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert by_id[1] == by_id[2] == by_id[3] == ("und", 0.0)
    assert by_id[5][0] == "de" and all(0 <= s <= 1 for _, s in by_id.values())
    assert lid.predict(df.limit(0), model).count() == 0


def test_nothing_labelled(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "en"), (3, "12", "en")], "doc_id long, text string, lang string")
    assert lid.fit(df) is None
    assert {(r.lang_pred, r.score) for r in lid.predict(df, None).collect()} == {("und", 0.0)}


def test_network_equals_plain_convolution():
    model = lid.train(["hello the end", "bonjour la fin", "the hen"], ["en", "fr", "en"], epochs=2)
    text = "the Fin hello"
    padded = np.zeros(lid.WINDOW, np.uint8)
    padded[: len(text)] = np.frombuffer(text.lower().encode(), np.uint8)
    peaks = []
    for taps in model.taps:
        width = len(taps)
        for f in range(taps.shape[2]):
            at = range(lid.WINDOW - max(lid.WIDTHS) + 1)
            peaks.append(max(sum(taps[k][padded[p + k], f] for k in range(width)) for p in at))
    logits = np.maximum(np.array(peaks) + model.bias, 0) @ model.weight + model.offset
    expected = np.exp(logits) / np.exp(logits).sum()
    windows, owner, filled = lid.cut_windows(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    assert (windows[0] == padded).all() and owner.tolist() == [0] and filled.tolist() == [len(text)]
    assert np.allclose(model.probabilities(windows)[0], expected, atol=1e-5)


def test_windows_cover_whole_texts():
    data = np.frombuffer(b"x" * 600 + b"y" * 256, np.uint8)
    windows, owner, filled = lid.cut_windows(data, np.array([0, 600, 600, 856]))
    assert owner.tolist() == [0, 0, 0, 1, 2] and filled.tolist() == [256, 256, 88, 1, 256]
    assert (windows[owner == 0] == ord("x")).sum() == 600 and (windows[4] == ord("y")).all()


def test_every_language_is_learned(spark, monkeypatch):
    """150 languages, each with words of its own; the bound on all rows leaves a share to each."""
    monkeypatch.setattr(lid, "DOCS", 150 * 8)
    rows = []
    for n in range(150):
        word = "".join(chr(97 + (n * k + n // 26 + k * k) % 26) for k in range(1, 6)) + chr(97 + n % 26) + chr(97 + n // 26)
        rows += [(1000 * n + i, f"{word} " * 40, f"lang{n:03d}") for i in range(12)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    texts, langs = lid.sample_windows(labelled)
    assert len(set(langs)) == 150 and len(texts) <= 3 * 8 * 150
    assert (texts, langs) == lid.sample_windows(labelled.repartition(7))
    model = lid.train(texts, langs)
    assert len(model.langs) == 150
    judged = lid.annotate(labelled, model)
    right, n = judged.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.9
