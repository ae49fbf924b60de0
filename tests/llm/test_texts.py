import hashlib
import random

import pytest

from moodloom.llm import decontaminate as dc
from moodloom.llm import line_dedup as ld
from tests.llm import brute


def line_docs(rng):
    lines = ["a b", "c", "d e f", "", "  ", "a b ", "g h i j", "É é"]
    base = [[rng.choice(lines) for _ in range(30)] for _ in range(6)]
    docs = {}
    for i in range(60):
        own = rng.choice(base)
        at = rng.randrange(20)
        docs[i] = "\n".join(own[at : at + rng.randrange(12)] + rng.choice(base)[: rng.randrange(9)])
    docs |= {100: None, 101: "", 102: "x y\n" * 30, 103: "\n\n\n", 104: "w " * 5000, 105: "w " * 5000}
    docs[106] = "\n".join(f"only line {i}" for i in range(60)) + "\n" + "w " * 5000
    return docs


@pytest.mark.parametrize("min_words", [1, 4, 10, 23])
def test_line_runs_equal_brute_force(spark, min_words):
    docs = line_docs(random.Random(min_words))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    expected = brute.repeated_lines(docs, min_words)
    assert len(expected) >= 3
    assert {r.doc: set(r.lines) for r in ld.repeated_lines(df, min_words=min_words).collect()} == expected
    for r in ld.dedup_lines(df, min_words=min_words).collect():
        own = docs[r.doc_id]
        if own is None:
            assert (r.text, r.n_lines, r.n_deleted) == (None, 0, 0)
            continue
        gone = expected.get(r.doc_id, set())
        kept = [line for i, line in enumerate(own.split("\n")) if i not in gone]
        assert (r.text, r.n_lines, r.n_deleted) == ("\n".join(kept), len(own.split("\n")), len(gone))


def test_line_dedup_keeps_columns_and_repeated_rows(spark):
    run = "\n".join(f"line {i} of a passage" for i in range(12))
    rows = [(2, run, 9, 9), (2, run, 9, 9), (None, run, 9, 9), (None, run, 9, 9), (3, f"x\n{run}\ny", 9, 9), (4, "z", 9, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, n_lines int")
    got = ld.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "n_chars", "n_lines", "n_deleted"]
    found = sorted((r.doc_id or 0, r.text, r.n_chars, r.n_lines, r.n_deleted) for r in got.collect())
    # The null id comes first and keeps the run.
    assert found == [(0, run, len(run), 12, 0)] * 2 + [(2, "", 0, 12, 12)] * 2 + [(3, "x\ny", 3, 14, 12), (4, "z", 1, 1, 0)]
    assert ld.dedup_lines(df.limit(0)).count() == 0


def check_items(spark, docs, items, **options):
    df = spark.createDataFrame([(d, t, 1) for d, t in docs.items()], "doc_id long, text string, n_words int")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, word string")
    got = {}
    for r in dc.decontaminate(df, bench, **options).collect():
        got[r.doc_id] = (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
    expected = {}
    for d, (n, hit, found, bad) in brute.contaminated(docs, items, **options).items():
        expected[d] = (n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bad)
    assert got == expected
    return got


def item_docs(rng, window):
    vocabulary = ["the", "of", "and"] + [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 3 * window)))) for i in range(20)]
    docs = {}
    for i in range(80):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        if rng.random() < 0.6:
            part = rng.choice(items)[1].upper().split()
            at = rng.randrange(len(part))
            words[rng.randrange(len(words) + 1) : 0] = part[at : at + rng.randrange(2 * window)]
        docs[i] = rng.choice([" ", ", ", "\n"]).join(words) + rng.choice(["", ".", " "])
    return docs, items


@pytest.mark.parametrize("window, seed", [(3, 1), (5, 2), (13, 3)])
def test_items_equal_brute_force(spark, window, seed):
    got = check_items(spark, *item_docs(random.Random(seed), window), window=window)
    assert any(r[4] for r in got.values()) and any(r[1] and not r[4] for r in got.values()) | (window > 3)


def test_items_in_odd_texts(spark):
    long = " ".join(f"word{i}" for i in range(13))
    items = [(1, long), (2, long), (10, f"{long} extra"), (3, "Short One!"), (4, ""), (5, None), (6, "..."), (7, "été ÉTÉ")]
    docs = {
        1: None, 2: "", 3: "...", 4: long, 5: f"-{long.upper()}-", 6: "short-one", 7: "one short", 8: long[:-1], 9: "été été ÉTÉ",
        10: "short one " + "x " * 50_000, 11: "short one " + "x " * 38, 12: "short one " + "x " * 39, 13: f"{long} {long} extra",
    }
    got = check_items(spark, docs, items)
    assert got[4][2] == 3 and got[11][4] and not got[12][4] and got[6][1] == 2


def test_items_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", -1)
    check_items(spark, *item_docs(random.Random(9), 4), window=4)


def test_items_of_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "a b"), (None, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "a b"), (4, "c"), (4, "c")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in dc.decontaminate(df, bench).collect())
    assert got == [(0, 0, 0, 0, False), (0, 2, 2, 0, True), (1, 1, 1, 1, True), (1, 2, 2, 0, True), (1, 2, 2, 0, True)]
    assert dc.decontaminate(df.limit(0), bench).count() == 0
    assert [r.n_hit for r in dc.decontaminate(df, bench.limit(0)).collect()] == [0] * 5


def test_decontamination_is_native(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = dc.decontaminate(df, df.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
