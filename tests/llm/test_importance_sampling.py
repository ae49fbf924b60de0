import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from moodloom.llm import importance_sampling as imp
from moodloom.llm.spans import Buffer
from tests.llm import brute


def n_grams(text, max_n):
    words = brute.benchmark_words(text)
    return [b" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, max_n, buckets, percent, min_words, seed):
    """(id, n_words, n_features, weight, score) of each row, and the drawn places in order."""
    s, t = Counter(), Counter()
    for text in docs:
        s.update(zlib.crc32(g) % buckets for g in n_grams(text[1], max_n))
    for text in target:
        t.update(zlib.crc32(g) % buckets for g in n_grams(text, max_n))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    rows = []
    for doc_id, text in docs:
        grams = n_grams(text, max_n)
        weight = sum(gain(zlib.crc32(g) % buckets) for g in grams)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((doc_id, len(brute.benchmark_words(text)), len(grams), weight, score))
    able = sorted((-r[4], r[0] is None, r[0] or 0, r[2], i) for i, r in enumerate(rows) if r[1] >= min_words)
    return rows, [x[-1] for x in able[: percent * len(able) // 100]]


@pytest.mark.parametrize(("max_n", "buckets", "at_once"), [(1, 50, 1 << 20), (2, 1000, 64), (3, 7, 7)])
def test_equals_plain_python(spark, monkeypatch, max_n, buckets, at_once):
    monkeypatch.setattr(imp, "BYTES_AT_ONCE", at_once)
    monkeypatch.setattr(imp, "OCCURRENCES_AT_ONCE", at_once)
    rng = random.Random(max_n)
    some = ["the", "The", "cat", "é", "ÉA", "x1", "2024", "b" * 40, "b" * 39 + "c", "-", "漢字", "..", "a-b"]
    texts = [None, "", " .,! ", "one two\nthree", "w " * 5000]
    texts += [rng.choice([" ", "\n", ", "]).join(rng.choice(some) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    docs = [(None if i % 50 == 7 else i, t) for i, t in enumerate(texts)]
    target = [None, "", *texts[10:20]]
    expected, drawn = plain(docs, target, max_n, buckets, 10, 8, "s")
    rows = [(i, t, 1, "x") for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, rank int, weight string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = imp.resample(df, wanted, max_n, buckets, 10, 8, "s")
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    got = found.collect()
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, expected))
    ranked = sorted((r.rank, tuple(r)[:5]) for r in got if r["rank"] is not None)
    assert [r for r, _ in ranked] == list(range(1, len(drawn) + 1))
    assert [r[1][4] for r in ranked] == [expected[i][4] for i in drawn]
    assert [r[1][0] for r in ranked] == [expected[i][0] for i in drawn]


def test_equal_keys_stay_apart(monkeypatch):
    """All XXH64 keys equal: only the bytes tell the words apart."""
    monkeypatch.setattr(imp, "xxhash64", lambda buffer, start, size: np.zeros(len(start), np.uint64))
    words = imp.Words([b"a b a cc b a longer longer1 longer"])
    ((start, size, _),) = words.n_grams(1)
    table = imp.Table(words.buffer, start, size, 100)
    spelled = [bytes(words.buffer.bytes[a : a + n]) for a, n in zip(start, size)]
    assert len(table.used) == len(set(spelled)) == 5
    for slot, word in zip(table.slot.tolist(), spelled):
        assert table.count[slot] == spelled.count(word) and table.bucket[slot] == zlib.crc32(word) % 100


def test_table_of_nothing():
    empty = np.zeros(0, np.int64)
    table = imp.Table(Buffer(b""), empty, empty, 10)
    assert len(table.used) == len(table.slot) == 0


def test_ranks_over_many_ranges_and_equal_rows(spark):
    """A third of the rows are equal in id and score; the ranks still run without a gap."""
    rows = [(7 if i % 3 == 0 else i, 30, 30, 5, 1000 if i % 3 == 0 else i % 200) for i in range(3000)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = imp.draw(scored, 50, 20).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ranked = sorted((r["rank"], -r.score, r.doc_id) for r in got if r["rank"] is not None)
    assert len(got) == 3000 and [r[0] for r in ranked] == list(range(1, 1501))
    assert [r[1:] for r in ranked] == sorted((-r[4], r[0]) for r in rows)[:1500]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 30), (2, None)], "doc_id long, text string")
    assert imp.resample(docs.limit(0), docs).collect() == []
    got = {r.doc_id: r for r in imp.resample(docs, docs.limit(0), percent=100).collect()}
    assert got[1]["rank"] == 1 and got[1].n_features == 30 and got[1].weight < 0
    assert got[2]["rank"] is None and got[2].n_features == got[2].weight == 0


def test_drawn_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(i, "w " * 25, "en") for i in range(20)], "doc_id long, text string, lang string")
    ranked = imp.resample(docs, docs)
    drawn = imp.drawn_documents(docs, ranked)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in ranked.where("rank is not null").collect()}
    assert drawn.count() == 2
