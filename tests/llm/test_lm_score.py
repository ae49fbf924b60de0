import math
import zlib
from collections import Counter

import numpy as np
import pytest

from moodloom.llm import lm_score as lm

SF = "/root/testdata/sf0.001"


def brute(docs):
    """(n_tokens, n_known, N, base, score) by plain counts; the weights come from the same EM."""
    tokens = {d: (t or "").encode().lower().split() + [b" "] for d, t in docs.items()}
    part = {d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 for d in docs}

    def counts(folds):
        words, pairs = Counter(), Counter()
        for d, own in tokens.items():
            if part[d] in folds:
                words.update(own)
                pairs.update(zip([b" ", *own[:-1]], own))
        return words, pairs, sum(words.values()), len(words)

    def estimates(model, before, w):
        words, pairs, n, v = model
        c = words[before]
        bucket = min(int(math.log2(c)) + 1, lm.BUCKETS - 1) if c else 0
        return bucket, pairs[before, w] / max(c, 1), words[w] / max(n, 1), 1 / (v + 1)

    kept = counts({0, 1, 3, 4, 5})
    cells = Counter()
    for d, own in tokens.items():
        if part[d] == 6:
            for before, w in zip([b" ", *own[:-1]], own):
                b, p2, p1, p0 = estimates(kept, before, w)
                cell = [lm.NONE if p == 0 else round(float(np.rint(np.log2(p / p0) * lm.STEP))) for p in (p2, p1)]
                cells[b, cell[0], cell[1]] += 1
    weights = lm.mixture_weights(np.array([(*k, n) for k, n in cells.items()], np.int64).reshape(-1, 4))
    full = counts({0, 1, 3, 4, 5, 6})
    words, _, n, v = full
    result = {}
    for d, own in tokens.items():
        score = 0.0
        for before, w in zip([b" ", *own[:-1]], own):
            b, *p = estimates(full, before, w)
            score += math.log10(float(np.dot(weights[b], p)))
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own)
        result[d] = (part[d] == 2, len(own), sum(w in words for w in own), n, base, score)
    return result


def same(got, expected):
    assert len(got) == len(expected)
    for r in got:
        e = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[:4]
        assert r.base_score == pytest.approx(e[4], rel=1e-9) and r.score == pytest.approx(e[5], rel=1e-9)


def test_equals_plain_counts(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute({r.doc_id: r.text for r in docs.collect()})
    same(lm.score(docs).collect(), expected)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 5_000)  # many small blocks
    got = lm.score(docs).collect()
    same(got, expected)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(spark):
    rows = [(i, f"a b{i % 3} É é a b", 1.0) for i in range(40)]
    rows += [(100, None, 1.0), (101, "", 1.0), (102, " \t\n\x0b\x0c\r", 1.0), (103, "w " * 30_000, 1.0), (None, "a", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    same(lm.score(df).collect(), brute({r[0]: r[1] for r in rows}))
    assert lm.score(df.limit(0)).count() == 0


def test_nothing_to_learn_from(spark):
    held_out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    df = spark.createDataFrame([(i, "a b") for i in held_out], "doc_id long, text string")
    got = lm.score(df).collect()
    assert len(got) == len(held_out) and {(r.train_tokens, r.n_known, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}


def test_repeated_rows_count_each(spark):
    df = spark.createDataFrame([(2, "a b")] * 3, "doc_id long, text string")
    assert [r.train_tokens for r in lm.score(df).collect()] == [9, 9, 9]


def test_weights_follow_the_held_out_counts():
    far = 10 * lm.STEP
    cells = np.array([(3, far, 0, 90), (3, lm.NONE, 0, 10), (5, lm.NONE, far, 50)], np.int64)
    w = lm.mixture_weights(cells)
    assert np.allclose(w.sum(axis=1), 1) and w[0, 0] == 0 and (w[1:] > 0).all()
    assert w[3, 0] == pytest.approx(0.9, abs=0.01) and w[5, 1] > 0.99
    assert (w[7] == w[5]).all()


def test_packing():
    x = np.array([0, 1, 2**63, 2**64 - 1, 7], np.uint64)
    assert (lm._unpack(lm._pack(x)) == x).all() and len(lm._unpack(lm._pack(x[:0]))) == 0
