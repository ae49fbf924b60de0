"""The registered queries without SQL, over the smallest tables, against plain Python."""

import hashlib
import zlib

import pytest

import __spark_entry__ as entry
from moodloom.llm import language_id, queries, sentence_pieces, token_counts
from tests.llm import brute
from tests.llm.test_lm_score import brute as lm_brute
from tests.llm.test_lm_score import same as same_scores

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name):
    rows = entry.queries()[name](spark, SF).collect()
    return {r.doc_id: r for r in rows}, len(rows)


def best_scores(text, scores, unknown, n):
    """Scores of the n best segmentations of a whole text, by dynamic programming over its characters."""
    text = f" {text}" if text else ""
    longest = max(map(len, scores))
    best = [[0.0]] + [[] for _ in text]
    for j in range(1, len(text) + 1):
        found = [s + unknown for s in best[j - 1]] if text[j - 1] not in scores else []
        for i in range(max(0, j - longest), j):
            own = scores.get(text[i:j])
            if own is not None:
                found += [s + own for s in best[i]]
        best[j] = sorted(found, reverse=True)[:n]
    return best[-1]


def test_op1_sentence_pieces(spark, documents):
    vocabulary = sentence_pieces.load_vocabulary(queries.PIECES)
    scores = {t: vocabulary.scores[i] for t, i in vocabulary.pieces.items()}
    got, n = run(spark, "op1_sentence_pieces")
    assert n == len(documents) and set(got) == set(documents)
    checked = 0
    for d, r in got.items():
        text = documents[d].text
        assert r.decoded_md5 == hashlib.md5(text.encode()).hexdigest() and r.ids_hash is not None and r.n_pieces > 0
        if len(text) < 4000:
            checked += 1
            found = [x for x in (r.score, r.score_2, r.score_3) if x is not None]
            assert found == pytest.approx(best_scores(text, scores, vocabulary.unknown_score, 3))
    assert checked > 100


def test_op2_language_id(spark, documents):
    got, n = run(spark, "op2_language_id")
    assert n == len(documents)
    langs = {r.lang for r in documents.values()} - {None}
    right = total = 0
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in documents[d].text or "")
        assert r.lang_pred in langs if letters else r.lang_pred == language_id.UNKNOWN
        if r.held_out and documents[d].lang is not None:
            total += 1
            right += r.lang_pred == documents[d].lang
    assert total > 20 and right / total >= 0.9


def test_op3_lm_score(spark, documents):
    rows = entry.queries()["op3_lm_score"](spark, SF).collect()
    same_scores(rows, lm_brute({d: r.text for d, r in documents.items()}))


def test_op9_token_counts(spark, documents):
    vocabulary = set(token_counts.load_pieces(queries.PIECES))
    got, n = run(spark, "op9_token_counts")
    assert n == len(documents)
    for d, r in got.items():
        text = documents[d].text or ""
        assert r.n_tokens == brute.greedy_tokens(text, vocabulary)
        assert r.n_chunks == (len(token_counts.chunks(text)) if text else 0)


def test_op10_line_dedup(spark, documents):
    texts = {d: r.text for d, r in documents.items()}
    gone = brute.repeated_lines(texts, 50)
    got, n = run(spark, "op10_line_dedup")
    assert n == len(documents) and sum(r.n_deleted > 0 for r in got.values()) == len(gone) > 0
    for d, r in got.items():
        lines = texts[d].split("\n")
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone.get(d, ()))
        assert (r.n_lines, r.n_deleted) == (len(lines), len(gone.get(d, ())))
        assert (r.n_chars, r.text_md5) == (len(left), hashlib.md5(left.encode()).hexdigest())
