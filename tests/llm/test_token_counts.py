import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moodloom.llm import token_counts
from tests.llm import brute

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@given(st.lists(st.text("abc", min_size=1, max_size=5), max_size=12), st.text("abcé", max_size=30))
@settings(max_examples=300, deadline=None)
def test_automaton_equals_longest_match(vocabulary, text):
    # brute puts a space before the text; it is no piece here and counts one byte.
    machine = token_counts.build(vocabulary)
    expected = brute.greedy_tokens(text, set(vocabulary)) - bool(text)
    assert machine.count(text) == expected


@pytest.fixture(scope="module")
def pieces():
    return token_counts.load_pieces(PIECES)


def test_real_vocabulary_by_whole_texts(pieces):
    machine, known = token_counts.build(pieces), set(pieces)
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice(["the", " ", "  ", "\n", "keit", "é", "漢", "▁", "ing", "X", "🙂", "."]) for _ in range(30))
        assert sum(map(machine.count, token_counts.chunks(text))) == brute.greedy_tokens(text, known)


def test_rows(spark, pieces):
    texts = [None, "", " ", "a", "word " * 50_000, "word " * 50_000, "x" * 100_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: (r.n_chunks, r.n_tokens) for r in token_counts.count_tokens(df, token_counts.build(pieces)).collect()}
    assert got[0] == got[1] == (0, 0) and got[4] == got[5]
    assert [got[i][1] for i in range(2, 7)] == [brute.greedy_tokens(texts[i], set(pieces)) for i in range(2, 7)]
    assert token_counts.count_tokens(df.limit(0), token_counts.build(pieces)).count() == 0


def test_empty_vocabulary():
    assert token_counts.build([]).count(" é") == 3
