import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from moodloom.llm import spelling_variants as sv


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_counts(docs, noise, min_chars, min_count):
    total = Counter()
    for doc_id, text in docs:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= min_chars:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= min_count}


def plain_groups(words, ratio):
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best
    rows = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, n, form.get(w), words.get(form.get(w)), root, len(near[w])))
    return rows


def as_rows(df):
    return {(r.word, r.n, r.form, r.form_n, r.root, r.n_near) for r in df.collect()}


@pytest.mark.parametrize("symbols", [2, 8])
def test_groups_equal_all_pairs(spark, symbols):
    rng = random.Random(symbols)
    letters = "abAzéÿÀ"
    words = {"".join(rng.choice(letters.lower() + "À") for _ in range(rng.randint(1, 6))): rng.choice([1, 1, 2, 5, 6, 30, 150, 900]) for _ in range(500)}
    words |= {"q" * 40: 1, "q" * 41: 5, "q" * 42: 25, "q" * 43: 125, "q" * 44: 625, "q" * 46: 9999, "a": 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    got = sv.group_variants(df, 5, symbols)
    assert got.count() == len(words)
    assert as_rows(got) == plain_groups(words, 5)


def test_whole_operator_equals_plain_python(spark, monkeypatch):
    monkeypatch.setattr(sv, "COUNTED", 3)
    rng = random.Random(4)
    base = ["spelling", "spellings", "speling", "VARIANT", "variants", "été", "ÉTÉLONG", "étélong", "×÷×÷×÷", "kitten", "mitten", "smitten"]
    texts = [None, "", "123 !!", "x" * 20_000, "spelling's x-ray"]
    texts += [rng.choice([" ", ",", "1"]).join(rng.choice(base) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    docs = [(None if i % 40 == 3 else i // 2, t) for i, t in enumerate(texts)]
    rows = [(i, t, 1, "x") for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, word string").repartition(3)
    for noise, min_chars, min_count in [(199, 6, 5), (3, 4, 2), (1, 1, 1)]:
        words = plain_counts(docs, noise, min_chars, min_count)
        counted = sv.count_words(df, noise, min_chars, min_count)
        assert {r.word: r.n for r in counted.collect()} == words
        got = sv.spelling_variants(df, noise, min_chars, min_count, 5)
        assert as_rows(got) == plain_groups(words, 5)


def test_deleting_the_only_letter_leaves_no_word(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert sv.count_words(df, 1, 1, 1).collect() == []


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "word")], "doc_id long, text string")
    assert sv.spelling_variants(df).collect() == []
    assert sv.spelling_variants(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        sv.group_variants(df.selectExpr("text as word", "1L as n"), ratio=1)


def test_neighbour_hashes_are_those_of_the_neighbours():
    rng = random.Random(5)
    for length in (1, 2, 3, 8):
        words = ["".join(rng.choice("0123") for _ in range(length)) for _ in range(6)]
        rows, keys = sv.neighbour_hashes(sv._symbols([w.encode() for w in words]), 4)
        for i, word in enumerate(words):
            deleted = {word[:j] + word[j + 1 :] for j in range(length)}
            replaced = {word[:j] + c + word[j + 1 :] for j in range(length) for c in "0123" if c > word[j]}
            expected = [int(sv.own_hashes(sv._symbols([w.encode()]))[0]) for w in deleted | replaced]
            assert sorted(keys[rows == i].tolist()) == sorted(expected)


def test_long_words_take_linear_memory():
    word = np.zeros((1, 50_000), np.int64)
    word[0, ::2] = 1
    rows, keys = sv.neighbour_hashes(word, 8)
    assert len(keys) == 50_000 + 25_000 * 7 + 25_000 * 6 and len(set(keys.tolist())) == len(keys)


def test_many_words_of_one_reduced_form_and_one_form(spark):
    """All words share their symbols, and one frequent word is the form of all its near ones."""
    letters = "".join(c for c in sv.LETTERS[26:] if zlib.crc32(c.encode()) % 8 == zlib.crc32(b"a") % 8)
    words = {"a" * 7: 100_000}
    for i in range(7):
        words |= {"a" * i + c + "a" * (6 - i): 5 for c in letters if c != "a"}
    got = sv.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert as_rows(got) == plain_groups(words, 5)
