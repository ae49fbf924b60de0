"""Scores against a plain word-by-word scorer written from the published rules."""

import math
import random

import pytest
from pyspark.sql import functions as F

from moodloom.functions import dictionaries as words
from moodloom.operators import sentiment as s

LEXICON = {**dict(words.SEED_LEXICON), "kind": 2.4, "badass": 1.4, "broken": -2.1, "hearty": 0.5}
N, C = -0.74, 0.733


def brute(text):
    tokens = []
    for w in text.split():
        bare = w.strip(s.PUNCTUATION)
        tokens.append(w if len(bare) <= 2 else bare)
    low = [w.lower() for w in tokens]
    upper = [w.isupper() for w in tokens]
    mixed = 0 < sum(upper) < len(tokens)
    values = []
    for i, w in enumerate(low):
        if w in words.BOOSTERS or w not in LEXICON or (w == "kind" and low[i + 1 : i + 2] == ["of"]):
            values.append(0.0)
            continue
        v = LEXICON[w]
        back = lambda d: low[i - d] if i >= d else ""
        if w == "no" and i + 1 < len(low) and low[i + 1] in LEXICON:
            v = 0.0
        if "no" in (back(1), back(2)) or (back(3) == "no" and back(1) in ("or", "nor")):
            v = LEXICON[w] * N
        if upper[i] and mixed:
            v += C if v > 0 else -C
        for d, damp in ((1, 1), (2, 0.95), (3, 0.9)):
            if i < d or back(d) in LEXICON:
                continue
            scalar = words.BOOSTERS.get(back(d), 0.0)
            if scalar:
                scalar = -scalar if v < 0 else scalar
                if upper[i - d] and mixed:
                    scalar += C if v > 0 else -C
            v += scalar * damp
            negates = back(d) in words.NEGATIONS or "n't" in back(d)
            excite = ("so", "this")
            if d == 1:
                v *= N if negates else 1
            elif d == 2:
                if back(2) == "never" and back(1) in excite:
                    v *= 1.25
                elif not (back(2) == "without" and back(1) == "doubt") and negates:
                    v *= N
            else:
                if (back(3) == "never" and back(2) in excite) or back(1) in excite:
                    v *= 1.25
                elif not (back(3) == "without" and "doubt" in (back(2), back(1))) and negates:
                    v *= N
                v = idiom(low, i, v)
        if back(1) == "least" and (i == 1 or back(2) not in ("at", "very")):
            v *= N
        values.append(v)
    if "but" in low:
        b = low.index("but")
        values = [v * 0.5 if i < b else v * 1.5 if i > b else v for i, v in enumerate(values)]
    if not values:
        return (0.0, 0.0, 0.0, 0.0)
    total = sum(values)
    asks = text.count("?")
    emphasis = min(text.count("!"), 4) * 0.292 + (0 if asks < 2 else asks * 0.18 if asks <= 3 else 0.96)
    total += emphasis if total > 0 else -emphasis if total < 0 else 0
    pos = sum(v + 1 for v in values if v > 0)
    neg = sum(1 - v for v in values if v < 0)
    if pos > neg:
        pos += emphasis
    elif neg > pos:
        neg += emphasis
    neu = values.count(0)
    parts = pos + neg + neu
    return (
        round(max(-1.0, min(1.0, total / math.sqrt(total * total + 15))), 4),
        *(round(x / parts, 3) for x in (pos, neg, neu)),
    )


def idiom(low, i, v):
    gram = lambda a, b: " ".join(low[i + a : i + b + 1])
    for seq in (gram(-1, 0), gram(-2, 0), gram(-2, -1), gram(-3, -1), gram(-3, -2)):
        if seq in words.IDIOMS:
            v = words.IDIOMS[seq]
            break
    if len(low) - 1 > i and gram(0, 1) in words.IDIOMS:
        v = words.IDIOMS[gram(0, 1)]
    if len(low) - 1 > i + 1 and gram(0, 2) in words.IDIOMS:
        v = words.IDIOMS[gram(0, 2)]
    return v + sum(words.BOOSTERS.get(g, 0.0) for g in (gram(-3, -1), gram(-3, -2), gram(-2, -1)))


def score(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    rows = s.sentiment_scores(df, lexicon, "id", "text").orderBy("id").collect()
    assert len(rows) == len(texts)
    return [tuple(r)[1:] for r in rows]


def test_known_sentences(spark):
    texts = [
        "I love this", "This is not good", "VERY bad news", "never been happy", "good but terrible ending",
        "never so good", "without doubt good", "at least good", "least good", "no good", "NO", "kind of good",
        "it is so good", "a broken heart was bad", "'good'", "", None, "nothing here", "love!!!", "love???? ok",
        "the very least great", "doubt it is kind of great", "not  very　good",
    ]
    for text, got in zip(texts, score(spark, texts)):
        assert got == pytest.approx(brute(text or ""), abs=1e-9), text


def test_random_sentences(spark):
    pool = [*LEXICON, "not", "never", "so", "this", "without", "doubt", "very", "barely", "but", "least", "at",
            "or", "nor", "of", "sort", "isn't", "heart", "bus", "stop", "the", "report", "ass", "shit", "x"]
    rng = random.Random(7)
    texts = []
    for _ in range(3000):
        picked = [rng.choice(pool) for _ in range(rng.randint(0, 9))]
        picked = [w.upper() if rng.random() < 0.2 else w for w in picked]
        texts.append(" ".join(picked) + rng.choice(["", "", "!", "!!", "??", "?????", "."]))
    wrong = [(t, a, brute(t)) for t, a in zip(texts, score(spark, texts)) if a != pytest.approx(brute(t), abs=1.5e-4)]
    assert not wrong, wrong[:3]


def test_words_by_kind_of_whitespace_and_case(spark):
    rng = random.Random(9)
    pool = ["good", "BAD", "But", "BUT", "bUt", "butter", "I", "--", "'no'", "ÉTÉ", "love", "so", "(great)", "x"]
    gaps = [" ", " ", "  ", "\t", "\n", "\u00a0", "\u3000", "\u2028"]
    texts = ["".join(rng.choice(pool) + rng.choice(gaps) for _ in range(rng.randint(0, 8))) for _ in range(500)]
    texts += [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 8))).upper() for _ in range(100)]
    texts += [" good", "good ", "  ", "GOOD", "GOOD BAD", "GOOD bad"]
    for text, got in zip(texts, score(spark, texts)):
        assert got == pytest.approx(brute(text), abs=1.5e-4), text


def test_phrases_are_looked_up_as_sets(spark):
    df = spark.createDataFrame([(w,) for w in ["very", "kind of", "none", None]], "w string")
    many = {f"w{i}": i / 8 for i in range(s.LOOKUP_SETS + 1)} | {"very": 0.5}
    for values in (words.BOOSTERS, words.IDIOMS, many, {}):
        found = s._lookup_in(values)(F.col("w"))
        assert [r[0] for r in df.select(found).collect()] == [values.get(w) for w in ["very", "kind of", "none", None]]
    # A map is searched entry by entry.
    assert "map(keys" not in plan_of(s.sentiment_scores(df, words.seed_lexicon(spark), "w", "w"))


def test_label_bounds(spark):
    df = spark.createDataFrame([(0.05,), (0.0499,), (-0.05,), (-0.0499,), (0.0,)], "c double")
    got = [r[0] for r in df.select(s.label(F.col("c"))).collect()]
    assert got == ["positive", "neutral", "negative", "neutral", "neutral"]


def test_emoji_descriptions(spark):
    df = spark.createDataFrame([("😀!!",), ("so😀😂 ok",), ("plain",)], "t string")
    got = [r[0] for r in df.select(s.describe_emoji(F.col("t"), words.SEED_EMOJI)).collect()]
    assert got == ["grinning face!!", "so grinning face face with tears of joy ok", "plain"]


def longest_match(text, emoji):
    """Described text, by trying every length at every place."""
    longest, at, out, before = max(map(len, emoji)), 0, "", " "
    while at < len(text):
        for size in range(min(longest, len(text) - at), 0, -1):
            cut = text[at : at + size]
            if cut in emoji or size == 1:
                break
        name = emoji.get(cut)
        out += cut if name is None else name if before == " " else " " + name
        before, at = cut, at + len(cut)
    return out


def test_five_thousand_emoji_sequences(spark):
    rng = random.Random(8)
    bases = [chr(c) for c in [*range(0x1F300, 0x1F64F), 0x2764, 0xA9, 0x231A]]
    tones, joiner, variant = [chr(c) for c in range(0x1F3FB, 0x1F400)], "\u200d", "\ufe0f"
    emoji = {b: f"sign {i}" for i, b in enumerate(bases[::3])}
    while len(emoji) < 5000:
        parts = [rng.choice(bases) + rng.choice(["", variant, *tones]) for _ in range(rng.randint(1, 4))]
        emoji.setdefault(joiner.join(parts), f"sequence {len(emoji)}")
    alphabet = [*bases, *tones, joiner, variant, " ", "a", "é", "漢", "\n", "!"]
    keys = list(emoji)
    texts = ["", " ", "plain", "é漢 no emoji", keys[-1] * 50, keys[-1][:-1], "x" * 20_000 + keys[-2]]
    for _ in range(150):
        texts.append("".join(rng.choice(keys) if rng.random() < 0.4 else rng.choice(alphabet) for _ in range(rng.randint(1, 30))))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, t string")
    got = {r.i: r.d for r in df.select("i", s.describe_emoji(F.col("t"), emoji).alias("d")).collect()}
    assert got.pop(-1) is None
    for i, text in enumerate(texts):
        assert got[i] == longest_match(text, emoji), i
    assert "Python" not in plan_of(df.select(s.describe_emoji(F.col("t"), emoji)))
    assert df.select(s.describe_emoji(F.col("t"), {}).alias("t")).collect() == df.select("t").collect()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scores_shuffle_one_row_per_text(spark):
    df = spark.createDataFrame([("1", "love")], "tweet_id string, clean_text string")
    plan = plan_of(s.sentiment_scores(df, words.seed_lexicon(spark)))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_columns_travel_with_the_scores(spark):
    rows = [("1", "love it", 7, None), ("2", "", 8, "x"), ("3", None, None, "y")]
    df = spark.createDataFrame(rows, "tweet_id string, clean_text string, a int, b string")
    scored = s.with_sentiment(df.repartition("tweet_id"), words.seed_lexicon(spark))
    got = {r.tweet_id: (r.clean_text, r.a, r.b, r.sentiment) for r in scored.collect()}
    assert got == {"1": ("love it", 7, None, "positive"), "2": ("", 8, "x", "neutral"), "3": (None, None, "y", "neutral")}
    # Nothing is joined back, and the input's own partitioning is enough.
    plan = plan_of(s.with_sentiment(df.repartition("tweet_id"), words.seed_lexicon(spark)))
    assert plan.count("Exchange hashpartitioning(tweet_id") == 1 and "SortMergeJoin" not in plan


def test_large_lexicon_is_joined_by_shuffle(spark):
    texts = ["not good bad", "", "so GREAT !!", "love no hate but good"] * 3
    expected = score(spark, texts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("1", "love")], "tweet_id string, clean_text string")
        assert "BroadcastHashJoin" not in plan_of(s.sentiment_scores(df, words.seed_lexicon(spark)))
        assert score(spark, texts) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_lexicon_file_keeps_keys_and_the_last_value(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    path.write_text(":D\t2.3\t0.5\t[1]\n:d\t1.2\t0.1\nGood\t9\nbad\t-2\nbad\t-1\nno value\n\"quoted\t1\n")
    got = {r.token: r.valence for r in words.load_lexicon(spark, str(path)).collect()}
    assert got == {":D": 2.3, ":d": 1.2, "Good": 9.0, "bad": -1.0, '"quoted': 1.0}
