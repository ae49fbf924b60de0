"""Rules as text, against evaluating every rule on every post."""

import random
import re

import pytest

from moodloom.functions import topics
from moodloom.operators import rules


def spelled(alternatives):
    """Alternatives as sets of short texts."""
    mark = {"words": "", "lang": "lang:", "retweet": "is:retweet"}
    return {frozenset(("" if c.wanted else "-") + mark[c.kind] + c.value for c in a) for a in alternatives}


@pytest.mark.parametrize(
    ("text", "strict", "intended"),
    [
        ("a", {"a"}, None),
        ("A b", {"a b"}, None),
        ("a OR b c", {"a", "b c"}, None),
        ("a OR b lang:en -is:retweet", {"a", "b lang:en -is:retweet"}, {"a lang:en -is:retweet", "b lang:en -is:retweet"}),
        ("(a OR b) lang:en", {"a lang:en", "b lang:en"}, None),
        ("a -(b OR c)", {"a -b -c"}, None),
        ("a -(b c)", {"a -b", "a -c"}, None),
        ("-(a OR -b)", {"-a b"}, None),
        ("(a OR b)(c OR d)", {"a c", "a d", "b c", "b d"}, None),
        ("a -a", set(), None),
        ("lang:en", {"lang:en"}, None),
    ],
)
def test_alternatives(text, strict, intended):
    as_sets = lambda x: {frozenset(a.split()) for a in x}
    assert spelled(rules.parse(text, "strict")) == as_sets(strict)
    assert spelled(rules.parse(text)) == as_sets(strict if intended is None else intended)


def test_phrases_are_word_sequences():
    assert spelled(rules.parse('"Machine  Learning" -"don\'t know"')) == {frozenset(["machine learning", "-don t know"])}


@pytest.mark.parametrize("text", ["", "a OR", "OR a", "(a", "a)", 'a "b', "from:me", "-", "()", "!!", '""', "a OR OR b"])
def test_unreadable_rules(text):
    with pytest.raises(ValueError):
        rules.parse(text)


def test_alternatives_are_bounded():
    with pytest.raises(ValueError):
        rules.parse(" ".join(f"(a{i} OR b{i})" for i in range(20)))
    with pytest.raises(ValueError):
        rules.parse("a", "loose")


WORDS = [f"w{i}" for i in range(300)] + ["été", "x_1"]


def condition(rng):
    kind = rng.random()
    if kind < 0.7:
        return ("word", rng.choice(WORDS))
    if kind < 0.85:
        return ("phrase", f"{rng.choice(WORDS)} {rng.choice(WORDS[:20])}")
    return ("lang", rng.choice(["en", "fr"])) if kind < 0.93 else ("retweet", "")


def tree(rng, depth=2):
    kind = rng.random()
    if depth == 0 or kind < 0.3:
        return condition(rng)
    if kind < 0.45:
        return ("not", tree(rng, depth - 1))
    return ("or" if kind < 0.7 else "and", [tree(rng, depth - 1) for _ in range(rng.randint(2, 3))])


def text_of(node):
    kind, body = node
    if kind in ("and", "or"):
        return "(" + (" OR " if kind == "or" else " ").join(map(text_of, body)) + ")"
    if kind == "not":
        return "-(" + text_of(body) + ")"
    return {"word": body, "phrase": f'"{body}"', "lang": f"lang:{body}", "retweet": "is:retweet"}[kind]


def holds(node, words, lang, retweet):
    kind, body = node
    if kind == "and":
        return all(holds(b, words, lang, retweet) for b in body)
    if kind == "or":
        return any(holds(b, words, lang, retweet) for b in body)
    if kind == "not":
        return not holds(body, words, lang, retweet)
    if kind == "lang":
        return lang == body
    if kind == "retweet":
        return retweet
    return f" {body} " in f" {' '.join(words)} "


def test_five_thousand_rules(spark):
    rng = random.Random(11)
    trees = [("and", [condition(rng), condition(rng)]) if n % 10 else tree(rng) for n in range(5000)]
    texts = [(text_of(t), f"tag{n % 4000}") for n, t in enumerate(trees)]
    posts = [(0, None, None), (1, "", "en"), (2, "RT w1 w2", "fr"), (3, "w1" * 3000, "en"), (4, "w5 " * 2000, "fr")]
    for i in range(5, 60):
        some = rng.choices(WORDS, k=rng.randint(0, 25))
        text = ("RT " if i % 7 == 0 else "") + rng.choice([" ", ", ", "-"]).join(w.upper() if i % 3 == 0 else w for w in some)
        posts.append((i, text, rng.choice(["en", "fr", None])))
    table = rules.rule_table(spark, texts)
    df = spark.createDataFrame(posts, "arrival_seq long, text string, lang string")
    tagged = rules.with_rule_tags(df, table)
    got = {r.arrival_seq: r.tags for r in tagged.collect()}
    for i, text, lang in posts:
        words = re.findall(r"\w+", (text or "").lower())
        retweet = (text or "").startswith("RT ")
        expected = [tag for t, (_, tag) in zip(trees, texts) if holds(t, words, lang, retweet)]
        assert got[i] == list(dict.fromkeys(expected)), i
    # One plan for any number of rules, and few alternatives met by a post.
    one = rules.with_rule_tags(df, rules.rule_table(spark, texts[:1]))
    shape = lambda x: re.findall(r"(?m)^[ +:\-]*(\w+)", x._jdf.queryExecution().optimizedPlan().toString())
    assert shape(tagged) == shape(one)
    waiting = {r.word: r["count"] for r in table.groupBy("word").count().collect()}
    indexed = sum(n for w, n in waiting.items() if w != rules.ANY)
    assert max(n for w, n in waiting.items() if w != rules.ANY) < indexed / 50


def test_texts_equal_the_rules_as_objects(spark):
    posts = [
        (1, "ChatGPT wins", "en"), (2, "RT ChatGPT", "en"), (3, "climate is change", "fr"), (4, "NBA Champions League", "en"),
        (5, "election", None), (6, "RT DeFi", "de"), (7, "Bitcoins", "en"), (8, None, "en"),
    ]
    df = spark.createDataFrame(posts, "arrival_seq long, text string, lang string")
    for precedence in ("intended", "strict"):
        table = rules.rule_table(spark, topics.STREAM_RULE_TEXTS, precedence)
        got = {r.arrival_seq: r.tags for r in rules.with_rule_tags(df, table).collect()}
        plain = df.select("arrival_seq", topics.matched_tags(df.text, df.lang, precedence=precedence).alias("tags"))
        assert got == {r.arrival_seq: r.tags for r in plain.collect()}


def test_no_rules_and_no_posts(spark):
    df = spark.createDataFrame([(1, "a", "en")], "arrival_seq long, text string, lang string")
    assert rules.with_rule_tags(df, rules.rule_table(spark, [])).collect()[0].tags == []
    assert rules.with_rule_tags(df.limit(0), rules.rule_table(spark, [("a", "t")])).collect() == []


def test_a_shuffled_lookup_carries_words_not_texts(spark):
    """The size of a rule table is known, and a table too large to be broadcast does not send a text with each word."""
    table = rules.rule_table(spark, [(f"w{i} -w{i + 1}", f"tag{i}") for i in range(100)] + [("lang:fr", "fr")])
    assert int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1 << 20
    posts = [(i, f"w{i % 100} and w{i * 7 % 100}", "fr" if i % 3 else None) for i in range(50)]
    df = spark.createDataFrame(posts, "arrival_seq long, text string, lang string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    sent = {}
    for size in (threshold, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        try:
            tagged = rules.with_rule_tags(df, table)
            plan = tagged._jdf.queryExecution().executedPlan().toString()
            sent[size] = {r.arrival_seq: r.tags for r in tagged.collect()}
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert ("Exchange hashpartitioning(word" in plan) == (size == "-1")
    lookup = next(line for line in plan.split("\n") if "Generate explode(array_distinct" in line)
    assert re.search(r"\), \[arrival_seq#\d+L\], ", lookup)
    for i, text, lang in posts:
        words = set(text.split())
        expected = [f"tag{n}" for n in range(100) if f"w{n}" in words and f"w{n + 1}" not in words]
        assert sent[threshold][i] == sent["-1"][i] == expected + (["fr"] if lang else [])
