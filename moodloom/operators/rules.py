"""Stream rules as text, and posts matched against thousands of them.

A rule is words and ``"phrases"``; what stands side by side must all hold, ``OR`` binds more loosely, parentheses
group, ``-`` negates. ``lang:xx`` compares the language and ``is:retweet`` says that a post is one. Words compare whole and in lower
case; the words of a phrase follow each other, whatever is between them.

A rule is turned into alternatives, each a list of conditions that must all hold. Each alternative with a word waits
under one of its words, the one that the fewest alternatives have; a post looks up its own words and meets only
alternatives that wait there. Rules are rows, so a plan does not grow with them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodloom.functions.text import WORD
from moodloom.functions.topics import is_retweet

MAX_ALTERNATIVES = 10_000
ANY = ""  # the word that all posts have
_TOKEN = re.compile(r'\s*(\(|\)|-?"[^"]*"|-(?=\()|[^\s()"]+)')
_WORDS = re.compile(r"\w+")  # the characters of WORD


@dataclass(frozen=True)
class Condition:
    kind: str  # "words", "lang" or "retweet"
    value: str
    wanted: bool


Alternatives = list[frozenset[Condition]]


def _condition(token: str) -> Condition:
    wanted = not token.startswith("-")
    body = token.removeprefix("-")
    if body.startswith("lang:"):
        return Condition("lang", body[5:].lower(), wanted)
    if body == "is:retweet":
        return Condition("retweet", "", wanted)
    if re.match(r"[a-z_]+:", body):
        raise ValueError(f"unknown operator: {token}")
    words = _WORDS.findall(body.lower())
    if not words:
        raise ValueError(f"no word in {token!r}")
    return Condition("words", " ".join(words), wanted)


def _all(options: Iterable[Alternatives]) -> Alternatives:
    """Every choice of one alternative from each, without those that contradict themselves."""
    found: dict[frozenset[Condition], None] = {frozenset(): None}
    for option in options:
        found = dict.fromkeys(a | b for a, b in product(found, option))
        found = {a: None for a in found if not any(Condition(c.kind, c.value, not c.wanted) in a for c in a)}
        if len(found) > MAX_ALTERNATIVES:
            raise ValueError(f"more than {MAX_ALTERNATIVES} alternatives")
    return list(found)


def _not(options: Alternatives) -> Alternatives:
    turned = [[frozenset([Condition(c.kind, c.value, not c.wanted)]) for c in a] for a in options]
    return _all(turned)


class _Reader:
    def __init__(self, text: str):
        self.tokens = _TOKEN.findall(text)
        if "".join(self.tokens) != re.sub(r"\s+(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)", "", text):
            raise ValueError(f"cannot read {text!r}")
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1]

    def choice(self) -> list[list[Alternatives]]:
        """The sides of OR, each a list of what must hold."""
        sides = [self.together()]
        while self.peek() == "OR":
            self.take()
            sides.append(self.together())
        return sides

    def together(self) -> list[Alternatives]:
        units = []
        while self.peek() not in (None, ")", "OR"):
            units.append(self.unit())
        if not units:
            raise ValueError("a condition is missing")
        return units

    def unit(self) -> Alternatives:
        token = self.take()
        if token == "-":
            if self.peek() != "(":
                raise ValueError("nothing is negated")
            return _not(self.unit())
        if token == "(":
            inner = [a for side in self.choice() for a in _all(side)]
            if self.peek() != ")":
                raise ValueError("a parenthesis stays open")
            self.take()
            return inner
        return [frozenset([_condition(token)])]


def _is_operator(unit: Alternatives) -> bool:
    return len(unit) == 1 and all(c.kind != "words" for c in unit[0])


def parse(text: str, precedence: str = "intended") -> Alternatives:
    """The alternatives of a rule.

    ``strict`` reads it as written, so that conditions after the last OR bind to its right side alone. ``intended`` lets
    ``lang:`` and ``is:`` that end a rule hold for all of it.
    """
    if precedence not in ("intended", "strict"):
        raise ValueError(f"unknown precedence: {precedence}")
    reader = _Reader(text)
    sides = reader.choice()
    if reader.peek() is not None:
        raise ValueError(f"unexpected {reader.peek()!r}")
    shared: list[Alternatives] = []
    if precedence == "intended" and len(sides) > 1:
        while len(sides[-1]) > 1 and _is_operator(sides[-1][-1]):
            shared.append(sides[-1].pop())
    return _all([[a for side in sides for a in _all(side)], *shared])


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]], precedence: str = "intended") -> DataFrame:
    """A row for each alternative of the rules (text, tag): the word it waits under, and its conditions."""
    read = [(n, tag, a) for n, (text, tag) in enumerate(rules) for a in parse(text, precedence)]
    common = Counter(w for _, _, a in read for w in {w for c in a if c.kind == "words" and c.wanted for w in c.value.split()})
    rows = []
    for n, tag, a in read:
        asked = [c.value for c in a if c.kind == "words" and c.wanted]
        own = sorted({w for value in asked for w in value.split()}, key=lambda w: (common[w], -len(w), w))
        banned = [c.value for c in a if c.kind == "words" and not c.wanted]
        langs = [c.value for c in a if c.kind == "lang" and c.wanted]
        not_langs = [c.value for c in a if c.kind == "lang" and not c.wanted]
        retweet = next((c.wanted for c in a if c.kind == "retweet"), None)
        rows.append((own[0] if own else ANY, n, tag, sorted(asked), sorted(banned), langs, not_langs, retweet))
    some = pa.list_(pa.string())
    schema = {
        "word": pa.string(), "rule": pa.int32(), "tag": pa.string(), "asked": some, "banned": some,
        "langs": some, "not_langs": some, "retweet": pa.bool_(),
    }
    # From Arrow it is a local relation, whose size the optimizer knows: it broadcasts a table of a few MB.
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(schema.values())]
    return spark.createDataFrame(pa.table(columns, names=list(schema)))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]+"), F.lit(0))


def rule_tags(posts: DataFrame, rules: DataFrame, key: str = "arrival_seq") -> DataFrame:
    """(key, tags) of the posts that match, tags in the order of the rules and each once.

    ``posts`` has ``text`` and ``lang``; a null text has no words and is no retweet, a null language equals none.
    ``rules`` comes from ``rule_table``. The lookup by word carries the key alone, so that a rule table too large to be
    broadcast shuffles words and never the text with each of them; the alternatives found then meet the text by key.
    """
    plain = posts.select(
        F.col(key),
        F.lower("lang").alias("lang"),
        is_retweet(F.col("text")).alias("is_retweet"),
        F.coalesce(words_of(F.col("text")), F.array().cast("array<string>")).alias("own"),
    )
    words = plain.select(key, F.explode(F.array_distinct("own")).alias("word"))
    terms = [c for c in rules.columns if c != "word"]
    candidates = (
        words.join(rules.where(F.col("word") != ANY), "word")
        .groupBy(key)
        .agg(F.collect_list(F.struct(*terms)).alias("candidates"))
    )
    # Alternatives without a word are met by every post: one row of them all.
    every = rules.where(F.col("word") == ANY).agg(F.collect_list(F.struct(*terms)).alias("every"))
    # Between spaces, words and phrases are found by the same search.
    spaced = F.concat(F.lit(" "), F.array_join("own", " "), F.lit(" "))
    met = plain.join(candidates, key, "left").crossJoin(F.broadcast(every)).select(
        key, "lang", "is_retweet", spaced.alias("spaced"),
        F.when(F.col("candidates").isNull(), F.col("every")).otherwise(F.concat("candidates", "every")).alias("candidates"),
    )

    def has(value: Column) -> Column:
        return F.col("spaced").contains(F.concat(F.lit(" "), value, F.lit(" ")))

    lang = F.coalesce("lang", F.lit(""))

    def holds(rule: Column) -> Column:
        return (
            F.forall(rule["asked"], has)
            & ~F.exists(rule["banned"], has)
            & F.forall(rule["langs"], lambda x: x == lang)
            & ~F.exists(rule["not_langs"], lambda x: x == lang)
            & (rule["retweet"].isNull() | (rule["retweet"] == F.col("is_retweet")))
        )

    matched = F.transform(F.filter("candidates", holds), lambda c: F.struct(c["rule"].alias("rule"), c["tag"].alias("tag")))
    # The outer form infers no filter, which would match every post once more.
    hits = met.select(key, F.explode_outer(matched).alias("hit")).where(F.col("hit").isNotNull())
    found = hits.groupBy(key).agg(F.sort_array(F.collect_set("hit")).alias("found"))
    return found.select(key, F.array_distinct(F.col("found.tag")).alias("tags"))


def with_rule_tags(posts: DataFrame, rules: DataFrame, key: str = "arrival_seq", out: str = "tags") -> DataFrame:
    """All posts with the tags of the rules they match, an empty array where there is none. Keys must be distinct."""
    none = F.array().cast("array<string>")
    found = rule_tags(posts, rules, key).withColumnRenamed("tags", "_found")
    return posts.join(found, key, "left").withColumn(out, F.coalesce("_found", none)).drop("_found")
