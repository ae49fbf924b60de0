"""Topic tagging and keyword stream rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodloom.functions.text import WORD

# Topics in order of precedence, with their keywords.
TOPIC_KEYWORDS = {
    "AI": ["ChatGPT", "OpenAI", "LLM", "artificial intelligence", "machine learning"],
    "Climate": ["climate change", "global warming", "COP30", "carbon emissions", "renewable energy"],
    "Sports": ["Champions League", "NBA", "NFL", "transfer", "goal"],
    "Politics": ["election", "senate", "policy", "government", "vote"],
    "Crypto": ["Bitcoin", "Ethereum", "DeFi", "crypto", "blockchain"],
}
DEFAULT_TOPIC = "General"


@dataclass(frozen=True)
class StreamRule:
    """Posts with any of ``terms`` (each one or more words that must all occur)."""

    tag: str
    terms: Sequence[Sequence[str]]
    lang: str = "en"
    exclude_retweets: bool = True


# The filter rules of the collection stream.
STREAM_RULES = [
    StreamRule("AI", [["ChatGPT"], ["OpenAI"], ["LLM"]]),
    StreamRule("Climate", [["climate", "change"], ["COP30"]]),
    StreamRule("Sports", [["Champions", "League"], ["NBA"]]),
    StreamRule("Politics", [["election"], ["senate"]]),
    StreamRule("Crypto", [["Bitcoin"], ["Ethereum"], ["DeFi"]]),
]


# The rules as they are handed to a stream, as (text, tag).
STREAM_RULE_TEXTS = [
    ("ChatGPT OR OpenAI OR LLM lang:en -is:retweet", "AI"),
    ("climate change OR COP30 lang:en -is:retweet", "Climate"),
    ("Champions League OR NBA lang:en -is:retweet", "Sports"),
    ("election OR senate lang:en -is:retweet", "Politics"),
    ("Bitcoin OR Ethereum OR DeFi lang:en -is:retweet", "Crypto"),
]


def is_retweet(text: Column) -> Column:
    return F.coalesce(text.startswith("RT "), F.lit(False))


def detect_topic(text: Column, keywords: Mapping[str, Sequence[str]] = TOPIC_KEYWORDS) -> Column:
    """First topic with a keyword anywhere in the lower-cased text."""
    lowered = F.lower(text)
    branches = [
        F.when(reduce(or_, [lowered.contains(word.lower()) for word in words]), topic)
        for topic, words in keywords.items()
    ]
    return F.coalesce(*branches, F.lit(DEFAULT_TOPIC))


def _has_word(text: Column, word: str) -> Column:
    return text.rlike(rf"(?i)(^|[^{WORD}]){re.escape(word)}($|[^{WORD}])")


def rule_matches(
    rule: StreamRule, text: Column, lang: Column, precedence: str = "intended"
) -> Column:
    """Whether a post passes a rule.

    ``intended`` applies language and retweet conditions to every term;
    ``strict`` binds them, as AND before OR, to the last term only.
    """
    terms = [reduce(and_, [_has_word(text, w) for w in words]) for words in rule.terms]
    condition = lang.eqNullSafe(rule.lang)
    if rule.exclude_retweets:
        condition = condition & ~is_retweet(text)
    if precedence == "strict":
        matched = reduce(or_, [*terms[:-1], terms[-1] & condition])
    elif precedence == "intended":
        matched = reduce(or_, terms) & condition
    else:
        raise ValueError(f"unknown precedence: {precedence}")
    return F.coalesce(matched, F.lit(False))


def matched_tags(
    text: Column,
    lang: Column,
    rules: Sequence[StreamRule] = STREAM_RULES,
    precedence: str = "intended",
) -> Column:
    """Tags of all rules that match, in rule order; empty when none does."""
    tags = [F.when(rule_matches(r, text, lang, precedence), r.tag) for r in rules]
    return F.array_compact(F.array(*tags))
