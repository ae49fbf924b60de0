"""The column functions under names that SQL text can use.

They are SQL functions: their bodies are SQL expressions, which the optimizer puts in the place of a call. Nothing runs
in Python, and filters and pruning see through them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from moodloom.functions import text as tx
from moodloom.functions.topics import DEFAULT_TOPIC, TOPIC_KEYWORDS
from moodloom.operators.sentiment import NEGATIVE_TO, POSITIVE_FROM


def _quoted(value: str) -> str:
    """A string literal with its backslashes as they are."""
    if '"' in value:
        raise ValueError('a double quote cannot be written here')
    return f'r"{value}"'


def _replaced(text: str, *steps: tuple[str, str]) -> str:
    for pattern, by in steps:
        text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(by)})"
    return text


def _topic(keywords: Mapping[str, Sequence[str]]) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower(text), {_quoted(k.lower())})" for k in words) + f" THEN {_quoted(topic)}"
        for topic, words in keywords.items()
    )
    return f"CASE {cases} ELSE {_quoted(DEFAULT_TOPIC)} END"


_CLEAN = _replaced(
    "coalesce(text, '')", (tx.URL, ""), (tx.MENTION, ""), (tx.HASHTAG, "$1"), (tx.ENTITY, " "), (tx.NOT_WORD, " ")
)
_WEEK = """concat(date_format(ts, 'yyyy'), '-W',
  lpad(CAST(floor((dayofyear(ts) + 7 - dayofweek(ts)) / 7) AS STRING), 2, '0'))"""


def statements(keywords: Mapping[str, Sequence[str]] = TOPIC_KEYWORDS) -> dict[str, str]:
    """What each function is, by name: its parameters, what it returns, and its body."""
    return {
        "clean_tweet": f"(text STRING) RETURNS STRING RETURN trim({_CLEAN})",
        "hashtags": f"(text STRING) RETURNS ARRAY<STRING> RETURN regexp_extract_all(coalesce(text, ''), {_quoted(tx.HASHTAG)}, 1)",
        "is_retweet": "(text STRING) RETURNS BOOLEAN RETURN coalesce(startswith(text, 'RT '), false)",
        "topic": f"(text STRING) RETURNS STRING RETURN {_topic(keywords)}",
        "vader_label": f"""(compound DOUBLE) RETURNS STRING RETURN CASE WHEN compound >= {POSITIVE_FROM}D THEN 'positive'
          WHEN compound <= {NEGATIVE_TO}D THEN 'negative' ELSE 'neutral' END""",
        "sunday_week": f"(ts TIMESTAMP) RETURNS STRING RETURN {_WEEK}",
        "time_columns": f"""(ts TIMESTAMP)
          RETURNS TABLE (date DATE, hour_of_day INT, day_of_week STRING, week STRING, month STRING)
          RETURN SELECT to_date(ts), hour(ts), date_format(ts, 'EEEE'), {_WEEK}, date_format(ts, 'yyyy-MM')""",
    }


def register(
    spark: SparkSession, prefix: str = "", keywords: Mapping[str, Sequence[str]] = TOPIC_KEYWORDS
) -> list[str]:
    """Create the functions for this session, with a prefix to their names; returns the names.

    ``time_columns`` is a table function: ``FROM posts, LATERAL time_columns(created_at)``. The rest are scalar.
    """
    names = []
    for name, body in statements(keywords).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{body}")
        names.append(prefix + name)
    return names
