"""DuckDB twins of the registered queries.

Written from the rules, not from the DataFrame code: window functions, list
functions and scalar expressions, over the same whole tables.
"""

from __future__ import annotations

import re

from moodloom.functions import dictionaries as words
from moodloom.functions import text as tx
from moodloom.functions.topics import STREAM_RULES, TOPIC_KEYWORDS
from moodloom.operators.preprocess import NOUN_SUFFIXES
from moodloom.operators.sentiment import PUNCTUATION
from moodloom.schemas import SENTIMENTS
from moodloom.sources.posts import POSTS_SQL


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(items) -> str:
    return "(" + ", ".join(_q(i) for i in items) + ")"


def _values(pairs) -> str:
    return ", ".join(f"({_q(a)}, {_q(b) if isinstance(b, str) else f'CAST({b} AS DOUBLE)'})" for a, b in pairs)


def _with(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


# Collection

POSTS = "posts AS (" + POSTS_SQL.replace("{events}", "events").replace("{documents}", "documents") + ")"

_TOPIC = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(lower(text), {_q(k.lower())})" for k in keys) + f" THEN '{topic}'"
    for topic, keys in TOPIC_KEYWORDS.items()
) + " ELSE 'General' END"

COLLECTED = f"""collected AS (
 SELECT arrival_seq, tweet_id, username, text, {_TOPIC} AS topic, coalesce(lang, 'en') AS lang,
  coalesce(retweet_count, 0) AS retweet_count, coalesce(like_count, 0) AS like_count, created_at
 FROM posts WHERE NOT starts_with(text, 'RT ')
 QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY arrival_seq) = 1)"""
FIRST = """firsts AS (SELECT tweet_id, text FROM posts
 QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY arrival_seq) = 1)"""
ENGLISH = "english AS (SELECT * FROM collected WHERE lang = 'en')"


def _rule(terms: list[list[str]], strict: bool) -> str:
    def has(word: str) -> str:
        return f"regexp_matches(text, '(?i)(^|[^{tx.WORD}]){word}($|[^{tx.WORD}])')"

    options = ["(" + " AND ".join(has(w) for w in t) + ")" for t in terms]
    condition = "coalesce(lang, 'en') = 'en' AND NOT starts_with(text, 'RT ')"
    if strict:
        options[-1] = f"({options[-1]} AND {condition})"
        return " OR ".join(options)
    return f"({' OR '.join(options)}) AND {condition}"


def _tags(strict: bool) -> str:
    return "concat_ws('|', " + ", ".join(
        f"CASE WHEN {_rule(rule.terms, strict)} THEN '{rule.tag}' END" for rule in STREAM_RULES
    ) + ")"


# Text


def _clean(text: str) -> str:
    for pattern, to in [
        (tx.URL, ""),
        (tx.MENTION, ""),
        (tx.HASHTAG, "\\1"),
        ("&amp;|&lt;|&gt;", " "),
        (rf"[^{tx.WORD}{tx.SPACE}']", " "),
        (f"[{tx.SPACE}]+", " "),
    ]:
        text = f"regexp_replace({text}, {_q(pattern)}, {_q(to)}, 'g')"
    return f"trim({text})"


def _squeeze(chars: str) -> str:
    """Drops a character that equals the three before it."""
    return (
        f"array_to_string(list_filter({chars}, lambda c, i: NOT (i > 3 AND {chars}[i-1] = c "
        f"AND {chars}[i-2] = c AND {chars}[i-3] = c)), '')"
    )


def _tokenized(source: str, key: str) -> list[str]:
    return [
        f"cleaned AS (SELECT *, {_clean('text')} AS clean_text FROM {source})",
        "chars AS (SELECT *, string_split(clean_text, '') AS cs FROM cleaned)",
        f"""tokenized AS (SELECT * EXCLUDE (cs), list_transform(
   regexp_extract_all({_squeeze('cs')}, {_q(tx.TOKEN)}),
   lambda t: CASE WHEN regexp_matches(t, {_q(tx.EMOTICON)}) THEN t ELSE lower(t) END) AS tokens FROM chars)""",
        f"""kept AS (SELECT * REPLACE (list_filter(tokens,
   lambda t: length(t) > 2 AND t NOT IN {_in(words.default_stopwords())}) AS tokens) FROM tokenized)""",
        f"irregular(form, lemma) AS (VALUES {_values(words.SEED_IRREGULAR)})",
        f"places AS (SELECT {key}, unnest(tokens) AS t, generate_subscripts(tokens, 1) AS i FROM kept)",
        f"""lemmas AS (SELECT {key}, i, CASE WHEN r.form IS NOT NULL THEN r.lemma ELSE coalesce(
    {_shortest(f"list_concat([t], {_stripped('[t]')})")}, {_shortest(_stripped(_stripped('[t]')))}, t) END AS lemma
   FROM places LEFT JOIN irregular r ON r.form = t)""",
        f"""lemmatized AS (SELECT k.* EXCLUDE (tokens), coalesce(l.tokens, []) AS tokens FROM kept k LEFT JOIN
   (SELECT {key}, list(lemma ORDER BY i) AS tokens FROM lemmas GROUP BY {key}) l USING ({key}))""",
    ]


def _stripped(words_: str) -> str:
    """All words that one noun ending less makes of a list of words."""
    rules = ", ".join(
        f"CASE WHEN ends_with(w, '{ending}') THEN left(w, length(w) - {len(ending)}) || '{base}' END"
        for ending, base in NOUN_SUFFIXES
    )
    return f"list_filter(flatten(list_transform({words_}, lambda w: [{rules}])), lambda c: c IS NOT NULL)"


def _shortest(words_: str) -> str:
    """The first of the shortest of a list's words that are nouns."""
    return f"""list_reduce(list_filter({words_}, lambda c: c IN {_in(words.SEED_NOUNS)}),
     lambda a, b: CASE WHEN a IS NULL OR length(b) < length(a) THEN b ELSE a END, CAST(NULL AS VARCHAR))"""


PREPARED = """prepared AS (SELECT * FROM (
 SELECT *, array_to_string(tokens, ' ') AS processed_text, CAST(length(clean_text) AS INT) AS text_length,
  CAST(length(list_filter(string_split(array_to_string(tokens, ' '), ' '), lambda w: w <> '')) AS INT) AS word_count
 FROM lemmatized) WHERE word_count >= 3)"""
READY = [POSTS, COLLECTED, ENGLISH, *_tokenized("english", "tweet_id"), PREPARED]
TOKENIZED = [POSTS, *_tokenized("posts", "arrival_seq")]

TERMS = [
    f"""unigrams AS (SELECT tweet_id, regexp_extract_all(lower(processed_text), '{tx.FEATURE_TOKEN}') AS u FROM prepared)""",
    """terms_of AS (SELECT tweet_id, list_concat(u, list_transform(range(1, len(u)),
   lambda j: u[j] || ' ' || u[j + 1])) AS terms FROM unigrams)""",
]


# Sentiment


def _scores(source: str, key: str, text: str) -> list[str]:
    lexicon = f"lexicon(token, valence) AS (VALUES {_values(words.SEED_LEXICON)})"
    up, down = _in(words.BOOSTER_UP), _in(words.BOOSTER_DOWN)

    def upper(w: str) -> str:
        return f"({w} = upper({w}) AND {w} <> lower({w}))"

    def booster(w: str) -> str:
        return f"(CASE WHEN {w} IN {up} THEN CAST(0.293 AS DOUBLE) WHEN {w} IN {down} THEN CAST(-0.293 AS DOUBLE) END)"

    def negates(w: str) -> str:
        return f"({w} IN {_in(words.NEGATIONS)} OR contains({w}, 'n''t'))"

    def step(n: int, expr: str) -> str:
        return f"v{n} AS (SELECT * REPLACE ({expr} AS v) FROM v{n - 1})"

    factor = "CAST(-0.74 AS DOUBLE)"
    caps = "CAST(0.733 AS DOUBLE)"
    sign = "(CASE WHEN v > 0 THEN 1 ELSE -1 END)"
    context = {
        1: f"CASE WHEN {negates('b1')} THEN v * {factor} ELSE v END",
        2: f"""CASE WHEN b2 = 'never' AND b1 IN ('so', 'this') THEN v * 1.25::DOUBLE
            WHEN b2 = 'without' AND b1 = 'doubt' THEN v WHEN {negates('b2')} THEN v * {factor} ELSE v END""",
        3: f"""CASE WHEN (b3 = 'never' AND b2 IN ('so', 'this')) OR b1 IN ('so', 'this') THEN v * 1.25::DOUBLE
            WHEN b3 = 'without' AND (b2 = 'doubt' OR b1 = 'doubt') THEN v
            WHEN {negates('b3')} THEN v * {factor} ELSE v END""",
    }
    steps = []
    n = 1
    for d, weight in [(1, "1.0"), (2, "0.95"), (3, "0.9")]:
        reach = f"i > {d} AND NOT lex{d}"
        b = booster(f"b{d}")
        steps.append(step(n, f"""CASE WHEN {reach} AND {b} IS NOT NULL THEN v +
           (CASE WHEN v < 0 THEN -{b} ELSE {b} END
            + CASE WHEN mixed AND up{d} THEN {caps} * {sign} ELSE 0 END) * CAST({weight} AS DOUBLE) ELSE v END"""))
        steps.append(step(n + 1, f"CASE WHEN {reach} THEN {context[d]} ELSE v END"))
        n += 2
    idiom = f"idioms(phrase, worth) AS (VALUES {_values(words.IDIOMS.items())})"

    def worth(*parts: str) -> str:
        joined = " || ' ' || ".join(parts)
        return f"(SELECT worth FROM idioms WHERE phrase = {joined})"

    grams = ["b3 || ' ' || b2 || ' ' || b1", "b3 || ' ' || b2", "b2 || ' ' || b1"]
    steps.append(step(n, f"""CASE WHEN i > 3 AND NOT lex3 THEN
        coalesce({worth('item', 'n1', 'n2')}, {worth('item', 'n1')}, {worth('b1', 'item')},
         {worth('b2', 'b1', 'item')}, {worth('b2', 'b1')}, {worth('b3', 'b2', 'b1')}, {worth('b3', 'b2')}, v)
        + {' + '.join(f'coalesce({booster(f"({g})")}, 0)' for g in grams)} ELSE v END"""))
    steps.append(step(n + 1, f"""CASE WHEN b1 = 'least' AND NOT lex1 AND (i = 2 OR b2 NOT IN ('at', 'very'))
        THEN v * {factor} ELSE v END"""))
    steps.append(step(n + 2, f"""CASE WHEN item IN {up} OR item IN {down} OR (item = 'kind' AND n1 = 'of') THEN 0
        WHEN but IS NOT NULL AND i < but THEN v * 0.5::DOUBLE WHEN but IS NOT NULL AND i > but THEN v * 1.5::DOUBLE
        ELSE v END"""))
    last = n + 2
    bare = f"trim(w, {_q(PUNCTUATION)})"
    marks = "least(length(text) - length(replace(text, '!', '')), 4) * CAST(0.292 AS DOUBLE)"
    asks = "(length(text) - length(replace(text, '?', '')))"
    return [
        lexicon,
        idiom,
        f"""wordlist AS (SELECT {key} AS id, text,
         list_transform(list_filter(regexp_split_to_array(text, '[{tx.SPACE}]+'), lambda w: w <> ''),
          lambda w: CASE WHEN length({bare}) <= 2 THEN w ELSE {bare} END) AS ws
         FROM (SELECT {key}, {text} AS text FROM {source}))""",
        f"""framed AS (SELECT id, ws, len(ws) AS n_words,
         {marks} + CASE WHEN {asks} > 3 THEN 0.96::DOUBLE WHEN {asks} > 1 THEN {asks} * 0.18::DOUBLE ELSE 0 END AS emphasis,
         len(list_filter(ws, lambda w: {upper('w')})) BETWEEN 1 AND len(ws) - 1 AS mixed,
         list_position(list_transform(ws, lambda w: lower(w)), 'but') AS but
         FROM wordlist)""",
        """placed AS (SELECT id, ws, mixed, but, i, ws[i] AS word FROM
          (SELECT id, ws, mixed, but, unnest(range(1, n_words + 1)) AS i FROM framed))""",
        f"""around AS (SELECT id, mixed, but, i, word, lower(word) AS item,
          CASE WHEN i > 1 THEN ws[i-1] END AS p1, CASE WHEN i > 2 THEN ws[i-2] END AS p2,
          CASE WHEN i > 3 THEN ws[i-3] END AS p3, lower(ws[i+1]) AS n1, lower(ws[i+2]) AS n2,
          l.valence AS base FROM placed JOIN lexicon l ON l.token = lower(word))""",
        f"""based AS (SELECT id, i, but, mixed, word, item, n1, n2, lower(p1) AS b1, lower(p2) AS b2, lower(p3) AS b3,
          coalesce({upper('p1')}, false) AS up1, coalesce({upper('p2')}, false) AS up2, coalesce({upper('p3')}, false) AS up3,
          coalesce(lower(p1) IN (SELECT token FROM lexicon), false) AS lex1,
          coalesce(lower(p2) IN (SELECT token FROM lexicon), false) AS lex2,
          coalesce(lower(p3) IN (SELECT token FROM lexicon), false) AS lex3,
          (CASE WHEN lower(p1) = 'no' OR lower(p2) = 'no' OR (lower(p3) = 'no' AND lower(p1) IN ('or', 'nor')) THEN base * {factor}
                WHEN item = 'no' AND n1 IN (SELECT token FROM lexicon) THEN 0 ELSE base END) AS v
          FROM around)""",
        f"""v0 AS (SELECT * REPLACE (v + CASE WHEN mixed AND {upper('word')}
          THEN (CASE WHEN v > 0 THEN {caps} ELSE -{caps} END) ELSE 0 END AS v) FROM based)""",
        *steps,
        f"""summed AS (SELECT f.id, f.n_words, f.emphasis, coalesce(sum(v ORDER BY i), 0) AS total,
          coalesce(sum(v + 1 ORDER BY i) FILTER (v > 0), 0) AS pos, coalesce(sum(1 - v ORDER BY i) FILTER (v < 0), 0) AS neg,
          f.n_words - count(*) FILTER (v <> 0) AS neu
          FROM framed f LEFT JOIN v{last} USING (id) GROUP BY f.id, f.n_words, f.emphasis)""",
        """pushed AS (SELECT id, n_words, neu, CASE WHEN total > 0 THEN total + emphasis WHEN total < 0 THEN total - emphasis ELSE 0 END AS total,
          CASE WHEN pos > neg THEN pos + emphasis ELSE pos END AS pos, CASE WHEN pos < neg THEN neg + emphasis ELSE neg END AS neg FROM summed)""",
        f"""scores AS (SELECT id AS {key},
          round_even(greatest(least(total / sqrt(total * total + CAST(15 AS DOUBLE)), 1.0::DOUBLE), -1.0::DOUBLE), 4) AS vader_compound,
          CASE WHEN n_words = 0 THEN 0.0::DOUBLE ELSE round_even(pos / (pos + neg + neu), 3) END AS vader_pos,
          CASE WHEN n_words = 0 THEN 0.0::DOUBLE ELSE round_even(neg / (pos + neg + neu), 3) END AS vader_neg,
          CASE WHEN n_words = 0 THEN 0.0::DOUBLE ELSE round_even(neu / (pos + neg + neu), 3) END AS vader_neu
          FROM pushed)""",
    ]


SCORED = [
    *READY,
    *_scores("prepared", "tweet_id", "clean_text"),
    """scored AS (SELECT p.*, vader_compound, vader_pos, vader_neg, vader_neu,
     CASE WHEN vader_compound >= 0.05 THEN 'positive' WHEN vader_compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment
     FROM prepared p JOIN scores USING (tweet_id))""",
]
_TIMES = """CAST(created_at AS DATE) AS date, CAST(hour(created_at) AS INT) AS hour_of_day,
 dayname(created_at) AS day_of_week, strftime(created_at, '%Y-W%U') AS week, strftime(created_at, '%Y-%m') AS month"""
REPORTED = [
    *SCORED,
    f"reported AS (SELECT *, greatest(vader_pos, vader_neg, vader_neu) AS confidence, {_TIMES} FROM scored)",
]


def _mean(column: str) -> str:
    return f"CAST(sum(CAST(round({column} * 10000) AS BIGINT)) AS DOUBLE) / (count({column}) * 10000)"


# Features and models

TF = [
    *TERMS,
    "tf AS (SELECT tweet_id, term, count(*) AS tf FROM (SELECT tweet_id, unnest(terms) AS term FROM terms_of) GROUP BY ALL)",
]


def _vocabulary(ids: str) -> list[str]:
    return [
        f"n_docs AS (SELECT count(*) AS n FROM {ids})",
        f"""vocab AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS idx, ln((n + 1) / (df + 1)) + 1 AS idf FROM (
          SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, any_value(n) AS n
          FROM tf JOIN {ids} USING (tweet_id), n_docs GROUP BY term
          HAVING df >= 3 AND df <= CAST(0.9 AS DOUBLE) * any_value(n) ORDER BY cf DESC, term LIMIT 5000))""",
        """raw_weights AS (SELECT tweet_id, term, idx, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term))""",
        """weights AS (SELECT tweet_id, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY tweet_id)) AS weight FROM raw_weights)""",
    ]


SPLIT = [
    """quota AS (SELECT sentiment, n - (fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, sentiment) <= n_train - sum(fl) OVER ()
       THEN 1 ELSE 0 END) AS n_test FROM (SELECT sentiment, n, n_train, (n * n_train) // total AS fl, (n * n_train) % total AS rest FROM (
        SELECT sentiment, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
         total - CAST(ceil(total * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n_train FROM scored GROUP BY sentiment)))""",
    """parts AS (SELECT tweet_id, s.sentiment, CASE WHEN row_number() OVER (PARTITION BY s.sentiment
        ORDER BY md5('42:' || tweet_id), tweet_id) <= n_test THEN 'test' ELSE 'train' END AS split
       FROM scored s JOIN quota USING (sentiment))""",
]
NB = [
    *SCORED,
    *SPLIT,
    *TF,
    "train AS (SELECT tweet_id, sentiment FROM parts WHERE split = 'train')",
    *_vocabulary("train"),
    "sums AS (SELECT idx, "
    + ", ".join(f"coalesce(sum(weight) FILTER (sentiment = '{s}'), 0) AS {s}" for s in SENTIMENTS)
    + " FROM weights JOIN train USING (tweet_id) GROUP BY idx)",
    "theta AS (SELECT term, idx, "
    + ", ".join(
        f"ln((coalesce({s}, 0) + 0.1::DOUBLE) / (sum(coalesce({s}, 0)) OVER () + 0.1::DOUBLE * count(*) OVER ())) AS {s}"
        for s in SENTIMENTS
    )
    + " FROM vocab LEFT JOIN sums USING (idx))",
    "prior AS (SELECT "
    + ", ".join(f"ln(count(*) FILTER (sentiment = '{s}') / count(*)) AS prior_{s}" for s in SENTIMENTS)
    + " FROM train)",
    "doc_sums AS (SELECT tweet_id, "
    + ", ".join(f"sum(weight * {s}) AS {s}" for s in SENTIMENTS)
    + " FROM weights JOIN theta USING (idx) GROUP BY tweet_id)",
    "totals AS (SELECT t.tweet_id, t.sentiment, "
    + ", ".join(f"coalesce(d.{s}, 0) + prior_{s} AS {s}" for s in SENTIMENTS)
    + " FROM parts t LEFT JOIN doc_sums d USING (tweet_id), prior WHERE t.split = 'test')",
    """predicted AS (SELECT tweet_id, sentiment, CASE WHEN negative >= neutral AND negative >= positive THEN 'negative'
       WHEN neutral >= positive THEN 'neutral' ELSE 'positive' END AS prediction FROM totals)""",
]


# Logistic regression by Newton steps, each of CG_STEPS conjugate gradients; the first ones go half the way. A row of
# ``lr`` is a feature (-1: the intercept, not penalised) with weights w, step s, residual r, direction p, scale d.
CG_STEPS, HALF_STEPS, FULL_STEPS = 30, 7, 13


def _each(pattern: str, join: str = ", ") -> str:
    """The pattern for the classes 0, 1, 2 in the place of #."""
    return join.join(pattern.replace("#", str(k)) for k in range(len(SENTIMENTS)))


def _newton() -> str:
    total = "sum(" + _each("r# * r# / d#", " + ") + ") OVER ()"
    first = f"it % {CG_STEPS + 1} = 0"
    length = f"CASE WHEN it < {HALF_STEPS * (CG_STEPS + 1)} THEN 0.5::DOUBLE ELSE 1 END"
    last = f"it % {CG_STEPS + 1} = {CG_STEPS}"
    return f"""lr(it, idx, ridge, {_each('w#, s#, r#, p#, d#')}) AS (
 SELECT 0, idx, CASE WHEN idx < 0 THEN 0 ELSE 1::DOUBLE END, {_each('0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 1::DOUBLE')}
 FROM (SELECT DISTINCT idx FROM lr_terms)
 UNION ALL
 SELECT it + 1, idx, ridge, {_each(f'w# + CASE WHEN {last} THEN ({length}) * s# ELSE 0 END, s#, r#, r# / d# + beta * p#, d#')}
 FROM (SELECT * REPLACE (0 AS a), CASE WHEN {first} OR rz = 0 THEN 0 ELSE {total} / rz END AS beta FROM (
  SELECT it, idx, ridge, rz, a, {_each('w#, p#')},
   {_each(f'CASE WHEN {first} THEN 0 ELSE s# + a * p# END AS s#')},
   {_each(f'CASE WHEN {first} THEN -h# ELSE r# - a * h# END AS r#')},
   {_each(f'CASE WHEN {first} THEN c# ELSE d# END AS d#')}
  FROM (SELECT *, CASE WHEN {first} THEN 0 ELSE coalesce(rz / nullif(ph, 0), 0) END AS a FROM (
   SELECT *, {total} AS rz, sum({_each('p# * h#', ' + ')}) OVER () AS ph FROM (
    WITH m AS (SELECT doc, max(it) AS it, {_each('sum(x * w#) AS m#, sum(x * p#) AS u#')} FROM lr_terms JOIN lr USING (idx) GROUP BY doc),
    e AS (SELECT doc, it, cost, label, {_each('u#')}, {_each('exp(m# - greatest(m0, m1, m2)) AS e#')} FROM m JOIN lr_rows USING (doc)),
    q AS (SELECT doc, it, cost, label, {_each('u#')}, {_each('e# / (e0 + e1 + e2) AS q#')} FROM e),
    t AS (SELECT doc, {_each('cost * q# * (1 - q#) AS v#')},
     {_each(f'cost * CASE WHEN {first} THEN q# - CASE WHEN label = # THEN 1 ELSE 0 END ELSE q# * (u# - q0 * u0 - q1 * u1 - q2 * u2) END AS t#')} FROM q),
    f AS (SELECT idx, {_each('sum(x * t#) AS t#, sum(x * x * v#) AS v#')} FROM lr_terms JOIN t USING (doc) GROUP BY idx)
    SELECT lr.*, {_each(f't# + ridge * CASE WHEN {first} THEN w# ELSE p# END AS h#, v# + ridge AS c#')} FROM lr JOIN f USING (idx)))))
 WHERE it < {(HALF_STEPS + FULL_STEPS) * (CG_STEPS + 1)}))"""


LR = [
    *SCORED,
    *SPLIT,
    *TF,
    "train AS (SELECT tweet_id, sentiment FROM parts WHERE split = 'train')",
    *_vocabulary("train"),
    """lr_rows AS MATERIALIZED (SELECT row_number() OVER (ORDER BY tweet_id) AS doc, tweet_id,
     CASE sentiment """
    + " ".join(f"WHEN '{s}' THEN {k}" for k, s in enumerate(SENTIMENTS))
    + """ END AS label, count(*) OVER () / ((SELECT count(DISTINCT sentiment) FROM train) * CAST(count(*) OVER (PARTITION BY sentiment) AS DOUBLE)) AS cost
     FROM train)""",
    "scales AS MATERIALIZED (SELECT idx, max(weight) AS scale FROM weights JOIN train USING (tweet_id) GROUP BY idx)",
    """lr_terms AS MATERIALIZED (SELECT doc, idx, weight / scale AS x FROM weights JOIN lr_rows USING (tweet_id) JOIN scales USING (idx)
     UNION ALL SELECT doc, -1, 1 FROM lr_rows)""",
    _newton(),
    "fitted AS MATERIALIZED (SELECT * FROM lr WHERE it = (SELECT max(it) FROM lr))",
]


def _scored_by_lr(ids: str, weights: str, label: str) -> list[str]:
    """CTEs up to ``lr_scored``: the ids with prediction and probabilities; ``weights`` has their terms."""
    return [
        f"""lr_sums AS (SELECT tweet_id, {_each('sum(weight / scale * w#) AS m#')} FROM {weights} JOIN scales USING (idx)
          JOIN fitted USING (idx) GROUP BY tweet_id)""",
        f"""lr_margins AS (SELECT i.*, {_each('coalesce(m#, 0) + (SELECT w# FROM fitted WHERE idx = -1) AS m#')}
          FROM {ids} i LEFT JOIN lr_sums USING (tweet_id))""",
        f"""lr_scored AS (SELECT * EXCLUDE ({_each('m#')}),
          CASE WHEN m0 >= m1 AND m0 >= m2 THEN '{SENTIMENTS[0]}' WHEN m1 >= m2 THEN '{SENTIMENTS[1]}' ELSE '{SENTIMENTS[2]}' END AS {label},
          """
        + ", ".join(f"exp(m{k} - greatest(m0, m1, m2)) / ({_each('exp(m# - greatest(m0, m1, m2))', ' + ')}) AS prob_{s}" for k, s in enumerate(SENTIMENTS))
        + " FROM lr_margins)",
    ]


_AGAIN = re.compile(
    r"\b(cleaned|chars|tokenized|kept|irregular|places|lemmas|lemmatized|unigrams|terms_of|tf|raw_weights|weights"
    r"|lexicon|idioms|wordlist|framed|placed|around|based|v\d+|summed|pushed|scores)\b"
)


def _again(*ctes: str) -> list[str]:
    """The same steps under other names, for a second relation in one statement."""
    return [_AGAIN.sub(r"\1_2", cte) for cte in ctes]


# The first arrivals' texts, prepared without a least number of words, and scored as they are.
FIRSTS_READY = [
    FIRST,
    *_again(*_tokenized("firsts", "tweet_id")),
    *[
        cte.replace("FROM prepared", "FROM (SELECT tweet_id, array_to_string(tokens, ' ') AS processed_text FROM lemmatized_2)")
        for cte in _again(*TF)
    ],
    *_again(*_vocabulary("train")[2:]),
    *_again(*_scores("firsts", "tweet_id", "{emoji}")),
]
PROBABILITIES = ", ".join(f"round(prob_{s}, 3) AS prob_{s}" for s in SENTIMENTS)


def _report() -> str:
    rows = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SENTIMENTS))
    return f""", classes(position, class) AS (VALUES {rows}),
 counted AS (SELECT position, class, (SELECT count(*) FROM predicted WHERE sentiment = class AND prediction = class) AS hit,
  (SELECT count(*) FROM predicted WHERE prediction = class) AS chosen,
  (SELECT count(*) FROM predicted WHERE sentiment = class) AS support FROM classes),
 rated AS (SELECT class, support, hit, CASE WHEN chosen = 0 THEN 0 ELSE hit / chosen END AS precision,
  CASE WHEN support = 0 THEN 0 ELSE hit / support END AS recall,
  CASE WHEN chosen + support = 0 THEN 0 ELSE 2 * hit / (chosen + support) END AS f1 FROM counted)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rated
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
  round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM rated
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM rated
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM rated"""


def _emoji(text: str) -> str:
    """The text with its emoji described: cut at the longest of them, else at characters."""
    longest = sorted(words.SEED_EMOJI, key=len, reverse=True)
    cuts = f"regexp_extract_all({text}, '(?s){'|'.join(longest)}|.')"
    names = " ".join(
        f"WHEN '{e}' THEN CASE WHEN struct_extract(x, 2) = ' ' THEN '' ELSE ' ' END || '{words.SEED_EMOJI[e]}'" for e in longest
    )
    pairs = f"list_zip({cuts}, list_prepend(' ', {cuts}), true)"
    return f"array_to_string(list_transform({pairs}, lambda x: CASE struct_extract(x, 1) {names} ELSE struct_extract(x, 1) END), '')"


def _top(source: str, name: str) -> str:
    return f"""SELECT date, {name}, n, rank FROM (SELECT date, {name}, n,
      CAST(row_number() OVER (PARTITION BY date ORDER BY n DESC, {name}) AS INT) AS rank
      FROM (SELECT date, {name}, count(*) AS n FROM ({source}) GROUP BY date, {name})) WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    pipe = "array_to_string(tokens, '|') AS tokens"
    by_sentiment = ", ".join(f"count(tweet_id) FILTER (sentiment = '{s}') AS {s}" for s in SENTIMENTS)
    shares = ", ".join(
        f"round_even({s} / (positive + negative + neutral) * 100, 2) AS pct_{s}" for s in SENTIMENTS
    )
    raw = "arrival_seq, tweet_id, username, text, lang, created_at"
    daily = f"""SELECT date, topic, sentiment, count(tweet_id) AS tweet_count, {_mean('vader_compound')} AS avg_vader,
      {_mean('confidence')} AS avg_confidence, CAST(coalesce(sum(like_count), 0) AS BIGINT) AS total_likes,
      CAST(coalesce(sum(retweet_count), 0) AS BIGINT) AS total_retweets FROM reported GROUP BY date, topic, sentiment"""
    kpis = f"""SELECT *, {shares} FROM (SELECT topic, count(tweet_id) AS total_tweets, {_mean('vader_compound')} AS avg_vader,
      CAST(coalesce(sum(like_count), 0) AS BIGINT) AS total_likes, CAST(coalesce(sum(retweet_count), 0) AS BIGINT) AS total_retweets,
      {by_sentiment} FROM reported GROUP BY topic)"""
    heat = """SELECT day_of_week, hour_of_day, sentiment, count(tweet_id) AS tweet_count,
      CAST(any_value(isodow(created_at)) - 1 AS INT) AS day_num FROM reported GROUP BY day_of_week, hour_of_day, sentiment"""
    weighted = [*READY, *TF, *_vocabulary("prepared")]
    volume = _with(POSTS, select=f"""SELECT date_trunc('hour', created_at) AS hour, {_TOPIC} AS topic,
      count(*) AS tweet_count FROM posts GROUP BY ALL""")
    labels = _with(*SCORED, select="SELECT tweet_id, vader_compound, sentiment FROM scored")
    return {
        "load_english": _with(POSTS, COLLECTED, ENGLISH, select="""SELECT tweet_id, username, text, topic, lang,
            retweet_count, like_count, created_at FROM english"""),
        "ingest_filter": _with(POSTS, select="SELECT arrival_seq, tweet_id, text FROM posts WHERE left(text, 3) <> 'RT '"),
        "ingest_defaults": _with(POSTS, select="""SELECT arrival_seq, tweet_id, coalesce(lang, 'en') AS lang,
            coalesce(retweet_count, 0) AS retweet_count, coalesce(like_count, 0) AS like_count, created_at FROM posts"""),
        "ingest_dedup": _with(POSTS, select=f"""SELECT {raw} FROM posts
            QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY arrival_seq) = 1"""),
        "ingest_conflict": _with(POSTS, select="""SELECT min(arrival_seq) AS arrival_seq, tweet_id FROM posts
            WHERE tweet_id NOT IN (SELECT tweet_id FROM posts WHERE starts_with(text, 'RT ')) GROUP BY tweet_id"""),
        "ingest_cap": _with(POSTS, COLLECTED, select="""SELECT arrival_seq, tweet_id, topic FROM collected
            ORDER BY arrival_seq LIMIT 500"""),
        "topic_detect": _with(POSTS, select=f"SELECT arrival_seq, {_TOPIC} AS topic FROM posts"),
        "stream_rules": _with(POSTS, select=f"""SELECT arrival_seq, {_tags(False)} AS tags,
            {_tags(True)} AS strict_tags FROM posts"""),
        "clean_tweet": _with(*TOKENIZED[:2], select="SELECT arrival_seq, clean_text FROM cleaned"),
        "tokenize": _with(*TOKENIZED, select=f"SELECT arrival_seq, {pipe} FROM tokenized"),
        "remove_stopwords": _with(*TOKENIZED, select=f"SELECT arrival_seq, {pipe} FROM kept"),
        "lemmatize": _with(*TOKENIZED, select=f"SELECT arrival_seq, {pipe} FROM lemmatized"),
        "preprocess": _with(*READY, select="SELECT tweet_id, clean_text, processed_text, text_length, word_count FROM prepared"),
        "ngrams": _with(*READY, *TERMS, select="SELECT tweet_id, array_to_string(terms, '|') AS terms FROM terms_of"),
        "vader_scores": _with(*TOKENIZED[:2], *_scores("cleaned", "arrival_seq", "clean_text"), select="SELECT * FROM scores"),
        "vader_raw_scores": _with(POSTS, *_scores("posts", "arrival_seq", _emoji("text")), select="SELECT * FROM scores"),
        "vader_label": labels,
        "time_columns": _with(POSTS, select=f"SELECT arrival_seq, created_at, {_TIMES} FROM posts"),
        "fact_tweets": _with(*REPORTED, select="""SELECT tweet_id, topic, sentiment, vader_compound, confidence, retweet_count,
            like_count, word_count, created_at, date, hour_of_day, day_of_week, week, month, vader_compound AS sentiment_score FROM reported"""),
        "daily_sentiment": _with(*REPORTED, select=f"""SELECT *, round_even(tweet_count / sum(tweet_count) OVER (PARTITION BY date, topic) * 100, 2) AS pct
            FROM ({daily})"""),
        "topic_kpis": _with(*REPORTED, select=kpis),
        "sentiment_pivot": _with(*REPORTED, select=f"SELECT topic, {by_sentiment} FROM reported GROUP BY topic"),
        "hourly_heatmap": _with(*REPORTED, select=heat),
        "sentiment_distribution": _with(*SCORED, select="""SELECT sentiment, count(*) AS tweet_count,
            round_even(count(*) / sum(count(*)) OVER () * 100, 2) AS pct FROM scored GROUP BY sentiment"""),
        "volume_over_time": volume,
        "trending_keywords": _with(*READY, select=_top("SELECT CAST(created_at AS DATE) AS date, unnest(tokens) AS keyword FROM prepared", "keyword")),
        "trending_hashtags": _with(POSTS, select=_top(f"""SELECT CAST(created_at AS DATE) AS date,
            lower(unnest(regexp_extract_all(text, {_q(tx.HASHTAG)}, 1))) AS hashtag FROM posts""", "hashtag")),
        "influencer_sentiment": _with(*SCORED, select=f"""SELECT username, count(*) AS tweets, {_mean('vader_compound')} AS avg_vader,
            CAST(sum(like_count) + sum(retweet_count) AS BIGINT) AS engagement FROM scored GROUP BY username
            ORDER BY engagement DESC, username LIMIT 20"""),
        "tfidf_vocab": _with(*weighted, select="SELECT term, df, cf, idx, round(idf, 6) AS idf FROM vocab"),
        "tfidf_weights": _with(*weighted, select="SELECT tweet_id, term, idx, round(weight, 6) AS weight FROM weights"),
        "maxabs_scale": _with(*weighted, select="""SELECT tweet_id, idx,
            round(weight / max(abs(weight)) OVER (PARTITION BY idx), 6) AS scaled FROM weights"""),
        "stratified_split": _with(*SCORED, *SPLIT, select="SELECT tweet_id, sentiment, split FROM parts"),
        "class_weights": _with(*SCORED, select="""SELECT sentiment, count(*) AS n,
            round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM scored GROUP BY sentiment"""),
        "train_nb": _with(*NB, select="""SELECT term, idx, round(positive, 6) AS positive, round(negative, 6) AS negative,
            round(neutral, 6) AS neutral FROM theta"""),
        "predict_nb": _with(*NB, select="SELECT tweet_id, sentiment, prediction FROM predicted"),
        "accuracy": _with(*NB, select="SELECT count(*) AS n, count(*) FILTER (sentiment = prediction) / count(*) AS accuracy FROM predicted"),
        "confusion_matrix": _with(*NB, select=f"""SELECT position, actual,
            {', '.join(f"count(prediction) FILTER (prediction = '{s}') AS {s}" for s in SENTIMENTS)}
            FROM (VALUES {', '.join(f"({i}, '{s}')" for i, s in enumerate(SENTIMENTS))}) c(position, actual)
            LEFT JOIN predicted ON sentiment = actual GROUP BY position, actual"""),
        "classification_report": _with(*NB, select="")[:-1] + _report(),
        "sql_functions": _with(*TOKENIZED[:2], select=f"""SELECT arrival_seq, clean_text, {_TOPIC} AS topic,
            starts_with(text, 'RT ') AS is_retweet, CAST(len(regexp_extract_all(text, {_q(tx.HASHTAG)}, 1)) AS INT) AS n_tags,
            {_TIMES} FROM cleaned"""),
        "sql_labels": _with(*SCORED, select=f"SELECT {_TOPIC} AS topic, sentiment, count(*) AS n FROM scored GROUP BY ALL"),
        "csv_roundtrip": _with(*READY, select="""SELECT tweet_id, username, text, topic, lang, retweet_count, like_count, created_at,
            clean_text, processed_text, text_length, word_count FROM prepared"""),
        "export_manifest": _with(*REPORTED, select=f"""SELECT 'Fact_Tweets' AS table_name, count(*) AS rows FROM reported
            UNION ALL SELECT 'Daily_Sentiment', count(*) FROM ({daily}) UNION ALL SELECT 'Topic_KPIs', count(*) FROM ({kpis})
            UNION ALL SELECT 'Hourly_Heatmap', count(*) FROM ({heat})
            UNION ALL SELECT 'Model_Metrics', 3"""),
        "raw_table": _with(POSTS, select=f"""SELECT arrival_seq, tweet_id, {_TOPIC} AS topic FROM posts
            WHERE NOT starts_with(text, 'RT ')
            QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY arrival_seq % 2, arrival_seq) = 1"""),
        "train_lr": _with(*LR, "test AS (SELECT tweet_id, sentiment FROM parts WHERE split = 'test')",
            *_scored_by_lr("test", "weights", "prediction"),
            select=f"SELECT tweet_id, sentiment, prediction, {PROBABILITIES} FROM lr_scored"),
        "predict_batch": _with(*LR, *[cte.replace("{emoji}", _emoji("text")) for cte in FIRSTS_READY],
            *_scored_by_lr("firsts", "weights_2", "sentiment"),
            select=f"""SELECT tweet_id, text, sentiment, vader_compound, {PROBABILITIES},
            round(greatest({', '.join(f'prob_{s}' for s in SENTIMENTS)}), 3) AS confidence FROM lr_scored JOIN scores_2 USING (tweet_id)"""),
        "scheduled_run": _with(*LR, *_scored_by_lr("prepared", "weights", "label"),
            select="""SELECT *, round_even(tweet_count / sum(tweet_count) OVER (PARTITION BY date, topic) * 100, 2) AS pct FROM (
            SELECT CAST(created_at AS DATE) AS date, topic, label AS sentiment, count(*) AS tweet_count,
             CAST(sum(like_count) AS BIGINT) AS total_likes, CAST(sum(retweet_count) AS BIGINT) AS total_retweets
            FROM lr_scored GROUP BY ALL)"""),
        "run_log": _with(*READY, select="""SELECT count(*) AS tweet_count, true AS success, CAST(NULL AS VARCHAR) AS error_msg
            FROM prepared UNION ALL SELECT 0, true, NULL"""),
        "stream_ingest": _with(POSTS, COLLECTED, select="""SELECT arrival_seq, tweet_id, topic, lang, retweet_count, like_count
            FROM collected"""),
        "stream_dedup": _with(POSTS, select="SELECT tweet_id, min(arrival_seq) AS arrival_seq FROM posts GROUP BY tweet_id"),
        "stream_target": _with(POSTS, COLLECTED, select="""SELECT arrival_seq, tweet_id, topic FROM collected
            ORDER BY arrival_seq LIMIT 500"""),
        "stream_volume": volume,
        "stream_score": _with(*LR, *_scored_by_lr("prepared", "weights", "label"),
            select="""SELECT tweet_id, vader_compound, s.sentiment AS vader_sentiment, label AS sentiment
            FROM scored s JOIN (SELECT tweet_id, label FROM lr_scored) USING (tweet_id)"""),
    }
