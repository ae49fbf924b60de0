"""Lexicon sentiment as a relational operator.

Each word becomes a row; those in the lexicon take their neighbours (three before, two
after) from the text's words, so negation, boosters and the like need no window. A lexicon of a few MB is
broadcast by its size, and the joins are on the map side; a larger one is joined
by shuffle. Only lexicon words and one marker row per text pass the first join, and
the aggregate reduces a text to one short row. The columns to keep travel on
the marker row, so nothing is joined back, and an input partitioned by id needs
no exchange at all.

The rules are those of Hutto & Gilbert (2014) and the published scorer,
including its reading of ``never so`` three words back, where ``so`` or ``this``
directly before the word raises it even without ``never``. One difference: words
before and after ``but`` are weighted by position, while the published loop finds
them by value.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.functions.dictionaries import BOOSTERS, IDIOMS, NEGATIONS
from moodloom.functions.text import SPACE

# Fixed values.
NEGATION_FACTOR = -0.74
CAPS_INCREASE = 0.733
EXCITE = 1.25
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
NORMALIZER = 15.0
DISTANCE_WEIGHT = {1: 1.0, 2: 0.95, 3: 0.9}
EXCLAMATION, EXCLAMATION_MAX = 0.292, 4
QUESTION, QUESTION_MANY = 0.18, 0.96
POSITIVE_FROM, NEGATIVE_TO = 0.05, -0.05
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Printable ASCII is ruled out before the many ranges of whitespace.
OTHER_SPACE = f"[[^ -~]&&[{SPACE}]]"
# Mappings with at most so many values are looked up as sets.
LOOKUP_SETS = 16


def _ranges(chars: Iterable[str]) -> str:
    """The inside of a bracket expression for these characters."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, set(chars))):
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans)


def sequence_pattern(sequences: Iterable[str]) -> str:
    """A pattern whose matches cut any text whole: the longest of the sequences that begins at a place, else one character.

    Sequences with a common beginning share it, so a place is tried once for each way to go on; characters that
    begin no sequence are told by their range.
    """
    tree: dict = {}
    for sequence in sequences:
        node = tree
        for char in sequence:
            node = node.setdefault(char, {})
        node[""] = {}

    def written(node: dict) -> str:
        ways = [f"\\x{{{ord(char):x}}}{written(after)}" for char, after in sorted(node.items()) if char]
        if not ways:
            return ""
        return f"(?:{'|'.join(ways)})" + ("?" if "" in node else "")

    if not tree:
        return "(?s:.)"
    tree.pop("", None)
    return f"[^{_ranges(tree)}]|{written(tree)}|(?s:.)"


def describe_emoji(text: Column, emoji: Mapping[str, str]) -> Column:
    """Replace each emoji by its description; of several that begin at a place, the longest counts.

    An emoji may be a sequence (with joiners, variation selectors, skin tones). A space goes before the description
    unless the character before it is one. The names are one constant of the plan, looked up for emoji only.
    """
    emoji = {k: v for k, v in emoji.items() if k}
    if not emoji:
        return text
    firsts = _ranges(k[0] for k in emoji)
    names = F.map_from_arrays(F.array(*map(F.lit, emoji)), F.array(*map(F.lit, emoji.values())))
    cuts = F.regexp_extract_all(text, F.lit(sequence_pattern(emoji)), F.lit(0))
    before = F.slice(F.concat(F.array(F.lit(" ")), cuts), F.lit(1), F.size(cuts))

    def spell(cut: Column, previous: Column) -> Column:
        name = F.when(cut.rlike(f"^[{firsts}]"), F.try_element_at(names, cut))
        return (
            F.when(name.isNull(), cut)
            .when(previous == " ", name)
            .otherwise(F.concat(F.lit(" "), name))
        )

    spelled = F.array_join(F.zip_with(cuts, before, spell), "")
    return F.when(text.rlike(f"[{firsts}]"), spelled).otherwise(text)


def _is_upper(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _strip_punctuation(word: Column) -> Column:
    bare = F.btrim(word, F.lit(PUNCTUATION))
    return F.when(F.length(bare) <= 2, word).otherwise(bare)


def _count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def punctuation_emphasis(text: Column) -> Column:
    marks = F.least(_count_char(text, "!"), F.lit(EXCLAMATION_MAX)) * F.lit(EXCLAMATION)
    asks = _count_char(text, "?")
    questions = (
        F.when(asks > 3, F.lit(QUESTION_MANY)).when(asks > 1, asks * F.lit(QUESTION)).otherwise(F.lit(0.0))
    )
    # Counting writes a text anew, so those without either mark are spared it.
    return F.when(text.contains("!") | text.contains("?"), marks + questions).otherwise(F.lit(0.0))


def _lookup_in(values: Mapping[str, float]) -> Callable[[Column], Column]:
    """Value of a phrase in a short fixed mapping, else null.

    A map is searched entry by entry, a set of literals by hash: phrases with one value make a set. With
    many values the mapping travels as one JSON literal, which the optimizer folds to a map.
    """
    phrases: dict[float, list[str]] = {}
    for phrase, value in values.items():
        phrases.setdefault(float(value), []).append(phrase)
    if not 0 < len(phrases) <= LOOKUP_SETS:
        entries = F.from_json(F.lit(json.dumps(values)), "map<string,double>")
        return lambda phrase: F.element_at(entries, phrase)
    return lambda phrase: F.coalesce(*[F.when(phrase.isin(listed), F.lit(v)) for v, listed in phrases.items()])


def _words(text: Column) -> Column:
    """The words between runs of whitespace, without punctuation around them.

    A split at plain spaces takes a seventh of the time of one by pattern, so it serves all texts: other whitespace,
    if there is any, becomes a space first. Only texts with punctuation are looked at word by word.
    """
    plain = F.when(text.rlike(OTHER_SPACE), F.regexp_replace(text, OTHER_SPACE, " ")).otherwise(text)
    words = F.array_remove(F.split(plain, " "), "")
    return F.when(text.rlike(f"[{_ranges(PUNCTUATION)}]"), F.transform(words, _strip_punctuation)).otherwise(words)


def _position_of(words: Column, wanted: str) -> Column:
    """Index of the first word that is ``wanted`` in any case, else -1; for words whose letters have no other forms than ASCII."""
    spellings = ["".join(letters) for letters in product(*[(c, c.upper()) for c in wanted])]
    return F.coalesce(F.least(*[F.nullif(F.array_position(words, x), F.lit(0)) for x in spellings]), F.lit(0)) - 1


def word_rows(df: DataFrame, id_col: str, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per word with all ``words`` of its text; a text without words keeps one row of nulls.

    ``kept``, a struct of the columns ``keep``, is set in the first row of a text.
    """
    return (
        df.select(
            F.col(id_col).alias("id"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
            F.struct(*[F.col(c) for c in keep] or [F.lit(0).alias("none")]).alias("kept"),
        )
        .withColumn("words", _words(F.col("text")))
        .select(
            "id",
            "kept",
            F.size("words").alias("n_words"),
            punctuation_emphasis(F.col("text")).alias("emphasis"),
            # Asked of words in capitals only, so one word that is not tells that both kinds occur.
            (~F.forall("words", _is_upper)).alias("mixed_case"),
            _position_of(F.col("words"), "but").alias("but_at"),
            "words",
        )
        .select("*", F.posexplode_outer("words").alias("pos", "word"))
        .withColumn("kept", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("kept")))
    )


def _valence(
    rows: DataFrame,
    lexicon: DataFrame,
    boosters: Mapping[str, float],
    negations: Sequence[str],
    idioms: Mapping[str, float],
) -> DataFrame:
    """Value ``v`` of each lexicon word in context; other words but the first are dropped.

    The lower-casing by ``transform`` also ends the generated stage that explodes
    and joins, so that its loop stays small enough to be compiled to machine code.
    """

    def valence_of(name: str) -> DataFrame:
        return lexicon.select(F.col("token").alias(name), F.col("valence").alias(f"{name}_valence"))

    near = {"back1": -1, "back2": -2, "back3": -3, "next1": 1, "next2": 2}
    hits = (
        rows.withColumn("item", F.lower("word"))
        .join(valence_of("item"), "item", "left")
        .where(F.col("item_valence").isNotNull() | F.coalesce("pos", F.lit(0)).eqNullSafe(0))
        .withColumns({name: F.get("words", F.col("pos") + d) for name, d in near.items()})
        .drop("words")
        .withColumn(
            "around", F.transform(F.array("back1", "back2", "back3", "next1", "next2"), F.lower)
        )
        .withColumns({name: F.col("around")[i] for i, name in enumerate(("b1", "b2", "b3", "n1", "n2"))})
    )
    # Where a shuffle joins a large lexicon, missing neighbours must not meet in one task.
    nobody = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("id"), F.lit(997)).cast("string"))
    for name in ("b1", "b2", "b3", "n1"):
        other = valence_of("_near").withColumnRenamed("_near_valence", f"{name}_valence")
        hits = hits.join(other, F.coalesce(F.col(name), nobody) == F.col("_near"), "left").drop("_near")

    booster_of = _lookup_in(boosters)
    item, pos, v, mixed = F.col("item"), F.col("pos"), F.col("v"), F.col("mixed_case")
    b1, b2, b3, n1, n2 = (F.coalesce(name, F.lit("")) for name in ("b1", "b2", "b3", "n1", "n2"))
    after_no = (b1 == "no") | (b2 == "no") | ((b3 == "no") & b1.isin("or", "nor"))
    silent_no = (item == "no") & F.col("n1_valence").isNotNull()
    caps = F.when(mixed & _is_upper(F.col("word")), F.lit(CAPS_INCREASE)).otherwise(0.0)
    hits = hits.withColumn(
        "v",
        F.when(after_no, F.col("item_valence") * NEGATION_FACTOR)
        .when(silent_no, 0.0)
        .otherwise(F.col("item_valence")),
    ).withColumn("v", v + F.when(v > 0, caps).otherwise(-caps))

    listed = _lookup_in(dict.fromkeys(negations, NEGATION_FACTOR))

    def negation(word: Column) -> Column:
        return F.when(word.contains("n't"), NEGATION_FACTOR).otherwise(F.coalesce(listed(word), F.lit(1.0)))

    excites = ["so", "this"]
    factors = {
        1: negation(b1),
        2: F.when((b2 == "never") & b1.isin(excites), EXCITE)
        .when((b2 == "without") & (b1 == "doubt"), 1.0)
        .otherwise(negation(b2)),
        3: F.when(((b3 == "never") & b2.isin(excites)) | b1.isin(excites), EXCITE)
        .when((b3 == "without") & ((b2 == "doubt") | (b1 == "doubt")), 1.0)
        .otherwise(negation(b3)),
    }
    reaches = {d: (pos >= d) & F.col(f"b{d}_valence").isNull() for d in factors}
    back_steps = [
        F.struct(
            F.coalesce(F.when(reaches[d], booster_of(word)), F.lit(0.0)).alias("scalar"),
            F.when(mixed & _is_upper(F.col(f"back{d}")), F.lit(CAPS_INCREASE)).otherwise(0.0).alias("caps"),
            F.lit(DISTANCE_WEIGHT[d]).alias("weight"),
            F.when(reaches[d], factors[d]).otherwise(1.0).alias("factor"),
        )
        for d, word in ((1, b1), (2, b2), (3, b3))
    ]

    def one_step_back(value: Column, step: Column) -> Column:
        boost = F.when(value < 0, -step["scalar"]).otherwise(step["scalar"])
        shout = F.when(value > 0, step["caps"]).otherwise(-step["caps"])
        raised = F.when(step["scalar"] == 0, value).otherwise(value + (boost + shout) * step["weight"])
        return raised * step["factor"]

    # Marker rows without a value are spared the steps.
    stepped = F.when(v.isNotNull(), F.aggregate(F.array(*back_steps), v, one_step_back))
    hits = hits.withColumn("v", stepped)
    in_idiom = _idiom_value(v, item, b1, b2, b3, n1, n2, booster_of, _lookup_in(idioms))
    hits = hits.withColumn("v", F.when(reaches[3], in_idiom).otherwise(v))

    least = (b1 == "least") & F.col("b1_valence").isNull()
    least = least & ((pos == 1) | ~b2.isin("at", "very"))
    but_at = F.col("but_at")
    skipped = booster_of(item).isNotNull() | ((item == "kind") & (n1 == "of"))
    weight = (
        F.when(F.col("item_valence").isNull() | skipped, 0.0)
        .when((but_at >= 0) & (pos < but_at), BUT_BEFORE)
        .when((but_at >= 0) & (pos > but_at), BUT_AFTER)
        .otherwise(1.0)
    )
    weighted = v * F.when(least, NEGATION_FACTOR).otherwise(1.0) * weight
    return hits.withColumn("v", F.coalesce(weighted, F.lit(0.0)))


def _idiom_value(v, item, b1, b2, b3, n1, n2, booster_of, idiom_of) -> Column:
    """Multi-word expressions around a word: they replace its value; two-word dampeners add."""

    def phrase(*words: Column) -> Column:
        return F.concat_ws(" ", *words)

    three_back, two_first, two_back = phrase(b3, b2, b1), phrase(b3, b2), phrase(b2, b1)
    behind = [idiom_of(p) for p in
              (phrase(b1, item), phrase(b2, b1, item), two_back, three_back, two_first)]
    ahead = [idiom_of(phrase(item, n1, n2)), idiom_of(phrase(item, n1))]
    value = F.coalesce(*ahead, *behind, v)
    for p in (three_back, two_first, two_back):
        value = value + F.coalesce(booster_of(p), F.lit(0.0))
    return value


def sentiment_scores(
    df: DataFrame,
    lexicon: DataFrame,
    id_col: str = "tweet_id",
    text_col: str = "clean_text",
    boosters: Mapping[str, float] = BOOSTERS,
    negations: Sequence[str] = NEGATIONS,
    idioms: Mapping[str, float] = IDIOMS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``id_col``, the columns ``keep`` and the four scores, one row per input row; ``id_col`` must be unique."""
    keep = [c for c in keep if c != id_col]
    rows = word_rows(df, id_col, text_col, keep)
    valued = _valence(rows if keep else rows.drop("kept"), lexicon, boosters, negations, idioms)
    v = F.col("v")
    kept = [F.first("kept", ignorenulls=True).alias("kept")] if keep else []
    sums = valued.groupBy("id").agg(
        *kept,
        F.max("n_words").alias("n_words"),
        F.max("emphasis").alias("emphasis"),
        F.sum("v").alias("total"),
        F.sum(F.when(v > 0, v + 1).otherwise(0.0)).alias("pos_sum"),
        F.sum(F.when(v < 0, 1 - v).otherwise(0.0)).alias("neg_sum"),
        F.sum((v != 0).cast("int")).alias("scored"),
    )
    total, emphasis = F.col("total"), F.col("emphasis")
    pushed = F.when(total > 0, total + emphasis).when(total < 0, total - emphasis).otherwise(F.lit(0.0))
    pos, neg = F.col("pos_sum"), F.col("neg_sum")
    sums = sums.select(
        "id",
        *[F.col("kept")[c].alias(f"_keep_{c}") for c in keep],
        pushed.alias("total"),
        F.when(pos > neg, pos + emphasis).otherwise(pos).alias("pos_sum"),
        F.when(pos < neg, neg + emphasis).otherwise(neg).alias("neg_sum"),
        (F.col("n_words") - F.col("scored")).cast("double").alias("neutral"),
        F.col("n_words"),
    ).withColumn("parts", F.col("pos_sum") + F.col("neg_sum") + F.col("neutral"))

    def share(name: str) -> Column:
        return F.when(F.col("n_words") == 0, F.lit(0.0)).otherwise(
            F.bround(F.col(name) / F.col("parts"), 3)
        )

    total = F.col("total")
    compound = total / F.sqrt(total * total + NORMALIZER)
    return sums.select(
        F.col("id").alias(id_col),
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
        F.bround(F.greatest(F.least(compound, F.lit(1.0)), F.lit(-1.0)), 4).alias("vader_compound"),
        share("pos_sum").alias("vader_pos"),
        share("neg_sum").alias("vader_neg"),
        share("neutral").alias("vader_neu"),
    )


def label(compound: Column) -> Column:
    return (
        F.when(compound >= POSITIVE_FROM, "positive")
        .when(compound <= NEGATIVE_TO, "negative")
        .otherwise("neutral")
    )


def with_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    id_col: str = "tweet_id",
    text_col: str = "clean_text",
    keep: Sequence[str] | None = None,
    **lists,
) -> DataFrame:
    """The columns ``keep`` (all by default) plus the four scores and the label."""
    keep = list(df.columns if keep is None else keep)
    scores = sentiment_scores(df, lexicon, id_col, text_col, keep=keep, **lists)
    return scores.withColumn("sentiment", label(F.col("vader_compound")))
