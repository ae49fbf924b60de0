"""Word lists.

The lexicon and the lemma vocabulary are tables, because full ones have many
thousands of rows: ``load_lexicon`` and ``load_words`` read them from files, and
the seeds here are small self-written stand-ins. The short fixed lists of the
scorer are plain Python values and become literals in the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEXICON_SCHEMA = "token string, valence double"

SEED_LEXICON = [
    ("love", 3.2),
    ("good", 1.9),
    ("bad", -2.5),
    ("happy", 2.7),
    ("terrible", -2.1),
    ("okay", 0.9),
    ("great", 3.1),
    ("sad", -2.1),
    ("hate", -2.7),
    ("no", -1.2),
]

# Nouns for the suffix rules, and irregular forms.
SEED_NOUNS = [
    "blockchain", "change", "church", "city", "country", "day", "election", "fox", "game",
    "goal", "government", "half", "house", "match", "man", "market", "news", "policy",
    "report", "wish", "woman", "word", "year",
]
SEED_IRREGULAR = [("children", "child"), ("feet", "foot"), ("mice", "mouse"), ("people", "person")]

# The English list of Spark's StopWordsRemover.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()

# Words the stopword list must not remove.
KEPT_STOPWORDS = ["not", "no", "never", "very", "but"]

# Fixed values of the published sentiment rules (Hutto & Gilbert 2014).
BOOSTER_UP = [
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably",
    "decidedly", "deeply", "effing", "enormous", "enormously", "entirely", "especially",
    "exceptional", "exceptionally", "extreme", "extremely", "fabulously", "flipping", "flippin",
    "frackin", "fracking", "fricking", "frickin", "frigging", "friggin", "fully", "fuckin",
    "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely", "incredible",
    "incredibly", "intensely", "major", "majorly", "more", "most", "particularly", "purely",
    "quite", "really", "remarkably", "so", "substantially", "thoroughly", "total", "totally",
    "tremendous", "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly", "very",
]
BOOSTER_DOWN = [
    "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof", "kind-of", "less",
    "little", "marginal", "marginally", "occasional", "occasionally", "partly", "scarce",
    "scarcely", "slight", "slightly", "somewhat", "sort of", "sorta", "sortof", "sort-of",
]
BOOSTERS = {**dict.fromkeys(BOOSTER_UP, 0.293), **dict.fromkeys(BOOSTER_DOWN, -0.293)}
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't",
    "can't", "couldn't", "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent",
    "isnt", "mightnt", "mustnt", "neither", "don't", "hadn't", "hasn't", "haven't", "isn't",
    "mightn't", "mustn't", "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing",
    "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent", "oughtn't", "shan't",
    "shouldn't", "uh-uh", "wasn't", "weren't", "without", "wont", "wouldnt", "won't", "wouldn't",
    "rarely", "seldom", "despite",
]
IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "badass": 1.5,
    "bus stop": 0.0,
    "yeah right": -2.0,
    "kiss of death": -1.5,
    "to die for": 3.0,
    "beating heart": 3.1,
    "broken heart": -2.9,
}

# A few emoji with their Unicode names, for scoring raw text.
SEED_EMOJI = {
    "😀": "grinning face",
    "😂": "face with tears of joy",
    "😢": "crying face",
    "😡": "pouting face",
    "👍": "thumbs up sign",
}


def _rows(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A short local relation, whose size the optimizer knows."""
    literal = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])
    return spark.range(1).select(F.inline(literal))


def seed_lexicon(spark: SparkSession) -> DataFrame:
    return _rows(spark, SEED_LEXICON, "token", "valence")


def load_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated lexicon file: token, mean valence, then columns that are ignored.

    Tokens stay as written: words are looked up in lower case, so ``:D`` is no ``:d``. Of
    several lines for a token the last one counts.
    """
    rows = spark.read.schema(LEXICON_SCHEMA).csv(path, sep="\t", quote="", mode="PERMISSIVE")
    line = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return (
        rows.select("token", "valence", line.alias("line"))
        .where(F.col("valence").isNotNull())
        .groupBy("token")
        .agg(F.max_by("valence", "line").alias("valence"))
    )


def load_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line."""
    return spark.read.text(path).select(F.trim("value").alias("token")).where("token <> ''")


def seed_nouns(spark: SparkSession) -> DataFrame:
    return _rows(spark, [(w,) for w in SEED_NOUNS], "token")


def seed_irregular(spark: SparkSession) -> DataFrame:
    return _rows(spark, SEED_IRREGULAR, "token", "lemma")


def default_stopwords() -> list[str]:
    return [word for word in ENGLISH_STOPWORDS if word not in KEPT_STOPWORDS]
