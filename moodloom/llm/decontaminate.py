"""Benchmark decontamination by a prefix-filtered join.

An item's window is ``WINDOW`` consecutive words of it (an item with fewer words is one window).
A window occurs in a document only if all its words do, so one word is a sufficient prefix.
Words are ordered by rarity: the corpus frequency of the benchmark's words is counted,
and each window is known by its rarest word and that word's offset. Document words are joined
with these words only. A match says where the window would start; length and
position bounds drop starts outside the document. What is left is verified twice: by
a hash of the document's words there, and then word by word.

All steps are DataFrame functions. Texts are shuffled once, for the verification. The benchmark's
words and windows are broadcast while they are few (counted first), else joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import ascii_lower
from moodloom.session import materialize

WINDOW = 13
SHARE = 20  # contaminated: a 20th of the words are hit
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 200_000


def _parts(text: Column) -> Column:
    """The words, with an empty string before or after them where the text begins or ends with a break."""
    return F.split(ascii_lower(text), BREAKS)


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_windows(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id") -> DataFrame:
    """(window_id, words, items): the distinct windows and the items they come from."""
    words = F.filter(_parts(F.col("text")), lambda w: w != "")
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words.alias("words"))
    n = F.size("words")
    many = F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.slice(F.col("words"), i, F.lit(window)))
    cut = F.when(n >= window, many).when(n > 0, F.array("words"))
    rows = items.select("item", F.explode(cut).alias("words"))
    distinct = rows.groupBy("words").agg(F.collect_set("item").alias("items"))
    return materialize(distinct.withColumn("window_id", F.monotonically_increasing_id()), "windows")


def window_prefixes(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(word, window_id, at, len, hash): each window's rarest word in the corpus and its offset.

    Windows with a word that no document has are left out: they occur nowhere.
    """
    members = windows.select("window_id", "words", F.posexplode("words").alias("at", "word"))
    vocabulary = _bounded(materialize(members.select("word").distinct(), "vocabulary"))
    seen = docs.select(F.explode(_parts(F.col("text"))).alias("word"))
    counts = materialize(seen.join(vocabulary, "word").groupBy("word").agg(F.count("*").alias("n")), "frequency")
    ranked = members.join(counts, "word", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("rarest")
    )
    sizes = windows.select("window_id", F.size("words").alias("len"), F.xxhash64("words").alias("hash"))
    found = ranked.where("rarest.n > 0").join(sizes, "window_id")
    return materialize(found.select("rarest.word", "rarest.at", "window_id", "len", "hash"), "prefixes")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: int = SHARE,
    id_col: str = "doc_id",
    item_col: str = "item_id",
) -> DataFrame:
    """(id, ver, n_words, n_hit, n_items, items_sha256, contaminated), a row per row of ``docs``.

    A word inside any occurrence of a window is hit. Contaminated: some word is hit, and
    ``share`` times the hit words are the document's words at least. ``ver`` is a hash of the text
    that tells apart rows with one id. Null and empty texts have no words; null items none
    either. Repeated rows are judged alike and all returned; a null id is an id like another; a null
    item id hits words but is no item. Empty tables give no row, or documents without hits.
    Other columns of either table are ignored.
    """
    windows = item_windows(benchmark, window, item_col)
    prefixes = window_prefixes(docs, windows)
    texts = docs.select(F.col(id_col).alias("doc"), "text")
    places = texts.select("doc", _parts(F.col("text")).alias("parts")).select(
        "doc", F.size("parts").alias("size"), F.posexplode("parts").alias("pos", "word")
    )
    # Few distinct words first: a window's words repeat, and the wide rows come second.
    marked = places.join(_bounded(prefixes.select("word").distinct()), "word")
    start = (F.col("pos") - F.col("at")).alias("start")
    starts = marked.join(_bounded(prefixes), "word").select("doc", "size", start, "len", "hash", "window_id")
    inside = starts.where("start >= 0 and start + len <= size").drop("size")
    cands = inside.groupBy("doc").agg(F.collect_set(F.struct("start", "len", "hash", "window_id")).alias("cands"))
    cands = cands.withColumnRenamed("doc", "cand_doc")

    read = texts.join(cands, F.col("doc").eqNullSafe(F.col("cand_doc")), "left").select(
        "doc", F.xxhash64("text").alias("ver"), _parts(F.col("text")).alias("parts"), "cands"
    )
    edge = lambda i: F.when(F.element_at("parts", i) == "", 1).otherwise(0)
    spare = F.when(F.size("parts") > 1, edge(1) + edge(-1)).otherwise(edge(1))
    same = lambda c: F.xxhash64(F.slice(F.col("parts"), c["start"] + 1, c["len"])) == c["hash"]
    hits = F.transform(
        F.filter("cands", same),
        lambda c: F.struct(
            c["start"].alias("start"),
            c["window_id"].alias("window_id"),
            F.slice(F.col("parts"), c["start"] + 1, c["len"]).alias("found"),
        ),
    )
    n_words = F.when(F.col("parts").isNull(), 0).otherwise(F.size("parts") - spare).cast("long")
    read = materialize(read.select("doc", "ver", n_words.alias("n_words"), hits.alias("hits")), "hits")

    # A repeated row would bring the same hits again.
    once = read.where(F.size("hits") > 0).dropDuplicates(["doc", "ver"])
    verified = (
        once.select("doc", "ver", F.explode("hits").alias("hit"))
        .select("doc", "ver", "hit.*")
        .join(windows, "window_id")
        .where(F.col("found") == F.col("words"))
    )
    covered = F.flatten(F.collect_list(F.sequence(F.col("start"), F.col("start") + F.size("words") - 1)))
    totals = verified.groupBy("doc", "ver").agg(
        F.size(F.array_distinct(covered)).cast("long").alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    totals = totals.select(F.col("doc").alias("d"), F.col("ver").alias("v"), "hit", "items")
    result = read.join(
        totals, F.col("doc").eqNullSafe(F.col("d")) & F.col("ver").eqNullSafe(F.col("v")), "left"
    )
    n_hit, items = F.coalesce("hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return result.select(
        F.col("doc").alias(id_col),
        "ver",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
