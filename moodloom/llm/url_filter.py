"""URL filters: rules on host and path, then a list of URLs behind a blocked Bloom filter.

The Bloom filter of the listed canonical URLs is an array of 256-bit blocks, a table of at
most ``MAX_BLOCKS`` rows, so its broadcast has a fixed bound. A URL sets its bits in one
block only. Pages whose bits are all set are possible hits; an exact hash join
with the list removes the false ones. All other pages never leave their partition. A longer
list than the bound was made for fills the blocks and lets more false hits through to
the exact join; the verdicts stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import UPPER

# Fixed values: (host, path, verdict); the longest fitting rule decides.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Query parameters that do not change the page.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"
MAX_BLOCKS = 1 << 16
URLS_PER_BLOCK = 20
WORDS = 4
BITS = 8
SALTS = 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are '' for a null url or one without '://'."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def canonical(url: Column) -> Column:
    """Host without 'www.' and ports 80 and 443, path without '.html' and last slashes, and the
    sorted query without tracking parameters. Null if there is no host."""
    host, path = host_and_path(url)
    bare = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    trimmed = F.regexp_replace(F.regexp_replace(path, r"\.html?$", ""), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(bare != "", F.concat(bare, trimmed, tail))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits the host or a parent domain, and its verdict; else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return name, verdict


def _bit(key: Column, i: int) -> Column:
    """Number, 0 to 255, of the i-th bit of a URL: eight bits of a second hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("bits"), key), 8 * i).bitwiseAND(F.lit(255))


def _words(key: Column) -> list[Column]:
    """The block's words with only this URL's bits set."""
    words = []
    for w in range(WORDS):
        word = F.lit(0).cast("long")
        for i in range(BITS):
            bit = _bit(key, i)
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
            word = word.bitwiseOR(F.when(F.shiftright(bit, 6) == w, mask).otherwise(F.lit(0)))
        words.append(word)
    return words


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as rows (block, word0, ..): at most ``blocks`` of them."""
    named = listed.select(
        _block(F.col(key), blocks).alias("block"),
        *[w.alias(f"word{i}") for i, w in enumerate(_words(F.col(key)))],
    )
    return named.groupBy("block").agg(*[F.bit_or(f"word{i}").alias(f"word{i}") for i in range(WORDS)])


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules=RULES,
    list_verdict: str = "block",
    default: str = "allow",
    id_col: str = "page_id",
) -> DataFrame:
    """(id, host, path, rule, verdict, listed) for each page.

    ``listed`` has a column ``url``; it may hold nulls, repeats and any spelling of a URL.
    A rule decides first. Otherwise a page whose canonical URL is listed gets
    ``list_verdict`` and any other, also one without a host, ``default``. Repeated pages are
    judged one by one; other columns of either table are ignored; an empty list or table works.
    """
    host, path = host_and_path(F.col("url"))
    base = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), canonical(F.col("url")).alias("_key"))
    name, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    base = base.select("*", name.alias("rule"), verdict.alias("_said"))
    keys = listed.select(canonical(F.col("url")).alias("_key")).where("_key is not null").distinct()
    blocks = max(1, min(MAX_BLOCKS, keys.count() // URLS_PER_BLOCK + 1))
    bloom = F.broadcast(bloom_blocks(keys, "_key", blocks))
    probe = base.withColumn("block", F.when(F.col("rule").isNull(), _block(F.col("_key"), blocks)))
    # Pages with a rule have a null block, which no block equals.
    joined = probe.join(bloom, "block", "left")
    hit = F.col("word0").isNotNull()
    for i, word in enumerate(_words(F.col("_key"))):
        hit = hit & (F.col(f"word{i}").bitwiseAND(word) == word)
    judged = joined.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    columns = [F.col(id_col), F.col("host"), F.col("path"), F.col("rule")]
    sure = judged.where(~F.col("_hit")).select(
        *columns, F.coalesce("_said", F.lit(default)).alias("verdict"), F.lit(False).alias("listed")
    )
    # One URL can be a third of all pages: its hits are dealt over salts, the list's URLs repeated.
    salted = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn(
        "listed", F.lit(True)
    )
    exact = (
        judged.where("_hit")
        .withColumn("_salt", F.pmod(F.xxhash64(F.col(id_col), F.col("path")), F.lit(SALTS)).cast("int"))
        .join(salted, ["_key", "_salt"], "left")
        .withColumn("listed", F.coalesce("listed", F.lit(False)))
        .select(
            *columns,
            F.when(F.col("listed"), F.lit(list_verdict)).otherwise(F.lit(default)).alias("verdict"),
            "listed",
        )
    )
    return sure.unionByName(exact)
