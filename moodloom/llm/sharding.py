"""Sharding by a permutation-filled lookup table (Maglev hashing).

Each shard has a preference order over the slots of a prime-sized table. Shards
take turns: in its turn, a shard claims the first slot of its order that is still
free. Rows find their slot by a hash of their key and their shard by one map-side
lookup. When a shard is added or removed, few slots change hands.

The table has ``size`` rows whatever the data, so its broadcast is bounded.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 65_537
MAX_SIZE = 1_000_003
HASH_DIGITS = 15


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:HASH_DIGITS], 16)


def lookup_table(shards: list[str], size: int = SIZE) -> list[int]:
    """The shard index of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct, and there must be one at least")
    if not len(shards) <= size <= MAX_SIZE or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"size must be a prime from the number of shards to {MAX_SIZE}")
    if size == 1:
        return [0]
    slot = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    owner = [-1] * size
    for turn in range(size):
        i = turn % len(shards)
        while owner[slot[i]] >= 0:
            slot[i] = (slot[i] + skip[i]) % size
        owner[slot[i]] = i
    return owner


def key_slot(key: Column, size: int = SIZE) -> Column:
    """Slot of a key by the first hex digits of its md5; a null key counts as ''."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_DIGITS)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size).cast("long")).cast("int")


def place(
    df: DataFrame,
    key: str,
    shards: list[str],
    size: int = SIZE,
    spread_by: str | None = None,
    spread: int = 1,
) -> DataFrame:
    """Every row with its ``slot`` and ``shard``.

    Rows of one key go to one shard. A hot key can be spread: with ``spread_by`` (a
    column that differs within the key) it uses up to ``spread`` slots. Null keys are
    placed like ''; repeated rows stay repeated and share a shard; an empty table gives
    an empty result. Input columns named ``slot`` or ``shard`` are replaced.
    """
    spark: SparkSession = df.sparkSession
    own = F.col(key).cast("string")
    if spread > 1:
        if spread_by is None:
            raise ValueError("spread needs spread_by")
        part = F.pmod(F.xxhash64(F.col(spread_by)), F.lit(spread)).cast("string")
        own = F.concat(F.coalesce(own, F.lit("")), F.lit("#"), part)
    keyed = df.withColumn("slot", key_slot(own, size)).drop("shard")
    rows = [(slot, shards[i]) for slot, i in enumerate(lookup_table(shards, size))]
    table = spark.createDataFrame(rows, "slot int, shard string")
    return keyed.join(F.broadcast(table), "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard. Tasks write what they hold, so a large shard is many files."""
    placed.write.partitionBy("shard").parquet(path)
