import pytest
from pyspark.sql import functions as F

from moodloom.llm import sharding

NAMES = ["a", "b", "c"]


def by_turns(names, size):
    """Every shard's whole preference order first, then turns."""
    orders = []
    for name in names:
        first = sharding._number(f"offset:{name}") % size
        skip = sharding._number(f"skip:{name}") % (size - 1) + 1
        orders.append([(first + j * skip) % size for j in range(size)])
    owner = {}
    while len(owner) < size:
        for i, order in enumerate(orders):
            free = [s for s in order if s not in owner]
            if free:
                owner[free[0]] = i
    return [owner[s] for s in range(size)]


@pytest.mark.parametrize("size", [3, 5, 31, 97])
def test_table_is_filled_by_turns(size):
    assert sharding.lookup_table(NAMES, size) == by_turns(NAMES, size)


def test_shares_are_even_and_few_slots_move():
    names = [f"s{i}" for i in range(10)]
    before, after = sharding.lookup_table(names, 4093), sharding.lookup_table(names[:-1], 4093)
    assert max(before.count(i) for i in range(10)) - min(before.count(i) for i in range(10)) <= 1
    moved = sum(x != y for x, y in zip(before, after) if x != 9)
    assert moved < 0.1 * 4093


@pytest.mark.parametrize("names, size", [([], 5), (["a", "a"], 5), (["a"], 4), (["a", "b", "c"], 2), (["a"], 1_000_033)])
def test_bad_tables_are_refused(names, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(names, size)


def test_place_rows(spark):
    rows = [(1, "x", 9, "old"), (2, None, 9, "old"), (3, "", 9, "old"), (4, "x", 9, "old"), (4, "x", 9, "old"), (5, "y" * 100_000, 9, "o")]
    df = spark.createDataFrame(rows, "id int, key string, slot int, shard string")
    got = sharding.place(df, "key", NAMES, 31).collect()
    assert len(got) == 6
    by_id = {r.id: (r.slot, r.shard) for r in got}
    table = sharding.lookup_table(NAMES, 31)
    assert by_id[2] == by_id[3] and by_id[1] == by_id[4]
    assert all(NAMES[table[slot]] == shard for slot, shard in by_id.values())
    assert sharding.place(df.limit(0), "key", NAMES, 31).count() == 0


def test_hot_key_spreads(spark):
    df = spark.range(1000).withColumn("key", F.lit("hot"))
    slots = sharding.place(df, "key", NAMES, 31, spread_by="id", spread=8).select("slot").distinct().count()
    assert 3 <= slots <= 8
    assert sharding.place(df, "key", NAMES, 31).select("slot").distinct().count() == 1


def test_write_shards(spark, tmp_path):
    path = str(tmp_path / "out")
    sharding.write_shards(sharding.place(spark.range(50), "id", NAMES, 31), path)
    back = spark.read.parquet(path)
    assert back.count() == 50 and {r.shard for r in back.select("shard").distinct().collect()} <= set(NAMES)
