"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections.

1. One pass over the texts gives each document's set of word shingles as sorted 64-bit hashes, of
   which only a summary is kept: the size, a 128-bit hash of the set, a bitmap of the
   shingles and ``TOKENS`` minima of the set under as many permutations of the hashes. Documents
   with equal sets form a class and go on as one.
2. Classes that share a minimum meet in a tile. A tile of more than ``TILE`` classes is
   dealt by size bands, of which only equal and adjacent ones can hold a pair, and then by
   pairs of chunks, so no task holds more than two chunks. In a tile the bits in which
   two bitmaps differ bound the overlap from above:
   |A & B| <= (|A| + |B| - differing bits) / 2. Pairs that fail are dropped unseen.
3. Of the pairs that pass, each tile first names a spanning forest of stars around documents in random
   order, other ones in each tile, and only these pairs are verified, by intersecting the sorted
   arrays. A group of n near copies thus costs some n checks, not n^2. Components of the true links
   are formed, and tiles that still hold several components get the arrays themselves: every
   passing pair between two components is verified there, in the first of its tiles, and only
   links leave the tile. So any linked pair is verified or already in one component.

A pair at the similarity s shares no minimum with probability (1 - s)^TOKENS: 1e-14 at 0.8, which
takes the place of a hash collision's. No tile, partner or candidate is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.llm.components import components
from moodloom.session import materialize

WORDS = 5
TOKENS = 20
TILE = 4_096
GROUP = 512  # partners of one document that a task verifies
FIRST_TOKENS = 2  # minima whose forests are verified first
REMEMBERED = 200_000
BROADCAST_ROWS = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(7)
_PLACE = _random.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PERMUTE = _random.integers(0, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles; word hashes are remembered."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        # bytes.lower and bytes.split know ASCII only: A-Z, and the six white-space bytes.
        parts = text.encode().lower().split()
        hashes = []
        for part in parts:
            found = known.get(part)
            if found is None:
                found = known[part] = xxhash.xxh3_64_intdigest(part)
            hashes.append(found)
        h = np.array(hashes, dtype=np.uint64)
        if not len(h):
            return h
        span = min(self.words, len(h))
        total = np.full(len(h) - span + 1, span, np.uint64)
        for k in range(span):
            total += _mixed(h[k : len(h) - span + 1 + k] * _PLACE[k])
        return np.unique(_mixed(total))


def bitmap(shingles: np.ndarray) -> bytes:
    """Bits of the hashes modulo a power of two, from two to four times the size of the set."""
    size = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    at = (shingles >> np.uint64(20)) & np.uint64(size - 1)
    flags = np.zeros(size, np.uint8)
    flags[at.astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def signatures(docs: DataFrame, id_col: str, words: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in (b.slice(low, 1000) for b in batches for low in range(0, b.num_rows, 1000)):
            rows = []
            for text in batch.column(1):
                s = shingle(text.as_py())
                if len(s):
                    name = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist()
                    rows.append((len(s), *name, bitmap(s), minima(s).tolist()))
                else:
                    rows.append((0, None, None, None, None))
            n, hi, lo, bits, tokens = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(hi, pa.int64()),
                    pa.array(lo, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.array(tokens, pa.list_(pa.int64())),
                ],
                names=["doc", "n", "hi", "lo", "bits", "tokens"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc {id_type}, n bigint, hi bigint, lo bigint, bits binary, tokens array<bigint>"
    return docs.select(F.col(id_col).alias("doc"), "text").mapInArrow(sign, schema)


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of sorted batches, those with equal first columns together."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    for _, group in groupby(rows, key=itemgetter(*range(keys))):
        yield list(group)


class Tile:
    """Rows sorted by size with their bitmaps, for the overlap bound."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[bytes], num: int, den: int):
        self.sizes, self.num, self.den = sizes, num, den
        width = np.array([len(b) for b in bitmaps])
        # Bitmaps grow with the size, so rows of one width are neighbours. A partner is at most den / num
        # times as large, and its bitmap as wide or twice as wide; folding halves a bitmap.
        self.runs = {}
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            bits = np.frombuffer(b"".join(bitmaps[i] for i in own), np.uint64).reshape(len(own), -1)
            half = bits.reshape(len(own), 2, -1) if w > 8 else None
            self.runs[w] = (int(own[0]), bits, None if half is None else half[:, 0] | half[:, 1])
        self.width = width

    def partners(self, i: int, among: np.ndarray) -> np.ndarray:
        """Of the rows ``among``, sorted, those whose overlap bound with row i reaches the similarity."""
        sizes, num, den = self.sizes, self.num, self.den
        low, high = np.searchsorted(sizes[among], [-(-sizes[i] * num // den), sizes[i] * den // num + 1])
        among = among[low:high]
        found = []
        w = int(self.width[i])
        for other in np.unique(self.width[among]).tolist():
            rows = among[self.width[among] == other]
            start, bits, folded = self.runs[other]
            own_start, own_bits, own_folded = self.runs[w]
            at, own = rows - start, i - own_start
            if other == w:
                differ = bits[at] ^ own_bits[own]
            elif other == 2 * w:
                differ = folded[at] ^ own_bits[own]
            else:
                differ = bits[at] ^ own_folded[own]
            both = sizes[i] + sizes[rows]
            bound = (both - np.bitwise_count(differ).sum(axis=1, dtype=np.int64)) // 2
            found.append(rows[(num + den) * bound >= num * both])
        return np.concatenate(found) if found else among


TILE_KEYS = ["j", "token", "band", "low", "high"]
TILE_COLUMNS = [*TILE_KEYS, "n", "node", "component", "visitor", "chunk"]


def _dealt(tiles: DataFrame, data: str) -> DataFrame:
    rows = tiles.select(*TILE_COLUMNS, data).repartition(*TILE_KEYS)
    return rows.sortWithinPartitions(*TILE_KEYS, "n", "node")


def _open_pairs(label, visits, chunks, split: bool, i: int) -> np.ndarray:
    """Mask of the rows that may pair with row i: of another component, and not met in another tile."""
    among = label != label[i]
    if visits[i]:
        among &= ~visits
    if split:
        among &= chunks != chunks[i]
    return among


def tile_forests(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """(j, a, b): a spanning forest of each tile's passing pairs between components, of stars in random order."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for rows in _grouped(batches, 5):
            if len(rows) < 2:
                continue
            j, token, _, low, high = rows[0][:5]
            n, node, component, visitor, chunk, bits = zip(*[r[5:] for r in rows])
            label = np.unique(np.array(component), return_inverse=True)[1]
            if label.max() == 0:
                continue
            visits, chunks = np.array(visitor), np.array(chunk)
            tile = Tile(np.array(n, np.int64), list(bits), num, den)
            for i in np.random.default_rng(abs(token) + j).permutation(len(rows)).tolist():
                among = _open_pairs(label, visits, chunks, low != high, i)
                for p in tile.partners(i, np.flatnonzero(among)).tolist():
                    if label[p] != label[i]:
                        found.append((j, node[i], node[p]))
                        label[label == label[p]] = label[i]
                if label[0] == label[-1] and (label == label[0]).all():
                    break
            if len(found) > 10_000:
                yield _rows(found)
                found = []
        yield _rows(found)

    def _rows(found: list[tuple]) -> pa.RecordBatch:
        j, a, b = zip(*found) if found else ([],) * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(j, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["j", "a", "b"]
        )

    return _dealt(tiles, "bits").mapInArrow(pairs, "j int, a bigint, b bigint")


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least hash of the set under each permutation."""
    return (shingles[None, :] * _PERMUTE[:, None]).min(axis=1).view(np.int64)


def tile_links(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): the links between components in each tile, verified on the rows' ``shingles``."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for rows in _grouped(batches, 5):
            j, _, _, low, high = rows[0][:5]
            n, node, component, visitor, chunk, data = zip(*[r[5:] for r in rows])
            label = np.unique(np.array(component), return_inverse=True)[1]
            if label.max() == 0:
                continue
            visits, chunks = np.array(visitor), np.array(chunk)
            sets = [np.frombuffer(d, np.uint64) for d in data]
            least = np.stack([minima(s) for s in sets])
            tile = Tile(np.array(n, np.int64), [bitmap(s) for s in sets], num, den)
            for i in range(len(rows)):
                among = _open_pairs(label, visits, chunks, low != high, i)
                among[: i + 1] = False
                # A pair that met in a tile before was verified there.
                among[among] = ~(least[among, :j] == least[i, :j]).any(axis=1)
                for p in tile.partners(i, np.flatnonzero(among)).tolist():
                    common = len(np.intersect1d(sets[i], sets[p], assume_unique=True))
                    if label[p] != label[i] and (num + den) * common >= num * (n[i] + n[p]):
                        a.append(node[i])
                        b.append(node[p])
                        label[label == label[p]] = label[i]
        # A forest at most for each tile.
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _dealt(tiles, "shingles").mapInArrow(links, "a bigint, b bigint")


def deal_tiles(members: DataFrame, num: int, den: int) -> DataFrame:
    """Tile rows of (j, token, size, ...): small tiles whole, large ones by size band and pair of chunks."""
    base = [c for c in members.columns if c != "size"]
    small = members.where(F.col("size") <= TILE).select(
        *base,
        F.lit(-1).alias("band"),
        F.lit(0).alias("low"),
        F.lit(0).alias("high"),
        F.lit(False).alias("visitor"),
        F.lit(0).alias("chunk"),
    )
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num)) + 1e-9).cast("int")
    roles = F.array(
        F.struct(band.alias("band"), F.lit(False).alias("visitor")),
        F.struct((band - 1).alias("band"), F.lit(True).alias("visitor")),
    )
    large = members.where(F.col("size") > TILE).select(*base, F.explode(roles).alias("role")).select(*base, "role.*")
    pool = ["j", "token", "band"]
    split = large.groupBy(*pool).agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    large = large.join(split, pool).withColumn("chunk", chunk)
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return small.unionByName(
        large.select(
            *base, "band", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
            "visitor", "chunk",
        )
    )


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose exact similarity is num / den at least; ``sets`` has (node, shingles)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivots = None, []
        for batch in batches:
            a_found, b_found = [], []
            for a, part, b, data in zip(*[c.to_pylist() for c in batch.columns]):
                own = np.frombuffer(data, np.uint64)
                if (a, part) != key:
                    key, pivots = (a, part), []
                if b is None:
                    pivots.append(own)
                    continue
                for pivot in pivots:
                    common = len(np.intersect1d(pivot, own, assume_unique=True))
                    if (num + den) * common >= num * (len(pivot) + len(own)):
                        a_found.append(a)
                        b_found.append(b)
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array(a_found, pa.int64()), pa.array(b_found, pa.int64())], names=["a", "b"]
            )

    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    dealt = pairs.join(counts, "a").select("a", part.alias("part"), "b")
    partners = dealt.join(sets.select(F.col("node").alias("b"), "shingles"), "b").select("a", "part", "b", "shingles")
    pivots = counts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    pivots = pivots.join(sets.select(F.col("node").alias("a"), "shingles"), "a").select(
        "a", F.col("part").cast("int").alias("part"), F.lit(None).cast("long").alias("b"), "shingles"
    )
    rows = partners.unionByName(pivots).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return rows.mapInArrow(check, "a bigint, b bigint")


def shingle_sets(docs: DataFrame, nodes: DataFrame, id_col: str, words: int) -> DataFrame:
    """(node, hi, shingles) of the documents named in ``nodes``: the sorted hashes as bytes, and half their own hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                data = [shingle(t.as_py()).tobytes() for t in part.column(1)]
                names = [int(np.frombuffer(xxhash.xxh3_128_digest(d), np.int64)[0]) for d in data]
                columns = [part.column(0), pa.array(names, pa.int64()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "hi", "shingles"])

    # While they are few, the ids go to the texts, else both are shuffled.
    few = F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes
    texts = docs.select(F.col(id_col).cast("long").alias("node"), "text").join(few, "node", "left_semi")
    return texts.mapInArrow(cut, "node bigint, hi bigint, shingles binary")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", words: int = WORDS, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id) for each row: the smallest id reachable by links.

    Two documents link when 100 * |A & B| >= percent * |A | B| over their sets of ``words``-word
    shingles (A-Z lower-cased, split at white space; with fewer words, the whole sequence
    is one shingle). Null, empty and blank texts have an empty set and link with nothing. Ids
    are integers. Rows with one id are one document with all their links; rows with a null id
    link with nothing and get a null component. Other columns are ignored; an empty
    table gives an empty result.
    """
    num, den = percent, 100
    signed = materialize(signatures(docs, id_col, words), "signatures")
    usable = signed.where("n > 0 and doc is not null").withColumn("doc", F.col("doc").cast("long"))
    classes = usable.groupBy("hi", "lo").agg(
        F.min("doc").alias("node"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("tokens").alias("tokens")
    )
    classes = materialize(classes, "classes")
    met = classes.select("node", "hi", F.posexplode("tokens").alias("j", "token"))
    shared = met.groupBy("j", "token").agg(F.count("*").alias("size")).where("size > 1")
    # Most minima are met once; the bitmaps go to what is left.
    members = met.join(shared.hint("merge"), ["j", "token"]).join(
        classes.select("node", "hi", "n", "bits"), ["node", "hi"]
    )
    members = materialize(members, "members")

    tiles = deal_tiles(members.withColumn("component", F.col("node")), num, den)
    forest = materialize(tile_forests(tiles, num, den).groupBy("a", "b").agg(F.min("j").alias("j")), "forest")
    nodes = materialize(forest.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    sets = materialize(shingle_sets(docs, nodes, id_col, words), "sets")

    links = materialize(verify(forest.where(F.col("j") < FIRST_TOKENS).select("a", "b"), sets, num, den), "links")
    found = components(links)
    rest = forest.where(F.col("j") >= FIRST_TOKENS).select("a", "b")
    links = materialize(verify(between(rest, found), sets, num, den), "links")
    found = components(links.unionByName(_stars(found)))

    # What the forests left open: tiles that hold several components.
    narrow = members.select("j", "token", "size", "node", "hi", "n").join(nodes, "node", "left_semi")
    placed = narrow.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("j", "token").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    mixed = mixed.where("x <> y").select("j", "token")
    open_tiles = deal_tiles(placed.join(mixed, ["j", "token"]), num, den).join(
        sets.dropDuplicates(["node", "hi"]), ["node", "hi"]
    )
    links = materialize(tile_links(open_tiles, num, den), "links")
    found = components(links.unionByName(_stars(found)))

    named = classes.select("hi", "lo", "node")
    own = usable.select("doc", "hi", "lo").join(named, ["hi", "lo"]).select(F.col("doc").alias("a"), F.col("node").alias("b"))
    # Several classes can hold one id only if rows repeat it; then the id ties them.
    member = own.join(found.withColumnRenamed("node", "b"), "b", "left").select(
        F.col("a"), F.coalesce("component", "b").alias("component")
    )
    member = member.groupBy("a").agg(F.min("component").alias("component"), F.max("component").alias("most"))
    member = materialize(member, "member")
    twice = member.where("component <> most")
    if not twice.isEmpty():
        found = components(own.unionByName(_stars(found)))
        member = found.select(F.col("node").alias("a"), "component")
    result = signed.join(member.select("a", "component"), F.col("doc").cast("long") == F.col("a"), "left")
    return result.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", F.col("doc").cast("long")).alias("component_id"),
    )


def _stars(found: DataFrame) -> DataFrame:
    """Components as edges, one for each node."""
    return found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def between(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    x = found.select(F.col("node").alias("a"), F.col("component").alias("x"))
    y = found.select(F.col("node").alias("b"), F.col("component").alias("y"))
    joined = pairs.join(x, "a", "left").join(y, "b", "left")
    return joined.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")
