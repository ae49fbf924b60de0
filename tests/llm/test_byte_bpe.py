import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from moodloom.llm import byte_bpe, queries
from moodloom.llm.spans import Buffer, same_bytes, xxhash64

SF = "/root/testdata/sf0.001"
LETTERS = "abAB '  \n\t\u0085　 é漢字🙂١²½'s're'llİſK‍́--==00"
ODD = [
    "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])),
    "a" * 100_000, "-" * 50_000, "ab" * 30_000, " " * 30_000, " " * 30_000 + "x", "漢" * 20_000, "\n" * 999, "",
    "'s 'S 're <|endoftext|> \u0000", "x",
]


@pytest.fixture(scope="module")
def tokens():
    return byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def tokenizer(tokens):
    return byte_bpe.build(tokens, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(tokens):
    ranks = {t: i for i, t in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_hash_of_spans_equals_the_library():
    import xxhash

    rng = random.Random(3)
    spans = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(40), *range(40), 100, 1000]]
    size = np.array([len(s) for s in spans])
    start = np.cumsum(size) - size
    buffer = Buffer(b"".join(spans))
    assert xxhash64(buffer, start, size).tolist() == [xxhash.xxh64_intdigest(s) for s in spans]
    other = np.arange(len(spans)) ^ 1
    fits = np.flatnonzero(size == size[other])
    same = same_bytes(buffer, start[fits], buffer, start[other[fits]], size[fits])
    assert same.tolist() == [spans[i] == spans[i ^ 1] for i in fits.tolist()]


def test_perfect_hash_is_minimal(tokens, tokenizer):
    own = tokenizer.hash
    size = np.array([len(t) for t in tokens])
    found = own.find(Buffer(b"".join(tokens)), np.cumsum(size) - size, size)
    assert found.tolist() == list(range(len(tokens)))
    assert sorted(own.key.tolist()) == list(range(len(tokens))) == list(range(own.n))
    known = set(tokens)
    others = [t + b"q" for t in tokens if t + b"q" not in known] + [b"", b"\x00" * 500]
    size = np.array([len(t) for t in others])
    assert (own.find(Buffer(b"".join(others)), np.cumsum(size) - size, size) == -1).all()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100])
def test_perfect_hash_of_few_keys(n):
    keys = [str(i).encode() for i in range(n)]
    size = np.array([len(t) for t in keys], np.int64)
    found = byte_bpe.PerfectHash(keys).find(Buffer(b"".join(keys)), np.cumsum(size) - size, size)
    assert found.tolist() == list(range(n))


def test_encoder_equals_the_library(tokenizer, library):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    encoder = byte_bpe.Encoder(tokenizer)
    ids, counts = encoder.encode(texts)
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [library.encode_ordinary(t) for t in texts]


def test_long_pre_tokens_take_no_square_time(tokens):
    merger = byte_bpe.Merger(tokens)
    rng = random.Random(2)
    for piece in [b"a" * 200_000, b"ab" * 100_000, bytes(rng.choice(b"abcdefgh") for _ in range(200_000))]:
        began = time.process_time()
        assert b"".join(tokens[i] for i in merger(piece)) == piece
        assert time.process_time() - began < 5


def test_remembered_pieces_are_bounded(tokenizer, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 2)
    encoder = byte_bpe.Encoder(tokenizer)
    text = "thanonont oftionnten athawh thonre thanonont " + "zq" * 100
    ids, _ = encoder.encode([text])
    assert ids.tolist() == library.encode_ordinary(text) and len(encoder.known) <= 2


def test_nulls_repeated_rows_and_clashing_names(spark, tokenizer, library):
    texts = [None, "", "tick tock", "tick tock", *ODD[1:]]
    rows = [(i // 2, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int").repartition(3)
    encoded = byte_bpe.encode(docs, tokenizer, columns=("ids", "packed", "decoded"))
    assert encoded.columns == ["doc_id", "n_tokens", "ids", "packed", "decoded"]
    got = encoded.collect()
    expected = sorted((i, t or "", library.encode_ordinary(t or "")) for i, t, _, _ in rows)
    assert sorted((r.doc_id, bytes(r.decoded).decode(), r.ids) for r in got) == expected
    assert all(r.n_tokens == len(r.ids) and np.frombuffer(r.packed, "<u4").tolist() == r.ids for r in got)
    assert byte_bpe.encode(docs.limit(0), tokenizer).count() == 0
    named = spark.createDataFrame([(None, "a b")], "`my id` string, text string")
    assert byte_bpe.encode(named, tokenizer, id_col="my id").collect()[0].ids == library.encode_ordinary("a b")


def test_decode_odd_ids(spark, tokenizer):
    rows = [(None, "x"), ([], "x"), ([-1, 99_999_999, None, 0], "x")]
    df = spark.createDataFrame(rows, "ids array<int>, decoded string")
    assert [r.decoded for r in byte_bpe.decode(df, tokenizer).collect()] == [None, b"", tokenizer.tokens[0]]


def test_decode_gives_the_texts_back(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    back = byte_bpe.decode(byte_bpe.encode(docs, tokenizer), tokenizer)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == texts


def test_ranks_must_be_whole(tmp_path):
    (tmp_path / "ranks").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        byte_bpe.load_ranks(str(tmp_path / "ranks"))


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = {}
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected[r.doc_id] = (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()
        )
    got = queries.op12_byte_bpe(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == expected
