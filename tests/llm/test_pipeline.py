import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from check import compare, connect
from moodloom.llm import language_id, oracles, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, connect(SF), entry.oracle_sql()[name]).startswith("ok")


def test_registered_names():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "sentence_pieces"]


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_equal_brute_force(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(90_001, None, "en", "s", 0), (90_002, "12 !", "en", "s", 4), (90_003, "", None, "s", 0)], source.schema)
    docs = cp.materialize(source.unionByName(extra), "documents")

    model = language_id.fit(docs.where(language_id.F.crc32(language_id.F.col("doc_id").cast("string")) % 5 != 0))
    judged = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()}
    first = cp.materialize(cp.identify_language(spark, docs, SF), "language")
    kept = {d: t for d, t in texts(docs).items() if judged[d][0] != "und" and judged[d][1] >= cp.MIN_SCORE}
    assert texts(first) == kept and set(texts(docs)) - set(kept) == {90_001, 90_002, 90_003}

    second = cp.materialize(cp.dedup_lines(spark, first, SF), "lines")
    gone = brute.repeated_lines(kept, 50)
    cut = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ())) for d, t in kept.items()}
    cut = {d: t for d, t in cut.items() if d not in gone or t.strip()}
    assert texts(second) == cut and len(cut) < len(kept)
    assert second.where("n_chars <> length(text) and n_chars <> octet_length(text)").count() <= first.where(
        "n_chars <> length(text) and n_chars <> octet_length(text)"
    ).count()

    third = cp.materialize(cp.drop_near_copies(spark, second, SF), "copies")
    single = {d: cut[d] for d, (_, component) in brute.jaccard(cut).items() if component == d}
    assert texts(third) == single

    fourth = cp.materialize(cp.drop_contaminated(spark, third, SF), "contaminated")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d: single[d] for d, r in brute.contaminated(single, items).items() if not r[3]}
    assert texts(fourth) == clean and len(clean) < len(single)
    assert fourth.columns == docs.columns

    last = {r.doc_id: r for r in cp.encode_pieces(spark, fourth, SF).collect()}
    assert {d: r.decoded for d, r in last.items()} == clean
    assert all(r.n_pieces == len(r.ids) > 0 for r in last.values())


def test_run_returns_the_last_stage(spark):
    got = cp.run(spark, SF)
    assert got.columns == ["doc_id", "n_pieces", "score", "ids", "others", "decoded"]
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0.5 * n < got.count() < n
