"""The corpus pipeline and the registered queries on small tables."""

from __future__ import annotations

import brute
import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from barlake.llm import line_dedup, quality_rules, queries, sentencepiece_fst
from barlake.llm.near_dup import keep_one  # noqa: F401

ROWS, PASSAGE, _ = brute.corpus(seed=9, n=80)
LABELS = [(i, int(i % 7 > 0), 0) for i, _ in ROWS[:70]]
ITEMS = [(1, PASSAGE), (2, "words that no document holds at all in this order")]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in ROWS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def plain_pipeline():
    """id -> token ids, stage by stage with the plain versions."""
    import sentencepiece

    good = {i for i, q, _ in LABELS if q}
    scores = brute.quality_scores(ROWS, good, quality_rules.BUCKETS, quality_rules.ALPHA)
    rows = []
    for (i, t), s in zip(ROWS, scores, strict=True):
        n, *_, repeated = brute.base_quality(t)
        if n >= 10 and 100 * repeated <= 20 * n and s >= quality_rules.THRESHOLD:
            rows.append((i, t))
    cut = brute.line_dedup(rows)
    rows = [(i, cut[i][2]) for i, _ in rows]
    group = brute.near_groups(rows)
    rows = [(i, t) for i, t in rows if group[i][0] == i]
    found = {i for i, _ in brute.contained(rows, ITEMS)}
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.DEFAULT_MODEL)
    return {i: lib.encode(t) for i, t in rows if i not in found}


def test_pipeline_is_the_plain_one(spark, sf):
    want = plain_pipeline()
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want and 20 < len(want) < len(ROWS) - 20


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
    lines = corpus_pipeline.stage_line_dedup(spark, docs, sf).collect()
    assert all(r.n_chars == len(r.text or "") for r in lines)
    assert sum(r["__n_dropped"] for r in line_dedup.dedup_lines(docs).collect()) > 0


def test_stages_take_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


#: Queries whose rows are not documents; tests/llm/test_mining.py has their own tests.
NOT_BY_DOCUMENT = {"op11_vector_codes", "op12_collocations"}


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - NOT_BY_DOCUMENT))
def test_queries_cover_every_document(spark, sf, name):
    out = __spark_entry__.queries()[name](spark, sf)
    rows = out.collect()
    ids = {r.doc_id for r in rows}
    assert ids <= {i for i, _ in ROWS} and (name == "op7_decontaminate" or len(rows) == len(ROWS) == len(ids))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_gives_the_same_rows(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet/*.parquet'")
    if name == "op11_vector_codes":
        vectors = [(i, [((i * 7 + k * 13) % 31 - 15) / 16 for k in range(16)], i % 3 or None) for i in range(60)]
        spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{sf}/embeddings.parquet")
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet/*.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    got = __spark_entry__.queries()[name](spark, sf).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
