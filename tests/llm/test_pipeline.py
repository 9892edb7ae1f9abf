"""The pipeline and the registered queries."""

import collections

import pytest
from llm_cases import DATA
from test_texts import LOWER, near_groups, packed_ok
from tokenizers import Tokenizer

import corpus_pipeline
from plantpulse.llm import pii, quality, queries


def test_pipeline_against_plain_python(spark, vocab_path):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.fit(docs, labels)
    good = {i: t for i, t in rows.items() if model.score(
        __import__("numpy").array([model.ratios(t.encode())]))[0] >= 0.5}
    equal = collections.defaultdict(list)
    for i, t in good.items():
        equal[t.translate(LOWER)].append(i)
    unique = {max(g): good[max(g)] for g in equal.values()}
    kept = {i: unique[i] for i, _, c in near_groups(unique.items()) if i == c}
    final = [(i, pii.replaced(t)[0]) for i, t in kept.items()]
    got = corpus_pipeline.run(spark, DATA).collect()
    assert 0 < len(final) < len(rows)
    assert {r["doc_id"] for r in got} == set(kept)
    packed_ok(got, final, Tokenizer.from_file(vocab_path), 2048)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "jaccard_join", "pii", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).dtypes == docs.dtypes
        assert stage(spark, docs.where("false"), DATA).count() == 0


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_returns_every_row(spark, name):
    out = queries.queries()[name](spark, DATA)
    source = {"op4_html_extraction": "pages", "op8_nearest_neighbours": "embeddings", "op12_vector_codes": "embeddings",
              "op13_conversation_repair": "conversations"}.get(name, "documents")
    given = spark.read.parquet(f"{DATA}/{source}.parquet")
    key = {"pages": "page_id", "documents": "doc_id", "conversations": "conv_id", "embeddings": "vec_id"}.get(source)
    if key in out.columns and "query_id" not in out.columns:
        assert out.select(key).distinct().count() == given.select(key).distinct().count()
    else:
        assert out.select("query_id").distinct().count() == given.where("vec_id % 20 = 0").count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    import duckdb
    db = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    result = db.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    got = queries.queries()[name](spark, DATA).select(*columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(result.fetchall())
