"""The registered queries: those with SQL against it; the pipeline against its stages."""

import duckdb
import pytest

import corpus_pipeline
from isoloom.llm.common import table
from isoloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for view in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF}/{view}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = con.execute(ORACLE[name])
    names = [c[0] for c in found.description]
    order = [names.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in found.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_all_documents(spark, name):
    ids = QUERIES[name](spark, SF).select("doc_id").distinct()
    assert ids.count() == table(spark, SF, "documents").count()


def test_pipeline_is_its_stages(spark):
    docs = table(spark, SF, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES:
        assert docs.columns == columns
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        sizes.append(docs.count())
    whole = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, docs.select(*key).collect()))
    assert sizes[0] > sizes[1] >= sizes[2] >= sizes[3] > 0


def test_pipeline_stages_take_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "src0", 0), (2, None, "en", None, 0), (3, "A b c. " * 500, None, "src1", 3500)]
    docs = spark.createDataFrame(rows + rows[3:], table(spark, SF, "documents").schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns and left.count() <= (8 if name == "mixing" else 5)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).where("doc_id = 3").count() >= 2


def test_near_duplicates_tell_rows_apart(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    near = " ".join(one.split()[:-1])
    texts = [(5, one), (5, two), (2, near), (None, three), (None, three), (7, two), (None, near)]
    rows = [(i, t, "en", "src0", len(t)) for i, t in texts]
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    left = corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id", "text").collect()
    assert sorted(map(repr, map(tuple, left))) == sorted(map(repr, [(2, near), (5, two), (None, three)]))
