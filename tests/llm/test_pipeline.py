import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from pageloom.llm import queries

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "pages", "conversations")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    cols = sorted(want.columns)
    assert sorted(queries.QUERIES[name](spark, SMALL).columns) == cols
    got = queries.QUERIES[name](spark, SMALL).select(*cols).collect()
    assert sorted(map(tuple, got), key=str) == sorted(con.sql(f"SELECT {', '.join(f'"{c}"' for c in cols)} FROM ({queries.ORACLES[name]})").fetchall(), key=str)


def test_every_operator_has_a_query():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_keep_clean_documents_and_columns(spark, documents, clashing, prose, tmp_path):
    spark.createDataFrame([(1, prose(42, 40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(k, prose(k, 80)) for k in range(30)]
    dirty = [(100, None), (101, "12 34"), (102, clean[3][1]), (103, clean[4][1] + " tail"), (104, prose(9000, 30) + " " + prose(42, 40)),
             (105, prose(50, 30) + "\n" + prose(51, 30)), (106, "head\n" + prose(50, 30) + "\n" + prose(51, 30)), (7, clean[7][1]), (None, prose(77, 60))]
    docs = clashing(documents(clean + dirty))
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        ids[name] = sorted(r.doc_id if r.doc_id is not None else -1 for r in rows)
        assert all(r.words == "mine words" and r.key == "mine key" and r.n_chars == len(r.text) for r in rows)
        assert set(range(30)) <= set(ids[name]), name
    assert not {100, 101} & set(ids["language_id"]) and 102 in ids["language_id"]
    assert 106 in ids["line_dedup"]
    assert {102, 103} & set(ids["near_dedup"]) == set() and ids["near_dedup"].count(7) == 1
    assert 104 in ids["near_dedup"] and 104 not in ids["decontamination"] and -1 in ids["decontamination"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    assert all(r.offset + r.length <= 1024 for r in packed)


def test_texts_stay_if_no_language_is_named(spark, documents, tmp_path):
    docs = documents([(1, "some text"), (2, "12"), (3, None)], lang=None)
    assert [r.doc_id for r in corpus_pipeline.language_id(spark, docs, str(tmp_path)).collect()] == [1]


def test_stages_on_empty_tables(spark, documents, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    fill = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert fill.filter("n > 1024").count() == 0 and out.count() > 0
