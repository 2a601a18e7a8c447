"""Each stage against a brute-force version on its own input, and the queries over the smallest tables."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from check import TABLES, rows_of
from orderlake.llm import langid, queries
from tests.llm import test_byte_bpe, test_decontaminate, test_pii, test_simhash
from tests.llm.cases import hard, reachable

reference = test_byte_bpe.reference


@pytest.fixture(scope="module")
def stages(spark):
    """The rows each stage got and gave."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [("documents", docs.columns, docs.collect())]
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.common.stage(step(spark, docs, sf_dir), name)
        found.append((name, docs.columns, docs.collect()))
    return found


def test_columns_stay(stages):
    names = [name for name, _, _ in stages]
    assert names == ["documents", "language", "near_duplicates", "decontamination", "personal_data", "tokens"]
    assert all(columns == stages[0][1] for _, columns, _ in stages[:-1])


def test_language(stages, spark, sf_dir):
    rows, kept = stages[0][2], stages[1][2]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    use = langid.Classifier(langid.learn(docs.filter(~langid.held_out())))
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in rows if not use.predict(r.text)[2])
    assert len(kept) > 0.95 * len(rows)


def test_near_duplicates(stages):
    rows, kept = stages[1][2], stages[2][2]
    prints = {r.doc_id: test_simhash.plain_fingerprint(r.text) for r in rows}
    roots = reachable(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert sorted(r.doc_id for r in kept) == sorted(set(roots.values())) and len(kept) < len(rows)


def test_decontamination(stages, spark, sf_dir):
    rows, kept = stages[2][2], stages[3][2]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    judged = test_decontaminate.plain([(r.doc_id, r.text) for r in rows], items)
    assert sorted(r.doc_id for r in kept) == sorted(j[0] for j in judged if not j[4]) and len(kept) < len(rows)


def test_personal_data(stages):
    before, after = {r.doc_id: r for r in stages[3][2]}, {r.doc_id: r for r in stages[4][2]}
    assert before.keys() == after.keys()
    changed = 0
    for doc_id, r in after.items():
        assert r.n_chars == len(r.text) and not [s for s in test_pii.plain(r.text) if s[0] != "phone"]
        changed += r.text != before[doc_id].text
        assert r.text != before[doc_id].text or not test_pii.plain(r.text)
    assert changed


def test_tokens(stages, reference):
    texts = {r.doc_id: r.text for r in stages[4][2]}
    assert len(stages[5][2]) == len(texts)
    for r in stages[5][2]:
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode_ordinary(texts[r.doc_id]) and r.text == texts[r.doc_id]


def test_run(spark, sf_dir, stages):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(r.doc_id for r in stages[5][2])


def test_stages_take_hard_rows(spark, sf_dir):
    docs = hard(spark)
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.common.stage(step(spark, docs, sf_dir), name)
        assert docs.columns == hard(spark).columns
    assert docs.count() > 0
    none = hard(spark).filter(F.lit(False))
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, none, sf_dir).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_dir)
    result = db.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(columns, result.fetchall()) == rows_of(df.columns, df.collect())


def test_all_are_registered(spark, sf_dir):
    names = entry_points.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    held = queries.op9_language_id(spark, sf_dir).filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
