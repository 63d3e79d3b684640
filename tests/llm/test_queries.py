"""The registered queries against their SQL twins, and the pipeline stage by stage."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stridewise.llm.jaccard import jaccard_components
from stridewise.llm.mixing import mix_sources
from stridewise.llm.packing import pack_documents
from stridewise.llm.pii import personal_data
from stridewise.llm.queries import ORACLES, QUERIES
from stridewise.llm.quality import quality_rules

SF = "/root/testdata/sf0.001"


def bag(frame):
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if pd.isna(v) else round(float(v), 6) if isinstance(v, float) else v for v in r) for r in frame.itertuples(index=False)]
    return sorted(frame.columns), sorted(rows, key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    assert bag(QUERIES[name](spark, SF).toPandas()) == bag(con.execute(ORACLES[name]).df())


def test_all_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stage(function(spark, before, SF), f"test-{name}")
        ids = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
        if name != "packing":
            assert docs.columns == columns
        if name == "quality_rules":
            assert ids == sorted(r["doc_id"] for r in quality_rules(before).where("kept").collect())
        elif name == "ngram_jaccard":
            assert ids == sorted({r["component_id"] for r in jaccard_components(before, k=5, percent=80).collect()})
        elif name == "pii":
            assert ids == sorted(r["doc_id"] for r in before.collect())
            assert personal_data(docs).where("spans <> ''").count() == 0
        elif name == "mixing":
            assert len(ids) == mix_sources(before).groupBy().sum("copies").first()[0]
        else:
            want = pack_documents(before).select("doc_id", "start", "length", "ids_crc32").collect()
            assert sorted(want) == sorted(docs.select("doc_id", "start", "length", "ids_crc32").collect())
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
