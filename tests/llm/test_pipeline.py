from collections import Counter

import corpus_pipeline
import pytest
from brute import base_spans
from checks import compare

from incident_mart.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    want = compare.connect(SF).execute(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, SF).toPandas()
    assert len(want) and compare.differences(got[list(want.columns)], want) is None


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_covers_its_table(spark, name):
    got = registry.queries()[name](spark, SF)
    of = "pages" if name.startswith("op6") else "documents"
    assert got.count() == spark.read.parquet(f"{SF}/{of}.parquet").count()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, rows = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == names
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        rows.append(docs.collect())
    start, clean, single, masked, mixed, coded = rows
    assert len(start) > len(clean) >= len(single) == len(masked)
    assert {r.doc_id for r in single} <= {r.doc_id for r in clean} <= {r.doc_id for r in start}
    assert all(not base_spans(r.text) for r in masked)
    untouched = {r.doc_id: r.text for r in single if not base_spans(r.text)}
    assert all(untouched.get(r.doc_id, r.text) == r.text for r in masked)
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2
    assert Counter((r.doc_id, r.text) for r in coded) == Counter((r.doc_id, r.text) for r in mixed)


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
