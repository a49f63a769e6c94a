import re

import duckdb
import pytest

import corpus_pipeline
from leadlens.llm import queries
from leadlens.llm.common import materialized
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, docs_of
from tests.llm.test_op6_decontaminate import plain as contaminated
from tests.llm.test_op7_minhash import plain as near


@pytest.fixture(scope="module")
def results(spark):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialized(stage(spark, docs, SF_SMALL))
        out.append(docs)
    return out


def test_stages_against_brute_force(spark, results):
    first = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [[(r.doc_id, r.text) for r in d.orderBy("doc_id").collect()] for d in [first, *results]]
    assert all(d.columns == first.columns for d in results[:-1])
    assert set(rows[1]) <= set(rows[0])
    seen, want = set(), []
    for i, t in rows[1]:
        if (text := re.sub("[\x20\x09-\x0D]+", " ", t)) not in seen:
            seen.add(text)
            want.append((i, t))
    assert rows[2] == want
    comp = near(rows[2], 5)[1]
    assert rows[3] == [rows[2][i] for i in sorted(set(comp.values()))]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert rows[4] == [r for r in rows[3] if not contaminated(r[1], items)[-1]]
    assert rows[5] == rows[4] and results[-1].columns == [*first.columns, "n_tokens", "rate", "copies"]


def test_run_gives_the_last_stage(spark, results):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(tuple, results[-1].collect()))


def test_stages_on_awkward_and_empty_documents(spark):
    for docs in (docs_of(spark, [*AWKWARD, (None, None), (3, "a"), (3, "a")], extra=True), docs_of(spark, [], extra=True)):
        docs = materialized(docs)
        for name, stage in corpus_pipeline.STAGES:
            out = materialized(stage(spark, docs, SF_SMALL))
            if name != "mixing":
                assert out.columns == docs.columns
            docs = out


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF_SMALL), con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_every_operator_is_registered():
    assert [sum(n.startswith(f"op{k}_") for n in queries.QUERIES) for k in range(1, 11)] == [1] * 10
