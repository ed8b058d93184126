"""The registered queries against SQL, and the pipeline against a plain version of its stages."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from test_copies import plain_components
from test_passages import plain_hits
from tierlake.llm.quality import score_quality, train
from tierlake.llm.registered import ORACLES, QUERIES
from tierlake.sources.staging import stage

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


def test_all_are_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) and "pipeline" in queries()
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        database.execute("create view {0} as select * from read_parquet('{1}/{0}.parquet')".format(table, FOLDER))
    found, wanted = QUERIES[name](spark, FOLDER), database.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    got = sorted(map(str, (tuple(r[c] for c in columns) for r in found.collect())))
    rows = database.sql("select {} from wanted".format(", ".join(columns))).fetchall()
    assert got == sorted(map(str, rows))


def test_pipeline_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(FOLDER + "/documents.parquet")
    kept = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    scores = score_quality(docs, train(docs, spark.read.parquet(FOLDER + "/labels.parquet"))).collect()
    items = [tuple(r) for r in spark.read.parquet(FOLDER + "/benchmark.parquet").select("item_id", "text").collect()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = stage(function(spark, docs, FOLDER), name)
        assert after.columns == docs.columns
        found = sorted(r["doc_id"] for r in after.collect())
        if name == "quality":
            good = {r["row_id"] for r in scores if r["score"] >= 0.5}
            kept = [(k, t) for k, t in kept if k in good]
        elif name == "exact_dedup":
            first = {}
            for k, t in sorted(kept):
                first.setdefault(" ".join((t or "").replace("\n", " ").replace("\t", " ").split(" ")), k)
            kept = [(k, t) for k, t in kept if k in set(first.values())]
        elif name == "jaccard_join":
            roots = {root for _, _, root in plain_components(kept, 5, 80)}
            kept = [(k, t) for k, t in kept if k in roots]
        else:
            clean = {k for k, _, n, _ in plain_hits(kept, items) if not n}
            kept = [(k, t) for k, t in kept if k in clean]
        assert found == sorted(k for k, _ in kept), name
        docs = after
    assert 0 < len(kept) < 200
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in mixed} <= {k for k, _ in kept} and len(mixed) > len(kept) / 2
