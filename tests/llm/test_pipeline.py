"""The pipeline, stage by stage on what the stage before it kept, against the operators' SQL and brute force."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from riskmart.llm import langid, queries
from riskmart.session import stage

from . import line_brute
from .conftest import CLASHING
from .test_mixing import shared
from .test_ngram_join import expected

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def by_sql(df, sql):
    con = duckdb.connect()
    documents = df.toPandas()  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT * FROM documents")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF}/benchmark.parquet')")
    return {r["doc_id"]: r for r in con.execute(sql).df().to_dict("records")}


def test_columns(kept):
    assert all(df.columns == kept[0].columns for df in kept[1:-1])
    assert kept[-1].columns == [*kept[0].columns, "mix_copies"]


def test_language_stage_keeps_the_recognised(kept):
    found = langid.identify(kept[0], "doc_id").collect()
    want = {r["doc_id"] for r in found if r["lang_pred"] != langid.UND and r["score"] >= langid.MIN_SCORE}
    assert set(rows_of(kept[1])) == want and len(want) >= 0.97 * len(found)


def test_line_stage_equals_plain_python(kept):
    want = line_brute.report([(r["doc_id"], r["text"]) for r in kept[1].collect()])
    assert {i: r["text"] for i, r in rows_of(kept[2]).items()} == {r[0]: r[3] for r in want}


def test_near_duplicate_stage_keeps_the_first_of_each_class(kept):
    classes = expected([(i, r["text"]) for i, r in rows_of(kept[2]).items()])
    assert set(rows_of(kept[3])) == {i for i, (first, _) in classes.items() if first == i}


def test_benchmark_stage_equals_sql(kept):
    want = by_sql(kept[3], queries.OP8_SQL)
    assert set(rows_of(kept[4])) == {i for i, r in want.items() if not r["contaminated"]}


def test_mix_stage_meets_the_targets(kept):
    sizes, taken = {}, {}
    mixed = rows_of(kept[5])
    for i, r in rows_of(kept[4]).items():
        n = len(r["text"].split())
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        taken[r["source"]] = taken.get(r["source"], 0) + n * (mixed[i]["mix_copies"] if i in mixed else 0)
    longest = max(len(r["text"].split()) for r in rows_of(kept[4]).values())
    assert all(target - longest < taken[s] <= target for s, target in shared(sizes).items())


def test_edge_rows_pass_through_all_stages(spark, monkeypatch, edge, empty):
    monkeypatch.setattr(langid, "fit", lambda docs: langid.Network.fresh(["de", "en"]))
    columns = {c: edge["n_chars"].cast("string") for c in CLASHING}
    for docs in (edge.withColumns(columns), empty):
        for _, step in corpus_pipeline.STAGES:
            names = docs.columns
            docs = stage(step(spark, docs, SF), "test-edge")
            assert docs.columns[:len(names)] == names
