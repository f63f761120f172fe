"""The pipeline stage by stage, and every query of the subpackage that has check SQL."""

import duckdb
import pytest

import corpus_pipeline
from riskflow.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas().set_index("doc_id").quality
    before, columns = docs.toPandas().set_index("doc_id"), docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.toPandas()
        if n == 4:
            assert set(after.doc_id) == set(before.index) and after.groupby("sequence_id").length.sum().max() <= 2048
            break
        assert docs.columns == columns and after.doc_id.is_unique
        after = after.set_index("doc_id")
        if n < 3:
            assert (after.text == before.text.loc[after.index]).all()
        if name == "quality_classifier":
            good, bad = labels[labels == 1].index, labels[labels == 0].index
            assert after.index.isin(good).sum() >= 0.98 * len(good) and after.index.isin(bad).sum() <= 0.15 * len(bad)
        if name == "exact_dedup":
            folded = before.text.str.replace(r"[\x20\x09-\x0D]+", " ", regex=True)
            assert sorted(after.index) == sorted(folded.reset_index().groupby("text").doc_id.min())
        if name == "near_duplicates":
            assert 0 < len(after) < len(before)
        if name == "line_dedup":
            assert list(after.n_chars) == list(after.text.str.len()) and len(after) == len(before)
            long = [x for t in after.text for x in set(t.lower().split("\n")) if len(x.split()) > 50]
            assert len(long) == len(set(long))
        before = after


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, docs, no_docs, name, stage):
    """Nulls, empty and long texts, repeated rows and clashing names; and no rows at all."""
    rows, left = docs.count(), stage(spark, docs, SF)
    assert stage(spark, no_docs, SF).count() == 0
    if name == "best_fit_packing":
        assert left.where("piece = 0").count() == rows
        return
    assert left.columns == docs.columns
    kept = left.collect()
    assert 0 < len(kept) <= rows and (len(kept) == rows or name != "line_dedup")
    assert all(r.n_chars == len(r.text) for r in kept) or name != "line_dedup"


def test_run_is_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.execute(SQL[name]), QUERIES[name](spark, SF)
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in got.select(columns).collect())
