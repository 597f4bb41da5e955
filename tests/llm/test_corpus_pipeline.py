from __future__ import annotations

import corpus_pipeline
import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from civic_mart.llm import quality, queries, secret_scan, simhash, toxicity
from llm_data import no_docs, odd_docs


@pytest.fixture(autouse=True)
def quick_training(monkeypatch):
    monkeypatch.setattr(toxicity, "MIN_STEPS", 8)


def test_stages_follow_their_operators(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, texts, kept = docs.columns, {}, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.toPandas()
        after = stage(spark, docs, SF_SMALL)
        if i < 4:
            assert after.columns == columns
        after.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        ids = sorted(docs.toPandas()["doc_id"])
        kept.append(len(ids))
        if name == "quality_rules":
            want = quality.quality_rules(spark.read.parquet(f"{tmp_path}/{i - 1}")).where("kept").toPandas()["doc_id"]
            assert ids == sorted(want)
        if name == "simhash_near_dedup":
            found = simhash.simhash_near_dups(spark.read.parquet(f"{tmp_path}/{i - 1}")).toPandas()
            assert ids == sorted(found["component_id"].unique())
        if name == "secret_scans":
            texts = dict(zip(before["doc_id"], before["text"]))
            for r in docs.collect():
                assert r.text == secret_scan.redacted(texts[r.doc_id]) and r.n_chars == len(r.text)
    assert kept[0] <= 200 and kept[1] < kept[0] and kept[2] <= kept[1] and kept[3] == kept[2] and kept[4] >= kept[3]
    assert [s[0] for s in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "simhash_near_dedup", "secret_scans",
                                                      "best_fit_packing"]


def test_stages_on_odd_rows_and_empty_tables(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF_SMALL).columns == docs.columns
    docs = odd_docs(spark)
    left = corpus_pipeline.simhash_near_dedup(spark, docs, SF_SMALL).collect()
    # one empty text, one of the two cats, the long text once, the other text of its id, and the rest
    assert sorted(str(r.doc_id) for r in left) == ["1", "2", "5", "5", "8", "9", "None"]
    left = corpus_pipeline.quality_rules(spark, docs, SF_SMALL).collect()
    assert all(len(r.text.split()) >= 20 for r in left if r.text)
    assert corpus_pipeline.secrets(spark, docs, SF_SMALL).count() == docs.count()


def test_extra_columns_may_be_called_anything(spark):
    """Names that the stages use themselves pass through, in any case of letters."""
    docs = odd_docs(spark).select("*", *[F.lit(i).alias(n) for i, n in enumerate(
        ["_id", "_TEXT", "_host", "_gone", "_keep", "_rows", "text_key", "removed_words"])])
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.simhash_near_dedup, corpus_pipeline.secrets):
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        assert {(r["_id"], r["_TEXT"], r["removed_words"]) for r in out.collect()} <= {(0, 1, 7)}


def test_quality_stage_removes_boilerplate_lines(spark):
    """A line in most documents of a host goes from every text that is kept; other texts stay."""
    own = "".join(f"word{j} " for j in range(40))
    rows = [(i, f"Subscribe to our letter now\n{own}{i}\n  SUBSCRIBE to our  letter now ", "en", "h", 1) for i in range(80)]
    rows += [(100 + i, f"Subscribe to our letter now\n{own}{i}", "en", "other", 1) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.quality_rules(spark, docs, SF_SMALL).collect()}
    assert len(got) == 83
    assert all(got[i].text == f"{own}{i}" and got[i].n_chars == len(got[i].text) for i in range(80))
    assert all(got[100 + i].text == rows[80 + i][1] for i in range(3))


def test_toxicity_stage_rejects_what_the_operator_predicts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    want = toxicity.toxicity(docs, labels).where("predicted = 0").toPandas()["doc_id"]
    got = corpus_pipeline.toxicity(spark, docs, SF_SMALL).toPandas()["doc_id"]
    assert sorted(got) == sorted(want)


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(queries.ORACLES[name])
    names = [c[0] for c in cur.description]
    want = sorted(map(str, cur.fetchall()))
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in got.select(*names).collect()) == want
