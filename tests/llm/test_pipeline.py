"""The corpus pipeline against its stages done by hand, and on awkward tables."""

import pytest

import corpus_pipeline
from test_operators import SCHEMA, contaminated, fingerprint, measured, personal_spans, smallest_reachable
from scoreflow.llm.quality import quality_report
from scoreflow.llm.wordbpe import word_vocabulary_path
from tokenizers import Tokenizer


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "token_ids"]


def test_whole_pipeline(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    good = {r["doc_id"] for r in quality_report(documents).where("kept").collect()}
    assert all(not measured(rows[i])[5] for i in good)
    left = {i: t for i, t in rows.items() if i in good}
    roots = smallest_reachable({i: fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if roots[i] == i}
    left = {i: t for i, t in left.items() if not contaminated({i: t}, items)[i][4]}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(got) == set(left)
    tokenizer = Tokenizer.from_file(word_vocabulary_path())
    for i, text in left.items():
        shown = text
        for kind, start, end in reversed(personal_spans(text)):
            shown = f"{shown[:start]}[{kind.upper()}]{shown[end:]}"
        ids = tokenizer.encode(shown, add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, "x"), (None, None), (2, ""), (2, "")]])
def test_stages_on_awkward_tables(spark, sf_dir, rows):
    docs = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert out.count() <= len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(rows)


def test_no_stage_that_filters_moves_texts(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id is not null")
    for name, stage in corpus_pipeline.STAGES[:3]:
        plan = stage(spark, documents, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert len(joins) <= 1 and "Repartition" not in plan, (name, plan)


def test_stages_on_long_texts_and_repeated_rows(spark, sf_dir):
    long = " ".join(f"w{k}x{k % 7}" for k in range(60000))
    other = " ".join(f"v{k}y" for k in range(400))
    rows = [(1, long), (1, long), (2, long), (3, other), (3, other), (3, long), (None, other)]
    docs = spark.createDataFrame([(i, t, "en", "a", None, None, None, None) for i, t in rows], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir)
    assert sorted((r["doc_id"], len(r["text"])) for r in docs.collect()) == [(1, len(long)), (3, len(other))]
