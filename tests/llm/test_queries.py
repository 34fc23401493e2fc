"""Registered queries against their DuckDB oracles; the pipeline's laws."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF001
from daybook.llm import decontam, queries
from util import assert_same


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, duck001, name):
    assert_same(queries.QUERIES[name](spark, SF001), duck001, queries.ORACLES[name])


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF001}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, SF001).cache()
        out.append((name, docs, done))
        docs = done
    return out


def test_stages_keep_the_columns_of_documents(spark, stages):
    columns = spark.read.parquet(f"{SF001}/documents.parquet").dtypes
    assert [n for n, _, _ in stages] == ["language-id", "near-duplicates", "decontamination", "pseudonyms", "packing"]
    assert all(out.dtypes == columns for _, _, out in stages[:-1])


def test_language_stage_rejects_texts_without_a_language(spark, stages):
    from llm_cases import docs_of

    docs = stages[0][1].unionByName(docs_of(spark, [None, "", "123 456"], [9001, 9002, 9003]))
    kept = {r.doc_id for r in corpus_pipeline.identify(spark, docs, SF001).collect()}
    assert kept == {r.doc_id for r in stages[0][1].collect()}


def test_near_duplicate_stage_keeps_one_of_each_class(stages):
    from test_neardup import brute_classes

    _, docs, out = stages[1]
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(want.values()))


def test_decontamination_stage_drops_what_the_rule_says(spark, stages):
    from test_decontam import brute

    _, docs, out = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = {i for i, n, hit, _ in brute([(r.doc_id, r.text) for r in docs.collect()], items, decontam.WINDOW) if hit == 0 or 20 * hit < n}
    assert {r.doc_id for r in out.collect()} == want


def test_pseudonym_stage_keeps_rows_and_counts(stages):
    _, docs, out = stages[3]
    before, after = ({r.doc_id: r for r in x.collect()} for x in (docs, out))
    assert before.keys() == after.keys() and all(r.n_chars == len(r.text) for r in after.values())
    assert any(before[i].text != after[i].text for i in after)


def test_packing_stage_holds_every_token(stages):
    _, docs, out = stages[4]
    assert sum(r.n_tokens for r in out.collect()) == sum(len(r.text.encode()) + 1 for r in docs.collect())


def test_run_hands_out_every_stage(spark, stages, tmp_path):
    """The pieces of the last stage cut the text of the stage before it."""
    from pyspark.errors import AnalysisException

    out = str(tmp_path / "corpus")
    pieces = corpus_pipeline.run(spark, SF001, out)
    assert pieces.count() == stages[-1][2].count()
    texts = {r.doc_id: r.text.encode() + b"\n" for r in spark.read.parquet(f"{out}/pseudonyms").collect()}
    assert {i: t[:-1].decode() for i, t in texts.items()} == {r.doc_id: r.text for r in stages[3][2].collect()}
    upto = {}
    for r in pieces.orderBy("doc_id", "piece").collect():
        assert r.start == upto.get(r.doc_id, 0) and len(texts[r.doc_id][r.start : r.start + r.n_tokens]) == r.n_tokens
        upto[r.doc_id] = r.start + r.n_tokens
    assert upto == {i: len(t) for i, t in texts.items()}
    with pytest.raises(AnalysisException):
        corpus_pipeline.run(spark, SF001, out)
