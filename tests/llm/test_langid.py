"""Language ID: held-out accuracy, calibration, sparse weights, edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from daybook.llm import langid
from llm_cases import EDGES, docs_of, edges, no_docs  # noqa: F401


@pytest.fixture(scope="module")
def judged(spark):
    return langid.op2_langid(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()


def test_held_out_accuracy(judged):
    held = [r for r in judged if r.held_out]
    assert len(held) > 100 and all(0 <= r.score <= 1 for r in judged)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98


def test_held_out_is_the_crc_rule(judged):
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in judged)


def test_ngrams_are_the_same_in_pieces(monkeypatch):
    letters, text = langid._letters(), "Ünï code, wörds and more " * 30
    whole = sorted(np.concatenate(list(langid.ngrams(text, letters))))
    assert whole and max(whole) < langid.DIMS
    monkeypatch.setattr(langid, "PIECE", 37)
    pieces = list(langid.ngrams(text, letters))
    # A piece sees two characters before it; those alone count again.
    again = sum(len(p) for p in pieces) - len(whole)
    assert len(pieces) > 10 and 0 <= again <= 3 * len(pieces)


def test_elastic_net_leaves_most_weights_zero():
    rng = np.random.default_rng(0)
    rows = [(int(i % 2), np.array([1 + i % 2, 10 + rng.integers(5000)]), np.array([1.0, 0.01])) for i in range(400)]
    weights, _ = langid.train_ftrl(rows, 2)
    assert (weights[1] != 0).all() and (weights[2] != 0).all() and (weights[10:] == 0).mean() > 0.9


def test_temperature_softens_overconfident_scores():
    truth = np.array([0, 1] * 50)
    logits = np.where(np.arange(2) == truth[:, None], 10.0, -10.0)
    logits[:30] *= -1
    t = langid.calibrate(logits, truth)
    p = langid._softmax(logits / t)
    assert t > 3 and abs(p.max(1).mean() - 0.7) < 0.05


def test_edges(spark, edges):
    model = langid.fit(docs_of(spark, ["the cat and the dog", "the house and the tree"] * 5))
    out = langid.predict(edges.withColumn("lang_pred", F.lit("clash")), model)
    assert {"lang_pred", "score", "doc_id", "kinds"} <= set(out.columns)
    for r in out.collect():
        letter = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred, r.score) == (("en", 1.0) if letter else ("und", 0.0))
    assert len(out.collect()) == len(EDGES)


def test_nothing_to_learn_from(spark, no_docs):
    assert langid.fit(no_docs) is None
    assert langid.fit(docs_of(spark, [None, "", "1"])) is None
    assert [r.lang_pred for r in langid.predict(docs_of(spark, ["abc"]), None).collect()] == ["und"]
    assert langid.predict(no_docs, None).count() == 0


def test_sample_is_bounded_and_has_every_language(spark):
    docs = docs_of(spark, [f"text number {'abcdefghij'[i % 10] * (i % 50)}" for i in range(400)])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 40 == 0, "xx").otherwise("yy"))
    rows = langid.sample(docs.select("lang", "text", F.col("doc_id").cast("string").alias("key")), 20, langid._letters())
    langs = [lang for lang, _, _ in rows]
    assert langs.count("xx") == 10 and langs.count("yy") == 20
