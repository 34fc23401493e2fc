"""Positional index: phrases and proximity against brute force."""

import hashlib
import random

import pytest

from daybook.llm import decontam as dc
from llm_cases import EDGES, docs_of, edges, no_docs  # noqa: F401


def bench_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def brute(docs, items, window):
    windows = {}
    for i, t in items:
        w = dc.words_of(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w = dc.words_of(t)
        hit, found = set(), set()
        for phrase, owners in windows.items():
            for k in range(len(w) - len(phrase) + 1):
                if tuple(w[k : k + len(phrase)]) == phrase:
                    hit |= set(range(k, k + len(phrase)))
                    found |= owners
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "vocabulary", "pairs"), [(1 << 20, 1 << 22, 1 << 20), (40, 2, 7)])
def test_phrases_equal_brute_force(spark, monkeypatch, block, vocabulary, pairs):
    """Few distinct words, so that windows repeat and overlap; small shards."""
    monkeypatch.setattr(dc, "SHARD_WORDS", 50)
    monkeypatch.setattr(dc, "PAIRS", pairs)
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("ab cd ef,gh".split()) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)] + [(60, None), (61, ""), (62, "AB cd"), (62, "AB cd")]
    items = [(i, text(rng.randint(1, 9))) for i in range(12)] + [(12, None), (13, "!"), (None, "ab cd ef"), (3, "ef ab"), (14, "ab cd ef"), (15, "zz yy")]
    got = dc.contamination(spark, docs_of(spark, [t for _, t in docs], [i for i, _ in docs], clash=True), bench_of(spark, items), window=4, block_bytes=block, vocabulary=vocabulary)
    assert sorted(((r.id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=str) == brute(docs, items, 4)


def test_edges_and_share(spark, edges):
    bench = bench_of(spark, [(1, "it is a text of some words"), (2, "京")])
    got = {(r.id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in dc.contamination(spark, edges, bench, one_in=2).collect()}
    assert (6, 7, 7, ("1",), True) in got and (0, 0, 0, (), False) in got and (9, 24000, 0, (), False) in got
    kept = dc.drop_contaminated(spark, edges, bench, one_in=2)
    assert kept.columns == edges.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["0", "1", "2", "3", "4", "5", "8", "9", "None", "11"])


def test_rule_counts_a_twentieth_as_contaminated(spark):
    words = " ".join(f"w{i}" for i in range(13))
    docs = docs_of(spark, [words + " x" * 247, words + " x" * 248, words + " y1 x" + " x" * 265, words + " y1 x" + " x" * 266])
    bench = bench_of(spark, [(1, words), (2, words[3:] + " y1")])
    assert {r.id: r.contaminated for r in dc.contamination(spark, docs, bench).collect()} == {0: True, 1: False, 2: True, 3: False}


def test_empty_tables(spark, no_docs, edges):
    assert dc.contamination(spark, no_docs, bench_of(spark, [(1, "a b")])).collect() == []
    clean = dc.contamination(spark, edges, bench_of(spark, [])).collect()
    assert len(clean) == len(EDGES) and not any(r.contaminated or r.n_hit for r in clean)


def test_proximity_equals_brute_force(spark):
    rng = random.Random(4)
    docs = [" ".join(rng.choice("a b c d e f g h".split()) for _ in range(rng.randint(0, 40))) for _ in range(40)] + [None, ""]
    queries, within = ["a b c", "h h g", "a", "zz a", ""], 5
    got = {(r.id, r.query) for r in dc.proximity_matches(spark, docs_of(spark, docs), queries, within).collect()}
    want = set()
    for i, t in enumerate(docs):
        w = dc.words_of(t)
        for q, text in enumerate(queries):
            need = set(dc.words_of(text))
            if need and any(need <= set(w[k : k + within]) for k in range(len(w))):
                want.add((i, q))
    assert got == want


def test_digest_columns(spark, tmp_path):
    from daybook.llm.decontam import op9_decontaminate

    docs_of(spark, ["nothing", "one two"]).write.parquet(str(tmp_path / "documents.parquet"))
    bench_of(spark, [(10, "One, TWO!"), (9, "two")]).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: (r.n_items, r.items_sha256) for r in op9_decontaminate(spark, str(tmp_path)).collect()}
    assert got == {0: (0, hashlib.sha256(b"").hexdigest()), 1: (2, hashlib.sha256(b"10,9").hexdigest())}


def test_a_block_is_held_as_arrays():
    """Some bytes per byte of the benchmark, and a shard visits only windows
    whose rarest term it holds."""
    import numpy as np

    rng = random.Random(7)
    items = [(i, " ".join(f"word{rng.randint(0, 5000)}" for _ in range(rng.randint(1, 400)))) for i in range(500)]
    phrases = dc.Phrases(items, 13)
    terms = phrases.terms()
    plans = phrases.rarest_first(terms, np.ones(len(terms), np.int64))
    size = sum(v.nbytes for v in vars(plans).values() if isinstance(v, np.ndarray))
    assert size < 8 * sum(len(t) for _, t in items)
    assert len(phrases.rarest_first(terms, np.zeros(len(terms), np.int64)).starts) == 0


def test_documents_are_indexed_once(spark, monkeypatch):
    made = []
    build = dc.build_index
    monkeypatch.setattr(dc, "build_index", lambda *a, **k: made.append(1) or build(*a, **k))
    bench = bench_of(spark, [(i, f"some words of item {i}") for i in range(12)])
    got = dc.contamination(spark, docs_of(spark, ["here are some words of item 7 again", "none"]), bench, block_bytes=100).collect()
    assert made == [1] and sorted((r.id, r.n_hit, tuple(r["items"])) for r in got) == [(0, 5, ("7",)), (1, 0, ())]
