"""DartMinHash against exact weighted Jaccard, classes against brute force."""

import collections
import random

import numpy as np
import pytest

from conftest import SF001
from daybook.llm import neardup as nd
from daybook.llm.decontam import words_of
from llm_cases import docs_of, edges, no_docs  # noqa: F401


def multiset(words, size=5):
    return collections.Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else collections.Counter()


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def brute_classes(rows, threshold=0.8):
    """Least id of each row's class; rows: (id, text)."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [multiset(words_of(t)) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            ti, tj = rows[i][1], rows[j][1]
            if ti is None or tj is None:
                continue
            if ti == tj or (sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= threshold):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return {key: least[find(i)] for i, (key, _) in enumerate(rows)}


def test_darts_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    for _ in range(4):
        keys = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = rng.integers(0, 4, 300), rng.integers(0, 4, 300)
        b[:200] = a[:200]
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        sa = nd.dart_minhash(keys[a > 0], a[a > 0], 1024)
        sb = nd.dart_minhash(keys[b > 0], b[b > 0], 1024)
        assert abs((sa == sb).mean() - want) < 4 * (want * (1 - want) / 1024) ** 0.5


def test_darts_take_real_weights():
    keys = np.arange(1, 400, dtype=np.uint64)
    a, b = np.full(399, 0.5), np.full(399, 0.3)
    got = (nd.dart_minhash(keys, a, 1024) == nd.dart_minhash(keys, b, 1024)).mean()
    assert abs(got - 0.6) < 0.07


def test_signature_fills_every_coordinate_for_tiny_and_large_sets():
    for n, w in ((1, 1), (3, 2), (5000, 1), (2, 3000)):
        keys = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(77)
        assert (nd.dart_minhash(keys, np.full(n, w), 192) != 0).all()
    assert (nd.dart_minhash(np.zeros(0, np.uint64), np.zeros(0), 8) == 0).all()


def test_packed_similarity_is_exact():
    rng = random.Random(5)
    for _ in range(50):
        a, b = ([rng.choice("abcdef").encode() for _ in range(rng.randint(1, 40))] for _ in range(2))
        hashed = [next(nd._word_lists([b" ".join(x)])) for x in (a, b)]
        got = nd.similarity(*(nd.pack(*nd.shingles(h, 2)) for h in hashed))
        assert got == pytest.approx(jaccard(multiset(a, 2), multiset(b, 2)))


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_classes_of_a_crowd_equal_brute_force(spark):
    """A crowd of near copies around 0.8, copies, a shared passage, and loners."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(300)}" for _ in range(120)]
    texts = [" ".join(edited(rng, base, rng.choice([0, 0, 1, 2, 3, 4, 5, 8]))) for _ in range(160)]
    texts += [" ".join([f"v{rng.randrange(3000)}" for _ in range(60)] + base[:50]) for _ in range(30)]
    texts += [None, None, "", "", "   ", "one two", "one two", "one three"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = docs_of(spark, [t for _, t in rows], [i for i, _ in rows], clash=True)
    got = {r.id: r.class_id for r in nd.classes(docs).collect()}
    assert got == brute_classes(rows)


def test_blocks_alone_find_all_links(spark, monkeypatch):
    """Blocks of a few rows: many blocks per bucket."""
    monkeypatch.setattr(nd, "BLOCK", 8)
    rng = random.Random(12)
    base = [f"w{rng.randrange(300)}" for _ in range(100)]
    rows = list(enumerate(" ".join(edited(rng, base, rng.choice([0, 2, 3, 4, 5]))) for _ in range(60)))
    got = {r.id: r.class_id for r in nd.classes(docs_of(spark, [t for _, t in rows])).collect()}
    assert got == brute_classes(rows)


def test_query_on_sample_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: r.class_id for r in nd.op4_neardup(spark, SF001).collect()}
    assert got == brute_classes([(r.doc_id, r.text) for r in docs.collect()])


def test_components_of_a_long_path(spark):
    n = 300
    pairs = [(f"{i:04}".encode(), f"{i + 1:04}".encode()) for i in range(n)] + [(b"x", b"y")]
    got = {bytes(r.node): bytes(r.comp) for r in nd.components(spark.createDataFrame(pairs, "a binary, b binary")).collect()}
    assert got == {**{f"{i:04}".encode(): b"0000" for i in range(n + 1)}, b"x": b"x", b"y": b"x"}


def test_one_document_of_each_class_stays(spark, edges):
    kept = nd.drop_near_duplicates(edges)
    assert kept.columns == edges.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("a") == 1 and texts.count("It is a text of some words.") == 1 and texts.count(None) == 2


def test_one_of_repeated_rows_is_kept(spark):
    """Equal ids and texts, null texts and null ids: one rule, whatever else the table holds."""
    long = "a text of some words that goes on for a while and is met again here and there"
    rows = [(1, long), (1, long), (1, long), (2, long + " now"), (3, None), (3, None), (4, None), (None, None), (None, None), (None, "x"), (5, "y")]
    for left in (rows, rows[4:], rows[3:]):
        docs = spark.createDataFrame([(*r, i, "z") for i, r in enumerate(left)], "doc_id long, text string, id int, hash string").repartition(5)
        got = nd.classes(docs).collect()
        assert len(got) == len(left)
        kept = [r.class_id for r in got if r.kept]
        stay = nd.drop_near_duplicates(docs)
        assert stay.columns == docs.columns and stay.dtypes == docs.dtypes
        wanted = {r for r in left if r not in {(2, long + " now")} or (1, long) not in left}
        assert sorted(map(str, ((r.doc_id, r.text) for r in stay.collect()))) == sorted(map(str, wanted))
        assert sorted(map(str, kept)) == sorted(str(r[0]) for r in wanted)
        assert [r.class_size for r in got if r.id == 3] == [2, 2]


def test_empty_table(no_docs):
    assert nd.classes(no_docs).collect() == []
    assert nd.drop_near_duplicates(no_docs).collect() == []
