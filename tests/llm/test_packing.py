"""Packing against exhaustive search and its own laws."""

import itertools
import random

import pytest

from daybook.llm import packing
from llm_cases import EDGES, docs_of, edges, no_docs  # noqa: F401


def padding(ends, sizes, counts):
    return sum(c * (min(e for e in ends if e >= s) - s) for s, c in zip(sizes, counts, strict=True))


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    sizes = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
    counts = [rng.randint(1, 20) for _ in sizes]
    for k in (1, 2, 3, 5):
        best = min(padding((*c, sizes[-1]), sizes, counts) for r in range(min(k, len(sizes))) for c in itertools.combinations(sizes[:-1], r))
        ends = packing.boundaries(sizes, counts, k)
        assert len(ends) <= k and ends[-1] == sizes[-1] and padding(ends, sizes, counts) == best


def test_no_length_no_bucket():
    assert packing.boundaries([], [], 4) == []


def test_pieces_cover_texts_and_batches_hold_the_budget(spark, edges):
    out = [r.asDict() for r in packing.pack(edges, max_len=100, n_buckets=3, budget=250).collect()]
    total = sum(len((t or "").encode()) + 1 for t in EDGES)
    assert sum(r["n_tokens"] for r in out) == total
    long = sorted((r["piece"], r["start"], r["n_tokens"]) for r in out if r["id"] == 9)
    assert [p for p, _, _ in long] == list(range(len(long))) and all(s == 100 * p for p, s, _ in long)
    for bucket in {r["bucket"] for r in out}:
        rows = [r for r in out if r["bucket"] == bucket]
        size = rows[0]["bucket_len"]
        per = max(1, 250 // size)
        assert all(r["n_tokens"] <= size == r["bucket_len"] for r in rows)
        places = sorted(r["batch"] * per + r["slot"] for r in rows)
        assert places == list(range(len(rows))) and all(r["slot"] < per for r in rows)


def test_empty_table(no_docs):
    assert packing.pack(no_docs).collect() == []


def test_other_lengths(spark):
    docs = docs_of(spark, ["a b c", "a", None])
    from pyspark.sql import functions as F

    out = packing.pack(docs, lengths=F.coalesce(F.size(F.split("text", " ")), F.lit(1)), max_len=8, n_buckets=2)
    assert sorted((r.id, r.n_tokens) for r in out.collect()) == [(0, 3), (1, 1), (2, 1)]


def test_bpe_tokens(spark):
    import base64

    public = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    path = public.path("byte_bpe_50k.tiktoken")
    texts = ["The quick brown fox", "", None, "straße 東京"]
    got = {r.doc_id: r.n_tokens for r in packing.bpe_tokens(docs_of(spark, texts), str(path), public.PATTERN).collect()}
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("x", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got == {i: len(bpe.encode_ordinary(t or "")) + 1 for i, t in enumerate(texts)}


def test_bpe_tokens_of_a_tiny_vocabulary(spark, tmp_path):
    import base64

    ranks = [bytes([i]) for i in range(256)] + [b"ab", b"abab", b"cd"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(ranks)) + b"\n")
    texts = ["abab", "ababcd x", "", None, "é", "abc" * 500]
    got = {r.doc_id: r.n_tokens for r in packing.bpe_tokens(docs_of(spark, texts), str(path), r"\S+|\s+").collect()}
    assert got == {0: 2, 1: 5, 2: 1, 3: 1, 4: 3, 5: 1001}
