"""Removed byte strings against a table of all windows."""

import random

import numpy as np
import pytest

from daybook.llm import suffixdedup as sd
from llm_cases import EDGES, docs_of, edges, no_docs  # noqa: F401


def brute(docs, length=50):
    """(id, bytes, spans, kept) by looking up every window."""
    least = {}
    data = [(i, (t or "").encode()) for i, t in docs]
    for i, b in data:
        for k in range(len(b) - length + 1 if i is not None else 0):
            w = b[k : k + length]
            least[w] = min(i, least.get(w, i))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1 if i is not None else 0):
            if least[b[k : k + length]] < i:
                gone[k : k + length] = True
        edge = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2).tolist()
        out.append((i, len(b), tuple(map(tuple, edge)), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def made(df, **kw):
    return sorted(((r.id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in sd.remove_repeats(df, **kw).collect()), key=str)


def crowd(seed, alphabet):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randint(40, 300))) for _ in range(10)]
    more = ["", "x" * 130, "é" * 60, "東京" * 30]
    texts = ["".join(rng.choice([*pool, *more, str(rng.random())])[rng.randint(0, 20) :] for _ in range(rng.randint(0, 6))) for _ in range(90)]
    return [(rng.randint(0, 70), t) for t in texts] + [(None, pool[0]), (None, None), (500, None), (501, pool[0]), (502, "q" * 2000)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh "])
@pytest.mark.parametrize("sizes", [sd.Sizes(part=10_000), sd.Sizes(3000, 700, 10_000, 2), sd.Sizes(400, 97, 1000, 1)])
def test_equals_brute_force(spark, alphabet, sizes):
    docs = crowd(5, alphabet)
    want = brute(docs)
    assert any(len(r[2]) > 1 for r in want)
    assert made(docs_of(spark, [t for _, t in docs], [i for i, _ in docs], clash=True).repartition(5), sizes=sizes) == want


def test_other_lengths(spark):
    docs = crowd(6, "abcd")[:40]
    df = docs_of(spark, [t for _, t in docs], [i for i, _ in docs])
    for length, q in ((7, 3), (22, 22), (64, 9)):
        assert made(df, length=length, q=q) == brute(docs, length)
    with pytest.raises(ValueError, match="gram"):
        sd.remove_repeats(df, length=10)


def test_edges(spark, edges, no_docs):
    ids = [0, 1, 2, 3, 4, 5, 6, 6, 8, 9, None, 11]
    assert made(edges) == brute(list(zip(ids, EDGES, strict=True)))
    assert made(no_docs) == []
    with pytest.raises(TypeError, match="whole numbers"):
        sd.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_exact_borders(spark):
    """49 equal bytes stay, 50 go; copies of one id stay; order decides."""
    a, b = "p" + "".join(map(chr, range(200, 224))), "0123456789" * 6  # 49 and 60 bytes
    docs = [(5, a + "x"), (4, a + "y"), (3, "L" + b + "R"), (9, "l" + b + "r"), (9, "l" + b + "r"), (2, "z" * 49), (1, "z" * 49)]
    got = {(r[0], r[2]) for r in made(docs_of(spark, [t for _, t in docs], [i for i, _ in docs]))}
    assert got == {(5, ()), (4, ()), (3, ()), (9, ((1, 61),)), (2, ()), (1, ())}


def test_identifiers_are_of_the_bytes_alone():
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=4000)), np.uint8)
    ids = sd.refined(sd.initial(data, 11), 11, 50)
    text, seen = data.tobytes(), {}
    assert len(ids) == len(data) - 49
    for k, i in enumerate(ids.tolist()):
        assert seen.setdefault(text[k : k + 50], i) == i
    assert len(set(seen.values())) == len(seen)
