"""Edit fingerprints: the query's contract, and likeness against edits."""

import hashlib
import random

import numpy as np

from daybook.llm import editprints as ep
from llm_cases import EDGES, docs_of, edges, no_docs  # noqa: F401


def naive(texts):
    """The same windows and walks, one character at a time."""
    em = ep.Embedder()
    mix = lambda x: int(ep.mix(np.array([x % 2**64], np.uint64))[0])
    places = ep.sample_places()
    out = []
    for text in texts:
        code = em.classes(text).tolist()
        n = len(code)
        if not n:
            out.append([0] * em.slots)
            continue

        def gram(p, l):
            return mix(code[p] + 1) if l == 1 else mix(gram(p, l // 2) * 3 + gram(p + l // 2, l // 2))

        grams = [gram(p, ep.GRAM) for p in range(n - ep.GRAM + 1)]
        key = [(g >> 32, p) for p, g in enumerate(grams)]
        cuts = [p for p in range(1, len(grams)) if key[p] == min(key[max(0, p - em.reach) : p + em.reach + 1])]
        windows = []
        for a, b, name in zip([0, *cuts], [*cuts, n], [0, *(grams[p] for p in cuts)], strict=True):
            windows.append((a, b, name))
        if max(b - a for a, b, _ in windows) > em.longest:
            windows = [(at, min(b, at + em.longest), mix(name + k * 0x9E3779B97F4A7C15) if k else name) for a, b, name in windows for k, at in enumerate(range(a, b, em.longest))]
        digits = []
        for s in range(em.slots):
            a, b, _ = min(windows, key=lambda w: (mix(w[2] ^ int(em.seed[s])), w[0]))
            at = max(p for p in places[s].tolist() if p < max(1, 9 * (b - a) // 4))
            i = a
            for j in range(at):
                i += em.moves[j][code[i]] if i < b else 0
            digits.append(em.digit[s][code[i] if i < b else ep._PAD])
        out.append(digits)
    return np.array(out)


def test_vector_walk_equals_naive_walk():
    rng = random.Random(1)
    texts = ["", "a", "ab", "é東\U0001f600", "x" * 2500, "".join(rng.choice("abc xyzé") for _ in range(1900)), "ab" * 700]
    assert (ep.Embedder()(texts) == naive(texts)).all()


def test_steps_move_rarely():
    step = ep.Embedder().step
    assert (step[0] <= 1).all() and (step[255] != step[239]).mean() < 0.2 and abs(np.mean(step[255]) / 576 - 0.5) < 0.1


def test_inserted_passages_disturb_their_windows_only():
    """30 and 60 characters put in at the start, the middle and the end of
    texts of 16,000: the rest stays alike, other texts stay unlike."""
    rng = random.Random(9)
    em, least, most = ep.Embedder(), [], []
    for _ in range(6):
        base = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(16_000))
        other = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(16_000))
        made = [base[:at] + "q z" * (n // 3) + base[at:] for n in (30, 60) for at in (0, 8000, 16_000)] + [base[700:], base[:-700]]
        a, *rest, b = em([base, *made, other])
        least.append(min(ep.likeness(a, x) for x in rest))
        most.append(ep.likeness(a, b))
    assert min(least) > 0.8 and max(most) < 0.15


def test_ids_of_any_type(spark):
    rows = [("b", "second text here"), ("a", "first"), (None, "no id"), ("c", "third text")]
    got = {r.id: r for r in ep.compare_edited(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    em = ep.Embedder()
    follow = {"c": "second text here", "b": "first", "a": "no id", None: "third text"}
    for i, t in rows:
        a, b = em([t, follow[i]])
        assert got[i].fingerprint == ep.hex_of(a) and got[i].near_next == ep.likeness(a, b)


def test_likeness_falls_with_edits():
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(3000))
    em, got = ep.Embedder(), []
    for n in (0, 2, 30, 400):
        text = list(base)
        for _ in range(n):
            p = rng.randrange(len(text))
            text[p : p + rng.randint(0, 1)] = rng.choice(["", "z", "q"])
        got.append(ep.likeness(em([base])[0], em(["".join(text)])[0]))
    other = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(3000))
    assert got[0] == 1.0 and got == sorted(got, reverse=True) and got[1] > 0.85 and ep.likeness(em([base])[0], em([other])[0]) < 0.3


def brute(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    em, out = ep.Embedder(), {}
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        a, b, c = em([t, changed, after])
        out[i] = (len(t), hashlib.sha256(changed.encode()).hexdigest(), ep.hex_of(a), ep.hex_of(b), ep.likeness(a, b), ep.likeness(a, c))
    return out


def test_comparison_equals_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdé f") for _ in range(rng.choice([0, 1, 2, 50, 700]))) for _ in range(200)] + [None, ""]
    ids = rng.sample(range(-500, 5000), len(texts))
    got = ep.compare_edited(docs_of(spark, texts, ids, clash=True)).collect()
    want = brute(list(zip(ids, texts, strict=True)))
    assert {r.id: tuple(r)[1:] for r in got} == want and len(got) == len(texts)


def test_small_steps_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(ep, "STEP_CHARS", 100)
    texts = [f"text {i} " * (i % 7) for i in range(60)]
    got = ep.compare_edited(docs_of(spark, texts)).collect()
    assert {r.id: tuple(r)[1:] for r in got} == brute(list(enumerate(texts)))


def test_edges(spark, edges, no_docs):
    got = ep.compare_edited(edges).collect()
    assert len(got) == len(EDGES) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for t in EDGES)
    (one,) = ep.compare_edited(docs_of(spark, ["abcd"])).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert ep.compare_edited(no_docs).collect() == [] and ep.fingerprints(no_docs).collect() == []


def test_fingerprints_of_equal_texts(spark, edges):
    prints = {}
    for r in ep.fingerprints(edges).collect():
        prints.setdefault(r.hash, set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_edit_classes(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh ijklmnop") for _ in range(800)) for _ in range(6)]
    texts = []
    for b in base:
        for _ in range(4):
            t = list(b)
            for _ in range(8):
                t[rng.randrange(len(t))] = "z"
            texts.append("".join(t))
    got = {r.id: r.class_id for r in ep.edit_classes(docs_of(spark, texts + [texts[0], None, ""], clash=True)).collect()}
    assert sum(got[i] == i // 4 * 4 for i in range(24)) >= 22 and got[24] == got[0]
    assert all(got[i] // 4 == i // 4 for i in range(24)) and got[25] == got[26] == 25
    assert ep.edit_classes(docs_of(spark, [])).collect() == []


def test_recall_of_pairs_within_one_percent(spark):
    """Pairs of 1,000 characters, 10 edits apart (put in, taken out, replaced):
    at least nine in ten share a class."""
    rng = random.Random(11)
    texts = []
    for k in range(60):
        base = "".join(rng.choice("abcdefgh ijklmnop") for _ in range(1000))
        t = list(base)
        for _ in range(10):
            p = rng.randrange(len(t))
            t[p : p + (k % 3 > 0)] = ["z", "z", ""][k % 3]
        texts += [base, "".join(t)]
    got = {r.id: r.class_id for r in ep.edit_classes(docs_of(spark, texts), max_edits=0.02).collect()}
    assert sum(got[i] == got[i + 1] for i in range(0, len(texts), 2)) >= 54
    assert all(got[i] // 2 == i // 2 for i in got)
