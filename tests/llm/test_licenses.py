"""Licence scan against plain Dice over all units and templates."""

import random

from daybook.llm import licenses as lc
from llm_cases import EDGES, docs_of, edges, no_docs  # noqa: F401


def brute(text):
    out = []
    for first, lines, unit in lc.units((text or "").encode()):
        have = lc.bigrams(unit)
        scored = [(2 * len(have & lc.bigrams(t.encode())) / (len(have) + len(lc.bigrams(t.encode()))), name) for name, t in lc.TEMPLATES] if have else []
        fits = sorted((-d, name) for d, name in scored if d >= lc.THRESHOLD)
        if fits:
            out.append((fits[0][1], first, lines, -fits[0][0]))
    return out


def found(spark, texts):
    got = lc.scan(docs_of(spark, texts, clash=True)).collect()
    assert len(got) == len(texts)
    return {r.id: [tuple(m) for m in r.found] for r in got}


def test_equals_brute_force_over_damaged_notices(spark):
    rng = random.Random(1)
    texts = []
    for _ in range(120):
        words = rng.choice(lc.TEMPLATES)[1].split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(["other", "words", "the", "License"])
        notice = " ".join(words)
        if rng.random() < 0.4:
            notice = notice.replace(" ", "\n", rng.randint(1, 6))
        texts.append(rng.choice(["", "First line.\n", "Para.\n\n", "a\n \n"]) + notice + rng.choice(["", "\nmore text", "\n\nmore"]))
    assert found(spark, texts) == {i: brute(t) for i, t in enumerate(texts)}


def test_known_notices(spark):
    got = found(spark, ["Some words of prose before it.\nLicensed under the Apache License, Version 2.0.", "RELEASED UNDER THE MIT LICENSE!", "Licensed under CC BY-NC 4.0", "the license plate of a car", "MIT"])
    assert [[m[0] for m in got[i]] for i in range(5)] == [["Apache-2.0"], ["MIT"], ["CC-BY-NC-4.0"], [], []] and got[0][0][1:3] == (1, 1)


def test_units():
    text = b"a\nb\n\n  c\n\n\nd\ne"
    assert list(lc.units(text)) == [(0, 1, b"a"), (1, 1, b"b"), (2, 1, b""), (3, 1, b"  c"), (4, 1, b""), (5, 1, b""), (6, 1, b"d"), (7, 1, b"e"), (0, 2, b"a\nb"), (6, 2, b"d\ne"), (0, 8, text)]


def test_edges(spark, edges, no_docs):
    got = lc.scan(edges).collect()
    assert len(got) == len(EDGES) and all(list(r.found) == [] for r in got)
    assert lc.scan(no_docs).collect() == []
    assert [list(r.found) for r in lc.scan(docs_of(spark, ["Released under the MIT License"]), templates=[]).collect()] == [[]]


def brute_places(text, templates):
    """All windows of all templates by score, those that overlap left out."""
    words = lc._WORDS.findall((text or "").lower().encode())
    pairs, scored = list(zip(words, words[1:], strict=False)), []
    for name, template in templates:
        want = lc.bigrams(template.encode())
        longest = int((2 - lc.THRESHOLD) / lc.THRESHOLD * (len(lc._WORDS.findall(template.lower().encode())) - 1) + 1e-9)
        for a in range(len(pairs)):
            if pairs[a] not in want:
                continue
            have = set()
            for b in range(a + 1, min(a + longest, len(pairs)) + 1):
                have.add(pairs[b - 1])
                dice = 2 * len(have & want) / (len(have) + len(want))
                if dice >= lc.THRESHOLD:
                    scored.append((-len(have & want) * dice, a, name, b, dice))
    taken = []
    for _, a, name, b, dice in sorted(scored):
        if all(b <= x or y <= a for x, y, _, _ in taken):
            taken.append((a, b, name, dice))
    return [(name, dice) for _, _, name, dice in sorted(taken)]


def placed(spark, texts, **kw):
    got = lc.scan(docs_of(spark, texts, clash=True), **kw).collect()
    return {r.id: [tuple(m) for m in r.places] for r in got}


def test_windows_equal_brute_force(spark):
    rng, short = random.Random(2), [t for t in lc.TEMPLATES if len(t[1].split()) < 60]
    texts = []
    for _ in range(60):
        words = "we wrote this work in the house and it is licensed under the stars".split()
        for _ in range(rng.randint(1, 3)):
            notice = rng.choice(short)[1].split()
            for _ in range(rng.randint(0, 3)):
                notice[rng.randrange(len(notice))] = rng.choice(["other", "the", "License"])
            at = rng.randrange(len(words))
            words[at:at] = notice
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n", "\n\n"]) for w in words))
    got = placed(spark, texts, templates=short)
    assert {i: [(m[0], m[3]) for m in ms] for i, ms in got.items()} == {i: brute_places(t, short) for i, t in enumerate(texts)}


def test_notices_in_prose_headers_before_code_and_whole_texts(spark):
    whole = {name: text for name, text in lc.TEMPLATES if len(text.split()) > 100}
    wrapped = "/*\n * Copyright 2020 Someone\n *\n * " + lc._GRANT.replace(" software", "\n * software").replace(" to use", "\n * to use") + "\n */\nint main(void) { return run(); }\n"
    texts = ["It was said at noon that the tool is Licensed under the Apache License, Version 2.0, which we like, and more prose.", wrapped]
    texts += [f"NAME\n\nCopyright 2021 A. Body\n\n{t}\n\nSome code follows = 1;\n" for t in whole.values()]
    got = placed(spark, texts)
    assert [m[:3] for m in got[0]] == [("Apache-2.0", 0, 1)] and [m[:3] for m in got[1]] == [("MIT", 3, 3)]
    for i, name in enumerate(whole):
        assert [m[0] for m in got[i + 2]] == [name] and got[i + 2][0][3] > 0.99, name


def test_sibling_versions(spark):
    cases = {
        "This work is licensed under the GNU General Public License, version 2": "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 2.1": "LGPL-2.1",
        "This work is licensed under the GNU Affero General Public License, version 3": "AGPL-3.0",
        "This program is free software: " + lc._FREE % ("General Public License", "2"): "GPL-2.0",
        "This program is free software: " + lc._FREE % ("Affero General Public License", "3"): "AGPL-3.0",
        "This program is free software: " + lc._FREE % ("Lesser General Public License", "3"): "LGPL-3.0",
    }
    got = placed(spark, list(cases))
    assert [[m[0] for m in got[i]] for i in range(len(cases))] == [[name] for name in cases.values()]
