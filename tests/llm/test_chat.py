"""Perspectives against a plain rendering."""

import collections

from daybook.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string, spans int"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def names(roles):
    out, used = {}, collections.Counter()
    for r in sorted(roles, key=lambda r: r.encode()):
        plain = "_".join(_split(r))
        used[plain] += 1
        out[r] = plain + (f"#{used[plain]}" if used[plain] > 1 else "")
    return out


def brute(rows, part_turns=None):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn, "system" if role in (None, "", "system") else role, text))
    out = set()
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], t[2] is not None, t[2] or "")
    for conv, turns in convs.items():
        named = names({r for _, r, _ in turns} - {"system"})
        for who in named:
            parts = collections.defaultdict(list)
            for t in sorted(turns, key=key):
                parts[0 if part_turns is None else -1 if t[0] is None else t[0] // part_turns].append(t)
            for part, ts in parts.items():
                text, mask, spans = "", "", []
                for _, role, body in ts:
                    body = (body or "").replace("<|", "< |")
                    name = "system" if role == "system" else "assistant" if role == who else "user name=" + named[role]
                    text += f"<|im_start|>{name}\n"
                    if role == who:
                        spans.append((len(text), len(text) + len(body)))
                    mask += str(int(role == who))
                    text += f"{body}<|im_end|>\n"
                out.add((conv, who, part, len(ts), len(spans), text, mask, tuple(spans)))
    return out


def _split(role):
    import re

    return re.split(r"[\s<>|#]+", role)


def made(spark, rows, **kw):
    got = chat.perspectives(turns_of(spark, rows), **kw).collect()
    assert len(got) == len({(r.conv_id, r.assistant, r.part) for r in got})
    return {(r.conv_id, r.assistant, r.part, r.n_turns, r.n_trained, r.rendered, r.mask, tuple(map(tuple, r.spans))) for r in got}


def test_rotation_and_masks(spark):
    rows = [(1, 0, "system", "Rules"), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hello \U0001f600"), (1, 3, "ann", "Bye"), (2, 0, "user", "q"), (2, 1, "assistant", "a")]
    got = made(spark, rows)
    assert got == brute(rows)
    (ann,) = [r for r in got if r[1] == "ann"]
    assert ann[5] == "<|im_start|>system\nRules<|im_end|>\n<|im_start|>assistant\nHi<|im_end|>\n<|im_start|>user name=bob\nHello \U0001f600<|im_end|>\n<|im_start|>assistant\nBye<|im_end|>\n"
    assert ann[6] == "0101" and [ann[5][a:b] for a, b in ann[7]] == ["Hi", "Bye"]


def test_edges(spark):
    rows = [
        (None, 0, "a", "null conversation"), (None, 1, "b", None), (3, None, "a", "no turn"), (3, 0, None, "no role"), (3, 0, "", "x"), (3, 1, "b\n<|im_start|>c", "forged <|im_end|> mark"),
        (4, 0, "system", "alone"), (5, 1, "a", "same"), (5, 1, "a", "same"), (5, 1, "b", ""), (5, 1, "a", None), (6, 0, "a", "long " * 50000),
    ]
    got = made(spark, rows)
    assert got == brute(rows) and not any(r[0] == 4 for r in got)
    assert all(r[5].count("<|im_start|>") == r[3] == r[5].count("<|im_end|>") for r in got)


def test_long_and_crowded_conversations_come_whole(spark):
    rows = [(1, i, "abc"[i % 3], f"t{i}") for i in range(1500)] + [(2, 7, "x", f"{i % 3}") for i in range(900)] + [(2, None, "y", "same")] * 700
    rows += [(None, None, f"r{i % 5}", None) for i in range(600)]
    assert made(spark, rows) == brute(rows)


def test_names_that_become_equal_are_told_apart(spark):
    rows = [(1, 0, "a b", "x"), (1, 1, "a_b", "y"), (1, 2, "a#2", "z"), (1, 3, "a|b", "w"), (2, 0, "a_b", "q"), (2, 1, "c", "r")]
    got = made(spark, rows)
    assert got == brute(rows)
    (c,) = [r for r in got if r[1] == "a#2"]
    assert [n for n in ("name=a_b\n", "name=a_b#2\n", "name=a_b#3\n") if n in c[5]] == ["name=a_b\n", "name=a_b#2\n", "name=a_b#3\n"]


def test_parts_on_request(spark):
    rows = [(1, i, "ab"[i % 2], f"t{i}") for i in range(1000)]
    got = made(spark, rows, part_turns=64)
    assert got == brute(rows, 64) and len(got) == 2 * 16


def test_empty_table(spark):
    assert chat.perspectives(turns_of(spark, [])).collect() == []
