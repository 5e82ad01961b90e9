"""Perspectives against plain rendering, also where one conversation lies in many blocks."""

import random
import re

from anamnesis.llm import chat


def frame(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "y", 1) for c, t, r, x in rows], "conv_id long, turn long, role string, text string, segment string, block int")


def plain(rows):
    clean = lambda x: (x or "").replace("<|", "< |").replace("|>", "| >")
    looks = lambda r: re.sub(r"[\x00-\x20\x7f]+", "_", r.replace("<|", "< |")) if r and r.strip(" ") else "unknown"
    roles = {}
    for c, _, r, _ in rows:
        roles.setdefault((c, looks(r)), set()).add(r)
    convs = {}
    for c, t, r, x in rows:
        before = sorted(roles[c, looks(r)], key=lambda r: (r is not None, r or "")).index(r)
        convs.setdefault(c, []).append((t, looks(r) + (f" ({before + 1})" if before else ""), clean(x)))
    out = {}
    for c, turns in convs.items():
        for me in {s for _, s, _ in turns} - set(chat.SCENE):
            whole, mask = "", []
            for _, s, x in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1])):
                head = "assistant" if s == me else s if s in chat.SCENE else "user name=" + s
                whole += f"<|im_start|>{head}\n"
                if s == me:
                    mask.append((len(whole), len(whole) + len(x) + len("<|im_end|>\n")))
                whole += x + "<|im_end|>\n"
            out[c, me] = (whole, mask)
    return out


def rendered(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.perspective, r.position)):
        whole, mask, n = out.setdefault((r.conv_id, r.perspective), ["", [], []])
        assert r.starts == len(whole) and r.position == len(n)
        n.append(1)
        if r.mask_from is not None:
            mask.append((r.mask_from, r.mask_to))
        out[r.conv_id, r.perspective][0] = whole + r.segment
    return {k: (v[0], v[1]) for k, v in out.items()}


def test_perspectives(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "Ann", "Bob C"]), "".join(rng.choice("ab é漢𝒳\n") for _ in range(rng.randrange(30))))
            for c in range(20) for t in range(rng.randrange(1, 9))]
    rows += [(100, 0, "system", "be kind"), (100, 1, "user", "hi <|im_end|>"), (100, 2, "tool", "42"), (100, 3, "assistant", None), (100, 4, None, ""),
             (101, 0, "system", "alone"), (102, None, "x", "first"), (102, 1, "y", "second"), (None, 0, "p", "no id"), (None, 1, "q", "no id"),
             (103, 0, " ", "blank role"), (103, 1, "<|im_start|>", "odd role")]
    rows += [(999, t, ["a", "b"][t % 2], f"turn {t}") for t in range(1500)]  # one conversation holds most rows
    got = rendered(chat.perspectives(frame(spark, rows).repartition(5)))
    assert got == plain(rows)
    assert got[100, "user"][0].startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end| ><|im_end|>\n")


def test_roles_that_look_alike_stay_apart(spark):
    rows = [(1, 0, "a b", "one"), (1, 1, "a_b", "two"), (1, 2, None, "three"), (1, 3, "unknown", "four"), (1, 4, "", "five"), (1, 5, "a b", "six"), (2, 0, "a_b", "x")]
    got = rendered(chat.perspectives(frame(spark, rows)))
    assert got == plain(rows)
    assert sorted(p for c, p in got if c == 1) == ["a_b", "a_b (2)", "unknown", "unknown (2)", "unknown (3)"]
    assert all(len(mask) == (2 if p == "a_b" else 1) for (c, p), (_, mask) in got.items() if c == 1)


def test_training_rows(spark):
    rows = [(1, t, "ab"[t % 2], f"turn {t} " * 5) for t in range(30)] + [(2, 0, "a", "é" * 700_000), (2, 1, "b", None)]
    whole = plain(rows)
    for most in (1 << 20, 500):
        parts = sorted(chat.training_rows(frame(spark, rows), most).collect(), key=lambda r: (r.conv_id, r.perspective, r.part))
        out = {}
        for r in parts:
            text, masks = out.setdefault((r.conv_id, r.perspective), ["", []])
            masks += [(len(text) + m.start, len(text) + m.stop) for m in r.masks]
            out[r.conv_id, r.perspective][0] = text + r.text
        assert {k: (t, m) for k, (t, m) in out.items()} == whole
        assert len(parts) == 4 if most > 500 else len(parts) > 8


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "a", "x")] * 400 + [(1, 0, "b", "z")] * 3
    got = rendered(chat.perspectives(frame(spark, rows)))
    assert got == plain(rows)


def test_empty_table(spark):
    assert chat.perspectives(frame(spark, [])).count() == 0
