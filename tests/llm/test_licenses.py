"""License scans against a plain reading of every place."""

import math
import random
import re

from anamnesis.llm import licenses

APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i:i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_against_plain_reading(docs_of):
    rng = random.Random(1)
    pool = "mit MIT license License apache gnu general public the of é Ü 2 0 - , 漢字 x_y".split()
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(1, 300)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, "MIT LICENSE mit-license"), (103, "MIT License " * 20_000), (0, "again"), (0, "again")]
    got = licenses.scan(docs_of(rows)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(
        ((i, *plain(t)) for i, t in rows), key=key)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)


def test_notices_without_their_names(docs_of):
    changed = MIT.replace("associated", "related")
    cut = "Permission is hereby granted, free of charge, to any dog"
    rows = [(1, "x " * 500 + MIT + " y" * 500), (2, changed), (3, cut), (4, APACHE), (5, "Licensed under CC BY-NC 4.0."),
            (6, "any person obtaining a copy of this software"), (7, "This work is licensed under the GNU General Public License, version 3.")]
    got = {r.doc_id: r for r in licenses.scan(docs_of(rows)).collect()}
    assert got[1].labels == "mit" and got[1].score == 1 and got[1].n_base == 0
    assert got[2].labels == "mit" and 0.9 < got[2].score < 1
    assert got[3].labels == got[6].labels == "" and got[3].score == 0
    assert got[4].labels == got[4].base_labels == "apache" and got[4].score == 1
    assert got[5].labels == "cc-by-nc" and got[5].base_labels == ""
    assert got[7].labels == "gpl"


def test_several_full_notices_in_one_text(docs_of):
    """Whichever notice has the rarest words, the others keep their labels."""
    notices = {"mit": MIT, "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
               "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "cc-by-nc": "Licensed under CC BY-NC 4.0.",
               "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License."}
    whole = "\n\n".join(notices.values())
    for rarest in notices:
        others = "\n".join(text for label, text in notices.items() if label != rarest)
        rows = [(0, whole), *((i, others) for i in range(1, 4))]
        got = {r.doc_id: r for r in licenses.scan(docs_of(rows)).collect()}
        assert got[0].labels == ",".join(sorted(notices)) and got[0].score == 1
        assert got[1].labels == ",".join(sorted(set(notices) - {rarest}))


def plain_match(known, words, least, band):
    """Every template at every place, word by word."""
    spaced = b" " + b" ".join(words) + b" "
    best = {}
    for template in known:
        size = len(template.words)
        for shift in range(-size, len(words)):
            there = [w in words[max(shift + i - band, 0):max(shift + i + band + 1, 0)] for i, w in enumerate(template.words)]
            exact = any(0 <= shift + i < len(words) and words[shift + i] == w for i, w in enumerate(template.words))
            if exact and sum(there) >= math.ceil(least * size) and all(p in spaced for p in template.required):
                best[template.label] = max(best.get(template.label, 0.0), sum(there) / size)
    return best


def edited(rng, words):
    out = list(words)
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(out))
        out[at:at + rng.choice([0, 1, 1])] = rng.choice([[], [b"edited"], [b"put", b"in"]])
    return out


def test_matches_against_every_place():
    """With any counts: what stands exactly somewhere is found, and nothing else."""
    rng = random.Random(9)
    known = licenses.templates()
    vocabulary = sorted(licenses.license_words(known))
    for _ in range(120):
        words = []
        for _ in range(rng.randrange(3)):
            words += [rng.choice(vocabulary) for _ in range(rng.randrange(15))] + edited(rng, rng.choice(known).words)
        words += [w for p in rng.choice(known).required for w in p.split()]
        counts = {w: rng.randrange(50) for w in vocabulary}
        got = licenses.Index(known, counts).match(words, b" " + b" ".join(words) + b" ")
        want = plain_match(known, words, 0.75, licenses.BAND)
        # The index looks where rare words stand exactly; a place found only by words off theirs may differ in score.
        assert set(got) <= set(want) and all(got[label] <= want[label] for label in got)
        for template in known:
            size = len(template.words)
            for shift in range(len(words) - size + 1):
                same = sum(words[shift + i] == w for i, w in enumerate(template.words))
                if same >= math.ceil(0.75 * size) and all(p in b" " + b" ".join(words) + b" " for p in template.required):
                    assert got[template.label] >= same / size


def test_an_edited_notice_keeps_its_label(docs_of):
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    words = bsd.split()
    rows = [(i, "start " + " ".join(words[:i] + ["really"] + words[i:]) + " end") for i in range(9, len(words))]
    rows += [(100 + i, " ".join(words[:i] + words[i + 1:])) for i in range(9, len(words))]
    got = licenses.scan(docs_of(rows)).collect()
    assert all(r.labels == "bsd" and r.score > 0.9 for r in got)


def test_versions_are_told_apart(docs_of):
    gnu = "under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License"
    rows = [(1, gnu.format("General Public License", 2)), (2, gnu.format("General Public License", 3)),
            (3, gnu.format("Lesser General Public License", 3)), (4, gnu.format("Affero General Public License", 3)),
            (5, "This is free and unencumbered software released into the public domain.")]
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(docs_of(rows)).collect()}
    assert "gpl-2" in got[1] and "gpl-3" not in got[1] and "gpl-3" in got[2] and "gpl-2" not in got[2]
    assert "lgpl" in got[3] and "agpl" not in got[3] and "agpl" in got[4] and got[5] == {"unlicense"}


def test_cost_follows_the_hits_not_the_templates():
    rng = random.Random(4)
    texts = [("x", " ".join(f"w{rng.randrange(10_000)}" for _ in range(30)), ["w1"]) for _ in range(3000)]
    index = licenses.Index(licenses.templates(texts), {})
    looked = []
    index.share = lambda *args: looked.append(args) or 0.0
    index.match([b"plain", b"prose"] * 500, b"")
    assert looked == [] and max(map(len, index.postings.values())) < 100


def test_counts_cover_all_documents(docs_of):
    rows = [(i, "license license of") for i in range(30)] + [(99, None)]
    got = {r.word: r.n for r in licenses.document_counts(docs_of(rows), frozenset([b"license", b"of", b"mit"])).collect()}
    assert got == {"license": 30, "of": 30}


def test_empty_table(docs_of):
    assert licenses.scan(docs_of([])).count() == 0
