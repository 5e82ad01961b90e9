"""SimHash groups against brute force over all pairs."""

import random

import xxhash

from anamnesis.llm import simhash


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    value = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(g, 42) >> bit & 1 for g in grams) > len(grams):
            value |= 1 << bit
    return value


def slow_groups(prints):
    """fingerprint -> smallest id over links of at most three bits."""
    fps = sorted({fp for _, fp in prints})
    root = {fp: fp for fp in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for doc_id, fp in prints:
        known = least.get(find(fp))
        least[find(fp)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return {fp: least[find(fp)] for fp in fps}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_of_whole_texts(rng):
    texts = [None, "", " \t", "one", "One two", "a b c", "ä Ö ü x y", " ".join(rng.choice("abcdef") for _ in range(70_000))]
    for text in texts:
        got = simhash.fingerprint(None if text is None else text.encode())
        assert got % (1 << 64) == slow_print(text)


def test_links_join_exactly_what_is_in_reach(spark):
    rng = random.Random(3)
    fps = set()
    for centre in [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]:
        for _ in range(40):
            flips = rng.choice([1, 2, 3, 3, 4, 5, 6])
            bits = rng.sample(range(64), flips) if rng.random() < 0.5 else rng.sample(range(b := rng.choice([0, 22, 43]), b + 21), flips)
            fp = centre
            for bit in bits:
                fp ^= 1 << bit
            fps.add(fp)
            if rng.random() < 0.5:
                centre = fp  # chains
    for _ in range(60):  # pairs that stand alone, all bits in one block or spread
        a = rng.getrandbits(64)
        b0 = rng.choice([0, 22, 43])
        for bit in rng.sample(range(b0, b0 + 21), 3) if rng.random() < 0.5 else rng.sample(range(64), 3):
            a2 = a ^ (1 << bit)
            fps.add(a)
            a = a2
        fps.add(a)
    prints = [(i, fp) for i, fp in enumerate(sorted(fps))]
    df = spark.createDataFrame([(i, signed(fp)) for i, fp in prints], "doc_id long, fp long")
    got = {r["fp"] % (1 << 64): r["component_id"] for r in simhash.groups(df).collect()}
    assert got == slow_groups(prints)


def test_lone_pairs_at_three_bits(spark):
    rng = random.Random(5)
    prints, want = [], {}
    for i in range(300):
        a = rng.getrandbits(64)
        start, width = rng.choice(simhash.BLOCKS)
        bits = rng.sample(range(start, start + width), 3) if i % 3 else rng.sample(range(64), 3)
        b = a ^ sum(1 << x for x in bits)
        prints += [(2 * i, signed(a)), (2 * i + 1, signed(b))]
        want |= {signed(a): 2 * i, signed(b): 2 * i}
    df = spark.createDataFrame(prints, "doc_id long, fp long")
    assert {r["fp"]: r["component_id"] for r in simhash.groups(df).collect()} == want


def test_documents_with_odd_rows(docs_of, rng):
    base = [rng.choice("the a of to in is was on at by".split()) + str(rng.randrange(300)) for _ in range(400)]
    near = base[:200] + ["changed"] + base[201:]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (3, " ".join(near)), (9, None), (8, ""), (None, "  "), (None, "alone here now"),
            (7, "x"), (7, "y z"), (2, " ".join(base[:300] + base[:100]))]
    got = simhash.near_duplicates(docs_of(rows)).collect()
    prints = [(i, slow_print(t)) for i, t in rows]
    groups = slow_groups(prints)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=key) == sorted(
        ((i, f"{fp:016x}", groups[fp]) for i, fp in prints), key=key)
    kept = simhash.one_of_each(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    left = kept.collect()
    # A row for each linked group of fingerprints, though groups may share a component_id.
    linked = slow_groups(list(enumerate(sorted({fp for _, fp in prints}))))
    assert len(left) == len(set(linked.values()))
    members = {}
    for i, fp in prints:
        members.setdefault(linked[fp], []).append(i)
    first = [min((i for i in ids if i is not None), default=None) for ids in members.values()]
    assert sorted(str(r.doc_id) for r in left) == sorted(map(str, first))


def test_one_row_stays_of_each_group_of_fingerprints(docs_of):
    """Unrelated texts stay whatever their doc_ids: null, repeated, or both."""
    alone = [(None, f"text number{i} stands alone{i} here{i}") for i in range(6)] + [(7, "x"), (7, "y z"), (7, "one more thing")]
    copies = [(None, "a copy without a name"), (4, "a copy without a name"), (None, "all copies unnamed"), (None, "all copies unnamed")]
    rows = alone + copies + [(None, None), (8, "")]
    fps = sorted({slow_print(t) for _, t in rows})
    linked = slow_groups([(n, fp) for n, fp in enumerate(fps)])
    assert len(set(linked.values())) == len(fps) == 12
    left = simhash.one_of_each(docs_of(rows)).collect()
    want = [*alone, (4, "a copy without a name"), (None, "all copies unnamed"), (8, "")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in left))) == sorted(map(str, want))


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.one_of_each(docs_of([])).count() == 0


def test_links_are_verified(spark):
    df = spark.range(200).selectExpr("id * 7919 as fp")
    assert simhash.links(df).where("bit_count(a ^ b) > 3").count() == 0
