import random

import numpy as np

from dealflow.llm import decontaminate as D


def items_df(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_every_fingerprint_within_the_radius_is_a_candidate():
    r = np.random.default_rng(1)
    index = D.MultiIndex(r.integers(0, 256, (300, D.BITS // 8), np.uint8))
    prints = index.prints[r.integers(0, 300, 800)]
    for row in prints:
        for bit in r.choice(D.BITS, r.integers(0, index.radius + 9), replace=False):
            row[bit // 8] ^= 1 << bit % 8
    got = set(zip(*[x.tolist() for x in index.within(prints)], strict=True))
    far = np.array([[np.unpackbits(p ^ q).sum() for q in index.prints] for p in prints])
    pairs = lambda most: set(zip(*[x.tolist() for x in np.nonzero(far <= most)], strict=True))
    assert pairs(index.radius) <= got <= pairs(index.reach) and len(pairs(index.radius)) > 500
    assert D.MultiIndex(index.prints[:0]).within(prints)[0].size == 0


def test_the_index_skips_most_pairs_and_finds_the_alike():
    r = np.random.default_rng(2)
    index = D.MultiIndex(r.integers(0, 256, (1000, D.BITS // 8), np.uint8))
    rows, _ = index.candidates(r.integers(0, 256, (1000, D.BITS // 8), np.uint8))
    assert len(rows) < 0.1 * 1000 * 1000
    found = 0
    for i in range(600):  # sets of 50 shingles, of which some are changed: 0.8 to 0.92 alike
        g = r.integers(0, 2**63, 60).astype(np.uint64)
        k = 2 + i % 4
        a, b = (D.pack(D.signs(x).sum(0, keepdims=True)) for x in (g[:50], np.concatenate([g[:50 - k], g[50: 50 + k]])))
        found += len(D.MultiIndex(a).within(b)[0])
    assert found == 600


def test_against_exact_search_of_all_windows(spark, docs, prose):
    r = random.Random(2)
    items = [(i, prose(1000 + i, r.randrange(15, 50))) for i in range(30)]
    rows = []
    for i in range(60):
        w = prose(i, r.randrange(20, 200)).split()
        if i % 2:
            own = items[r.randrange(30)][1].split()
            if i % 4 == 3 and len(own) > 40:
                own[r.randrange(len(own))] = "changed"
            if i % 6 == 1:
                own = [own[0].upper() + ",", *own[1:]]
            at = r.randrange(len(w))
            w[at:at] = own
        rows.append((i, " ".join(w)))
    got = {(x.doc_id, x.item_id): (x.start, x.n_words) for x in D.find_leaks(docs(rows), items_df(spark, items), keep=["doc_id"]).selectExpr("doc_id", "inline(leaks)").collect()}
    bench = D.Benchmark(items)
    want = {}
    for i, t in rows:
        g = D.grams(D.flat_words([t], D.Words(seed=5), D.normal_words)[0], D.SHINGLE)
        for k, own in enumerate(bench.sets):
            n = len(own)
            best = max(((bench.similarity(g[a: a + n], k), -a) for a in range(len(g) - n + 1)), default=(0, 0))
            if best[0] >= 0.8 - 1e-9:
                want[(i, bench.ids[k])] = (-best[1], n + D.SHINGLE - 1)
    assert got == want and len(want) >= 25


def test_blocks_of_items_and_edge_cases(spark, docs, clashing, edge_rows, prose):
    items = items_df(spark, [(1, prose(1, 60)), (1, prose(1, 60)), (2, prose(2, 80)), (3, None), (None, prose(1, 60)), (4, ""), (5, "one two"), (6, prose(3, 40))])
    whole = D.find_leaks(clashing, items)
    cut = D.find_leaks(clashing, items, block_items=2)
    show = lambda df: sorted((str(r.doc_id), len(r.text or ""), [x.item_id for x in r.leaks]) for r in df.collect())
    assert show(whole) == show(cut) and whole.columns == cut.columns and whole.count() == len(edge_rows)
    held = {(i, t): tuple(k) for (i, t), k in zip(edge_rows, [()] * len(edge_rows), strict=True)}
    assert len(held) and [x for x in show(whole) if x[0] == "3"][0][2] == [1, 1] and [x for x in show(whole) if x[0] == "10"][0][2] == [6]
    assert D.find_leaks(docs([]), items).count() == 0
    assert all(r.leaks == [] for r in D.find_leaks(docs(edge_rows), items_df(spark, [])).collect())


def test_blocks_change_no_similarity_near_the_threshold(spark, docs, prose):
    common = prose(77, 21).split()
    items = [(i, " ".join((common if i % 4 == 0 else []) + prose(3000 + i, 38 if i % 4 == 0 else 61).split())) for i in range(40)]
    rows = []
    for i, t in items:
        own = t.split()
        own[30] = "changed"
        if i % 4 == 1:  # other items' words at the end, but for the first of them
            own[55:] = common[: len(own) - 55]
        rows.append((i, " ".join(own)))
    leaks = lambda n: sorted((r.doc_id, r.item_id, r.similarity, r.start) for r in D.find_leaks(docs(rows), items_df(spark, items), keep=["doc_id"], threshold=0.5, block_items=n).selectExpr("doc_id", "inline(leaks)").collect())
    whole = leaks(2000)
    bench = D.Benchmark(items, 0.5)
    assert len(whole) >= 40 and whole == leaks(13) and any(0.79 < s < 0.81 for _, _, s, _ in whole)
    words = D.Words(seed=5)
    for i, k, s, a in whole:
        g = D.grams(D.flat_words([rows[i][1]], words, D.normal_words)[0], D.SHINGLE)
        assert s == bench.similarity(g[a: a + len(bench.sets[k])], k)


def test_items_shorter_than_a_shingle(spark, docs, prose):
    """An item of one to four words is found where its words stand in a row, and by its own length."""
    items = spark.createDataFrame([(1, "zebra crossing"), (2, "Forty-Two!"), (3, "quokka"), (4, "one two three four"), (5, ""), (6, "zebra crossing")], "item_id bigint, text string")
    p = prose(3, 40)
    rows = [(1, f"{p} A Zebra, crossing {p}"), (2, f"{p} zebra x crossing"), (3, "forty two"), (4, "Quokka"), (5, f"one two three {p} one two three four. One two three four"), (6, None), (7, p)]
    got = {r.doc_id: [(x.item_id, x.similarity, x.start, x.n_words) for x in r.leaks] for r in D.find_leaks(docs(rows), items).collect()}
    assert got == {1: [(1, 1.0, 41, 2), (6, 1.0, 41, 2)], 2: [], 3: [(2, 1.0, 0, 2)], 4: [(3, 1.0, 0, 1)], 5: [(4, 1.0, 43, 4)], 6: [], 7: []}
