import random
from collections import Counter

from dealflow.llm import near_dup as N


def shingle_set(t):
    w = (t or "").lower().split()
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows, threshold=0.8):
    """Classes and links over distinct (id, text), all pairs."""
    own = list(dict.fromkeys((i, t) for i, t in rows if i is not None and shingle_set(t)))
    sets = [shingle_set(t) for _, t in own]
    up = {i: i for i, _ in own}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    links = Counter()
    for a in range(len(own)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[own[a]] += 1
                links[own[b]] += 1
                x, y = sorted((find(own[a][0]), find(own[b][0])))
                up[y] = x
    return sorted(((i, find(i) if i in up else i, links[(i, t)]) for i, t in rows), key=repr)


def got(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in N.near_duplicates(df).collect()), key=repr)


def edited(text, r, n):
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def test_against_all_pairs(docs, prose):
    r = random.Random(3)
    rows = [(i, prose(i, r.randrange(3, 120))) for i in range(60)]
    rows += [(100 + i, edited(prose(5000, 200), r, i % 5)) for i in range(40)]
    rows += [(200 + i, prose(6000, 90)) for i in range(30)] + [(300 + i, edited(prose(6000, 90), r, 1)) for i in range(10)]
    r.shuffle(rows)
    assert got(docs(rows)) == brute(rows)


def test_groups_larger_than_a_block(docs, prose, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7)
    r = random.Random(4)
    rows = [(i, edited(prose(1, 150), r, 1 + i % 3)) for i in range(60)]
    assert got(docs(rows)) == brute(rows)


def test_edge_cases(docs, clashing, edge_rows):
    rows = [(i, t) for i, t in edge_rows if i != 5]
    assert got(clashing.where("doc_id is null or doc_id <> 5")) == brute(rows)
    out = {(r.doc_id, r.class_id) for r in N.near_duplicates(clashing).collect()}
    assert (5, 3) in out and (None, None) in out  # an id with two texts joins both classes
    assert N.near_duplicates(docs([])).count() == 0


def test_depth_reaches_the_recall():
    d = N.depth_for(0.8, 0.9995)
    assert 1 - (1 - 0.8 ** d) ** N.TREES >= 0.9995 > 1 - (1 - 0.8 ** (d + 1)) ** N.TREES
