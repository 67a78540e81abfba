"""Near-duplicate documents and components against plain loops."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from epochfold.llm import near_dup
from epochfold.llm.components import connected


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(rows, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2200)]
    df = rows("a long, b long", links + [(1, None), (None, None), (5000, 5000)])
    got = {r.node: r.component for r in connected(df).collect()}
    ends = {e for a, b in links if a != b for e in (a, b)}
    assert got == union_find(ends, links)


def test_no_links(rows):
    assert connected(rows("a string, b string", [])).count() == 0


def plain_sets(texts):
    out = []
    for text in texts:
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", small)
        runs = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        out.append(runs or ({tuple(words)} if words else set()))
    return out


def plain_components(rows, percent):
    """By row number; `rows` are (doc_id, text)."""
    sets = plain_sets(t for _, t in rows)
    owners = {}
    for i, s in enumerate(sets):
        for x in s:
            owners.setdefault(x, []).append(i)
    shared = Counter(p for which in owners.values() for p in combinations(which, 2))
    links = [
        (a, b)
        for (a, b), n in shared.items()
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)
    ]
    return sets, union_find(range(len(rows)), links), links


def test_op6(result, docs):
    data = sorted(docs.items())
    sets, roots, links = plain_components(data, 85)
    assert len(links) > 50
    want = {d: (len(sets[i]), data[roots[i]][0]) for i, (d, _) in enumerate(data)}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result("op6_")} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in result("op6_"))


def near_copies(n, words, changed, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(changed):
            copy[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_edges(rows):
    data = [
        (10, None),
        (11, ""),
        (12, " \t\n"),
        (13, "One two"),
        (14, "ONE  two\n"),
        (15, "one two three"),
        (16, "É two three four five"),
        (17, "é two three four five"),  # only A-Z are folded
        (18, "x " * 50_000),
        (19, "x x x x x"),
        (None, "one two"),
        (None, "alone here"),
        (20, "a b c d e f g"),
        (20, "a b c d e f g"),
    ]
    df = rows("doc_id long, text string", data, TEXT="1", node="2", component="3")
    got = near_dup.components(df, 85).collect()
    assert len(got) == len(data)
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id}
    assert by_id == {
        10: (0, 10, True),
        11: (0, 11, True),
        12: (0, 12, True),
        13: (1, 13, True),
        14: (1, 13, False),
        15: (1, 15, True),
        16: (1, 16, True),
        17: (1, 17, True),
        18: (1, 18, True),
        19: (1, 18, False),
        20: (3, 20, True),
    }
    nulls = sorted((r.component_id or 0, r.kept) for r in got if r.doc_id is None)
    assert nulls == [(0, True), (13, False)]
    assert near_dup.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_large_group_of_near_copies(rows, percent, monkeypatch):
    texts = near_copies(400, 200, 3) + near_copies(300, 200, 3, seed=2) + near_copies(60, 300, 8, seed=3)
    data = list(enumerate(texts))
    _, roots, _ = plain_components(data, percent)
    df = rows("doc_id long, text string", data).repartition(4)
    got = {r.doc_id: r.component_id for r in near_dup.components(df, percent).collect()}
    assert got == roots


def test_repeated_rows_are_confirmed_once(rows, monkeypatch):
    """Copies of one row and of a near copy of it are one pair of texts."""
    words = [f"w{i}" for i in range(200)]
    one, two = " ".join(words), " ".join([*words[:-1], "other"])
    stored, sizes = near_dup.stored, {}

    def counted(df, name):
        out = stored(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(near_dup, "stored", counted)
    df = rows("doc_id long, text string", [(1, one)] * 60 + [(2, two)] * 60)
    found = near_dup.components(df, 85).collect()
    assert len(found) == 120 and {r.component_id for r in found} == {1}
    assert sizes["texts"] == 2


def test_crowded_regions_are_split_by_deeper_prefixes():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 3, (500, 9)).astype(">u4")
    keys = keys[np.lexsort(keys.T[::-1])]
    whole = near_dup.regions(keys, crowd=10**9)
    assert all((keys[a:b, :2] == keys[a, :2]).all() for a, b in whole)
    split = near_dup.regions(keys, crowd=20)
    assert all(b - a <= 20 or (keys[a:b, :8] == keys[a, :8]).all() for a, b in split)
    assert len(split) > len(whole)
