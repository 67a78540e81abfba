"""Exact search against scores of all pairs."""

import math

import pytest

from epochfold.llm import topk


def plain(data, every=50, k=5, scale=256):
    """All scores of all pairs, over rows of (id, vector)."""
    whole = []
    for i, v in data:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(scale * x) for x in v]))
    best = {}
    for q, x in whole:
        if q is None or q % every:
            continue
        for c, y in whole:
            if c != q:
                score = sum(a * b for a, b in zip(x, y))
                score = min(max(score, -(1 << 63)), (1 << 63) - 1)
                best[q, c] = max(best.get((q, c), score), score)
    out = set()
    for query in {q for q, _ in best}:
        ranked = sorted((-s, c is None, c) for (q, c), s in best.items() if q == query)
        out |= {(query, rank, c, -s) for rank, (s, _, c) in enumerate(ranked[:k], 1)}
    return out


def got(df):
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


def test_op11(spark, sf_dir, result):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    have = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in result("op11_")}
    assert have == plain([(r.vec_id, r.embedding) for r in table])


ODD = [
    (0, [1.0, 0.5, 0.0]),
    (0, [1.0, 0.5, 0.0]),  # a repeated row
    (50, [0.25, -0.5, 0.75]),
    (50, [0.0, 2.0, 0.0]),  # another vector under the same id
    (1, [1.0, 0.5, 0.0]),  # ties
    (2, [1.0, 0.5, 0.0]),
    (3, None),
    (4, [None, 1.0, 1.0]),
    (5, [float("nan"), 1.0, 1.0]),
    (6, [float("inf"), 1.0, 1.0]),
    (7, []),
    (8, [1.0]),
    (9, [0.0, 0.0, 0.0]),
    (-50, [-1.0, -0.001, 0.001]),
    (100, []),
    (None, [1.0, 0.5, 0.0]),
    (None, [3.0, 0.5, 0.0]),
    (10, [0.0, 0.0, 5.0, 7.0]),
]


@pytest.mark.parametrize("queries, run", [(4096, 8192), (2, 3)])
def test_odd_rows(rows, monkeypatch, queries, run):
    """Nulls, ties, repeated rows and ids, other lengths; the same in small blocks and runs."""
    monkeypatch.setattr(topk, "QUERIES", queries)
    monkeypatch.setattr(topk, "RUN", run)
    df = rows("vec_id long, embedding array<double>", ODD, group="1", side="'x'", VEC_ID="2")
    assert got(topk.top_k(df)) == plain(ODD)


@pytest.mark.parametrize("size", [1e4, 1e6, 1e9, 1e15, 1e300])
def test_large_components(rows, size):
    """Scores are exact as far as 64 bits go."""
    data = [(i, [size * (i % 7 - 3), 1.0, -size if i % 3 else 2.0]) for i in range(0, 200, 10)]
    df = rows("vec_id long, embedding array<double>", data)
    assert got(topk.top_k(df)) == plain(data)


def test_empty_and_alone(rows):
    schema = "vec_id long, embedding array<float>"
    assert got(topk.top_k(rows(schema, []))) == set()
    assert got(topk.top_k(rows(schema, [(0, [1.0])]))) == set()


def test_one_vector_in_a_third_of_the_rows(rows):
    """Copies of one vector under ids of their own, and one row repeated."""
    data = [(i, [1.0, 1.0]) for i in range(300)] + [(1000, [2.0, 0.0])] * 300 + [(i, [0.5, i / 400]) for i in range(300, 600)]
    assert got(topk.top_k(rows("vec_id long, embedding array<double>", data))) == plain(data)
