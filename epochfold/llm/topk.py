"""Exact top-k search by inner product: exhaustive, term at a time.

A term is a component's number. A task turns a run of candidates into postings, which have for each
term the candidates that hold it and their weights. Every term of a sparse query row scatters its
postings, times the query's weight, into a dense array of scores with one place for each candidate.
A partial selection keeps the best of a run, runs are merged within a task, and tasks by a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epochfold.llm.shared import pick, stored

#: Query rows in a block, about: a task holds one block at a time.
QUERIES = 4096
#: Candidates that are scored in one run.
RUN = 8192
#: Groups of candidates for each core, so that the load is even.
GROUPS_A_CORE = 2
#: Scores beyond this need more than the bits that a combined key of score and place has left.
_PLAIN = 1 << 48
#: Stands for a missing id, and so comes after all others.
_NO_ID = (1 << 63) - 1
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


class Rows:
    """Ids and sparse integer weights: row i has the terms and weights from starts[i] on."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.ids, self.starts, self.terms, self.weights = ids, starts, terms, weights
        self.top = int(np.abs(weights).max()) if len(weights) else 0

    def __len__(self) -> int:
        return len(self.ids)

    @classmethod
    def of(cls, ids: pa.Array, vectors: pa.ListArray, scale: int) -> Rows:
        """floor(scale * component), zeros left out. Python integers if 64 bits are too few."""
        vectors = vectors.cast(pa.list_(pa.float64()))
        sizes = np.asarray(pc.list_value_length(vectors), np.int64)
        with np.errstate(over="ignore"):
            values = np.floor(np.asarray(vectors.flatten(), np.float64) * scale)
        values = np.clip(values, -1.7e308, 1.7e308)
        row = np.repeat(np.arange(len(sizes)), sizes)
        term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        there = np.flatnonzero(values)
        starts = np.concatenate([[0], np.cumsum(np.bincount(row[there], minlength=len(sizes)))])
        values = values[there]
        if len(values) and np.abs(values).max() >= 2.0**62:
            weights = np.array([int(v) for v in values.tolist()], object)
        else:
            weights = values.astype(np.int64)
        return cls(np.asarray(pc.fill_null(ids, _NO_ID), np.int64), starts, term[there], weights)

    def taken(self, order: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[order]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[:-1][order] - starts[:-1], sizes)
        return Rows(self.ids[order], starts, self.terms[at], self.weights[at])


def joined(parts: list[Rows]) -> Rows:
    sizes = np.concatenate([np.diff(p.starts) for p in parts])
    return Rows(
        np.concatenate([p.ids for p in parts]),
        np.concatenate([[0], np.cumsum(sizes)]),
        np.concatenate([p.terms for p in parts]),
        np.concatenate([p.weights for p in parts]),
    )


class Postings:
    """A run of candidates by term, in ascending order of their ids."""

    def __init__(self, rows: Rows, kind: type):
        rows = rows.taken(np.argsort(rows.ids, kind="stable"))
        self.size = len(rows)
        #: The ids, and where the rows of each begin: rows that share an id are one candidate.
        self.ids, self.firsts = np.unique(rows.ids, return_index=True)
        place = np.repeat(np.arange(self.size), np.diff(rows.starts))
        order = np.argsort(rows.terms, kind="stable")
        terms, bounds = np.unique(rows.terms[order], return_index=True)
        bounds = np.append(bounds, len(order))
        place, weights = place[order], rows.weights[order].astype(kind)
        #: term -> places and weights; no places if every candidate has the term
        self.of = {}
        for term, a, b in zip(terms.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            self.of[term] = (None if b - a == self.size else place[a:b], weights[a:b])

    def scores(self, terms: list, weights: list, out: np.ndarray, spare: np.ndarray) -> np.ndarray:
        """The query's score with every candidate: all its postings, one term after another."""
        out[:] = 0
        for term, weight in zip(terms, weights, strict=True):
            if term not in self.of:
                continue
            places, held = self.of[term]
            if places is None:
                np.multiply(held, weight, out=spare)
                out += spare
            else:
                out[places] += held * weight
        if len(self.ids) < self.size:
            return np.maximum.reduceat(out, self.firsts)
        return out


class Best:
    """The k best candidates of each query row so far."""

    def __init__(self, queries: Rows, k: int):
        self.queries, self.k = queries, k
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(len(queries))]

    def add(self, rows: Rows) -> None:
        """Score a run of candidates against all queries and keep the best."""
        if not len(rows) or not len(self.queries):
            return
        width = max(int(np.diff(self.queries.starts).max()), 1)
        most = self.queries.top * rows.top * width
        kind = np.int32 if most < 1 << 30 else np.int64 if most < _PLAIN else object
        postings = Postings(rows, kind)
        out, spare = np.zeros(postings.size, kind), np.zeros(postings.size, kind)
        n = len(postings.ids)
        backwards = np.arange(n - 1, -1, -1)
        queries = self.queries
        starts, terms = queries.starts.tolist(), queries.terms.tolist()
        weights = queries.weights.tolist()
        own = np.searchsorted(postings.ids, queries.ids)
        own = np.where(postings.ids[np.minimum(own, n - 1)] == queries.ids, np.minimum(own, n - 1), -1)
        for q, mine in enumerate(own.tolist()):
            a, b = starts[q], starts[q + 1]
            scores = postings.scores(terms[a:b], weights[a:b], out, spare)
            if kind is object:
                scores = [min(max(s, _LOWEST), _HIGHEST) for s in scores.tolist()]
                places = sorted(range(n), key=lambda i: (-scores[i], i))[: self.k + 1]
            else:
                keys = scores.astype(np.int64) * n + backwards
                last = max(n - self.k - 1, 0)
                places = np.argpartition(keys, last)[last:].tolist()
            new = [(int(scores[i]), int(postings.ids[i])) for i in places if i != mine]
            self._merge(q, new)

    def _merge(self, q: int, new: list[tuple[int, int]]) -> None:
        best: dict[int, int] = {}
        for score, other in self.found[q] + new:
            best[other] = max(best.get(other, score), score)
        ranked = sorted(((s, o) for o, s in best.items()), key=lambda e: (-e[0], e[1]))
        self.found[q] = ranked[: self.k]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for query, found in zip(self.queries.ids.tolist(), self.found, strict=True):
            for score, other in found:
                yield query, None if other == _NO_ID else other, score


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where the cell changes, and into runs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(i), np.int64) for i in range(3)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            for at in range(a, b, RUN):
                yield batch.slice(at, min(RUN, b - at))


def _search(scale: int, k: int):
    """Cells in a sorted stream: the queries of a cell come first, then its candidates."""

    def run(batches):
        cell, waiting, best, held = None, [], None, []

        def scored():
            nonlocal held
            if held:
                best.add(joined(held))
                held = []

        def result():
            if best is None:
                return
            scored()
            found = list(best.rows())
            columns = list(zip(*found, strict=True)) or [[], [], []]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

        for part in _blocks(batches):
            here = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
            if here != cell:
                yield from result()
                cell, waiting, best, held = here, [], None, []
            rows = Rows.of(part.column(3), part.column(4), scale)
            if part.column(2)[0].as_py() == 0:
                waiting.append(rows)
                continue
            if best is None:
                if not waiting:
                    continue
                best = Best(joined(waiting), k)
            held.append(rows)
            if sum(map(len, held)) >= RUN:
                scored()
        yield from result()

    return run


def top_k(
    vectors: DataFrame,
    every: int = 50,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates with the highest inner product of each query.

    Components become floor(scale * component). Queries are the rows with an id divisible by
    `every`; candidates are all rows but the query's own. Ties go to the smaller id. Both sides are
    dealt to cells, a block of some QUERIES queries and a group of candidates each; a task streams a
    cell's candidates past its queries, so it holds one block and one run of candidates at a time,
    however large the table is. Nothing is left out: the search is exhaustive.

    A vector that is null or holds a null or non-finite component takes no part. An empty vector
    scores 0; of vectors of different lengths, the shorter one counts as filled up with zeros. Rows
    that share an id are one query, or one candidate, with its best score; equal rows count once.
    Rows without an id are one candidate with a null id, last among ties, and no query. A query
    without any candidate has no rows. Scores beyond 64 bits count as the nearest long. Other columns
    are not read.
    """
    rows = pick(vectors, vec_id=id_col, vector=vector_col)
    usable = F.col("vector").isNotNull()
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kind = F.col("vector").cast("array<double>")
    rows = rows.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), kind.alias("vector"))
    rows = stored(rows.where(finite).distinct(), "vectors")
    is_query = F.col("vec_id") % every == 0
    n_queries = rows.where(is_query).count()
    blocks = max(1, -(-n_queries // QUERIES))
    groups = GROUPS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism

    def dealt(number: int, salt: int):
        return F.pmod(F.xxhash64(F.lit(salt), "vec_id", "vector"), F.lit(number)).cast("int")

    def numbers(upto: int):
        return F.explode(F.sequence(F.lit(0), F.lit(upto - 1)))

    queries = rows.where(is_query).select(
        dealt(blocks, 1).alias("block"), numbers(groups).alias("group"), F.lit(0).alias("side"), "vec_id", "vector"
    )
    candidates = rows.select(
        numbers(blocks).alias("block"), dealt(groups, 2).alias("group"), F.lit(1).alias("side"), "vec_id", "vector"
    )
    cells = queries.unionByName(candidates).repartition(groups * min(blocks, 16), "block", "group")
    cells = cells.sortWithinPartitions("block", "group", "side")
    found = cells.mapInArrow(_search(scale, k), "query_id long, vec_id long, score long")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
