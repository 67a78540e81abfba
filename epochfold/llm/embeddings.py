"""Near-duplicate embeddings by a pigeonhole join over subspaces.

Unit vectors with a cosine of at least c lie within a squared distance of 2 - 2c. After a random
rotation the coordinates are cut into blocks; the distance within some block is at most that
block's share of the whole. So each block is joined by range, under its share: its coordinates, a
byte each, meet in the regions of a tree. Vectors that can be linked, and what these can be linked
with, are a group; the exact cosine is taken within groups, to which each vector is sent once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epochfold.llm.components import connected
from epochfold.llm.shared import Scratch, pick, shuffles_freed

#: Coordinates in a block.
BLOCK = 16
#: Rows that meet in a region of a block. Larger groups of a label and length are cut by a tree.
REGION = 1 << 16
#: Vectors by which a tree is cut, for each of its regions.
SAMPLE = 16
#: Vectors whose cosines are taken in one piece. Larger groups are dealt to pairs of chunks.
CELL = 2000
#: Grouped vectors and crowded groups that are broadcast at most, 16 bytes each; more are joined by shuffle.
BROADCAST_CELLS = 1_000_000
#: Pairs that are confirmed at a time.
PAIRS = 1 << 18
#: Allowance for rounding in distances; cosines are decided without any.
SLACK = 1e-9


class Space:
    """Rotation, blocks and ranges for vectors of one length."""

    def __init__(self, size: int, cosine: float):
        rng = np.random.default_rng([size, 77])
        self.turn, _ = np.linalg.qr(rng.normal(size=(size, size)))
        n = max(1, size // BLOCK)
        self.starts = np.linspace(0, size, n, endpoint=False).astype(int)
        self.sizes = np.diff(np.append(self.starts, size))
        whole = 2 - 2 * cosine
        self.budgets = whole * self.sizes / size * (1 + SLACK) + SLACK
        # a coordinate as a byte; few are beyond the most, and cutting those off brings none apart
        self.step = min(1.0, 4 / math.sqrt(size)) / 127

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.turn

    def block(self, rows: np.ndarray, b: int) -> np.ndarray:
        return rows[:, self.starts[b] : self.starts[b] + self.sizes[b]]

    def codes(self, part: np.ndarray) -> np.ndarray:
        return np.clip(np.rint(part / self.step), -127, 127).astype(np.int8)

    def limit(self, b: int) -> int:
        """Squared distance of codes that rows within the block's budget have at most."""
        rounding = math.sqrt(self.sizes[b]) * (1 + SLACK)
        return math.floor((math.sqrt(self.budgets[b]) / self.step + rounding) ** 2 * (1 + SLACK))


_SPACES: dict[tuple[int, float], Space] = {}


def space(size: int, cosine: float) -> Space:
    key = (size, cosine)
    if key not in _SPACES:
        _SPACES[key] = Space(size, cosine)
    return _SPACES[key]


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors in double precision, their lengths, and the vectors at length 1."""
    x = np.asarray(rows, np.float64)
    scale = np.abs(x).max(1, keepdims=True)  # squares of large or small numbers leave the range
    x = x / scale
    length = np.sqrt((x * x).sum(1))
    return x, length, x / length[:, None]


def _tree(part: np.ndarray, depth: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(coordinate, cut) of each inner node of a tree, in the order of a heap; an infinite cut cuts nothing."""
    at, cut = np.zeros((1 << depth) - 1, int), np.full((1 << depth) - 1, np.inf)
    here = {0: np.arange(len(part))}
    for i in range(len(at)):
        rows = here.pop(i)
        if len(rows) > 1:
            spread = part[rows].std(0)
            d = int(spread.argmax())
            if spread[d] > reach / 2:
                at[i], cut[i] = d, np.median(part[rows, d])
        low = part[rows, at[i]] < cut[i]
        here[2 * i + 1], here[2 * i + 2] = rows[low], rows[~low]
    return at, cut


def _regions(part: np.ndarray, at: np.ndarray, cut: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, region) of each row's own region and those in reach that are to the right of it.

    So two rows in reach of each other meet in the region of the one further to the right.
    """
    rows, node, own = np.arange(len(part)), np.zeros(len(part), int), np.ones(len(part), bool)
    off = np.zeros(part.shape)  # how far the region is in each coordinate
    for _ in range((len(at) + 1).bit_length() - 1):
        d, x = at[node], part[rows, at[node]]
        right = x >= cut[node]
        other = off.copy()
        line = np.arange(len(rows))
        other[line, d] = np.maximum(off[line, d], np.abs(x - cut[node]))
        near = (~own | ~right) & ((other * other).sum(1) <= budget + SLACK)
        rows = np.concatenate([rows, rows[near]])
        node = np.concatenate([2 * node + 1 + right, 2 * node[near] + 1 + ~right[near]])
        off = np.concatenate([off, other[near]])
        own = np.concatenate([own, np.zeros(near.sum(), bool)])
    return rows, node


def _cells(batch: np.ndarray, labels: list, cosine: float, trees: dict):
    """(row, region key, block, codes) for every region that a row is dealt to."""
    _, _, unit = units(batch)
    size = unit.shape[1]
    grid = space(size, cosine)
    turned = grid.rotated(unit)
    label = np.asarray(labels, np.int64)
    groups = [(x, np.flatnonzero(label == x)) for x in np.unique(label).tolist()]
    for b in range(len(grid.starts)):
        part = grid.block(turned, b)
        codes = grid.codes(part)
        found = []
        for x, of_label in groups:
            if (x, size) in trees:
                rows, region = _regions(part[of_label], *trees[x, size][b], grid.budgets[b])
                found.append((of_label[rows], region))
            else:
                found.append((of_label, np.zeros(len(of_label), int)))
        rows, region = (np.concatenate(arrays) for arrays in zip(*found, strict=True))
        key = label[rows].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for part_of_key in (np.uint64(size), np.uint64(b), region.astype(np.uint64)):
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + part_of_key
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        yield rows, key.view(np.int64), b, codes[rows]


class Links:
    """Links within one piece: weights of the linked, and who is connected."""

    def __init__(self, n: int):
        self.weight = np.zeros(n, np.int64)
        self.parent = np.arange(n)
        self.linked = np.zeros(n, bool)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        found = self.parent[rows]
        while not np.array_equal(further := self.parent[found], found):
            found = further
        self.parent[rows] = found
        return found

    def least(self, node: np.ndarray) -> np.ndarray:
        """The smallest node that each row is connected with."""
        roots = self.roots(np.arange(len(node)))
        least = node.copy()
        np.minimum.at(least, roots, node)
        return least[roots]

    def join(self, one: np.ndarray, two: np.ndarray) -> None:
        if not len(one):
            return
        self.linked[one] = self.linked[two] = True
        # most links of a dense group connect what is connected already
        ends = np.stack([self.roots(one), self.roots(two)], 1)
        ends = ends[ends[:, 0] != ends[:, 1]]
        for a, b in np.unique(ends, axis=0).tolist() if len(ends) else ():
            while self.parent[a] != a:
                a = int(self.parent[a])
            while self.parent[b] != b:
                b = int(self.parent[b])
            self.parent[max(a, b)] = min(a, b)

    def add(self, one: np.ndarray, two: np.ndarray, copies: np.ndarray) -> None:
        n = len(self.weight)
        self.weight += np.bincount(one, copies[two], n).astype(np.int64)
        self.weight += np.bincount(two, copies[one], n).astype(np.int64)
        self.join(one, two)


def _sides(chunk: np.ndarray, chunks: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows whose pairs a piece has to look at, on either side, and whether both sides are the same."""
    first, second = chunks
    return np.flatnonzero(chunk == first), np.flatnonzero(chunk == second), first == second


def _candidates(codes: np.ndarray, sides: tuple[np.ndarray, np.ndarray, bool], limit: int) -> Links:
    """Who is connected by pairs of codes within the limit.

    Sides are halved until they are small; before that, rows out of reach of the other side are left out.
    """
    points = codes.astype(np.float32)  # sums of squares of bytes are exact
    square = (points * points).sum(1)
    links = Links(len(points))

    def within(rows, others):
        low, high = points[others].min(0), points[others].max(0)
        gap = points[rows] - np.clip(points[rows], low, high)
        return rows[(gap * gap).sum(1) <= limit]

    def halves(rows):
        part = points[rows]
        order = part[:, part.std(0).argmax()].argpartition(len(rows) // 2)
        return rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]

    todo = [sides]
    while todo:
        a, b, same = todo.pop()
        if not same and len(a) and len(b):
            a = within(a, b)
            b = within(b, a) if len(a) else b
        if not len(a) or not len(b):
            continue
        if len(a) * len(b) > PAIRS:
            if same:
                c, d = halves(a)
                todo += [(c, c, True), (d, d, True), (c, d, False)]
            elif len(a) >= len(b):
                todo += [(half, b, False) for half in halves(a)]
            else:
                todo += [(a, half, False) for half in halves(b)]
            continue
        gap = square[a, None] + square[None, b] - 2 * points[a] @ points[b].T
        i, j = np.nonzero(np.triu(gap <= limit, 1) if same else gap <= limit)
        links.join(a[i], b[j])
    return links


def _compare(rows: np.ndarray, copies: np.ndarray, sides: tuple[np.ndarray, np.ndarray, bool], cosine: float) -> Links:
    """All links between the sides."""
    x, length, unit = units(rows)
    links = Links(len(x))
    one, two, same = sides
    step = max(1, (1 << 20) // max(1, len(two)))
    for at in range(0, len(one), step):
        here = one[at : at + step]
        i, j = np.nonzero(unit[here] @ unit[two].T >= cosine - SLACK)
        i, j = here[i], two[j]
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), PAIRS):
            p, q = i[k : k + PAIRS], j[k : k + PAIRS]
            near = (x[p] * x[q]).sum(1) / (length[p] * length[q]) >= cosine
            links.add(p[near], q[near], copies)
    return links


def _pieces(batches):
    """Rows of one (key, first chunk, second chunk) at a time, from sorted batches."""
    held, now = [], None
    for batch in batches:
        keys = np.stack([np.asarray(batch.column(n)) for n in ("key", "c1", "c2")], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if begin == end:
                continue
            if held and now != tuple(keys[begin]):
                yield pa.Table.from_batches(held)
                held = []
            now = tuple(keys[begin])
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def _usable() -> Column:
    finite = "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    both = f"label is not null and {finite} and exists(embedding, x -> x <> 0)"
    return F.coalesce(F.expr(both), F.lit(False))


def _classes(vectors: DataFrame) -> DataFrame:
    """(node, label, embedding, copies) of distinct usable vectors."""
    counted = vectors.where(_usable()).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"))
    return counted.withColumn("node", F.xxhash64("label", "embedding"))


def _trees(classes: DataFrame, cosine: float) -> dict[tuple[int, int], list]:
    """Trees by label and length of vectors, one for each block, where more than `REGION` have both."""
    sized = classes.withColumn("size", F.size("embedding"))
    large = sized.groupBy("label", "size").count().where(F.col("count") > REGION).collect()
    if not large:
        return {}
    # where it is cut only decides who meets where
    picked = sized.where(F.pmod("node", F.lit(max(1, REGION // SAMPLE))) == 0)
    wanted = classes.sparkSession.createDataFrame([(r.label, r.size) for r in large], "label long, size int")
    of = {(r.label, r.size): [] for r in large}
    for r in picked.join(F.broadcast(wanted), ["label", "size"]).select("label", "size", "embedding").collect():
        of[r.label, r.size].append(r.embedding)
    trees = {}
    for r in large:
        grid = space(r.size, cosine)
        _, _, unit = units(np.asarray(of[r.label, r.size], np.float64).reshape(-1, r.size))
        turned = grid.rotated(unit)
        depth = math.ceil(math.log2(r["count"] / REGION))
        trees[r.label, r.size] = [
            _tree(grid.block(turned, b), depth, math.sqrt(grid.budgets[b])) for b in range(len(grid.starts))
        ]
    return trees


def _dealt(full: DataFrame, counts: DataFrame, most: int, scratch: Scratch, name: str) -> DataFrame:
    """Rows (key, node, ...) dealt to pieces (key, c1, c2); keys of more than `most` rows to pairs of `n` chunks."""
    crowded = counts.where(F.col("count") > most)
    crowded = crowded.select("key", F.ceil(F.col("count") / most).cast("int").alias("n"))
    crowded = scratch.stored(crowded, name)
    small = crowded.count() <= BROADCAST_CELLS
    dealt = full.join(F.broadcast(crowded) if small else crowded, "key", "left")
    dealt = dealt.withColumn("n", F.coalesce("n", F.lit(1)))
    dealt = dealt.withColumn("chunk", F.pmod(F.hash("node"), F.col("n")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.withColumn("c1", F.least("chunk", "other")).withColumn("c2", F.greatest("chunk", "other"))
    return dealt.drop("other").repartition("key", "c1", "c2").sortWithinPartitions("key", "c1", "c2")


def duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Two vectors are linked if their labels and lengths are equal, neither null, and their cosine in
    double precision is at least `cosine`. `component_id` is the smallest vec_id that links reach;
    `kept` tells whether it is the row's own.

    A vector that is null, empty, zero or has null or non-finite numbers, or whose label is null,
    has no links. Equal vectors are one node with a count, so copies are not paired with each other;
    rows that repeat a vec_id are vectors of their own. A null vec_id is never the smallest. Other
    columns are not read.

    Groups of more than `CELL` vectors are dealt to pairs of chunks, so a piece of work is bounded
    while every pair is compared.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    with shuffles_freed(vectors.sparkSession):
        return _duplicates(vectors, cosine, scratch)


def _duplicates(vectors: DataFrame, cosine: float, scratch: Scratch) -> DataFrame:
    rows = pick(vectors, "vec_id", "embedding", "label").withColumn("label", F.col("label").cast("long"))
    classes = scratch.stored(_classes(rows), "vectors")
    trees = _trees(classes, cosine)

    def cells_of(batches, whole):
        for batch in batches:
            sizes = np.asarray(pc.list_value_length(batch["embedding"]))
            for size in np.unique(sizes).tolist():
                same = batch.take(pa.array(np.flatnonzero(sizes == size)))
                vector = matrix(same["embedding"])
                node = np.asarray(same["node"])
                for at, key, block, codes in _cells(vector, same["label"].to_pylist(), cosine, trees):
                    if not whole:
                        yield pa.RecordBatch.from_arrays([pa.array(key)], names=["key"])
                        continue
                    width = codes.shape[1]
                    data = codes.tobytes()
                    code = [data[i : i + width] for i in range(0, len(data), width)]
                    arrays = [pa.array(key), pa.array(node[at]), pa.array(np.full(len(at), size << 32 | block))]
                    arrays.append(pa.array(code, pa.binary()))
                    yield pa.RecordBatch.from_arrays(arrays, names=["key", "node", "shape", "code"])

    counts = classes.mapInArrow(lambda b: cells_of(b, False), "key long").groupBy("key").count()
    full = classes.mapInArrow(lambda b: cells_of(b, True), "key long, node long, shape long, code binary")
    dealt = _dealt(full, counts, REGION, scratch, "crowded-regions")

    def meet(batches):
        for piece in _pieces(batches):
            if len(piece) < 2:
                continue
            node = piece["node"].to_numpy()
            size, block = divmod(piece["shape"][0].as_py(), 1 << 32)
            codes = np.frombuffer(b"".join(piece["code"].to_pylist()), np.int8).reshape(len(node), -1)
            chunks = (piece["c1"][0].as_py(), piece["c2"][0].as_py())
            sides = _sides(piece["chunk"].to_numpy(), chunks)
            links = _candidates(codes, sides, space(size, cosine).limit(block))
            hit = np.flatnonzero(links.linked)
            if len(hit):
                arrays = [pa.array(node[hit]), pa.array(links.least(node)[hit])]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    met = scratch.stored(dealt.mapInArrow(meet, "a long, b long"), "vectors-met")
    groups = connected(met).withColumnRenamed("component", "key")
    counts = groups.groupBy("key").count()
    few = groups.count() <= BROADCAST_CELLS
    full = classes.select("node", "copies", "embedding").join(F.broadcast(groups) if few else groups, "node")
    dealt = _dealt(full, counts, CELL, scratch, "crowded-groups")

    def compare(batches):
        for piece in _pieces(batches):
            if len(piece) < 2:
                continue
            node = piece["node"].to_numpy()
            chunks = (piece["c1"][0].as_py(), piece["c2"][0].as_py())
            sides = _sides(piece["chunk"].to_numpy(), chunks)
            links = _compare(matrix(piece["embedding"]), piece["copies"].to_numpy(), sides, cosine)
            hit = np.flatnonzero(links.linked)
            if len(hit):
                arrays = [pa.array(node[hit]), pa.array(links.weight[hit]), pa.array(links.least(node)[hit])]
                arrays.append(pa.array(np.full(len(hit), piece["n"][0].as_py() > 1)))
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "weight", "least", "cut"])

    found = dealt.mapInArrow(compare, "node long, weight long, least long, cut boolean")
    found = scratch.stored(found, "vector-links")
    weights = found.groupBy("node").agg(F.sum("weight").alias("weight"))
    # a group that is one piece is known as a whole; chunks of the others have to be connected
    joined = found.where("not cut").select("node", F.col("least").alias("component"))
    cut = found.where("cut").select(F.col("node").alias("a"), F.col("least").alias("b"))
    if not cut.isEmpty():
        joined = joined.unionByName(connected(cut))

    known = classes.select("node", F.col("copies") - 1).toDF("node", "copies")
    known = known.join(weights, "node", "left").join(joined, "node", "left")
    known = known.select(
        "node",
        (F.col("copies") + F.coalesce("weight", F.lit(0))).alias("n"),
        F.coalesce("component", "node").alias("component"),
    )
    named = rows.select("vec_id", F.xxhash64("label", "embedding").alias("hash"), _usable().alias("usable"))
    node = F.when(F.col("usable"), F.col("hash")).alias("node")
    named = named.select("vec_id", node).join(known, "node", "left")
    least = named.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("least"))
    out = named.join(least, "component", "left")
    top = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), top.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

