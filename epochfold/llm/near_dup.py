"""Near-duplicate documents: an LSH forest of MinHash signatures, confirmed on full shingle sets.

Each of several trees is a sort order: the signatures by a run of hashes of their own. Documents
that share a long prefix there stand side by side. A region is all documents that share the first
`LEAST_DEPTH` hashes, the tree being one; where a region is crowded it is taken apart by deeper
prefixes. Regions are counted over all rows and dealt by their prefix, so no border cuts them; the
deepest ones, if still crowded, are dealt as all pairs of bounded chunks.

Within regions, candidates are compared by signature, and no more than one partner a document is
confirmed in a first pass, so a cluster of near copies costs as many confirmations as it has
documents. In a second pass, documents that still have a candidate in another component bring their
texts to their regions, where all of them are compared in full; what leaves a region is a forest.
"""

from __future__ import annotations

from collections import OrderedDict
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochfold.llm.components import connected
from epochfold.llm.shared import map_texts, pick, stored

#: Words in a shingle.
SHINGLE = 5
TREES = 8
#: Hashes in a tree's sort key: the deepest a region can be.
DEPTH = 8
#: Hashes that neighbours must share at least.
LEAST_DEPTH = 2
#: A region of more documents than this is split by the next hash, the deepest ones into chunks.
CROWD = 2000
#: A candidate's signature may agree less than the threshold by so many standard deviations.
DEVIATIONS = 5
#: Words whose hashes a task remembers.
REMEMBERED = 200_000

_HASHES = TREES * DEPTH
_RANDOM = np.random.default_rng(20_240_601)
_FACTORS = _RANDOM.integers(0, 1 << 63, _HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 1 << 63, _HASHES, np.uint64)
_PLACES = _RANDOM.integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of shingles as sorted arrays of 64-bit hashes."""

    def __init__(self, remembered: int = REMEMBERED):
        self.known: dict[bytes, int] = {}
        self.remembered = remembered

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        words = [text.lower().split() if text else [] for text in texts]
        if len(self.known) > self.remembered:
            self.known.clear()
        new = set(chain.from_iterable(words)).difference(self.known)
        self.known.update((w, xxhash.xxh64_intdigest(w)) for w in new)
        get = self.known.__getitem__
        return [self._set(np.fromiter(map(get, w), np.uint64, len(w))) for w in words]

    @staticmethod
    def _set(hashes: np.ndarray) -> np.ndarray:
        n = len(hashes)
        if n < SHINGLE:  # one shingle that no run of five words equals
            whole = (hashes * _PLACES[:n]).sum(dtype=np.uint64) + np.uint64(n + 1)
            return _mixed(np.atleast_1d(whole)) if n else hashes
        sums = hashes[: n - SHINGLE + 1] * _PLACES[0]
        for k in range(1, SHINGLE):
            sums += hashes[k : n - SHINGLE + 1 + k] * _PLACES[k]
        return np.unique(_mixed(sums))


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 32-bit minima for each set; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), _HASHES), np.uint32)
    for k in range(_HASHES):
        hashed = ((flat ^ _OFFSETS[k]) * _FACTORS[k]) >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(hashed.astype(np.uint32), starts)
    return out


def signatures(docs: DataFrame, text_col: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """`keep` and (n_shingles, node, signature, sketch) of every row.

    `node` identifies the set of shingles; it is null, like what follows, for a text without words.
    `signature` holds the hashes in big-endian order, so that bytes sort as hashes do; `sketch` the
    low byte of each.
    """

    def make():
        shingler = Shingler()

        def work(texts):
            sets = shingler(texts)
            full = [s for s in sets if len(s)]
            hashes = min_hashes(full) if full else np.zeros((0, _HASHES), np.uint32)
            rows = iter(hashes.astype(">u4"))
            sketches = iter(hashes.astype(np.uint8))
            nodes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
            return [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(nodes, pa.int64()),
                pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([next(sketches).tobytes() if len(s) else None for s in sets], pa.binary()),
            ]

        return work

    as_bytes = docs.withColumn(text_col, F.col(text_col).cast("binary"))
    added = "n_shingles long, node long, signature binary, sketch binary"
    return map_texts(as_bytes, make, added, text_col, keep)


# -- candidates -------------------------------------------------------------------------------


def least_matches(percent: int) -> int:
    """Hashes that two signatures must share to be candidates."""
    p = percent / 100
    return max(1, int(_HASHES * p - DEVIATIONS * (_HASHES * p * (1 - p)) ** 0.5))


def regions(keys: np.ndarray, crowd: int = CROWD) -> list[tuple[int, int]]:
    """Runs of at least two rows of the sorted keys that share a prefix of adaptive depth."""
    out, todo = [], [(0, len(keys), LEAST_DEPTH)]
    while todo:
        begin, end, depth = todo.pop()
        part = keys[begin:end, :depth]
        cuts = np.flatnonzero((part[1:] != part[:-1]).any(1)) + 1
        bounds = np.concatenate([[0], cuts, [end - begin]])
        sizes = np.diff(bounds)
        for k in np.flatnonzero(sizes > 1).tolist():
            run = (begin + int(bounds[k]), begin + int(bounds[k + 1]))
            if sizes[k] > crowd and depth < DEPTH:
                todo.append((*run, depth + 1))
            else:
                out.append(run)
    return out


def _agreeing(sketch, sizes, rows, others, percent, least):
    """How many hashes each of `rows` shares with each of `others`; 0 if they can't be linked."""
    same = (sketch[rows, None, :] == sketch[None, others, :]).sum(2, dtype=np.int16)
    low = np.minimum(sizes[rows, None], sizes[None, others])
    high = np.maximum(sizes[rows, None], sizes[None, others])
    same[(same < least) | (low * 100 < high * percent)] = 0
    return same


def best_partners(node, sizes, sketch, run, percent, least):
    """For each row of a region that has a candidate, the one that agrees most."""
    begin, end = run
    others, step = np.arange(begin, end), max(1, (1 << 22) // ((end - begin) * _HASHES))
    for at in range(begin, end, step):
        rows = np.arange(at, min(end, at + step))
        same = _agreeing(sketch, sizes, rows, others, percent, least)
        same[np.arange(len(rows)), rows - begin] = 0
        best = same.argmax(1)
        most = same[np.arange(len(rows)), best]
        for i in np.flatnonzero(most).tolist():
            yield node[rows[i]], node[others[best[i]]], int(most[i])


def open_rows(sizes, sketch, group, run, percent, least):
    """Rows of a region that have a candidate in another group."""
    begin, end = run
    if (group[begin:end] == group[begin]).all():
        return
    others, step = np.arange(begin, end), max(1, (1 << 22) // ((end - begin) * _HASHES))
    for at in range(begin, end, step):
        rows = np.arange(at, min(end, at + step))
        same = _agreeing(sketch, sizes, rows, others, percent, least)
        same[group[rows, None] == group[None, others]] = 0
        yield from rows[same.any(1)].tolist()


def linked_pairs(sets: list[np.ndarray], percent: int, block: int = 512):
    """Index pairs i < j of sets that are similar enough, by sizes of all intersections.

    Sets are rows of a matrix with a column for each shingle that two of them have; the products of
    its rows count what they share. The matrix is taken in blocks of rows and columns.
    """
    flat = np.concatenate(sets)
    sizes = np.asarray([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, n = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(n > 1) - 1
    common = n[column] > 1
    row, column = row[common], number[column[common]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = int(column[-1]) + 1 if len(column) else 0
    wide = max(256, (8 << 20) // max(1, len(sets)))
    for top in range(0, len(sets), block):
        height = min(block, len(sets) - top)
        shared = np.zeros((height, len(sets)), np.float32)
        for left in range(0, width, wide):
            a, b = np.searchsorted(column, [left, left + wide])
            part = np.zeros((len(sets), min(wide, width - left)), np.float32)
            part[row[a:b], column[a:b] - left] = 1
            shared += part[top : top + height] @ part.T
        either = sizes[top : top + height, None] + sizes[None] - shared
        for i, j in zip(*np.nonzero(100 * shared >= percent * either), strict=True):
            if top + i < j:
                yield top + int(i), int(j)


def _tree_rows(sets: DataFrame, *more: str) -> DataFrame:
    """One row for each set and tree, with the tree's hashes."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = sets.select("node", "n_shingles", "sketch", "signature", *more, tree)
    key = F.substring("signature", F.col("tree") * 4 * DEPTH + 1, F.lit(4 * DEPTH))
    return rows.select("tree", key.alias("key"), "node", "n_shingles", "sketch", *more)


def _crowded(sets: DataFrame) -> list[DataFrame]:
    """(tree, prefix, n) of the regions of more than `CROWD` rows, for each depth that has any."""
    rows, out = _tree_rows(sets).select("tree", "key"), []
    for depth in range(LEAST_DEPTH - 1, DEPTH):
        rows = rows.withColumn("prefix", F.substring("key", 1, 4 * depth))
        found = rows.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n")).where(f"n > {CROWD}")
        found = stored(found, "crowded-regions")
        if found.isEmpty():
            break
        out.append(found)
        rows = rows.join(F.broadcast(found.drop("n")), ["tree", "prefix"], "left_semi").drop("prefix")
    return out


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of one `deal` side by side in one task."""
    return rows.repartition("deal").sortWithinPartitions("deal", "node")


def _in_regions(rows: DataFrame, crowded: list[DataFrame]) -> DataFrame:
    """The rows with `deal`: two rows of a region have at least one deal in common."""
    names = [c for c in rows.columns if c not in ("tree", "key")]
    rows = rows.withColumn("depth", F.lit(LEAST_DEPTH - 1)).withColumn("chunks", F.lit(1))
    for depth, found in enumerate(crowded, LEAST_DEPTH - 1):
        rows = rows.withColumn("prefix", F.substring("key", 1, 4 * depth))
        rows = rows.join(F.broadcast(found), ["tree", "prefix"], "left")
        if depth < DEPTH - 1:
            rows = rows.withColumn("depth", F.when(F.col("n").isNull(), F.col("depth")).otherwise(depth + 1))
        else:
            rows = rows.withColumn("chunks", F.coalesce(F.ceil(F.col("n") / CROWD).cast("int"), F.lit(1)))
        rows = rows.drop("prefix", "n")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("own")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    rows = rows.select("tree", "key", "depth", own, other, *names)
    numbers = [F.col("tree"), F.least("own", "other"), F.greatest("own", "other")]
    numbers = [F.unhex(F.lpad(F.hex(n), 8, "0")) for n in numbers]
    deal = F.concat(*numbers, F.expr("substring(key, 1, 4 * depth)")).alias("deal")
    return _dealt(rows.select(deal, *names))


def _sorted_part(batches) -> tuple[pa.Table | None, list[tuple[int, int]]]:
    """A task's rows, and its runs of at least two rows of one deal."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return None, []
    table = pa.Table.from_batches(held)
    deals, found, begin = table["deal"].to_pylist(), [], 0
    for i in range(1, len(deals) + 1):
        if i == len(deals) or deals[i] != deals[begin]:
            if i - begin > 1:
                found.append((begin, i))
            begin = i
    return table, found


def _compared(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, _HASHES)
    return table["n_shingles"].to_numpy(), sketch


def _best(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, matches): b agrees most with a, of all in a region of a's."""
    least = least_matches(percent)

    def run(batches):
        table, found = _sorted_part(batches)
        if table is None:
            return
        (sizes, sketch), node = _compared(table), table["node"].to_numpy()
        pairs = [p for run in found for p in best_partners(node, sizes, sketch, run, percent, least)]
        flat = np.asarray(pairs, np.int64).reshape(-1, 3)
        columns = [pa.array(np.ascontiguousarray(c)) for c in flat.T]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "matches"])

    return rows.mapInArrow(run, "a long, b long, matches long")


def _open(rows: DataFrame, percent: int) -> DataFrame:
    """(deal, node): where a node still has a candidate in another component."""
    least = least_matches(percent)

    def run(batches):
        table, found = _sorted_part(batches)
        if table is None:
            return
        (sizes, sketch), group = _compared(table), table["component"].to_numpy()
        at = [i for run in found for i in open_rows(sizes, sketch, group, run, percent, least)]
        out = table.select(["deal", "node"]).take(pa.array(at, pa.int64()))
        yield from out.to_batches()

    return rows.mapInArrow(run, "deal binary, node long")


def _joined_in_regions(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what is linked within regions, from rows with texts."""

    def run(batches):
        table, found = _sorted_part(batches)
        if table is None:
            return
        node, shingler, ends = table["node"].to_numpy(), Shingler(), []
        for begin, end in found:
            texts = table["text"].slice(begin, end - begin).to_pylist()
            parent = list(range(end - begin))

            def root(i, parent=parent):
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            for i, j in linked_pairs(shingler(texts), percent):
                a, b = root(i), root(j)
                if a != b:
                    parent[b] = a
                    ends.append((node[begin + i], node[begin + j]))
        flat = np.asarray(ends, np.int64).reshape(-1, 2)
        columns = [pa.array(np.ascontiguousarray(c)) for c in flat.T]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


# -- confirmation -----------------------------------------------------------------------------


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b")

    def run(batches):
        shingler, known = Shingler(), OrderedDict()

        def full_set(node, text):
            if node not in known:
                known[node] = shingler([text.as_py()])[0]
                if len(known) > 64:
                    known.popitem(last=False)
            return known[node]

        for batch in batches:
            found = []
            columns = (batch.column(n) for n in ("a", "b", "text_a", "text_b"))
            for a, b, text_a, text_b in zip(*columns, strict=True):
                one, two = full_set(a.as_py(), text_a), full_set(b.as_py(), text_b)
                both = len(np.intersect1d(one, two, assume_unique=True))
                if both * 100 >= percent * (len(one) + len(two) - both):
                    found.append((a.as_py(), b.as_py()))
            ends = [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Two documents are linked if 100 * |both sets| >= percent * |either set|; `component_id` is the
    smallest id that links reach, `kept` tells whether it is the row's own. Rows with equal sets
    are one node, so copies cost nothing beyond their signature.

    A null or empty text, or one without words, has no shingles and is linked with nothing. A null
    id stays null, is never the smallest, and is its own component if no id is reached. Rows that
    repeat an id are one document by id and each keeps its own text. Other columns are not read.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    kept = ("doc_id", "text_hash")
    signed = stored(signatures(hashed, "text", kept), "signatures")
    with_words = signed.where("node is not null")
    sets = with_words.select("node", "n_shingles", "signature", "sketch").dropDuplicates(["node"])

    # first pass: each set's best candidate
    crowded = _crowded(sets)
    found = _best(_in_regions(_tree_rows(sets), crowded), percent)
    best = found.groupBy("a").agg(F.max(F.struct("matches", "b")).alias("best"))
    ends = [F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")]
    chosen = stored(best.select(*ends).distinct(), "candidates")
    nodes = chosen.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sample = with_words.join(nodes, "node", "left_semi").groupBy("node")
    where = sample.agg(F.min(F.struct("doc_id", "text_hash")).alias("at"))
    wanted = where.select("node", F.col("at.doc_id").alias("id"), F.col("at.text_hash").alias("hash"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    text = F.col("text").cast("binary").alias("text")
    # a row for each repetition of the id and text would be compared with each of the other set's
    texts = hashed.join(wanted, same).select("node", text).dropDuplicates(["node"])
    texts = stored(texts, "texts")
    joined = connected(_confirmed(chosen, texts, percent))

    # second pass: candidates that are not joined yet
    component = F.coalesce("component", "node").alias("component")
    grouped = sets.join(joined, "node", "left").join(nodes, "node", "left_semi")
    grouped = grouped.select("node", "n_shingles", "signature", "sketch", component)
    unjoined = _open(_in_regions(_tree_rows(grouped, "component"), crowded), percent).join(texts, "node")
    more = stored(_joined_in_regions(_dealt(unjoined), percent), "links")
    of = lambda end: joined.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    across = more.join(of("a"), "a", "left").join(of("b"), "b", "left")
    across = across.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = connected(across).select(F.col("node").alias("component"), F.col("component").alias("top"))

    # back to documents
    named = signed.select("doc_id", "n_shingles", "node").join(joined, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node")).join(merged, "component", "left")
    named = named.withColumn("top", F.coalesce("top", "component")).select("doc_id", "n_shingles", "top")
    smallest = named.where("top is not null").groupBy("top").agg(F.min("doc_id").alias("least"))
    out = named.join(smallest, "top", "left")
    own = F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
