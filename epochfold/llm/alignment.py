"""Alignment of two tokenizers' tokens by the bytes they cover.

Tokens and bytes form an incidence matrix for each tokenizer, A and B, in compressed rows: a token's
row has the bytes that it covers. The rows of A Bᵀ, computed as Gustavson does, one row of A gathering
the rows of Bᵀ that it points to, are the links: pairs of tokens that overlap, with the bytes that they
share. Places where tokens of both end cut a text into groups, and the same product of two incidence
matrices of tokens and groups links the tokens of a group.

How often a pair of ids is linked is counted over the corpus by joins. A task emits its pairs for
slices of bounded size, so the joins see each pair once a slice and never once a link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from epochfold.llm.bpe import totals
from epochfold.llm.byte_bpe import SPLIT, Vocabulary, read_file
from epochfold.llm.shared import pick, release, slices, stored

#: Bytes of text in a slice, whose pairs are counted together; a longer text is a slice of its own.
SLICE = 8 << 20
#: Entries that a product expands at a time.
ENTRIES = 1 << 20
#: An id pair is one integer: the id of A so many bits higher.
SHIFT = 32


class Csr:
    """A sparse matrix of counts in compressed rows; `data` is None if all entries are 1."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, width: int, data: np.ndarray | None = None):
        self.starts, self.columns, self.width, self.data = starts, columns, width, data

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self, first: int, last: int) -> Csr:
        a, b = self.starts[first], self.starts[last]
        data = None if self.data is None else self.data[a:b]
        return Csr(self.starts[first : last + 1] - a, self.columns[a:b], self.width, data)

    def transposed(self) -> Csr:
        """By a counting sort of the entries by column."""
        row = np.repeat(np.arange(self.height), np.diff(self.starts))
        order = slice(None) if _ascending(self.columns) else np.argsort(self.columns, kind="stable")
        counts = np.bincount(self.columns, minlength=self.width)
        data = None if self.data is None else self.data[order]
        return Csr(np.concatenate([[0], np.cumsum(counts)]), row[order], self.height, data)

    def products(self, other: Csr, most: int = ENTRIES) -> Iterator[tuple[int, Csr]]:
        """This matrix times `other`, in runs of rows: (first row, its rows of the product).

        For each entry of a row, that entry's row of `other` is gathered; equal columns of a row are
        then added up. A run of rows gathers about `most` entries, or is one row.
        """
        gathered = np.diff(other.starts)[self.columns]
        upto = np.concatenate([[0], np.cumsum(gathered)])[self.starts]
        first = 0
        while first < self.height:
            last = int(np.searchsorted(upto, upto[first] + most, "right")) - 1
            last = min(max(last, first + 1), self.height)
            yield first, self.rows(first, last)._times(other)
            first = last

    def _times(self, other: Csr) -> Csr:
        sizes = np.diff(other.starts)[self.columns]
        row = np.repeat(np.arange(self.height), np.diff(self.starts))
        at, data = other.starts[self.columns], self.data
        if (sizes != 1).any():
            at = np.arange(sizes.sum()) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)
            row = np.repeat(row, sizes)
            data = None if data is None else np.repeat(data, sizes)
        column = other.columns[at]
        if other.data is not None:
            data = other.data[at] if data is None else data * other.data[at]
        key = row * other.width + column
        if not _ascending(key):
            order = np.argsort(key, kind="stable")
            key, row, column = key[order], row[order], column[order]
            data = None if data is None else data[order]
        new = np.flatnonzero(_begins(key))
        sums = np.diff(np.append(new, len(key)))
        if data is not None and len(new):
            sums = np.add.reduceat(data, new)
        counts = np.bincount(row[new], minlength=self.height)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), column[new], other.width, sums)


def _ascending(values: np.ndarray) -> bool:
    return bool((values[1:] >= values[:-1]).all())


def _begins(values: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


def incidence(ends: np.ndarray) -> Csr:
    """Tokens that end at these bytes, one after another, by the bytes they cover."""
    starts = np.concatenate([[0], ends])
    return Csr(starts, np.arange(starts[-1]), int(starts[-1]))


def membership(groups: np.ndarray, n: int) -> Csr:
    """Tokens by the group that each is in."""
    return Csr(np.arange(len(groups) + 1), groups, n)


class Bytes:
    """The bytes of each id of a vocabulary."""

    def __init__(self, parts: dict[int, bytes]):
        self.parts = np.full(max(parts) + 1, b"", object)
        for i, data in parts.items():
            self.parts[i] = data
        self.sizes = np.array(list(map(len, self.parts)), np.int64)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(self.parts[ids].tolist())


class ByteLevel:
    """Side A: a byte-level BPE; special tokens' strings in a text are plain text."""

    def __init__(self, source: str):
        vocab = Vocabulary(source)
        plain = {i: data for i, data in vocab.bytes_of.items() if i not in vocab.special.values()}
        self.bytes = Bytes(vocab.bytes_of)
        # the same merges, by the rank of what they give: several times as fast as the library
        pattern = SPLIT.replace(r"\p{White_Space}", r"\s").replace(r"\P{White_Space}", r"\S")
        ranks = {data: i for i, data in plain.items()}
        self.fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.source, self.exact = source, None

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except ValueError:  # runs of white space that its splitting rule has no room for
            if self.exact is None:
                self.exact = Tokenizer.from_str(self.source)
                self.exact.no_truncation()
                self.exact.no_padding()
                self.exact.encode_special_tokens = True
            return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """Side B: pieces of white-space-marked text, with bytes for what has no piece."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        parts = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            is_byte = self.model.is_byte(i)
            parts[i] = bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()
        self.bytes = Bytes(parts)

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _tokenizers(a_source: str, b_model: bytes) -> tuple[ByteLevel, Pieces]:
    """Read once a worker process."""
    return ByteLevel(a_source), Pieces(b_model)


class Tokens:
    """The tokens of some texts, one text after another. A text without tokens has no bytes."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, sizes: tuple):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        self.a_ends, self.b_ends = np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b])
        ends = np.zeros(int(self.a_ends[-1]) + 1 if len(a) else 1, bool)
        ends[self.a_ends] = True
        self.cuts = self.b_ends[ends[self.b_ends]]
        ends[:] = False
        ends[self.cuts] = True
        upto = np.cumsum(ends, dtype=np.int32)
        self.a_group, self.b_group = upto[self.a_ends - 1], upto[self.b_ends - 1]
        self.a_text = np.repeat(np.arange(len(n_a)), n_a)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Tokens of A and of B that overlap, and by how many bytes: A Bᵀ, a window of bytes at a time."""
        starts = np.concatenate([[0], self.a_ends])
        first = 0
        while first < len(self.a):
            last = int(np.searchsorted(starts, starts[first] + ENTRIES, "right")) - 1
            last = max(last, first + 1)
            begin, end = starts[first], starts[last]
            b_first = np.searchsorted(self.b_ends, begin, "right")
            b_last = np.searchsorted(self.b_ends, end) + 1
            b_ends = np.minimum(self.b_ends[b_first:b_last], end)
            left, right = incidence(self.a_ends[first:last] - begin), incidence(b_ends - begin)
            for i, j, n in _pairs(left, right.transposed()):
                yield first + i, b_first + j, n
            first = last

    def shared(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Tokens of A and of B in one group."""
        n = len(self.cuts)
        yield from _pairs(membership(self.a_group, n), membership(self.b_group, n).transposed())

    def keys(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The id pair of every link, and its text."""
        for i, j, _ in self.links():
            yield self.a[i] << SHIFT | self.b[j], self.a_text[i]

    def n_groups(self) -> np.ndarray:
        return np.bincount(self.a_text[_ends(self.a_group)], minlength=len(self.n_a))

    def digests(self, names: np.ndarray) -> list[str]:
        """SHA-256 of `a1,a2|b1;...` for each text; an empty string for one without tokens.

        The ids of both sides are laid out as they are written, each with what follows it.
        """
        n, size = len(self.cuts), len(names) // 3
        in_a, in_b = np.bincount(self.a_group, minlength=n), np.bincount(self.b_group, minlength=n)
        a_at = np.arange(len(self.a)) + (np.cumsum(in_b) - in_b)[self.a_group]
        b_at = np.arange(len(self.b)) + np.cumsum(in_a)[self.b_group]
        words = np.empty(len(self.a) + len(self.b), np.int64)
        words[a_at] = self.a + size * _ends(self.a_group)
        words[b_at] = self.b + 2 * size * _ends(self.b_group)
        ends = np.cumsum(self.n_a + self.n_b)
        out = []
        for begin, end in zip((ends - self.n_a - self.n_b).tolist(), ends.tolist(), strict=True):
            if begin == end:
                out.append("")
                continue
            digest = hashlib.sha256()
            for at in range(begin, end, ENTRIES):
                line = "".join(names[words[at : min(at + ENTRIES, end)]].tolist())
                digest.update((line[:-1] if at + ENTRIES >= end else line).encode())
            out.append(digest.hexdigest())
        return out


def _pairs(left: Csr, right: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for first, rows in left.products(right):
        yield first + np.repeat(np.arange(rows.height), np.diff(rows.starts)), rows.columns, rows.data


def tokenize(texts: list[str | None], a: ByteLevel, b: Pieces) -> Tokens:
    """Both sides' tokens of a space and each text; none if the tokens do not spell that."""
    texts = [t or "" for t in texts]
    nothing = np.zeros(0, np.int64)
    left = [a(" " + t) if t else nothing for t in texts]
    right = [np.array(ids, np.int64) if t else nothing for ids, t in zip(b(texts), texts, strict=True)]

    spelled = [f" {t}".encode() if t else b"" for t in texts]
    sizes = np.array(list(map(len, spelled)), np.int64)
    for vocabulary, side in ((a.bytes, left), (b.bytes, right)):
        flat, counts = _flat(side)
        same = (totals(vocabulary.sizes[flat], counts) == sizes).all()
        if same and vocabulary.joined(flat) == b"".join(spelled):
            continue
        for i, ids in enumerate(side):
            if vocabulary.joined(ids) != spelled[i]:
                left[i] = right[i] = nothing
                spelled[i], sizes[i] = b"", 0
    (flat_a, n_a), (flat_b, n_b) = _flat(left), _flat(right)
    return Tokens(flat_a, flat_b, n_a, n_b, (a.bytes.sizes, b.bytes.sizes))


def _flat(side: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after another, and how many each has."""
    return np.concatenate([np.zeros(0, np.int64), *side]), np.array(list(map(len, side)), np.int64)


def _ends(values: np.ndarray) -> np.ndarray:
    """Where a run of equal values ends."""
    return np.append(values[1:] != values[:-1], True)[: len(values)]


def _names(n: int) -> np.ndarray:
    """Ids below n followed by a comma, then all with a bar, then with a semicolon."""
    return np.array([f"{i}{end}" for end in ",|;" for i in range(n)], object)


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(_begins(keys))
    return keys[new], np.add.reduceat(counts, new) if len(keys) else counts


def _packed(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The ids of each text in compressed byte planes, the lowest bytes first."""
    pack = zstandard.ZstdCompressor(level=1).compress
    ends = np.cumsum(counts).tolist()
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    planes = planes[: 2 if not len(ids) or ids.max() < 1 << 16 else 4]
    out = [bytes([len(planes)]) + pack(planes[:, x:y].tobytes()) for x, y in zip([0, *ends], ends)]
    return pa.array(out, pa.binary())


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    parts, counts = [np.zeros(0, np.int64)], []
    for data in column.to_pylist():
        planes = np.frombuffer(unpack(data[1:]), np.uint8).reshape(data[0], -1)
        ids = np.zeros(planes.shape[1], np.int64)
        for i, plane in enumerate(planes):
            ids |= plane.astype(np.int64) << 8 * i
        parts.append(ids)
        counts.append(len(ids))
    return np.concatenate(parts), np.array(counts, np.int64)


class Tokenized:
    """Texts' tokens as a table, from which links, counts and digests are made.

    `texts` has (slice, id, a, b, n_groups, n_shared, groups_sha256), where a and b are ids in
    compressed byte planes and n_shared counts the pairs of tokens that share a group. `pairs`
    has (slice, a, b, n): how many links of a slice have a pair of ids.
    """

    def __init__(self, texts: DataFrame, pairs: DataFrame, read: Callable[[], tuple[ByteLevel, Pieces]]):
        self.texts, self.pairs, self.read = texts, pairs, read


def tokenized(
    df: DataFrame, a_tokenizer: str, b_tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> Tokenized:
    """Every text by both tokenizers, written to a table: one pass over the texts.

    A text that is null, empty, or not spelled by the tokens of either side has no tokens. Each row is
    a text of its own, also if ids or rows are repeated. Other columns are not read. A task's memory
    grows with the longest text, of which it holds the tokens, and with a slice's distinct pairs.
    """
    spark = df.sparkSession
    with open(b_tokenizer, "rb") as f:
        source = spark.sparkContext.broadcast((read_file(a_tokenizer), f.read()))

    def read():
        return _tokenizers(*source.value)

    rows = pick(df, id=id_col, text=text_col)
    schema = T.StructType(
        [
            *T.StructType.fromDDL("slice long, key long, n long").fields,
            T.StructField("id", rows.schema["id"].dataType),
            *T.StructType.fromDDL("a binary, b binary, n_groups long, n_shared long, groups_sha256 string").fields,
        ]
    )
    kinds = to_arrow_schema(schema)

    def filled(size: int, /, **columns) -> pa.RecordBatch:
        every = [columns.get(f.name, pa.nulls(size, f.type)) for f in kinds]
        return pa.RecordBatch.from_arrays(every, schema=kinds)

    def run(batches):
        a, b = read()
        names = _names(max(len(a.bytes.sizes), len(b.bytes.sizes)))
        number, held = TaskContext.get().partitionId() << 32, 0
        keys, counts = [], []

        def pairs():
            found, n = _counted(keys, counts)
            if len(found):
                yield filled(len(found), slice=pa.array(np.full(len(found), number)), key=pa.array(found), n=pa.array(n))

        for batch in batches:
            for part in slices(batch):
                size = part.column(1).nbytes
                if held and held + size > SLICE:
                    yield from pairs()
                    keys, counts, held, number = [], [], 0, number + 1
                held += size
                tokens = tokenize(part.column(1).to_pylist(), a, b)
                for new, _ in tokens.keys():
                    key, n = np.unique(new, return_counts=True)
                    keys.append(key)
                    counts.append(n)
                shared = np.zeros(part.num_rows, np.int64)
                for i, _, _ in tokens.shared():
                    shared += np.bincount(tokens.a_text[i], minlength=part.num_rows)
                yield filled(
                    part.num_rows,
                    slice=pa.array(np.full(part.num_rows, number)),
                    id=part.column(0).cast(kinds.field("id").type),
                    a=_packed(tokens.a, tokens.n_a),
                    b=_packed(tokens.b, tokens.n_b),
                    n_groups=pa.array(tokens.n_groups(), pa.int64()),
                    n_shared=pa.array(shared),
                    groups_sha256=pa.array(tokens.digests(names), pa.string()),
                )
        yield from pairs()
        release()

    table = stored(rows.mapInArrow(run, schema), "tokens")
    texts = table.where("a is not null").drop("key", "n")
    pairs = table.where("key is not null").select(
        "slice",
        F.shiftright("key", SHIFT).cast("int").alias("a"),
        F.col("key").bitwiseAND((1 << SHIFT) - 1).cast("int").alias("b"),
        "n",
    )
    return Tokenized(texts, pairs, read)


def links(tokens: Tokenized) -> DataFrame:
    """(id, links array<struct<a, b, bytes>>): positions of tokens that overlap in each text."""
    texts = tokens.texts.select("id", "a", "b")
    schema = T.StructType([texts.schema["id"], *T.StructType.fromDDL("links array<struct<a:long,b:long,bytes:long>>").fields])
    kinds, read = to_arrow_schema(schema), tokens.read

    def run(batches):
        a, b = read()
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                (x, n_a), (y, n_b) = _unpacked(one.column(1)), _unpacked(one.column(2))
                found = list(Tokens(x, y, n_a, n_b, (a.bytes.sizes, b.bytes.sizes)).links())
                columns = [np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]) for i in range(3)]
                kind = kinds.field("links").type.value_type
                flat = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(kind))
                lists = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([one.column(0), lists.cast(kinds.field("links").type)], schema=kinds)

    return texts.mapInArrow(run, schema)


def pair_counts(tokens: Tokenized) -> DataFrame:
    """(slice, a, b, count, best): each slice's id pairs with their links in the whole corpus.

    `best` tells that no id of A has more links with this b. A pair is one row a slice, so the sum
    over a pair has as many rows as there are slices that hold it. The highest count of each b is one
    row for each id of B's vocabulary, 32,000 here, and that is what bounds the broadcast.
    """
    whole = Window.partitionBy("a", "b")
    counted = stored(tokens.pairs.select("slice", "a", "b", F.sum("n").over(whole).alias("count")), "pairs")
    highest = counted.groupBy("b").agg(F.max("count").alias("highest"))
    counted = counted.join(F.broadcast(highest), "b")
    return counted.select("slice", "a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def report(tokens: Tokenized, id_col: str = "doc_id") -> DataFrame:
    """A row for each text: its tokens, groups and links, and how common the links' id pairs are.

    n_links counts links, n_best those whose pair has its b's highest count in the corpus, and
    count_sum adds the counts of all links' pairs. A slice's pairs and texts meet in one task, the
    pairs first; a task holds one slice's pairs and one batch of its texts.
    """
    counts = pair_counts(tokens)
    key = F.shiftleft(F.col("a").cast("long"), SHIFT).bitwiseOR(F.col("b").cast("long"))
    texts = tokens.texts
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in texts.schema.fields}
    of_text = [c for c in texts.columns if c != "slice"]
    pairs = counts.select(
        "slice", F.lit(0).alias("side"), key.alias("key"), "count", "best", *[none[c] for c in of_text]
    )
    rest = texts.select(
        "slice",
        F.lit(1).alias("side"),
        *[F.lit(None).cast(t).alias(n) for n, t in (("key", "long"), ("count", "long"), ("best", "boolean"))],
        *of_text,
    )
    mixed = pairs.unionByName(rest).repartition("slice").sortWithinPartitions("slice", "side")
    added = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_shared long"
    schema = T.StructType([texts.schema["id"], *T.StructType.fromDDL(added).fields])
    kinds, read = to_arrow_schema(schema), tokens.read

    def run(batches):
        a, b = read()
        now, held, table = None, [], None
        for batch in batches:
            numbers, sides = (np.asarray(batch.column(i), np.int64) for i in (0, 1))
            turns = np.flatnonzero((numbers[1:] != numbers[:-1]) | (sides[1:] != sides[:-1])) + 1
            for x, y in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
                part = batch.slice(x, y - x)
                if not part.num_rows:
                    continue
                if numbers[x] != now:
                    now, held, table = numbers[x], [], None
                if sides[x] == 0:
                    held.append([np.asarray(part.column(i)) for i in (2, 3)] + [np.asarray(part.column(4), bool)])
                    continue
                if table is None:
                    table = [np.concatenate([np.zeros(0, t), *(h[i] for h in held)]) for i, t in enumerate((np.int64, np.int64, bool))]
                    order = np.argsort(table[0], kind="stable")
                    table, held = [c[order] for c in table], []
                for piece in slices(part, 6, ENTRIES // 4):
                    yield _summed(piece, table, (a.bytes.sizes, b.bytes.sizes), kinds)
        release()

    return mixed.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _summed(part: pa.RecordBatch, table: list[np.ndarray], sizes: tuple, kinds: pa.Schema) -> pa.RecordBatch:
    """Rows of `report` from texts and the counts of their slice's pairs, sorted by key."""
    at = {name: i for i, name in enumerate(part.schema.names)}
    (a, n_a), (b, n_b) = _unpacked(part.column(at["a"])), _unpacked(part.column(at["b"]))
    keys, counts, best = table
    sums = np.zeros((3, part.num_rows), np.int64)
    for key, text in Tokens(a, b, n_a, n_b, sizes).keys():
        found = np.searchsorted(keys, key)
        new = np.flatnonzero(_begins(text))
        of = text[new]
        sums[0, of] += np.diff(np.append(new, len(text)))
        sums[1, of] += np.add.reduceat(best[found].astype(np.int64), new)
        sums[2, of] += np.add.reduceat(counts[found], new)
    columns = {name: part.column(i) for name, i in at.items()}
    columns |= {"n_a": pa.array(n_a), "n_b": pa.array(n_b)}
    columns |= {"n_links": pa.array(sums[0]), "n_best": pa.array(sums[1]), "count_sum": pa.array(sums[2])}
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in kinds], schema=kinds)
