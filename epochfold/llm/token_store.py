"""Token ids in binary files: fixed-size blocks, transposed into planes, each plane compressed.

A file holds the ids of consecutive documents:

    magic | compressed planes of block 0, block 1, ... | compressed footer | footer length | magic

The footer is the chunk index (for each block its ids and planes, for each plane its offset and
length) and the table of documents (id, number of ids). Integers are little-endian.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from epochfold.llm.bpe import Known, Runs
from epochfold.llm.byte_bpe import BARE, cut, read_file, unkeyed
from epochfold.llm.shared import pick, shared_folder, slices

MAGIC = b"IDPLANES"
#: Ids in a block. A multiple of 8, so that bit planes fill whole bytes.
BLOCK = 1 << 16
#: Chunks of text that a task remembers the ids of.
REMEMBERED = 700_000
#: Chunks of text that the library gets in one call.
JOINED = 20_000
#: Bytes of texts that are looked up together: words repeat, so more at a time are fewer look-ups.
TOGETHER = 4 << 20


# -- blocks and planes ------------------------------------------------------------------------


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of a block from the lowest up, as many as its largest id needs.

    A byte plane has one byte of every id; a bit plane one bit of every id, eight ids a byte.
    """
    need = int(ids.max()).bit_length() if len(ids) else 0
    if bits:
        return [np.packbits((ids >> b).astype(np.uint8) & 1).tobytes() for b in range(need)]
    return [(ids >> 8 * b).astype(np.uint8).tobytes() for b in range(-(-need // 8))]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    ids = np.zeros(n, np.uint32)
    for b, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        part = np.unpackbits(raw, count=n) if bits else raw
        ids |= part.astype(np.uint32) << (b if bits else 8 * b)
    return ids


class Writer:
    """Writes one file; holds a block of ids and the footer, never all ids."""

    def __init__(self, out, bits: bool, block: int = BLOCK, level: int = 1):
        self.out, self.bits, self.block = out, bits, block
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.waiting: list[np.ndarray] = []
        self.held = self.at = self.n_tokens = 0
        self.blocks, self.planes, self.doc_ids, self.counts = [], [], [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _block(self, ids: np.ndarray) -> None:
        planes = to_planes(ids, self.bits)
        self.blocks += [len(ids), len(planes)]
        for plane in planes:
            data = self.pack(plane)
            self.planes += [self.at, len(data)]
            self._put(data)

    def add(self, doc_ids: list, flat: np.ndarray, counts: np.ndarray) -> None:
        """Documents and their ids, one document after another."""
        self.doc_ids += doc_ids
        self.counts.append(counts)
        self.n_tokens += len(flat)
        self.waiting.append(flat.astype(np.uint32))
        self.held += len(flat)
        if self.held >= self.block:
            ids = np.concatenate(self.waiting)
            whole = len(ids) - len(ids) % self.block
            for i in range(0, whole, self.block):
                self._block(ids[i : i + self.block])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        known = np.asarray([d is not None for d in self.doc_ids], np.uint8)
        ids = np.asarray([d or 0 for d in self.doc_ids], np.int64)
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts]).astype(np.int64)
        head = struct.pack("<4q", len(self.blocks) // 2, len(self.planes) // 2, len(ids), self.bits)
        index = np.asarray(self.blocks + self.planes, np.int64).tobytes()
        footer = self.pack(head + index + ids.tobytes() + counts.tobytes() + known.tobytes())
        self._put(footer + struct.pack("<q", len(footer)) + MAGIC)
        self.out.close()


class Reader:
    """Reads a file by its chunk index."""

    def __init__(self, source, size: int):
        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        length, magic = struct.unpack("<q8s", self._get(size - 16, 16))
        if magic != MAGIC:
            raise ValueError("not a file of token ids, or cut short")
        footer = self.unpack(self._get(size - 16 - length, length))
        n_blocks, n_planes, n_docs, bits = struct.unpack_from("<4q", footer)
        numbers = np.frombuffer(footer, np.int64, 2 * (n_blocks + n_planes + n_docs), 32)
        self.bits = bool(bits)
        self.blocks = numbers[: 2 * n_blocks].reshape(-1, 2)
        self.planes = numbers[2 * n_blocks : 2 * (n_blocks + n_planes)].reshape(-1, 2)
        ids, self.counts = numbers[2 * (n_blocks + n_planes) :].reshape(2, -1)
        known = np.frombuffer(footer, np.uint8, n_docs, len(footer) - n_docs)
        self.doc_ids = [d if k else None for d, k in zip(ids.tolist(), known, strict=True)]

    def _get(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def __iter__(self) -> Iterator[np.ndarray]:
        """The blocks' ids."""
        first = np.cumsum(self.blocks[:, 1]) - self.blocks[:, 1]
        for (n, n_planes), begin in zip(self.blocks.tolist(), first.tolist(), strict=True):
            where = self.planes[begin : begin + n_planes].tolist()
            yield from_planes([self.unpack(self._get(*w)) for w in where], n, self.bits)

    def documents(self, most: int = 1 << 20) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """Runs of documents with about `most` ids: doc ids, all their ids, counts."""
        blocks, held, begin = iter(self), np.zeros(0, np.uint32), 0
        ends = np.cumsum(self.counts)
        while begin < len(self.counts):
            base = ends[begin] - self.counts[begin]
            end = max(begin + 1, int(np.searchsorted(ends, base + most, "right")))
            need, parts = int(ends[end - 1] - base), [held]
            have = len(held)
            while have < need:
                parts.append(next(blocks))
                have += len(parts[-1])
            ids = np.concatenate(parts)
            yield self.doc_ids[begin:end], ids[:need], self.counts[begin:end]
            held, begin = ids[need:], end


# -- encoding with the library ----------------------------------------------------------------


class LibraryEncoder:
    """The tokenizers library, asked once for each chunk of text that a task meets."""

    def __init__(self, source: str, end_id: int | None, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items() if t.special and not (t.lstrip or t.rstrip)}
        if not self.special or len(self.special) < len(added):
            raise ValueError("only plain special tokens are supported, and there must be one")
        self.sizes = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.sizes[i] = len(token)  # byte-level: a letter for each byte
        self.end_id, self.known = end_id, Known(self._ids, remembered)

    def _ids(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks, in runs of many.

        Chunks that begin with a space and hold no special token go to the library as one text,
        which it would cut between them anyway. All others are encoded apart from each other.
        """
        runs, order, at = Runs(), np.zeros(len(keys), np.int64), 0
        bare = np.fromiter((key[:1] == BARE for key in keys), bool, len(keys))
        for some, encode in ((np.flatnonzero(~bare), self._as_text), (np.flatnonzero(bare), self._marked)):
            for begin in range(0, len(some), JOINED):
                chosen = some[begin : begin + JOINED]
                runs.add(*encode([keys[i] for i in chosen.tolist()]))
                order[chosen] = np.arange(at, at + len(chosen))
                at += len(chosen)
        return runs(order)

    def _as_text(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of keys as one text; every chunk has to end where an id ends."""
        text = " " + " ".join(keys)
        if any(s in text for s in self.special):
            return self._marked(keys)
        (found,) = self.library.encode_batch_fast([text], add_special_tokens=False)
        ids = np.asarray(found.ids, np.int32)
        ends = np.cumsum(np.asarray(pc.binary_length(pa.array(keys, pa.string())), np.int64) + 1)
        reached = np.cumsum(self.sizes[ids])
        last = np.searchsorted(reached, ends)
        if last[-1] + 1 != len(ids) or not np.array_equal(reached[last], ends):
            return self._marked(keys)
        return ids, np.diff(last, prepend=-1)

    def _marked(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks with a special token between them.

        The library cuts a text at special tokens before all else, so what lies between them is
        encoded as it is alone. Chunks that hold such tokens themselves are encoded one by one.
        """
        between, mark = next(iter(self.special.items()))
        encode, run = self.library.encode_batch_fast, list(map(unkeyed, keys))
        if any(s in text for s in self.special for text in run):
            found = [e.ids for e in encode(run, add_special_tokens=False)]
            flat = np.concatenate([np.zeros(0, np.int32), *(np.asarray(x, np.int32) for x in found)])
            return flat, np.asarray(list(map(len, found)), np.int64)
        (found,) = encode([between.join(run)], add_special_tokens=False)
        ids = np.asarray(found.ids, np.int32)
        marks = np.flatnonzero(ids == mark)
        return ids[ids != mark], np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each text has."""
        flat, counts = self.known.grouped(cut(texts, self.special))
        if self.end_id is None:
            return flat, counts
        return np.insert(flat, np.cumsum(counts), self.end_id), counts + 1


@lru_cache(maxsize=1)
def library_encoder(source: str, end_id: int | None) -> LibraryEncoder:
    """One for all tasks of a worker process, with what it remembers."""
    return LibraryEncoder(source, end_id)


# -- Spark: write and read --------------------------------------------------------------------


def write(
    df: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = None,
    bits: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the ids of all texts in ascending id order; return the list of files.

    A range shuffle orders the documents (null ids first, equal ids by the text's hash), and each
    task writes one file, named anew at each attempt. Only files of attempts that succeeded are in
    the list, which is stored beside them: (file, part, n_docs, n_tokens), one row a file.
    """
    spark = df.sparkSession
    source = spark.sparkContext.broadcast(read_file(tokenizer))
    filesystem, base = pafs.FileSystem.from_uri(folder)
    filesystem.create_dir(f"{base}/ids", recursive=True)
    rows = pick(df, id_col, text_col).withColumn("tie", F.xxhash64(text_col))
    ordered = rows.repartitionByRange(id_col, "tie").sortWithinPartitions(id_col, "tie")

    def run(batches):
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
        files, at = pafs.FileSystem.from_uri(folder)
        writer = encoder = None
        for batch in batches:
            for piece in slices(batch, most=TOGETHER):
                if writer is None:
                    encoder = library_encoder(source.value, end_id)
                    writer = Writer(files.open_output_stream(f"{at}/ids/{name}"), bits)
                flat, counts = encoder(piece.column(1))
                writer.add(piece.column(0).cast(pa.int64()).to_pylist(), flat, counts)
        if writer is not None:
            writer.close()
            row = {"file": [name], "part": [part], "n_docs": [len(writer.doc_ids)]}
            yield pa.RecordBatch.from_pydict(row | {"n_tokens": [writer.n_tokens]})

    listed = "file string, part long, n_docs long, n_tokens long"
    ordered.mapInArrow(run, listed).write.parquet(f"{folder}/files")
    return spark.read.schema(listed).parquet(f"{folder}/files")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): from the files, ids as little-endian 32-bit integers.

    `start` counts the ids of all documents before; it needs the file list only.
    """
    files = spark.read.parquet(f"{folder}/files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    started = files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    dealt = started.select("file", "start").repartition(max(1, files.count()))

    def run(batches):
        store, at = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{at}/ids/{row['file']}"
                with store.open_input_file(path) as f:
                    start = row["start"]
                    for docs, flat, counts in Reader(f, f.size()).documents():
                        ends = np.cumsum(counts)
                        raw = flat.astype("<u4").tobytes()
                        cuts = zip((ends - counts).tolist(), ends.tolist(), strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(docs, pa.int64()),
                                pa.array(start + ends - counts),
                                pa.array(counts),
                                pa.array([raw[4 * a : 4 * b] for a, b in cuts], pa.binary()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )
                        start += int(ends[-1])

    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def digests(stored: DataFrame) -> DataFrame:
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(df: DataFrame, tokenizer: str, end_id: int | None, bits: bool = False) -> DataFrame:
    """Write a new set of files in the shared folder and read it back.

    One row for each row of `df`; a null or empty text has only the end id; an empty table has no
    files and no rows. Columns other than doc_id and text are not read.
    """
    folder = shared_folder(df.sparkSession, "token-ids")
    write(df, folder, tokenizer, end_id, bits)
    return read(df.sparkSession, folder)
