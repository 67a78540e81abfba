"""BPE encoding with an index of pair occurrences, and decoding."""

from __future__ import annotations

from collections.abc import Callable
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochfold.llm.byte_bpe import SHIFT, Vocabulary, cut, read_file, unkeyed, vocabulary
from epochfold.llm.shared import map_texts, pick

#: Chunks of text, and words, that a task remembers.
REMEMBERED = 300_000


def merge_words(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, one after another, and how many each word has.

    All words lie in one array of symbols. An index maps each pair of neighbouring symbols to all
    its positions; ranks that have positions wait in a heap. The lowest rank is applied at all its
    positions from left to right, and the pairs that appear next to a merged symbol are entered
    into the index. Entries that a merge has made obsolete are recognised when they are read.
    """
    rank_of, rules = vocab.rank_of, vocab.rules
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    raw = np.frombuffer(b"".join(words), np.uint8)
    if not len(raw):
        return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
    ids = np.asarray(vocab.byte_ids, np.int64)[raw]
    after = np.arange(1, len(ids) + 1)
    after[ends[lengths > 0] - 1] = -1
    before = np.arange(-1, len(ids) - 1)
    before[(ends - lengths)[lengths > 0]] = -1

    first = np.flatnonzero(after >= 0)
    keys = ids[first] << SHIFT | ids[first + 1]
    order = np.argsort(keys, kind="stable")
    found, starts = np.unique(keys[order], return_index=True)
    places = np.split(first[order], starts[1:]) if len(found) else []
    #: rank -> positions of the left symbols of its pair
    positions = {
        rank_of[key]: at.tolist()
        for key, at in zip(found.tolist(), places, strict=True)
        if key in rank_of
    }
    heap = list(positions)
    heapify(heap)

    symbol, after, before = ids.tolist(), after.tolist(), before.tolist()
    while heap:
        rank = heappop(heap)
        left, right, merged = rules[rank]
        shifted = merged << SHIFT
        for at in sorted(positions.pop(rank)):
            if symbol[at] != left:
                continue
            gone = after[at]
            if gone < 0 or symbol[gone] != right:
                continue
            symbol[at], symbol[gone] = merged, -1
            follow = after[at] = after[gone]
            if follow >= 0:
                before[follow] = at
                key = shifted | symbol[follow]
                if key in rank_of:
                    new = rank_of[key]
                    if new in positions:
                        positions[new].append(at)
                    else:
                        positions[new] = [at]
                        heappush(heap, new)
            ahead = before[at]
            if ahead >= 0:
                key = symbol[ahead] << SHIFT | merged
                if key in rank_of:
                    new = rank_of[key]
                    if new in positions:
                        positions[new].append(ahead)
                    else:
                        positions[new] = [ahead]
                        heappush(heap, new)

    symbol = np.asarray(symbol, np.int32)
    left = symbol >= 0
    counts = np.zeros(len(words), np.int64)
    counts[lengths > 0] = np.add.reduceat(left, (ends - lengths)[lengths > 0], dtype=np.int64)
    return symbol[left], counts


class Runs:
    """Runs of ids, known by the number they were added under."""

    def __init__(self):
        self.flat = np.zeros(0, np.int32)
        self.starts = self.counts = np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        starts = np.cumsum(counts) - counts + len(self.flat)
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, starts])
        self.counts = np.concatenate([self.counts, counts])

    def __call__(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these runs, one after another, and how many each has."""
        counts = self.counts[numbers]
        shift = self.starts[numbers] - (np.cumsum(counts) - counts)
        return self.flat[np.arange(counts.sum()) + np.repeat(shift, counts)], counts


def totals(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over neighbouring groups of these sizes; an empty group has 0."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


class Known:
    """Runs of ids by the text they stand for: a task's memory, with a bound.

    Beyond the bound, texts that only one call needed are forgotten, and all if that is not enough.
    Nothing depends on what is remembered but the time taken.
    """

    def __init__(self, learn: Callable, bound: int):
        #: From a list of new texts to their ids, one after another, and how many each has.
        self.learn, self.bound = learn, bound
        self.numbers: dict[str, int] = {}
        self.runs, self.uses = Runs(), np.zeros(0, np.int32)

    def add(self, texts: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        self.runs.add(flat, counts)
        self.numbers.update(zip(texts, range(len(self.numbers), 1 << 62)))
        self.uses = np.concatenate([self.uses, np.zeros(len(texts), np.int32)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, one after another, and how many each has; new ones are learned."""
        if len(self.numbers) > self.bound:
            self._trim()
        coded = texts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.numbers.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            new = [distinct[i] for i in missing]
            at[missing] = np.arange(len(missing)) + len(self.numbers)
            self.add(new, *self.learn(new))
        self.uses[at] += 1
        return self.runs(at[np.asarray(coded.indices)])

    def grouped(self, texts: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """As a call, with one count for each list."""
        flat, counts = self(texts.flatten())
        return flat, totals(counts, np.asarray(pc.list_value_length(texts), np.int64))

    def _trim(self) -> None:
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > self.bound // 2:
            keep = keep[:0]
        texts = list(self.numbers)
        texts, (flat, counts) = [texts[i] for i in keep.tolist()], self.runs(keep)
        self.numbers, self.runs, self.uses = {}, Runs(), np.zeros(0, np.int32)
        self.add(texts, flat, counts)


class Encoder:
    """Encodes texts; remembers chunks and words."""

    def __init__(self, vocab: Vocabulary, remembered: int = REMEMBERED):
        self.vocab = vocab
        self.pieces = Known(self._pieces, remembered)
        self.words = Known(self._words, remembered)

    def _words(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = self.vocab.special
        if not special.keys().isdisjoint(new):
            one = [w for w in new if w in special]
            rest = dict(zip(one, ([special[w]] for w in one), strict=True))
            plain = [w for w in new if w not in special]
            flat, counts = merge_words([w.encode() for w in plain], self.vocab)
            runs = np.split(flat, np.cumsum(counts)[:-1]) if plain else []
            rest.update(zip(plain, runs, strict=True))
            ids = [np.asarray(rest[w], np.int32) for w in new]
            return np.concatenate(ids), np.asarray(list(map(len, ids)), np.int64)
        return merge_words([w.encode() for w in new], self.vocab)

    def _pieces(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = self.vocab.parts
        return self.words.grouped(pa.array([parts(unkeyed(key)) for key in new], pa.list_(pa.string())))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each text has."""
        return self.pieces.grouped(cut(texts, self.vocab.special))


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text, as the tokenizers library encodes it.

    One row for each row of `df`, equal rows included; a null or empty text has no ids. Columns
    other than the two named are not read, whatever their names.
    """
    source = df.sparkSession.sparkContext.broadcast(read_file(tokenizer))

    def make():
        encoder = Encoder(vocabulary(source.value))

        def work(texts):
            return [_lists(*encoder(texts))]

        return work

    rows = pick(df, id_col, text_col)
    return map_texts(rows, make, "ids array<int>", text_col, (id_col,), arrow=True)


class Decoder:
    """Texts of lists of ids; special tokens are kept."""

    def __init__(self, vocab: Vocabulary):
        self.table = np.full(max(vocab.bytes_of) + 1, b"", object)
        for i, data in vocab.bytes_of.items():
            self.table[i] = data

    def __call__(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        parts = self.table[np.where((flat >= 0) & (flat < len(self.table)), flat, 0)]
        parts[(flat < 0) | (flat >= len(self.table))] = b""
        ends = np.cumsum(counts)
        runs = zip((ends - counts).tolist(), ends.tolist(), strict=True)
        return [b"".join(parts[a:b].tolist()).decode("utf-8", "replace") for a, b in runs]


def decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, text) of every list of ids; special tokens are kept.

    A null list gives an empty text; bytes that are no UTF-8 give U+FFFD; an id that the vocabulary
    lacks gives nothing, as in the library.
    """
    source = df.sparkSession.sparkContext.broadcast(read_file(tokenizer))
    rows = pick(df, id_col, ids_col)
    kind = rows.schema[0].dataType.simpleString()

    def run(batches):
        decoder = Decoder(vocabulary(source.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = part.column(1)
                counts = np.asarray(pc.fill_null(pc.list_value_length(ids), 0), np.int64)
                texts = decoder(np.asarray(ids.flatten()), counts)
                out = [part.column(0), ids, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(out, names=[id_col, ids_col, "text"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, `{ids_col}` array<int>, text string")


def round_trip(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids, text) as `decode` after `encode`, in one pass: the text is made from the ids."""
    source = df.sparkSession.sparkContext.broadcast(read_file(tokenizer))

    def make():
        encoder, decoder = Encoder(vocabulary(source.value)), Decoder(vocabulary(source.value))

        def work(texts):
            flat, counts = encoder(texts)
            decoded = pa.array(decoder(flat, counts), pa.string())
            return [_lists(flat, counts), decoded]

        return work

    rows = pick(df, id_col, text_col)
    return map_texts(rows, make, "ids array<int>, text string", text_col, (id_col,), arrow=True)


def digests(decoded: DataFrame) -> DataFrame:
    """The outputs of `decode` as counts and digests."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
