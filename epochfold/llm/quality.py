"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every word has a fixed sparse random index vector. A word's own vector is the sum of the index
vectors of the words beside it, over all documents. Words are hashed into a fixed number of rows,
so the table of vectors has the same size for every corpus and can be broadcast.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochfold.llm.bpe import Known
from epochfold.llm.shared import map_texts, pick, slices

#: Rows of the table of word vectors, and their length. 4 MB as 64-bit integers, whatever the data.
BUCKETS, SIZE = 1 << 14, 32
#: Non-zero entries of an index vector, half of them -1.
NONZERO = 8
#: Words to either side that count as beside a word.
REACH = 2
#: Labelled documents that the network is fitted to, the first by hash.
SAMPLE = 6000
#: Of these, one in so many calibrates the temperature instead.
HOLD = 5
HIDDEN, EPOCHS, RATE = 32, 60, 0.004
#: Raw words that a task remembers.
REMEMBERED = 200_000

_PART = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(11)
    out = np.zeros((BUCKETS + 1, SIZE), np.int16)  # the last row, all zero, stands between texts
    for row in out[:-1]:
        places = rng.permutation(SIZE)[:NONZERO]
        row[places[::2]], row[places[1::2]] = 1, -1
    return out


class Words:
    """Texts as bucket numbers of their words and signs, case ignored."""

    def __init__(self, remembered: int = REMEMBERED):
        self.known = Known(self._buckets, remembered)

    @staticmethod
    def _buckets(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [_PART.findall(word.lower()) for word in new]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        encoded = (p.encode("utf-8", "surrogatepass") for p in chain.from_iterable(parts))
        return np.fromiter((zlib.crc32(p) % BUCKETS for p in encoded), np.int32, int(counts.sum())), counts

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of all texts, one text after another, and how many each text has."""
        return self.known.grouped(pc.utf8_split_whitespace(pc.fill_null(texts, "")))


def contexts(buckets: np.ndarray, counts: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For every word, the sum of the index vectors within reach in the same text."""
    gaps = np.cumsum(counts)
    padded = np.insert(buckets, np.repeat(gaps, REACH), BUCKETS)
    padded = np.concatenate([np.full(REACH, BUCKETS, padded.dtype), padded])
    rows = index[padded]
    sums = np.zeros((len(padded) - 2 * REACH, SIZE), np.int16)
    for step in range(2 * REACH + 1):
        if step != REACH:
            sums += rows[step : step + len(sums)]
    return sums[padded[REACH : len(padded) - REACH] != BUCKETS]


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts and context sums of all buckets over all texts: a table of a fixed size.

    Tasks add up their own texts and send one row a bucket. Sums of integers do not depend on how
    the texts are dealt, so the table is the same on every run.
    """
    columns = ["bucket", "n", *[f"v{k}" for k in range(SIZE)]]

    def run(batches):
        words, index = Words(), index_vectors()
        table = np.zeros((BUCKETS, SIZE + 1), np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                buckets, counts = words(part.column(0))
                if not len(buckets):
                    continue
                order = np.argsort(buckets.astype(np.uint16), kind="stable")
                near = contexts(buckets, counts, index)[order]
                found, starts = np.unique(buckets[order], return_index=True)
                table[found, 1:] += np.add.reduceat(near, starts, axis=0, dtype=np.int64)
                table[found, 0] += np.diff(np.append(starts, len(order)))
        rows = np.flatnonzero(table[:, 0])
        if len(rows):
            arrays = [pa.array(rows), *(pa.array(c) for c in np.ascontiguousarray(table[rows].T))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    sums = docs.select(text_col).mapInArrow(run, ", ".join(f"{c} long" for c in columns))
    added = sums.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns[1:]])
    rows = added.toArrow()
    out = np.zeros((BUCKETS, SIZE + 1), np.int64)
    if rows.num_rows:
        out[rows["bucket"].to_numpy()] = np.stack([rows[c].to_numpy() for c in columns[1:]], 1)
    return out


def weighted(table: np.ndarray) -> np.ndarray:
    """Vectors of length 1 times a weight that frequent words have little of."""
    n, sums = table[:, 0].astype(np.float64), table[:, 1:].astype(np.float64)
    share = n / max(1.0, n.sum())
    length = np.linalg.norm(sums, axis=1)
    unit = sums / np.where(length > 0, length, 1)[:, None]
    return (unit * (1e-3 / (1e-3 + share))[:, None]).astype(np.float32)


#: Mean and spread of the vectors; share of words equal to the next, and of distinct words;
#: logarithm of the number of words.
FEATURES = 2 * SIZE + 3


def pooled(words: Words, texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Each text's word vectors as one row of `FEATURES` numbers; all 0 without words.

    Sums run over a text's distinct words, each with its count.
    """
    buckets, counts = words(texts)
    out = np.zeros((len(texts), FEATURES))
    if not len(buckets):
        return out
    text_of = np.repeat(np.arange(len(texts)), counts)
    found, times = np.unique(text_of * BUCKETS + buckets, return_counts=True)
    owner, rows = found // BUCKETS, vectors[found % BUCKETS]
    full, starts = np.unique(owner, return_index=True)
    weighted_rows = rows * times[:, None].astype(np.float32)
    n = counts[full, None]
    mean = np.add.reduceat(weighted_rows, starts, axis=0, dtype=np.float64) / n
    square = np.add.reduceat(weighted_rows * rows, starts, axis=0, dtype=np.float64) / n
    out[full, :SIZE] = mean
    out[full, SIZE : 2 * SIZE] = np.sqrt(np.maximum(square - mean**2, 0))
    equal = np.flatnonzero((buckets[1:] == buckets[:-1]) & (text_of[1:] == text_of[:-1]))
    out[:, -3] = np.bincount(text_of[equal], minlength=len(texts)) / np.maximum(1, counts - 1)
    out[:, -2] = np.bincount(owner, minlength=len(texts)) / np.maximum(1, counts)
    out[:, -1] = np.log1p(counts)
    return out


class Network:
    """Two layers; the probability is the logistic function of the output over a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, held: np.ndarray):
        self.mean, self.spread = np.zeros(x.shape[1]), np.ones(x.shape[1])
        rng = np.random.default_rng(5)
        self.w1 = rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN))
        self.w2, self.b1, self.b2 = rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(HIDDEN), np.zeros(1)
        self.temperature = 1.0
        if len(y):
            self.mean, self.spread = x.mean(0), x.std(0) + 1e-6
        if len({*y[~held].tolist()}) == 2:
            self._fit(x[~held], y[~held], rng)
        elif len(y):  # nothing to tell apart: the share of the only class, with one of each added
            self.w2[:] = 0
            self.b2[:] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        if held.any() and len({*y[held].tolist()}) == 2:
            logits = self.logits(x[held])
            steps = np.exp(np.linspace(-2, 2, 81))
            self.temperature = min(steps, key=lambda t: _loss(logits / t, y[held]))

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.spread @ self.w1 + self.b1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._hidden(x) @ self.w2 + self.b2[0]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))

    def _fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        """Adam with weight decay on the log loss."""
        names = ("w1", "b1", "w2", "b2")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        scaled, step = (x - self.mean) / self.spread, 0
        for _ in range(EPOCHS):
            for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
                step += 1
                hidden = np.tanh(scaled[at] @ self.w1 + self.b1)
                out = 1 / (1 + np.exp(-np.clip(hidden @ self.w2 + self.b2[0], -40, 40)))
                error = (out - y[at]) / len(at)
                back = error[:, None] * self.w2 * (1 - hidden**2)
                slopes = {
                    "w1": scaled[at].T @ back + 1e-3 * self.w1,
                    "b1": back.sum(0),
                    "w2": hidden.T @ error + 1e-3 * self.w2,
                    "b2": np.array([error.sum()]),
                }
                for n in names:
                    first[n] = 0.9 * first[n] + 0.1 * slopes[n]
                    second[n] = 0.999 * second[n] + 0.001 * slopes[n] ** 2
                    rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    setattr(self, n, getattr(self, n) - rate * first[n] / (np.sqrt(second[n]) + 1e-8))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def held_out(id_col: str = "doc_id"):
    """Whether labels of this id are kept from training; never so for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample: int = SAMPLE) -> Network:
    """The network, fitted on the driver to at most `sample` labelled documents.

    The sample is the labels that come first by hash of their id, out of those that may be learned
    from; it is small enough to be broadcast. Of labels that disagree, the lowest counts, and of an
    id's texts the one that comes first by hash, so that no more than `sample` texts are fitted.
    """
    known = pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
    known = known.where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    joined = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality")
    joined = joined.agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def make():
        words = Words()

        def work(texts):
            x = pooled(words, texts, shared.value)
            return [pa.array(list(x), pa.list_(pa.float64()))]

        return work

    rows = map_texts(joined, make, "x array<double>", keep=("doc_id", "quality"), arrow=True).collect()
    rows.sort(key=lambda r: (r.doc_id, r.x))
    x = np.asarray([r.x for r in rows], np.float64).reshape(-1, FEATURES)
    y = np.asarray([float(r.quality >= 1) for r in rows])
    held = np.asarray([zlib.crc32(f"calibrate {r.doc_id}".encode()) % HOLD == 0 for r in rows], bool)
    return Network(x, y, held)


def score(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple = ("doc_id",),
) -> DataFrame:
    """`keep` and (score, predicted) of every row: how likely the text is of quality 1.

    Word vectors come from all texts; the score of a text depends on nothing but the text and the
    fitted model. A null or empty text has no words and scores as such. Without labels of both
    classes every text scores the share of the class there is, or near one half. Labels of
    documents that are not there, null labels and repeated ones do no harm.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    vectors = weighted(word_vectors(rows))
    network = fit(rows, labels, vectors)
    model = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def make():
        words = Words()
        table, net = model.value

        def work(texts):
            p = net(pooled(words, texts, table))
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

        return work

    texts = pick(docs, *keep, **{"scored text": text_col})
    return map_texts(texts, make, "score double, predicted int", "scored text", keep, arrow=True)
