"""Secrets in texts: three fixed patterns, and a linear-chain CRF that adds what they miss.

The CRF tags the tokens of a text as begin, inside or outside of a secret. It never looks at the
patterns: its features are the shape of a token, the words beside it and features of the whole text.
It is trained on what the patterns find in a bounded sample, and on the same finds in forms that the
patterns miss: under other names, without any, and in capitals. So it learns what a secret looks like
and not what the patterns ask for.

Decoding is exact. Max-plus products are associative, so the tokens of a slice of texts are cut into
blocks that are multiplied side by side; a scan over the blocks gives the scores that each begins with.
"""

from __future__ import annotations

import heapq
import math
import re
import string
import zlib
from collections import Counter
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epochfold.llm.shared import map_texts, pick

KINDS = ("assign", "access", "hex", "crf")
#: Texts the CRF learns from: those with a pattern's find and as many without, by hash.
SAMPLE = 600
#: Tokens on either side of each find, or of the middle of a text without, that are learned from.
AROUND = 60
#: Tokens that a block of the decoder has.
BLOCK = 256
#: Characters of a token that are looked at, besides its length.
LOOKED_AT = 64
#: Buckets that a feature's text is hashed into.
BUCKETS = 1 << 15
EPOCHS = 8

_NAMES = ("password", "passwd", "secret", "token", "api")
_WORDS = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c + "?" for c in word)
    for word in ("password", "passwd", "secret", "token", "api_key")
)
#: Small and capital letters are spelled out: ignoring case would also take letters beyond ASCII.
ASSIGN = re.compile(rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs below 24 are dropped anyway, so the pattern asks for 24 at once.
HEX = re.compile(r"[0-9a-f]{24,}")

_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+|[^\sA-Za-z0-9+/_=-]+")
O, B, I = range(3)  # noqa: E741


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of what the patterns find, in order."""
    found = []
    small = text.lower()
    if any(name in small for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


# -- features ---------------------------------------------------------------------------------


class _Classes(dict):
    """Character classes for `str.translate`: digits, capitals, small letters, others as they are."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        self[code] = kind
        return kind


_CLASSES = _Classes()
_RUNS = re.compile(r"(.)\1+", re.DOTALL)


def shape(token: str) -> str:
    """Classes of characters in order, runs collapsed, with the length's magnitude."""
    runs = _RUNS.sub(r"\1", token[:LOOKED_AT].translate(_CLASSES))
    return runs[:8] + str(min(7, len(token).bit_length()))


def mixture(token: str) -> str:
    """How the token's characters are spread: digits, entropy, hexadecimal or not, whatever the case."""
    if token.isalpha() and len(token) <= 16:
        return "word"
    token = token[:LOOKED_AT].lower()
    n = len(token)
    counts = Counter(token)
    bits = -sum(c / n * math.log2(c / n) for c in counts.values())
    digits = sum(c.isdigit() for c in token) * 4 // n
    hexadecimal = all(c in "0123456789abcdef" for c in counts)
    return f"{int(bits * 2)}/{digits}/{hexadecimal:d}"


def word(token: str) -> str:
    """The token as a neighbouring word: letters only, small; others by shape."""
    return token.lower() if len(token) <= 16 else "#" + shape(token)


def token_features(token: str) -> tuple[list[str], str]:
    """A token's own features, and its feature as a neighbour."""
    form = shape(token)
    own = ["s" + form, "m" + mixture(token)]
    own.append(("w" + token.lower()) if token.isalpha() and len(token) <= 16 else "l" + form[-1])
    return own, word(token)


def file_features(text: str, n_tokens: int) -> list[str]:
    """Features of the whole text: density of digits and of assignment signs, length of tokens."""
    digits = sum(map(text.count, "0123456789"))
    signs = text.count("=") + text.count(":")
    mean = len(text) // max(1, n_tokens)
    return [
        f"fd{(digits * 400 // max(1, len(text))).bit_length()}",
        f"fs{(signs * 200 // max(1, n_tokens)).bit_length()}",
        f"ft{min(mean, 15)}",
    ]


def looked_at(token: str) -> str:
    """What of a token its features depend on; a long one takes no more room than a short one."""
    if len(token) <= LOOKED_AT:
        return token
    return token[:LOOKED_AT].ljust(min(1 << (len(token).bit_length() - 1), 2 * LOOKED_AT), token[0])


def code(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


_often = lru_cache(maxsize=1 << 14)(code)


def places(kind: str, codes: np.ndarray) -> np.ndarray:
    """Buckets of features of one kind, from the codes of what follows the kind's letter."""
    return (codes.astype(np.uint64) * np.uint64(2 * ord(kind) + 0x9E3779B1) >> np.uint64(16)) % np.uint64(BUCKETS)


def bucket(feature: str) -> int:
    return int(places(feature[0], np.array([code(feature[1:])]))[0])


class Scores:
    """Turns tokens into scores of the tags; remembers the tokens it has seen, up to a bound."""

    def __init__(self, weights: np.ndarray, remembered: int = 300_000):
        self.weights, self.remembered = weights, remembered
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.own = self.ahead = self.behind = np.zeros((0, 3), np.float32)

    def learn(self, tokens: list[str]) -> None:
        rows = []
        for token in tokens:
            form = shape(token)
            if token.isalpha() and len(token) <= 16:
                beside = code(token.lower())
                rows.append((_often(form), _often("word"), 1, beside, beside))
            else:
                rows.append((_often(form), _often(mixture(token)), 0, _often(form[-1]), code(word(token))))
        codes = np.asarray(rows, np.int64).reshape(-1, 5)
        third = np.where(codes[:, 2] == 1, places("w", codes[:, 3]), places("l", codes[:, 3]))
        own = [places("s", codes[:, 0]), places("m", codes[:, 1]), third]
        at = np.stack([*own, places("p", codes[:, 4]), places("n", codes[:, 4])], 1).astype(np.int64)
        self.own = np.concatenate([self.own, self.weights[at[:, :3]].sum(1)])
        self.ahead = np.concatenate([self.ahead, self.weights[at[:, 3]]])
        self.behind = np.concatenate([self.behind, self.weights[at[:, 4]]])
        self.known.update(zip(tokens, range(len(self.known), 1 << 62)))

    def __call__(self, tokens: list[list[str]], files: list[list[str]]) -> np.ndarray:
        """Scores of O, B and I for all tokens of all texts, one text after another."""
        if len(self.known) > self.remembered:
            self.forget()
        tokens = [list(map(looked_at, x)) if max(map(len, x), default=0) > LOOKED_AT else x for x in tokens]
        self.learn(list(set(chain.from_iterable(tokens)).difference(self.known)))
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        total = int(sizes.sum())
        ids = np.fromiter(map(self.known.__getitem__, chain.from_iterable(tokens)), np.int64, total)
        of_file = np.asarray([[bucket(f) for f in x] for x in files], np.int64)
        out = self.own[ids]
        if total:
            inner = np.ones(total, bool)
            inner[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
            at = np.flatnonzero(inner)
            out[at] += self.ahead[ids[at - 1]]
            out[at - 1] += self.behind[ids[at]]
            out += np.repeat(self.weights[of_file].sum(1), sizes, axis=0)
        return out


# -- the chain --------------------------------------------------------------------------------

#: Inside follows only begin or inside.
_ALLOWED = np.array([[0, 0, -1e4], [0, 0, 0], [0, 0, 0]])
_START = np.array([0, 0, -1e4])


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags of one sequence."""
    best, back = scores[0] + _START, np.zeros((len(scores), 3), np.int8)
    for i in range(1, len(scores)):
        paths = best[:, None] + moves
        back[i] = paths.argmax(0)
        best = paths.max(0) + scores[i]
    tags = np.zeros(len(scores), np.int8)
    tags[-1] = best.argmax()
    for i in range(len(scores) - 1, 0, -1):
        tags[i - 1] = back[i, tags[i]]
    return tags


def decode(scores: np.ndarray, moves: np.ndarray, firsts: np.ndarray, size: int = BLOCK) -> np.ndarray:
    """The best tags of sequences that lie one after another and begin where `firsts` is true.

    Where a sequence begins, the move does not depend on the tag before, so the best path of all
    tokens is that of each sequence. Blocks are multiplied side by side, token by token; the scores
    that each block begins with then come from the products of the blocks before it; a second run
    notes the best tag before each tag, and the tags are traced back, again block beside block.
    """
    n = len(scores)
    count = -(-n // size)
    # by place in the block, tag and block: what one step works on lies together
    steps = np.zeros((count * size, 3))
    steps[:n] = scores
    steps = np.ascontiguousarray(steps.reshape(count, size, 3).transpose(1, 2, 0))
    begins = np.zeros(count * size, bool)
    begins[:n] = firsts
    begins[n : n + 1] = True  # padding is a sequence of its own
    begins = np.ascontiguousarray(begins.reshape(count, size).T)

    def step(ahead: list[np.ndarray], i: int, noted: np.ndarray | None = None) -> list[np.ndarray]:
        """Scores by tag of token i, from those of the token before."""
        new = np.flatnonzero(begins[i])
        top = np.maximum(np.maximum(ahead[0], ahead[1]), ahead[2])[..., new] if len(new) else None
        out = []
        for j in range(3):
            ways = [ahead[k] + moves[k, j] for k in range(3)]
            best = np.maximum(ways[0], ways[1])
            if noted is not None:
                noted[j] = ways[1] > ways[0]
                noted[j][ways[2] > best] = 2
            np.maximum(best, ways[2], out=best)
            if len(new):
                best[..., new] = top + _START[j]
                if noted is not None:
                    noted[j][new] = np.argmax([a[new] for a in ahead], axis=0)
            out.append(best + steps[i, j])
        return out

    eye = np.where(np.eye(3, dtype=bool), 0.0, -1e9)
    product = [np.repeat(eye[:, j, None], count, 1) for j in range(3)]
    for i in range(size):
        product = step(product, i)
    by_block = np.stack(product).transpose(2, 1, 0)
    entry = np.zeros((count, 3))
    for b in range(1, count):
        entry[b] = (entry[b - 1][:, None] + by_block[b - 1]).max(0)
        entry[b] -= entry[b].max()
    back = np.zeros((size, 3, count), np.int8)
    ahead = [np.ascontiguousarray(entry[:, j]) for j in range(3)]
    for i in range(size):
        ahead = step(ahead, i, back[i])
    # for each tag that a block may end with, the tags before it; behind the last token is padding only
    tags = np.zeros((size, 3, count), np.int8)
    now = np.repeat(np.arange(3, dtype=np.int8)[:, None], count, 1)
    for i in range(size - 1, -1, -1):
        tags[i] = now
        now = np.take_along_axis(back[i], now.astype(np.intp), 0)
    out = np.zeros((count, size), np.int8)
    last = int(np.argmax([a[-1] for a in ahead]))
    for b in range(count - 1, -1, -1):
        out[b] = tags[:, last, b]
        last = int(now[last, b])
    return out.reshape(-1)[:n]


def tag(scores: np.ndarray, moves: np.ndarray, size: int = BLOCK) -> np.ndarray:
    """The best tags of one sequence, as `viterbi` finds them."""
    firsts = np.zeros(len(scores), bool)
    firsts[:1] = True
    return decode(np.asarray(scores, np.float64), moves, firsts, size)


def marginals(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of tags and of moves, by the forward-backward recursion."""
    n = len(scores)
    forward, backward = np.zeros((n, 3)), np.zeros((n, 3))
    forward[0] = scores[0] + _START
    for i in range(1, n):
        forward[i] = np.logaddexp.reduce(forward[i - 1][:, None] + moves, axis=0) + scores[i]
    for i in range(n - 2, -1, -1):
        backward[i] = np.logaddexp.reduce(moves + (scores[i + 1] + backward[i + 1])[None], axis=1)
    total = np.logaddexp.reduce(forward[-1])
    steps = forward[:-1, :, None] + moves + (scores[1:] + backward[1:])[:, None, :] - total
    return np.exp(forward + backward - total), np.exp(steps).sum(0)


def gold(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[str], np.ndarray]:
    """Tokens of a text and their tags by the spans."""
    found = list(_TOKEN.finditer(text))
    tags = np.zeros(len(found), np.int8)
    for start, kind, end in spans:
        if kind == 0:  # the value is the secret; the name and the sign before it are its context
            start = ASSIGN.match(text, start).start(2)
        first = True
        for i, m in enumerate(found):
            if m.end() > start and m.start() < end and not tags[i]:
                tags[i] = B if first else I
                first = False
    return [m[0] for m in found], tags


_ALPHABET = string.ascii_letters + string.digits
Example = tuple[list[str], list[int], list[str]]


def examples(text: str, around: int = AROUND) -> list[Example]:
    """(tokens, tags, features of the text): windows around every find, or around the middle."""
    tokens, tags = gold(text, base_spans(text))
    if not tokens:
        return []
    files = file_features(text, len(tokens))
    ranges: list[list[int]] = []
    for at in np.flatnonzero(tags).tolist() or [len(tokens) // 2]:
        begin, end = max(0, at - around), min(len(tokens), at + around + 1)
        if ranges and begin <= ranges[-1][1]:
            ranges[-1][1] = end
        else:
            ranges.append([begin, end])
    return [([looked_at(t) for t in tokens[a:b]], tags[a:b].tolist(), files) for a, b in ranges]


def disguised(example: Example, rng: np.random.Generator) -> list[Example]:
    """The finds of an example in forms that the patterns miss.

    Words near a find become other words of the example, so that neither a name nor any word tells;
    once more with the signs between them gone; with the finds themselves in capitals; and with random
    letters and digits of 16 to 64 characters in their place.
    """
    tokens, tags, files = example
    words = [t for t, tag in zip(tokens, tags, strict=True) if not tag and t.isalpha()] or ["value"]
    near = {j for i, tag in enumerate(tags) if tag for j in range(max(0, i - 3), min(len(tags), i + 3)) if not tags[j]}
    other = {i: words[rng.integers(len(words))] for i in sorted(near)}
    renamed = [other[i] if i in near and t[:1].isalpha() else t for i, t in enumerate(tokens)]
    bare = [other.get(i, t) for i, t in enumerate(tokens)]
    capitals = [t.upper() if tag else t for t, tag in zip(renamed, tags, strict=True)]
    spelled = [
        "".join(_ALPHABET[i] for i in rng.integers(len(_ALPHABET), size=rng.integers(16, 65))) if tag else t
        for t, tag in zip(renamed if rng.integers(2) else bare, tags, strict=True)
    ]
    return [(x, tags, files) for x in (renamed, bare, capitals, spelled)]


def train(texts: list[str], epochs: int = EPOCHS, rate: float = 0.2) -> tuple[np.ndarray, np.ndarray]:
    return fit([example for text in sorted(texts) for example in examples(text)], epochs, rate)


def fit(found: list[Example], epochs: int = EPOCHS, rate: float = 0.2) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the hashed features and of the moves, by AdaGrad on the likelihood."""
    order = np.random.default_rng(9)
    found = found + [d for e in found if any(e[1]) for d in disguised(e, order)]
    prepared = []
    none = bucket("none")
    for tokens, tags, files in found:
        features = [token_features(t) for t in tokens]
        rows = [[*map(bucket, own)] for own, _ in features]
        of_file = [bucket(f) for f in files]
        for i, row in enumerate(rows):
            row.append(bucket("p" + features[i - 1][1]) if i else none)
            row.append(bucket("n" + features[i + 1][1]) if i + 1 < len(rows) else none)
            row += of_file
        prepared.append((np.asarray(rows, np.int64), np.asarray(tags, np.int8)))
    weights, moves = np.zeros((BUCKETS, 3)), np.zeros((3, 3))
    past, past_moves = np.full((BUCKETS, 3), 1e-2), np.full((3, 3), 1e-2)
    for _ in range(epochs):
        for k in order.permutation(len(prepared)):
            rows, tags = prepared[k]
            chance, steps = marginals(weights[rows].sum(1), moves + _ALLOWED)
            want = np.eye(3)[tags]
            sums = np.zeros_like(moves)
            np.add.at(sums, (tags[:-1], tags[1:]), 1)
            step = sums - steps
            past_moves += step**2
            moves += rate * step / np.sqrt(past_moves)
            touched, where = np.unique(rows, return_inverse=True)
            slope = np.zeros((len(touched), 3))
            np.add.at(slope, where.reshape(rows.shape), (want - chance)[:, None, :])
            slope -= 1e-4 * weights[touched]
            past[touched] += slope**2
            weights[touched] += rate * slope / np.sqrt(past[touched])
    weights[none] = 0
    return weights.astype(np.float32), moves


class Finder:
    """All spans of texts: the patterns' and those that the CRF adds."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.scores, self.moves = Scores(weights), moves + _ALLOWED

    def __call__(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        texts = [text or "" for text in texts]
        out = [base_spans(text) for text in texts]
        tokens = [_TOKEN.findall(text) for text in texts]
        files = [file_features(t, len(x)) for t, x in zip(texts, tokens, strict=True)]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ends = np.cumsum(sizes)
        if not sizes.sum():
            return out
        firsts = np.zeros(ends[-1], bool)
        firsts[(ends - sizes)[sizes > 0]] = True
        tags = decode(self.scores(tokens, files).astype(np.float64), self.moves, firsts)
        for k in np.unique(np.searchsorted(ends, np.flatnonzero(tags), "right")).tolist():
            own = tags[ends[k] - sizes[k] : ends[k]]
            out[k] = sorted(out[k] + self._added(texts[k], own, out[k]))
        return out

    @staticmethod
    def _added(text: str, tags: np.ndarray, base: list) -> list[tuple[int, int, int]]:
        """Tagged runs, as spans, that no span of the patterns overlaps."""
        places = [m.span() for m in _TOKEN.finditer(text)]
        found = []
        for i in np.flatnonzero(tags).tolist():
            if tags[i] == B:
                found.append(list(places[i]))
            else:
                found[-1][1] = places[i][1]
        return [(a, 3, b) for a, b in found if not any(a < e and s < b for s, _, e in base)]


def sample(docs: DataFrame, size: int = SAMPLE, around: int = AROUND) -> list[Example]:
    """A bounded training sample: windows of texts with finds, and of others, the first by hash.

    One pass over the texts. A task keeps the first windows of both sorts, and of those that all tasks
    keep the first are taken, so the sample depends on the texts only and its size on `size`.
    """
    half = size // 2
    schema = "sort int, mark long, window int, tokens array<string>, tags array<int>, files array<string>"
    texts = docs.where("text is not null and length(text) > 0").select("text")

    def run(batches):
        kept: list[list[tuple]] = [[], []]
        number = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                mark = zlib.crc32(text.encode()) << 31 | zlib.crc32(text[::-1].encode()) >> 1
                sort = int(bool(base_spans(text)))
                if len(kept[sort]) == half and -mark <= kept[sort][0][0]:
                    continue
                for window, example in enumerate(examples(text, around)):
                    number += 1
                    entry = (-mark, -window, number, example)
                    if len(kept[sort]) < half:
                        heapq.heappush(kept[sort], entry)
                    else:
                        heapq.heappushpop(kept[sort], entry)
        rows = [(s, -m, -w, *e) for s, heap in enumerate(kept) for m, w, _, e in heap]
        columns = list(zip(*rows, strict=True)) or [[] for _ in range(6)]
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()))
        names = ["sort", "mark", "window", "tokens", "tags", "files"]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    order = Window.partitionBy("sort").orderBy("mark", "window")
    first = texts.mapInArrow(run, schema).withColumn("n", F.row_number().over(order))
    chosen = first.where(F.col("n") <= half).orderBy("sort", "n").collect()
    return [(r.tokens, r.tags, r.files) for r in chosen]


def find(docs: DataFrame, size: int = SAMPLE, around: int = AROUND) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) of every row; code points, end exclusive.

    Spans of the patterns come as they are; a run that the CRF tags is added as kind `crf` if it
    overlaps none of them. A null or empty text has none; equal rows give equal rows; without
    texts to learn from, the CRF adds nothing. Other columns are not read.

    The CRF is fitted on the driver to at most `size` windows of `around` tokens on either side of a
    find, half of them from texts without any; texts of any length and all their finds take part. Every
    text is tagged whole. Tokens of more than 64 characters are known by those and by their length.
    """
    rows = pick(docs, "doc_id", "text")
    weights, moves = fit(sample(rows, size, around))
    model = rows.sparkSession.sparkContext.broadcast((weights, moves))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def make():
        finder = Finder(*model.value)

        def work(texts):
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found]
                for found in finder(texts)
            ]
            return [pa.array(spans, kind)]

        return work

    return map_texts(rows, make, "spans array<struct<kind:string,start:int,end:int>>")


def report(found: DataFrame) -> DataFrame:
    """Counts and listings of the spans that `find` found."""
    listing = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(listing(base), 256).alias("base_sha256"),
        listing(F.col("spans")).alias("spans"),
    )
