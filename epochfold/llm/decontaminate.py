"""Benchmark decontamination: one Aho-Corasick automaton over all windows of the items' words."""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochfold.llm.shared import pick, release, slices, stored

#: Consecutive words of an item that count as a hit. An item of fewer words is one window.
WINDOW = 10
#: Bytes of item texts in one automaton (some 100 times as much memory). More items than that are
#: dealt to several automata, and the texts are scanned once for each.
AUTOMATON_BYTES = 4 << 20

#: Every ASCII byte but letters and digits separates words; capitals become small.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # capitals included


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def joined(words: list[bytes]) -> str:
    """The normalised text, one character a byte, with a space around each word."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""


def windows(words: list[bytes], size: int) -> list[str]:
    last = max(0, len(words) - size)
    return [joined(words[i : i + size]) for i in range(last + 1)] if words else []


def build(items: list[tuple[object, str]], size: int) -> ahocorasick.Automaton | None:
    """Each window leads to its length in words and the items that have it."""
    owners: dict[str, set] = {}
    for item, text in items:
        for window in windows(words_of(text), size):
            owners.setdefault(window, set()).add(item)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for window, which in owners.items():
        automaton.add_word(window, (window.count(" ") - 1, len(window), frozenset(which)))
    automaton.make_automaton()
    return automaton


def scan(automaton, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
    """Words of the text, ranges of hit words (first, end), items with a window in it.

    The text is scanned once, in normalised form; positions become word numbers by counting the
    spaces before them, which is done only if there is a hit.
    """
    words = words_of(text)
    plain = joined(words)
    found = list(automaton.iter(plain)) if automaton and plain else []
    if not found:
        return len(words), [], set()
    spaces = np.flatnonzero(np.frombuffer(plain.encode("latin-1"), np.uint8) == 32)
    first = np.searchsorted(spaces, [end - length + 1 for end, (_, length, _) in found]).tolist()
    ranges = [(begin, begin + n) for begin, (_, (n, _, _)) in zip(first, found, strict=True)]
    return len(words), merged(ranges), set().union(*(which for _, (_, _, which) in found))


def original(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as ranges of characters of the text as it was."""
    if not ranges:
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    return [(spans[a][0], spans[b - 1][1]) for a, b in ranges]


_HIT = ("word", "end", "from", "to")
_SCHEMA = f"n_words long, hits array<struct<{','.join(f'{n}:int' for n in _HIT)}>>, items array<bigint>"
_HITS = pa.list_(pa.struct([(n, pa.int32()) for n in _HIT]))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges as the fewest that cover the same; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _scanned(rows: DataFrame, items: tuple, window: int, keep: tuple, last: bool) -> DataFrame:
    """The columns `keep`, n_words, hits and items of rows scanned for these items.

    Rows that were scanned before have the last two already; unless it is the last scan, their text
    is passed on.
    """
    shared = rows.sparkSession.sparkContext.broadcast(items)
    before = "hits" in rows.columns
    rows = rows.select("text of row", *keep, *(["hits", "items"] if before else []))
    passed = [] if last else ["text of row"]
    fields = [rows.schema[c] for c in [*passed, *keep]] + T.StructType.fromDDL(_SCHEMA).fields
    schema = T.StructType(fields)

    def run(batches):
        automaton = build(list(shared.value), window)
        for whole in batches:
            for batch in slices(whole, 0):
                n_words, hits, found = [], [], []
                old = batch.select(["hits", "items"]).to_pylist() if before else None
                for i, text in enumerate(batch.column(0).to_pylist()):
                    n, ranges, which = scan(automaton, text)
                    if old:
                        ranges = merged(ranges + [(h["word"], h["end"]) for h in old[i]["hits"]])
                        which = which | {*old[i]["items"]}
                    n_words.append(n)
                    found.append(sorted(which))
                    spans = zip(ranges, original(text, ranges), strict=True)
                    hits.append([dict(zip(_HIT, (*a, *b), strict=True)) for a, b in spans])
                columns = batch.columns[0 if passed else 1 : 1 + len(keep)]
                columns += [pa.array(n_words, pa.int64()), pa.array(hits, _HITS)]
                columns.append(pa.array(found, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        del automaton
        release()

    return rows.mapInArrow(run, schema)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    most_bytes: int = AUTOMATON_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple = (),
) -> DataFrame:
    """`keep`, or else (doc_id), and (n_words, hits, items) of every row.

    `hits` array<struct<word, end, from, to>> are the maximal runs of hit words, by word number and by
    character of the original text;
    `items` array<bigint> are the ids of the items that have a window in the text, in ascending order.

    A null text has no words; an empty benchmark hits nothing; items without an id, without words
    or with a null text are in no text; an item id that occurs twice is one item; equal rows of
    `docs` give equal rows. Columns not named here are not read.

    The benchmark's size is checked. Up to `most_bytes` it goes into one automaton and each text is
    scanned once. Beyond that the items are dealt to automata of about that size, one is broadcast
    and scanned after the other, and the rows are stored in between.
    """
    text = {"text of row": text_col}
    rows = docs.withColumn("text of row", F.col(text_col)) if keep else pick(docs, doc_id=id_col, **text)
    keep = keep or ("doc_id",)
    items = pick(benchmark, "item_id", "text").where("item_id is not null and text is not null")
    items = items.withColumn("item_id", F.col("item_id").cast("long"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // most_bytes))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        share = tuple(map(tuple, items.where(shard == k).collect()))
        rows = _scanned(rows, share, window, keep, last=k == n - 1)
        rows = stored(rows, "decontamination") if k < n - 1 else rows
    return rows


def report(found: DataFrame) -> DataFrame:
    """What `find` found, as counts and a digest of the items."""
    n_hit = F.aggregate("hits", F.lit(0), lambda n, h: n + h["end"] - h["word"]).cast("long")
    listed = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
