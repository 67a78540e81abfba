"""Byte-level BPE vocabularies: the file, its splitting rule, and runs of text that encode alone."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: How this kind of vocabulary splits a text before merging. White space is spelled
#: as the Unicode property, since Python counts four more control characters as white space.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


#: A pair of ids is one integer: the left one so many bits higher.
SHIFT = 24


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is visible, else the next from U+0100."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def chunks(text: str) -> list[str]:
    """The text cut before each space that a visible character follows.

    The splitting rule never joins characters across such a place, so each chunk encodes as it
    does within the text. That does not hold around special tokens; look for them first.
    """
    first, *rest = text.split(" ")
    out = [first]
    for part in rest:
        if part and not part[0].isspace():
            out.append(" " + part)
        else:
            out[-1] += " " + part
    return [chunk for chunk in out if chunk]


#: A space that white space or nothing follows, in the syntax of Arrow's expressions.
_ODD_SPACE = r" ([\x{9}-\x{D}\x{1C}-\x{20}\x{85}\p{Z}]|\z)"
#: Ahead of a chunk that does not begin with a space.
BARE = "\0"


def keyed(chunk: str) -> str:
    """A chunk without the space it begins with, or marked as having none."""
    return chunk[1:] if chunk[0] == " " else BARE + chunk


def unkeyed(key: str) -> str:
    return key[1:] if key[:1] == BARE else " " + key


def cut(texts: pa.Array, special: Iterable[str]) -> pa.ListArray:
    """The keys of every text's chunks; a null or empty text has none.

    Most texts are split by Arrow. Those with a special token are one chunk, since white space
    beside the token must not be cut, and so are those with the character that marks keys.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    whole = pc.match_substring(texts, BARE)
    for token in special:
        whole = pc.or_(whole, pc.match_substring(texts, token))
    odd = pc.or_(pc.match_substring_regex(texts, _ODD_SPACE), pc.equal(texts, ""))
    plain = pc.invert(pc.or_(whole, odd))
    marked = pc.binary_join_element_wise(BARE, texts.filter(plain), "")
    split = pc.split_pattern(marked, " ")
    rest = np.flatnonzero(~np.asarray(plain))
    if not len(rest):
        return split
    alone = np.asarray(whole)[rest].tolist()
    some = texts.take(pa.array(rest)).to_pylist()
    some = [[BARE + t] if one else list(map(keyed, chunks(t))) for t, one in zip(some, alone, strict=True)]
    order = np.argsort(np.concatenate([np.flatnonzero(np.asarray(plain)), rest]))
    return pa.concat_arrays([split, pa.array(some, split.type)]).take(pa.array(order))


class Vocabulary:
    """What encoding and decoding need from a tokenizer file (tokenizers' JSON)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges"))
        plain = plain and not model.get("continuing_subword_prefix")
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] or not plain:
            raise ValueError("only plain byte-level BPE files are supported")
        if pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only the usual splitting rule is supported")
        ids = model["vocab"]
        letters = byte_letters()
        byte_of = {c: bytes([b]) for b, c in enumerate(letters)}
        self.byte_ids = [ids[c] for c in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: b"".join(map(byte_of.__getitem__, t)) for t, i in ids.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        #: rank -> (left id, right id, merged id)
        self.rules = []
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rules.append((ids[left], ids[right], ids[left + right]))
        #: left id << SHIFT | right id -> rank
        self.rank_of = {}
        for rank, (left, right, _) in enumerate(self.rules):
            self.rank_of.setdefault(left << SHIFT | right, rank)
        self.split = regex.compile(SPLIT).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split

    def parts(self, chunk: str) -> list[str]:
        """Special tokens and words of a chunk."""
        if not any(token in chunk for token in self.special):
            return self.split(chunk)
        out = []
        for run in self.special_split(chunk):
            out += [run] if run in self.special else self.split(run)
        return out


@lru_cache(maxsize=2)
def vocabulary(source: str) -> Vocabulary:
    """Parsed once a worker process."""
    return Vocabulary(source)


def read_file(path: str) -> str:
    """A tokenizer file is read on the driver and broadcast: its size is fixed by the vocabulary."""
    with open(path, encoding="utf-8") as f:
        return f.read()
