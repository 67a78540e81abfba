"""Token alignment against a plain loop over the libraries' tokens."""

import hashlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from epochfold.llm import alignment
from epochfold.llm.byte_bpe import Vocabulary, read_file
from epochfold.llm.queries import PIECES, TOKENIZER

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(TOKENIZER)
    a.no_truncation()
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    names = Vocabulary(read_file(TOKENIZER)).bytes_of

    @cache
    def piece(i):
        text = b.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if b.is_byte(i) else text.replace("▁", " ").encode()

    def tokens(text):
        """(ids, bytes) of both sides, or two empty lists."""
        if not text:
            return [], []
        left = [(i, names[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, piece(i)) for i in b.encode(text)]
        whole = f" {text}".encode()
        if any(b"".join(data for _, data in side) != whole for side in (left, right)):
            return [], []
        return left, right

    return tokens


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def plain(texts, tokens):
    """For each text what the operator counts, from all pairs of its tokens."""
    every, counts = [], Counter()
    for text in texts:
        left, right = map(spans, tokens(text))
        links, k = [], 0
        for i, x, y in left:
            while k < len(right) and right[k][2] <= x:
                k += 1
            m = k
            while m < len(right) and right[m][1] < y:
                links.append((i, right[m][0]))
                m += 1
        ends = sorted({y for *_, y in left} & {y for *_, y in right})
        groups = []
        waiting = [list(reversed(left)), list(reversed(right))]
        for end in ends:
            inside = [[], []]
            for side, found in zip(waiting, inside):
                while side and side[-1][2] <= end:
                    found.append(str(side.pop()[0]))
            groups.append("|".join(map(",".join, inside)))
        counts.update(links)
        every.append((left, right, links, groups))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for left, right, links, groups in every:
        best = sum(counts[link] == top[link[1]] for link in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if left else ""
        row = (len(left), len(right), len(groups), len(links), best, sum(counts[k] for k in links), digest)
        out.append(row)
    return out


def test_op12(result, docs, tools):
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in result("op12_")}
    want = dict(zip(docs, plain(list(docs.values()), tools), strict=True))
    assert rows == want


ODD = [
    None,
    "",
    " ",
    "a",
    "<|endoftext|> and <s> </s> <0x41>",
    "tab\tnew\r\nline  two   spaces ",
    "漢字かな 😀 é",
    "under▁score",  # side B cannot spell the mark
    "\x00\x1c\x85 ﻿",
    "word " * 300,
    "word " * 300,
    "x" * 70_000,
    " " * 3_000,
]


def test_odd_rows(rows, tools, monkeypatch):
    """Nulls, empty and long texts, repeated rows and ids, extra columns with clashing names."""
    data = [(i % 9 if i else None, t) for i, t in enumerate(ODD)]
    df = rows("doc_id long, text string", data, slice="1", a="'x'", key="2", DOC_ID="3")
    found = alignment.report(alignment.tokenized(df, TOKENIZER, PIECES)).collect()
    have = sorted((str(r.doc_id), *(str(r[c]) for c in COLUMNS)) for r in found)
    want = plain(ODD, tools)
    assert have == sorted((str(i), *map(str, row)) for (i, _), row in zip(data, want, strict=True))
    assert want[7][0] == 0 and want[4][0] > 0


def test_empty_table(rows):
    df = rows("doc_id long, text string", [])
    assert alignment.report(alignment.tokenized(df, TOKENIZER, PIECES)).collect() == []


def test_long_white_space():
    """What the fast splitter has no room for goes to the library."""
    side = alignment.ByteLevel(read_file(TOKENIZER))
    text = " x" + " " * 1_000_000
    assert side.bytes.joined(side(text)) == text.encode()
    assert side.exact is not None


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("aZ é漢😀\x1c\x85 \n\t'sl1²٣.▁<|>́"), max_size=40))
def test_fast_side_is_the_library(tools, text):
    side = alignment.ByteLevel(read_file(TOKENIZER)) if not hasattr(tools, "side") else tools.side
    tools.side = side
    left, _ = tools(text)
    if left:
        assert side(" " + text).tolist() == [i for i, _ in left]


@settings(max_examples=100, deadline=None)
@given(data=st.data())
def test_products(data):
    """Products in runs of rows are those of whole matrices."""
    n, m, k = (data.draw(st.integers(1, 6)) for _ in range(3))
    cells = st.integers(0, 2)
    x = np.array(data.draw(st.lists(st.lists(cells, min_size=m, max_size=m), min_size=n, max_size=n)))
    y = np.array(data.draw(st.lists(st.lists(cells, min_size=m, max_size=m), min_size=k, max_size=k)))

    def csr(dense):
        row, column = np.nonzero(dense)
        starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(dense)))])
        return alignment.Csr(starts, column, dense.shape[1], dense[row, column])

    out = np.zeros((n, k), int)
    for first, rows in csr(x).products(csr(y).transposed(), most=3):
        for i in range(rows.height):
            a, b = rows.starts[i], rows.starts[i + 1]
            assert len(set(rows.columns[a:b].tolist())) == b - a
            out[first + i, rows.columns[a:b]] = rows.data[a:b]
    assert (out == x @ y.T).all()


def test_links(rows, tools, monkeypatch):
    monkeypatch.setattr(alignment, "ENTRIES", 16)
    texts = ["Some unbelievable words, tokenization!", None]
    df = rows("doc_id long, text string", list(enumerate(texts)))
    found = {r.id: r.links for r in alignment.links(alignment.tokenized(df, TOKENIZER, PIECES)).collect()}
    assert found[1] == []
    left, right = map(spans, tools(texts[0]))
    want = []
    for i, (_, x, y) in enumerate(left):
        for j, (_, u, v) in enumerate(right):
            if min(y, v) > max(x, u):
                want.append((i, j, min(y, v) - max(x, u)))
    assert [tuple(link) for link in found[0]] == want


def test_shared_group_links(tools):
    """Pairs of tokens of a group by the product of incidence matrices."""
    text = "Some unbelievable words, tokenization of étrange naïveté!"
    a, b = alignment._tokenizers(read_file(TOKENIZER), open(PIECES, "rb").read())
    tokens = alignment.tokenize([text], a, b)
    pairs = {(i, j) for x, y, _ in tokens.shared() for i, j in zip(x.tolist(), y.tolist(), strict=True)}
    want = {
        (i, j)
        for i, g in enumerate(tokens.a_group.tolist())
        for j, h in enumerate(tokens.b_group.tolist())
        if g == h
    }
    assert pairs == want
