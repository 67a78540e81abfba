"""Token files and BPE against the library on whole texts."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from epochfold.llm import bpe, token_store
from epochfold.llm.byte_bpe import chunks, cut, unkeyed, vocabulary
from epochfold.llm.queries import TOKENIZER
from epochfold.llm.shared import shared_folder

LIBRARY = Tokenizer.from_file(TOKENIZER)
ODD = [
    None,
    "",
    " ",
    "  a",
    "a  <|endoftext|>  b",
    "<|endoftext|><|endoftext|> x",
    "x  <|endoftext|>",
    "a\n\n b \n\n",
    "one\ntwo three\n",
    "\none\r\ntwo\u2028three",
    "\x1c\x1d a\x1e",
    "aaaa" * 500,
    "'s 's don't’s",
    "  x　 y 12½ ²x ٣",
    "é \U0001f600 \U0001f468‍\U0001f469",
    "word " * 20_000,
    "nul \0a \0 \0",
    "\0",
    "same",
    "same",
]


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_encoder_splits_as_the_library_does():
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)} 1{chr(c)}" for c in range(1, 0xD800, 3)]
    flat, counts = bpe.Encoder(vocabulary(open(TOKENIZER).read()))(pa.array(texts))
    got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_a_small_memory_changes_nothing():
    vocab = vocabulary(open(TOKENIZER).read())
    for text in ODD:
        assert bpe.Encoder(vocab, remembered=0)(pa.array([text, text], pa.string()))[0].tolist() == library(text) * 2


def test_chunks_give_the_text_back():
    for text in ODD[1:]:
        assert "".join(chunks(text)) == text
    keys = cut(pa.array(ODD), ["<|endoftext|>"]).to_pylist()
    assert ["".join(map(unkeyed, k)) for k in keys] == [text or "" for text in ODD]


@pytest.mark.parametrize("bits", [True, False])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 65_535])
def test_planes(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << 17, n).astype(np.uint32)
    planes = token_store.to_planes(ids, bits)
    assert (token_store.from_planes(planes, n, bits) == ids).all()


def test_op5(result, docs):
    start, want = 0, {}
    for doc_id in sorted(docs):
        ids = np.asarray([*library(docs[doc_id]), 2], "<u4")
        want[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in result("op5_")}
    assert got == want


@pytest.mark.parametrize("bits", [True, False])
def test_token_store_edges(spark, rows, bits):
    data = [(None if i == 1 else i // 2, text) for i, text in enumerate(ODD)]
    df = rows("doc_id long, text string", data, TEXT="1", file="2", tie="3").repartition(3)
    folder = shared_folder(spark, "t")
    token_store.write(df, folder, TOKENIZER, end_id=2, bits=bits)
    got = token_store.read(spark, folder).collect()
    assert len(got) == len(ODD)
    ids = lambda r: np.frombuffer(r.ids, "<u4").tolist()
    want = sorted((-1 if d is None else d, library(t) + [2]) for d, t in data)
    assert sorted((-1 if r.doc_id is None else r.doc_id, ids(r)) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    assert [r.doc_id for r in ordered] == sorted(
        (r.doc_id for r in got), key=lambda d: (d is not None, d or 0)
    )


def test_token_store_without_rows(rows):
    assert token_store.round_trip(rows("doc_id long, text string", []), TOKENIZER, 2).count() == 0


def test_op10(result, docs):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for doc_id, text in docs.items():
        ids = library(text)
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        want[doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(back))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in result("op10_")}
    assert got == want


def test_bpe_edges(rows):
    df = rows("doc_id long, text string", list(enumerate(ODD)), Text="1", ids="array(1)")
    encoded = bpe.encode(df, TOKENIZER)
    got = {r.doc_id: (r.ids, r.text) for r in bpe.decode(encoded, TOKENIZER).collect()}
    for i, text in enumerate(ODD):
        assert got[i] == (library(text), text or "")
    once = {r.doc_id: (r.ids, r.text) for r in bpe.round_trip(df, TOKENIZER).collect()}
    assert once == got
    assert bpe.encode(df.limit(0), TOKENIZER).count() == 0
    assert bpe.round_trip(df.limit(0), TOKENIZER).count() == 0


def test_decode_of_odd_ids(rows):
    ids = [[50256, 99, -1, 60_000], [447], None, []]
    df = rows("doc_id long, ids array<int>", list(enumerate(ids)))
    got = {r.doc_id: r.text for r in bpe.decode(df, TOKENIZER).collect()}
    decode = lambda x: LIBRARY.decode(x, skip_special_tokens=False)
    assert got == {0: decode([50256, 99]), 1: decode([447]), 2: "", 3: ""}


def test_library_encoder_joins_chunks_without_harm(docs):
    """Joined, marked and single chunks give the library's ids, in the order of the keys."""
    encoder = token_store.LibraryEncoder(open(TOKENIZER).read(), None)
    odd = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)} 1{chr(c)}" for c in range(1, 0xD800, 29)]
    texts = [*ODD, *odd, *list(docs.values())[:150]]
    flat, counts = encoder(pa.array(texts, pa.string()))
    got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == [library(t) for t in texts]


def test_chunks_that_do_not_end_at_an_id_are_marked():
    """With sizes that fit no id, all chunks take the other way, and the ids stay the same."""
    one = token_store.LibraryEncoder(open(TOKENIZER).read(), None)
    two = token_store.LibraryEncoder(open(TOKENIZER).read(), None)
    two.sizes[:] = 0
    text = pa.array(["some words, and some more of them: é½ 12 345 ..."])
    assert [x.tolist() for x in one(text)] == [x.tolist() for x in two(text)]
