"""The quality classifier: held-out labels, no leakage, odd rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from epochfold.llm import quality
from epochfold.llm.quality import FEATURES

GOOD = [f"good{i}" for i in range(60)]
BAD = [f"bad{i}" for i in range(60)]


def text(rng, words, n=40):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text) and labels of 300 documents; good and bad ones share no word."""
    rng = random.Random(4)
    docs = [(i, text(rng, GOOD if i % 3 else BAD)) for i in range(300)]
    return docs, [(i, int(i % 3 > 0)) for i in range(300)]


def scores(df):
    return {r.doc_id: r.score for r in df.collect()}


def test_op4_on_held_out_labels(spark, sf_dir, result, docs):
    got = {r["doc_id"]: r for r in result("op4")}
    assert set(got) == set(docs)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    by_text = {}
    for i, r in got.items():
        assert by_text.setdefault(docs[i], r["score"]) == pytest.approx(r["score"], abs=1e-12)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality is not null").collect()
    held = [(got[r.doc_id]["score"], r.quality) for r in labels if got[r.doc_id]["held_out"]]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert len(good) > 5 and len(bad) > 5
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.95


def test_held_out_labels_and_other_columns_change_nothing(rows, corpus):
    docs, labels = corpus
    df = rows("doc_id long, text string", docs, lang="'x'", TEXT="1", score="2")
    one = scores(quality.score(df, rows("doc_id long, quality int", labels)))
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    other = [(i, 1 - q if i in held else q) for i, q in labels]
    other = rows("doc_id long, quality int", other, toxic="1")
    two = scores(quality.score(df.withColumn("lang", F.lit("y")).repartition(5), other))
    assert one == pytest.approx(two, abs=1e-9)
    assert min(one[i] for i, _ in docs if i % 3) > 0.5 > max(one[i] for i, _ in docs if not i % 3)


def test_odd_rows(rows, corpus):
    """Null, empty, very long, repeated texts and null ids all get a score, by the text alone."""
    docs, labels = corpus
    long_text = " ".join(GOOD * 5000)
    odd = [(1000, None), (1001, ""), (1002, " \n"), (1003, long_text), (1004, docs[1][1]), docs[1], docs[1], (None, docs[0][1])]
    known = [*labels, (None, 1), (5, None), (7, 0), (9999, 1), (1, 1)]
    df = rows("doc_id long, text string", docs + odd)
    found = quality.score(df, rows("doc_id long, quality int", known)).collect()
    assert len(found) == len(docs) + len(odd)
    assert all(0 <= r.score <= 1 for r in found)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert by_id[1000] == by_id[1001] == by_id[1002]
    assert by_id[1] == by_id[1004] and by_id[None] == by_id[0]
    assert min(by_id[1003]) > 0.5


def test_no_rows_no_labels_and_one_class(rows, corpus):
    docs, labels = corpus
    df = rows("doc_id long, text string", docs[:20])
    known = rows("doc_id long, quality int", labels)
    assert quality.score(df.limit(0), known).count() == 0
    assert len({*scores(quality.score(df, known.limit(0))).values()}) <= 20
    same = set(scores(quality.score(df, known.where("quality = 1"))).values())
    assert len(same) == 1 and same.pop() > 0.5


def test_ids_may_be_strings(rows, corpus):
    docs, labels = corpus
    df = rows("doc_id string, text string", [(f"d{i}", t) for i, t in docs[:120]])
    known = rows("doc_id string, quality int", [(f"d{i}", q) for i, q in labels])
    found = scores(quality.score(df, known))
    assert min(found[f"d{i}"] for i in range(120) if i % 3) > max(found[f"d{i}"] for i in range(0, 120, 3))


def test_the_sample_has_a_bound(rows, corpus, monkeypatch):
    """One id with many texts is one text of the sample."""
    docs, labels = corpus
    hot = next(i for i, _ in docs if zlib.crc32(str(i).encode()) % 5)
    many = [(hot, f"{docs[hot][1]} more{k}") for k in range(500)]
    seen = []

    class Seen(quality.Network):
        def __init__(self, x, y, held):
            seen.append((x.shape, len(y)))
            super().__init__(x, y, held)

    monkeypatch.setattr(quality, "Network", Seen)
    df = rows("doc_id long, text string", docs + many)
    vectors = quality.weighted(quality.word_vectors(df))
    quality.fit(df, rows("doc_id long, quality int", labels), vectors, sample=50)
    assert seen == [((50, FEATURES), 50)]
