"""Stages of the pipeline on null and repeated ids."""

import random

import corpus_pipeline
from epochfold.llm import quality


def texts(n, words=40, seed=1):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(10**6)}" for _ in range(words)) for _ in range(n)]


def sorted_rows(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_lines_of_null_and_repeated_ids(spark, rows, sf_dir):
    a, b, c, d, e, f = texts(6)
    data = [
        (None, f"{a}\n{b}"),
        (None, f"{c}\n{d}"),
        (1, f"{e}\n{a}"),  # the second line goes, from this text only
        (1, f"{f}\n{f} more"),
        (1, f"{d} x\n{b} y z"),
        (2, None),
    ]
    df = rows("doc_id long, text string", data).repartition(3)
    got = sorted_rows(corpus_pipeline.drop_lines(spark, df, sf_dir))
    want = [(None, f"{a}\n{b}"), (None, f"{c}\n{d}"), (1, ""), (1, e), (1, f), (2, None)]
    assert got == sorted(want, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_near_duplicates_of_null_and_repeated_ids(spark, rows, sf_dir):
    a, b, c, d, e = texts(5, 200)
    data = [
        (1, a),
        (2, f"{a} more"),
        (2, b),  # alone under an id whose other text goes
        (3, c),
        (3, c),
        (None, f"{c} more"),
        (None, d),
        (None, f"{d} more"),
        (None, e),
        (4, None),
    ]
    df = rows("doc_id long, text string", data).repartition(3)
    got = sorted_rows(corpus_pipeline.one_of_each_group(spark, df, sf_dir))
    assert len([r for r in got if r[1] in (d, f"{d} more")]) == 1
    got = [r for r in got if r[1] not in (d, f"{d} more")]
    assert got == [(None, e), (1, a), (2, b), (3, c), (4, None)]


def test_no_rows(spark, rows, sf_dir):
    df = rows("doc_id long, text string", [(1, "a")]).limit(0)
    assert corpus_pipeline.drop_lines(spark, df, sf_dir).count() == 0
    assert corpus_pipeline.one_of_each_group(spark, df, sf_dir).count() == 0


# -- quality, decontamination and encoding --------------------------------------------------------


def written(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def odd_rows(good, passage):
    """Rows with nulls, repeats, an empty and a very long text."""
    long_text = " ".join(good * 300)
    return [
        (1, good[0]),
        (1, good[0]),
        (1, f"{good[1]} {passage} {good[2]}"),
        (2, None),
        (3, ""),
        (None, good[3]),
        (None, f"{passage}"),
        (4, long_text),
        (5, f"{long_text} {passage.upper()}"),
    ]


def test_decontamination_drops_rows_by_their_text(spark, rows, tmp_path):
    good, (passage,) = texts(5), texts(1, 30, seed=2)
    items = rows("item_id long, text string", [(1, passage), (None, good[0]), (2, None), (3, "")])
    sf_dir = written(spark, tmp_path, benchmark=items)
    data = odd_rows(good, passage)
    df = rows("doc_id long, text string", data, hits="1", TEXT="'x'", n_hit="null").repartition(2)
    got = corpus_pipeline.drop_contaminated(spark, df, sf_dir)
    assert got.columns == df.columns
    want = [r for r in data if passage not in (r[1] or "").lower()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted([(r[0], r[1]) for r in got.collect()], key=key) == sorted(want, key=key)
    assert corpus_pipeline.drop_contaminated(spark, df.limit(0), sf_dir).count() == 0


def test_quality_keeps_what_the_classifier_accepts(spark, rows, tmp_path):
    """The rows that the operator's scores accept, equal rows and null ids included."""
    rng = random.Random(3)
    make = lambda words: " ".join(f"{rng.choice(words)}{rng.randrange(30)}" for _ in range(40))
    good, bad = [make(["w", "x"]) for _ in range(45)], [make(["junk", "spam"]) for _ in range(45)]
    passage = make(["w"])
    data = odd_rows(good, passage) + [(100 + i, t) for i, t in enumerate(bad + good)] + [(None, bad[0])]
    labels = rows("doc_id long, quality int", [(100 + i, int(i >= 45)) for i in range(90)])
    sf_dir = written(spark, tmp_path, labels=labels)
    df = rows("doc_id long, text string", data, score="1", predicted="'x'", TEXT="2").repartition(2)
    got = corpus_pipeline.keep_good(spark, df, sf_dir)
    assert got.columns == df.columns
    kept = sorted((r[0] or -1, r[1] or "") for r in got.collect())
    scored = quality.score(df, labels, keep=("doc_id", "text")).collect()
    assert len(scored) == len(data)
    assert kept == sorted((r.doc_id or -1, r.text or "") for r in scored if r.predicted == 1)
    assert {t for _, t in kept} & set(bad) == set() and set(good) <= {t for _, t in kept}
    assert corpus_pipeline.keep_good(spark, df.limit(0), sf_dir).count() == 0


def test_encoding_gives_the_ids_and_the_text_back(spark, rows, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    good, (passage,) = texts(5), texts(1, 30, seed=2)
    data = odd_rows(good, passage) + [(7, "é \U0001f600 <|endoftext|>\n\n x")]
    df = rows("doc_id long, text string", data, ids="1", n_tokens="2").repartition(2)
    got = corpus_pipeline.encode(spark, df, sf_dir).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    want = [(i, t or "") for i, t in data]
    assert sorted([(r.doc_id, r.text) for r in got], key=key) == sorted(want, key=key)
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert list(r.ids) == library.encode(r.text, add_special_tokens=False).ids
    assert corpus_pipeline.encode(spark, df.limit(0), sf_dir).count() == 0
