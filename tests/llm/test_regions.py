"""Regions of the forest against plain loops, however rows are dealt to tasks."""

from epochfold.llm import near_dup
from tests.llm.test_near_dup import near_copies, plain_components


def found(rows, data):
    df = rows("doc_id long, text string", data)
    return {r.doc_id: r.component_id for r in near_dup.components(df, 85).collect()}


def test_no_border_cuts_a_region(spark, rows, monkeypatch):
    texts = [text for seed in range(8) for text in near_copies(2, 200, 2, seed)]
    data = list(enumerate(texts))
    conf = {"spark.sql.shuffle.partitions": "128", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert found(rows, data) == plain_components(data, 85)[1]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_crowded_regions_in_chunks(rows, monkeypatch):
    monkeypatch.setattr(near_dup, "CROWD", 5)
    texts = near_copies(40, 300, 1, 1) + near_copies(30, 300, 1, 2) + near_copies(2, 300, 1, 3)
    data = list(enumerate(texts))
    assert found(rows, data) == plain_components(data, 85)[1]
