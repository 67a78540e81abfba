"""Stored replicas: publish, crash and replay, repeated and chained loads."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

import epochfold.sources.replica as replica_module
from epochfold import APPEND_CLOSE, MERGE, ReplicaStore, append_close, merge, prepare
from epochfold.operators import partitions
from epochfold.operators.increment import with_months
from epochfold.plans import jobs
from epochfold.plans import orders_history as history
from tests.test_edges import CASES, REPLICA, table, values

SF_DIR = "/root/testdata/sf0.001"
APPLY = {APPEND_CLOSE: append_close, MERGE: merge}


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def directories(store):
    out = set()
    for path, _, names in os.walk(store.root):
        if any(n.endswith(".parquet") for n in names) and "/_" not in path[len(store.root) :]:
            out.add(os.path.relpath(path, store.root))
    return out


@pytest.fixture
def new_store(spark, tmp_path):
    def make(**options):
        return ReplicaStore(spark, str(tmp_path / uuid.uuid4().hex), **options)

    return make


@pytest.mark.parametrize(
    ("name", "mode", "publish"),
    [(n, m, "move") for n in CASES for m in (APPEND_CLOSE, MERGE)]
    + [(n, MERGE, "copy") for n in ("emptied", "late", "null_start")],
)
def test_edges_on_disk(spark, new_store, name, mode, publish):
    rows_in, appended, merged = CASES[name]
    store = new_store(publish=publish)
    store.initial_load(table(spark, REPLICA))
    expected = appended if mode == APPEND_CLOSE else merged
    if expected is None:
        with pytest.raises(replica_module.MergeConflictError):
            store.apply(table(spark, rows_in), mode)
        assert values(store.read()) == sorted(r[3] for r in REPLICA)
    else:
        store.apply(table(spark, rows_in), mode)
        assert values(store.read()) == sorted(expected.split())
    assert store.files.names(f"{store.root}/_staging") == []
    found = partitions.partition_counts(store.read()).collect()
    assert directories(store) == {store._directory((r[0], r[1])) for r in found}
    assert store.read().schema["eff_to_month"].dataType.simpleString() == "string"


@pytest.mark.parametrize(
    ("mode", "options"),
    [
        (APPEND_CLOSE, {"format": "orc"}),
        (APPEND_CLOSE, {"tiny_bytes": 0}),
        (MERGE, {"broadcast_bytes": 0}),
        (MERGE, {"tiny_bytes": 0}),
        (MERGE, {"publish": "copy"}),
    ],
)
def test_chained_loads_equal_the_operators(spark, new_store, mode, options):
    store = new_store(**options)
    store.initial_load(history.initial(history.orders(spark, SF_DIR)))
    expected = history.replica(history.orders(spark, SF_DIR))
    first = history.increment(history.orders(spark, SF_DIR))
    late = history.late_increment(APPLY[mode](expected, prepare(first, expected.schema)))
    for raw in (first, late):
        expected = APPLY[mode](expected, prepare(raw, expected.schema))
        store.apply(raw, mode)
        assert rows(store.read()) == rows(expected)
    report = store.partition_report()
    only_gained = report.where("replaced = 0 and rows_before > 0").count()
    expected_appends = 0 if options.get("publish") == "copy" else only_gained
    assert report.where("action = 'append'").count() == expected_appends


def test_untouched_partitions_stay_as_they_are(spark, new_store):
    store = new_store()
    store.initial_load(history.initial(history.orders(spark, SF_DIR)))

    def files():
        out = {}
        for path, _, names in os.walk(store.root):
            if "/_" not in path[len(store.root) :]:
                out.update({os.path.join(path, n): path for n in names if n.endswith(".parquet")})
        return out

    before = files()
    narrow = history.increment(history.orders(spark, SF_DIR), year=1997)
    store.apply(narrow, APPEND_CLOSE, run_id="narrow")
    after = files()
    replaced = {
        f"{store.root}/{store._directory((r.to_month, r.from_month))}"
        for r in store.partition_report().where("replaced > 0").collect()
    }
    assert replaced
    for name, path in before.items():
        assert (name in after) == (path not in replaced)


@pytest.mark.parametrize(
    ("mode", "publish"), [(APPEND_CLOSE, "move"), (MERGE, "move"), (MERGE, "copy")]
)
def test_every_crash_point_of_a_publish_is_replayed(spark, new_store, mode, publish, monkeypatch):
    """Stop before the n-th change of the file system, then let a fresh store recover."""
    raw = [
        (2, "2024-02-03", "2024-04-10", "B"),  # empties a partition
        (1, "2024-01-03", "2024-04-11", "A"),  # rewrites one
        (6, "2024-01-09", "2024-03-02", "y"),  # adds to a closed one
        (9, "2024-05-01", "open", "x"),  # starts one
    ]
    schema = with_months(table(spark, REPLICA)).schema
    expected = values(
        APPLY[mode](with_months(table(spark, REPLICA)), prepare(table(spark, raw), schema))
    )
    crashes = 0
    for n in range(1, 60):
        store = new_store(publish=publish)
        store.initial_load(table(spark, REPLICA))
        left = [n]

        def stumbling(method, left=left):
            original = getattr(store.files, method)

            def call(*args):
                # Concurrent calls may follow the fatal one, as on a dying machine.
                left[0] -= 1
                if left[0] <= 0:
                    raise KeyboardInterrupt(method)
                return original(*args)

            return call

        publishing = store._publish

        def armed(stage, manifest):
            for method in ("delete", "move", "write_text"):
                monkeypatch.setattr(store.files, method, stumbling(method))
            publishing(stage, manifest)

        monkeypatch.setattr(store, "_publish", armed)
        try:
            store.apply(table(spark, raw), mode, run_id="r")
            break
        except KeyboardInterrupt:
            crashes += 1
        # The store that recovers may be set up for the other kind of publish.
        again = ReplicaStore(spark, store.root, publish="copy" if publish == "move" else "move")
        assert again.recover() == ["r"]
        assert values(again.read()) == expected
        again.apply(table(spark, raw), mode, run_id="r")
        assert values(again.read()) == expected
        assert again.partition_report().count() == again.partition_report().distinct().count()
    # A small file is replaced in one step, so a copy has few steps of its own.
    assert crashes >= (4 if publish == "copy" else 5)


def test_crash_before_the_manifest_changes_nothing(spark, new_store, monkeypatch):
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        store.apply(table(spark, CASES["emptied"][0]), MERGE, run_id="r")
    assert store.files.names(f"{store.root}/_staging") == ["r"]
    again = ReplicaStore(spark, store.root)
    assert values(again.read()) == sorted(r[3] for r in REPLICA)
    assert again.recover() == []
    again.apply(table(spark, CASES["emptied"][0]), MERGE, run_id="r")
    assert values(again.read()) == sorted(CASES["emptied"][2].split())


def test_repeating_an_increment(spark, new_store):
    raw = table(spark, CASES["redelivered"][0])
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    store.apply(raw, MERGE, run_id="one")
    store.apply(raw, MERGE, run_id="two")
    assert values(store.read()) == sorted(CASES["redelivered"][2].split())
    store.apply(raw, APPEND_CLOSE, run_id="three")
    store.apply(raw, APPEND_CLOSE, run_id="three")
    assert values(store.read()).count("a2") == 2
    assert store.stage_report().select("run_id").distinct().count() == 3


def test_a_changing_increment_is_refused(spark, new_store, monkeypatch):
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    monkeypatch.setattr(
        store, "_content", lambda replica, prepared, *rest: prepared.where("id <> 4").withColumn(
            "__tree", F.lit("replace"))
    )
    with pytest.raises(replica_module.LoadError, match="instead of"):
        store.apply(table(spark, CASES["emptied"][0] + CASES["late"][0]), MERGE)
    assert values(store.read()) == sorted(r[3] for r in REPLICA)
    assert store.files.names(f"{store.root}/_staging") == []


@pytest.mark.parametrize("publish", ["move", "copy"])
def test_initial_load_over_a_replica(spark, new_store, publish):
    store = new_store(publish=publish)
    store.initial_load(table(spark, REPLICA))
    with pytest.raises(replica_module.LoadError, match="already"):
        store.initial_load(table(spark, REPLICA))
    # The new content may come from the replica that it replaces.
    store.initial_load(store.read().where("v <> 'b'").withColumn("w", F.lit(1)), overwrite=True)
    assert values(store.read()) == ["a", "d", "e", "m", "n"]
    assert "w" in store.read().columns
    assert "eff_to_month=5999-12-31/eff_from_month=2024-02-29" not in directories(store)
    store.initial_load(store.read().orderBy("eff_from_dt"), overwrite=True, clustered=True)
    assert values(store.read()) == ["a", "d", "e", "m", "n"]


def test_initial_load_cut_short(spark, new_store, monkeypatch):
    store = new_store()
    write = store._write

    def partial(rows, *args):
        write(rows.where("id < 4"), *args)
        raise KeyboardInterrupt

    monkeypatch.setattr(store, "_write", partial)
    with pytest.raises(KeyboardInterrupt):
        store.initial_load(table(spark, REPLICA))
    again = ReplicaStore(spark, store.root)
    with pytest.raises(replica_module.LoadError, match="did not finish"):
        again.apply(table(spark, CASES["late"][0]), MERGE)
    again.initial_load(table(spark, REPLICA))
    assert values(again.read()) == sorted(r[3] for r in REPLICA)


def test_replica_written_by_other_means(spark, tmp_path):
    """Partitioned files without our metadata, as an earlier loader leaves them."""
    root = str(tmp_path / "foreign")
    with_months(table(spark, REPLICA)).write.partitionBy("eff_to_month", "eff_from_month").parquet(
        root
    )
    store = ReplicaStore(spark, root)
    store.apply(table(spark, CASES["emptied"][0]), APPEND_CLOSE)
    assert values(store.read()) == sorted(CASES["emptied"][1].split())


def test_jobs_by_path(spark, tmp_path):
    source, raw, root = (str(tmp_path / n) for n in ("source", "raw", "replica"))
    history.initial(history.orders(spark, SF_DIR)).write.parquet(source)
    history.increment(history.orders(spark, SF_DIR)).write.parquet(raw)
    jobs.initialise(spark, source, root)
    report = jobs.apply_increment(spark, raw, root, run_id="day-1")
    assert [r.stage for r in report.collect()] == [
        "profile", "keys", "detect", "stage", "verify", "publish"
    ]
    assert all(r.ok for r in jobs.check_load(spark, source, raw, root).collect())
    assert all(r.ok for r in jobs.check_load(spark, source, raw, root, MERGE).collect())


def test_filters_prune_partitions(spark, new_store):
    store = new_store()
    store.initial_load(history.initial(history.orders(spark, SF_DIR)))
    wanted = [("5999-12-31", "1997-01-31"), ("5999-12-31", None), (None, "1997-02-28")]
    for view in (
        partitions.open_view(store.read()),
        partitions.closed_view(store.read()),
        store.read().where(partitions.in_partitions(wanted, store.contract)),
    ):
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert "DataFilters: []" in plan and "PartitionFilters: []" not in plan
