"""Reports of every attempt, audits by run, and replicas as tables of the session's catalog."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from epochfold import APPEND_CLOSE, MERGE, ReplicaStore
from epochfold.operators import partitions
from epochfold.plans import orders_history as history
from epochfold.sources import replica as replica_module
from epochfold.sources.catalog import drop_external
from tests.test_edges import CASES, REPLICA, table, values
from tests.test_store import new_store  # noqa: F401

RAW = [
    (2, "2024-02-03", "2024-04-10", "B"),  # empties a partition
    (1, "2024-01-03", "2024-04-11", "A"),  # rewrites one
    (9, "2024-05-01", "open", "x"),  # starts one
]


def attempts(store):
    found = store.attempt_report().orderBy("started", "stage").collect()
    return [(r["run_id"], r["stage"], r["status"], r["rows_out"]) for r in found]


def checks(df):
    return {r["check"]: r["violations"] for r in df.collect()}


@pytest.fixture
def named(spark):
    names = []

    def make():
        names.append(f"replica_{uuid.uuid4().hex}")
        return names[-1]

    yield make
    for name in names:
        drop_external(spark, name)


# -- attempts -----------------------------------------------------------------------------------


def test_failed_loads_leave_their_stages(spark, new_store, monkeypatch):  # noqa: F811
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    n = len(REPLICA)
    first = [("initial-load", s, "done", n) for s in ("profile", "stage", "verify")]
    assert sorted(attempts(store)) == sorted(first)

    def stop(*_):
        raise replica_module.LoadError("disk full, " + "x" * 5000)

    with monkeypatch.context() as patch:
        patch.setattr(store, "_write_batch", stop)
        with pytest.raises(replica_module.LoadError):
            store.apply(table(spark, RAW), MERGE, run_id="r")
    assert store.stage_report().count() == 0
    (failed,) = store.attempt_report().where("status = 'failed'").collect()
    assert (failed["run_id"], failed["stage"], failed["rows_out"]) == ("r", "stage", 0)
    assert failed["error"].startswith("LoadError: disk full") and len(failed["error"]) <= 2000
    store.apply(table(spark, RAW), MERGE, run_id="r")
    done = store.attempt_report().where("run_id = 'r' and status = 'done'")
    assert done.groupBy("attempt").count().select("count").orderBy("count").collect() == [(3,), (5,)]


def test_keys_are_counted_as_written(spark, new_store):  # noqa: F811
    """Two rows of one version are one key; a version without an id is none."""
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    raw = [(9, "2024-05-01", "open", "x"), (9, "2024-05-01", "open", "y"), (None, "2024-05-01", "open", "z")]
    report = store.apply(table(spark, raw), MERGE, run_id="r")
    assert report.where("stage = 'keys'").select("rows_in", "rows_out").collect() == [(3, 1)]


@pytest.mark.parametrize("publish", ["move", "append", "copy"])
@pytest.mark.parametrize("again", [False, True])
def test_initial_load_is_verified(spark, new_store, publish, again):  # noqa: F811
    """A source that gives other rows at its second reading is refused."""
    store = new_store(publish=publish)
    if again:
        store.initial_load(table(spark, REPLICA))
    path = f"{store.root}-source"
    table(spark, REPLICA).write.parquet(path)
    source = spark.read.parquet(path)
    counted = store._incoming

    def changed(rows):
        found = counted(rows)
        next(iter(found.values())).incoming += 1
        return found

    store._incoming = changed
    with pytest.raises(replica_module.LoadError, match="instead of"):
        store.initial_load(source, overwrite=again)
    assert store.attempt_report().where("status = 'failed'").select("stage").collect() == [("verify",)]
    store._incoming = counted
    if again:  # the replica is as it was
        assert values(store.read()) == sorted(r[3] for r in REPLICA)
    store.initial_load(source, overwrite=again)
    assert values(store.read()) == sorted(r[3] for r in REPLICA)
    assert store.epoch == int(again)


def test_half_written_reports_are_not_read(spark, new_store):  # noqa: F811
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    before = store.attempt_report().count()
    store.files.write_text(f"{store.root}/_runs/attempts/x.json.draft", '{"attempt": "x"')
    assert store.attempt_report().count() == before


# -- audits -------------------------------------------------------------------------------------


@pytest.mark.parametrize("mode", [APPEND_CLOSE, MERGE])
def test_audit_of_each_edge_case(spark, new_store, mode):  # noqa: F811
    """Whatever the increment, a load that went well has its rows and the counts it reported."""
    for rows, appended, merged in CASES.values():
        if (appended if mode == APPEND_CLOSE else merged) is None:
            continue
        store = new_store()
        store.initial_load(table(spark, REPLICA))
        store.apply(table(spark, rows), mode, run_id="r")
        found = checks(store.audit("r", table(spark, rows)))
        assert found["partition_rows"] == found["increment_rows_present"] == 0, rows


def test_audit_finds_what_went_wrong(spark, new_store):  # noqa: F811
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    store.apply(table(spark, RAW), MERGE, run_id="r")
    good = checks(store.audit("r", table(spark, RAW)))
    assert set(good.values()) == {0} and len(good) == 4
    assert checks(store.audit("r")) == {"partition_rows": 0}

    rows = store.read().where("eff_from_month = '2024-05-31'")
    assert rows.count() == 1
    rows.write.mode("append").partitionBy("eff_to_month", "eff_from_month").parquet(store.root)
    assert checks(store.audit("r", table(spark, RAW))) == good | {
        "partition_rows": 1,
        "one_row_per_version": 1,
    }
    other = [(*RAW[0][:3], "other"), *RAW[1:]]
    assert checks(store.audit("r", table(spark, other)))["increment_rows_present"] == 1


def test_audit_reads_only_what_a_run_changed(spark, new_store):  # noqa: F811
    store = new_store()
    orders = history.orders(spark, "/root/testdata/sf0.001")
    store.initial_load(history.initial(orders))
    store.apply(history.increment(orders, year=1997), APPEND_CLOSE, run_id="r")
    before = set(store.partitions())
    own = {(r[0], r[1]) for r in store.changed_partitions("r").collect()}
    assert own < before
    # a partition that the run did not change may be lost, or unreadable, for all the audit knows
    lost = next(p for p in sorted(before - own) if p[1] < "1996")
    directory = f"{store.root}/{store._directory(lost)}"
    for name in os.listdir(directory):
        if name.endswith(".parquet"):
            with open(f"{directory}/{name}", "wb") as f:
                f.write(b"no such file")
    assert set(checks(store.audit("r", history.increment(orders, year=1997))).values()) == {0}


def test_audit_after_later_runs_and_generations(spark, new_store):  # noqa: F811
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    store.apply(table(spark, RAW), MERGE, run_id="one")
    store.apply(table(spark, [(9, "2024-05-01", "2024-06-03", "z")]), MERGE, run_id="two")
    assert checks(store.audit("one")) == {"partition_rows": 0}
    with pytest.raises(replica_module.LoadError, match="later run"):
        store.audit("one", table(spark, RAW))
    assert set(checks(store.audit("two", table(spark, [(9, "2024-05-01", "2024-06-03", "z")]))).values()) == {0}
    with pytest.raises(replica_module.LoadError, match="no published run"):
        store.audit("three")
    store.initial_load(table(spark, REPLICA), overwrite=True)
    with pytest.raises(replica_module.LoadError, match="no published run"):
        store.audit("one")


def test_audit_of_an_empty_increment(spark, new_store):  # noqa: F811
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    store.apply(table(spark, REPLICA).limit(0), MERGE, run_id="r")
    assert set(checks(store.audit("r", table(spark, REPLICA).limit(0))).values()) == {0}


# -- tables by name -----------------------------------------------------------------------------


@pytest.mark.parametrize("publish", ["move", "append", "copy"])
def test_table_follows_the_replica(spark, new_store, named, publish):  # noqa: F811
    name = named()
    store = new_store(publish=publish, table=name)
    store.initial_load(table(spark, REPLICA))
    assert values(spark.table(name)) == sorted(r[3] for r in REPLICA)
    for rows, _, merged in CASES.values():
        if merged is not None:
            store.apply(table(spark, rows), MERGE)
            assert values(spark.table(name)) == values(store.read())
    listed = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert listed == {store._directory(p) for p in store.partitions()}
    store.initial_load(table(spark, REPLICA), overwrite=True)
    assert values(spark.table(name)) == sorted(r[3] for r in REPLICA)
    assert spark.table(name).schema == store.read().schema


def test_table_is_pruned_by_month(spark, new_store, named):  # noqa: F811
    name = named()
    store = new_store(table=name)
    store.initial_load(history.initial(history.orders(spark, "/root/testdata/sf0.001")))
    view = partitions.open_view(spark.table(name)).where("eff_from_month = '1997-03-31'")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eff_to_month" in plan
    assert {os.path.dirname(f).rsplit("/", 1)[1] for f in view.inputFiles()} == {"eff_from_month=1997-03-31"}
    want = store.read().where("eff_from_month = '1997-03-31'").count()
    assert view.count() == want > 0


def test_table_catches_up_and_keeps_its_files(spark, new_store, named):  # noqa: F811
    """A load without the table, then recovery with it; dropping the table leaves the replica."""
    name = named()
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    with_table = ReplicaStore(spark, store.root, table=name)
    with_table.recover()
    assert values(spark.table(name)) == values(store.read())
    store.apply(table(spark, RAW), MERGE)
    with_table.recover()
    with_table.recover()
    assert values(spark.table(name)) == values(store.read())
    drop_external(spark, name)
    assert values(store.read()) and not spark.catalog.tableExists(name)


def test_table_of_another_place_is_left_alone(spark, new_store, named):  # noqa: F811
    name = named()
    spark.range(3).write.saveAsTable(name)
    store = new_store(table=name)
    with pytest.raises(ValueError, match="is not the replica"):
        store.initial_load(table(spark, REPLICA))
    assert spark.table(name).count() == 3
    assert values(store.read()) == sorted(r[3] for r in REPLICA)
    spark.sql(f"DROP TABLE {name}")


def test_table_of_other_columns_after_a_new_generation(spark, new_store, named):  # noqa: F811
    name = named()
    store = new_store(table=name)
    store.initial_load(table(spark, REPLICA))
    store.initial_load(table(spark, REPLICA).withColumn("more", F.lit(1)), overwrite=True)
    assert spark.table(name).where("more = 1").count() == len(REPLICA)
