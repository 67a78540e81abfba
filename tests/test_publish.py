"""Publishing next to another process: ownership, interleaved recovery, appended loads, generations."""

import json
import shutil

import pytest
from pyspark.sql.types import StructType

from epochfold import APPEND_CLOSE, MERGE, ReplicaStore, append_close, merge, prepare
from epochfold.operators.increment import with_months
from epochfold.sources import replica as replica_module
from epochfold.sources.owner import BusyError, FencedError
from tests.test_edges import CASES, REPLICA, table, values
from tests.test_store import directories, new_store  # noqa: F401

APPLY = {APPEND_CLOSE: append_close, MERGE: merge}
RAW = [
    (2, "2024-02-03", "2024-04-10", "B"),  # empties a partition
    (1, "2024-01-03", "2024-04-11", "A"),  # rewrites one
    (6, "2024-01-09", "2024-03-02", "y"),  # adds to a closed one
    (9, "2024-05-01", "open", "x"),  # starts one
]
CALLS = ("exists", "names", "delete", "delete_if_empty", "make", "move", "write_text", "read_text", "create")


def expected(spark, mode, raw=RAW):
    start = with_months(table(spark, REPLICA))
    return values(APPLY[mode](start, prepare(table(spark, raw), start.schema)))


def before_call(store, monkeypatch, n, action, calls=CALLS):
    """Run ``action`` once, ahead of the n-th operation on files; tell whether there was one."""
    left = [n]

    def wrapped(files, method):
        original = getattr(files, method)

        def call(*args):
            left[0] -= 1
            if left[0] == 0:
                action()
            return original(*args)

        monkeypatch.setattr(files, method, call)

    for files in (store.files, store.owner.files):
        for method in calls:
            wrapped(files, method)
    return lambda: left[0] <= 0


def one_at_a_time(action, items):
    for item in items:
        action(item)


def staged(spark, store, monkeypatch):
    """A load that is complete but for its manifest, as a directory to copy, and the manifest."""
    store.initial_load(table(spark, REPLICA))
    found = []

    def stop(stage, manifest):
        found.append((stage, manifest))
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(store, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            store.apply(table(spark, RAW), MERGE, run_id="r")
    return found[0]


@pytest.mark.parametrize("publish", ["move", "append"])
def test_recovery_between_any_two_operations(spark, new_store, monkeypatch, publish, tmp_path):  # noqa: F811
    """Another process takes over before the n-th operation of a publish; no row is lost."""
    want, before = expected(spark, MERGE), sorted(r[3] for r in REPLICA)
    store = new_store(publish=publish)
    stage, manifest = staged(spark, store, monkeypatch)
    seen = set()
    for n in range(1, 400):
        root = str(tmp_path / f"copy-{n}")
        shutil.copytree(store.root, root)
        one = ReplicaStore(spark, root, publish=publish)
        one.owner.token = store.owner.token
        monkeypatch.setattr(one, "_each", one_at_a_time)
        other = ReplicaStore(spark, root, publish=publish)
        reached = before_call(one, monkeypatch, n, other.recover)
        try:
            one._commit(stage.replace(store.root, root), dict(manifest))
            outcome = "finished"
        except (FencedError, replica_module.LoadError, OSError):
            outcome = "stopped"
        again = ReplicaStore(spark, root, publish=publish)
        again.recover()
        state = values(again.read())
        assert state in (want, before), n
        assert again.files.names(f"{root}/_staging") == []
        if not reached():
            assert outcome == "finished" and state == want
            break
        seen.add((outcome, state == want))
    else:
        raise AssertionError("the publish has more operations than were tried")
    assert ("finished", False) not in seen
    assert {("stopped", False), ("stopped", True)} <= seen


@pytest.mark.parametrize("publish", ["move", "append"])
def test_recovery_while_a_load_is_staged(spark, new_store, monkeypatch, publish):  # noqa: F811
    """A load that is taken over before its manifest stops, and the replica is as it was."""
    for step in ("_incoming", "_stage_keys", "_count_before", "_usage", "_verify"):
        store = new_store(publish=publish)
        store.initial_load(table(spark, REPLICA))
        original = getattr(store, step)

        def taken(*args, store=store, original=original):
            ReplicaStore(spark, store.root, publish=publish).recover()
            return original(*args)

        monkeypatch.setattr(store, step, taken)
        with pytest.raises((FencedError, replica_module.LoadError, OSError)):
            store.apply(table(spark, RAW), MERGE, run_id="r")
        again = ReplicaStore(spark, store.root, publish=publish)
        again.recover()
        assert values(again.read()) == sorted(r[3] for r in REPLICA)
        again.apply(table(spark, RAW), MERGE, run_id="r")
        assert values(again.read()) == expected(spark, MERGE)


def test_a_second_load_is_refused(spark, new_store, monkeypatch):  # noqa: F811
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    profile = store._incoming
    refused = []

    def busy(prepared):
        other = ReplicaStore(spark, store.root)
        with pytest.raises(BusyError, match="first"):
            other.apply(table(spark, RAW), MERGE, run_id="second")
        with pytest.raises(BusyError, match="first"):
            other.initial_load(table(spark, REPLICA), overwrite=True)
        refused.append(True)
        return profile(prepared)

    monkeypatch.setattr(store, "_incoming", busy)
    store.apply(table(spark, RAW), MERGE, run_id="first")
    assert refused and values(store.read()) == expected(spark, MERGE)
    assert not store.files.exists(f"{store.root}/_owner")
    ReplicaStore(spark, store.root).apply(table(spark, RAW), MERGE, run_id="second")


def test_a_repeated_run_takes_over_from_its_dead_attempt(spark, new_store, monkeypatch):  # noqa: F811
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        store.apply(table(spark, RAW), MERGE, run_id="r")
    again = ReplicaStore(spark, store.root)
    with pytest.raises(BusyError):
        again.apply(table(spark, RAW), MERGE, run_id="other")
    again.apply(table(spark, RAW), MERGE, run_id="r")
    assert values(again.read()) == expected(spark, MERGE)


@pytest.mark.parametrize("mode", [APPEND_CLOSE, MERGE])
def test_every_crash_point_of_an_appended_load(spark, new_store, monkeypatch, mode):  # noqa: F811
    """Stop ahead of the n-th change of the file system, wherever in the load that is."""
    want = expected(spark, mode)
    writes = ("delete", "delete_if_empty", "make", "move", "write_text", "create")
    states = set()
    for n in range(1, 80):
        store = new_store(publish="append")
        store.initial_load(table(spark, REPLICA))
        monkeypatch.setattr(store, "_each", one_at_a_time)

        def die():
            raise KeyboardInterrupt

        before_call(store, monkeypatch, n, die, writes)
        try:
            store.apply(table(spark, RAW), mode, run_id="r")
            break
        except KeyboardInterrupt:
            pass
        again = ReplicaStore(spark, store.root, publish="append")
        again.recover()
        state = values(again.read())
        assert state in (want, sorted(r[3] for r in REPLICA))
        states.add(tuple(state))
        again.apply(table(spark, RAW), mode, run_id="r")
        assert values(again.read()) == want
    else:
        raise AssertionError("more steps than were tried")
    assert len(states) == 2


def test_append_renames_nothing_and_overwrites_nothing(spark, new_store, monkeypatch):  # noqa: F811
    store = new_store(publish="append")

    def refuse(*args):
        raise AssertionError("renamed")

    for files in (store.files, store.owner.files):
        monkeypatch.setattr(files, "move", refuse)
    monkeypatch.setattr(store, "_overwrite_partitions", refuse)
    store.initial_load(table(spark, REPLICA))
    for i, name in enumerate(("emptied", "late")):
        store.apply(table(spark, CASES[name][0]), MERGE, run_id=f"r{i}")
    store.initial_load(store.read().where("v <> 'a'"), overwrite=True)
    assert "a" not in values(store.read())


def test_appended_load_that_fails_its_count_is_taken_back(spark, new_store, monkeypatch):  # noqa: F811
    store = new_store(publish="append")
    store.initial_load(table(spark, REPLICA))
    content = store._content
    monkeypatch.setattr(store, "_content", lambda *a: content(*a).where("v <> 'x'"))
    with pytest.raises(replica_module.LoadError, match="instead of"):
        store.apply(table(spark, RAW), MERGE, run_id="r")
    assert values(store.read()) == sorted(r[3] for r in REPLICA)
    assert store.files.names(f"{store.root}/_staging") == []


@pytest.mark.parametrize("publish", ["move", "append", "copy"])
def test_generations(spark, new_store, publish):  # noqa: F811
    """A run id counts within a generation of the replica only."""
    store = new_store(publish=publish)
    store.initial_load(table(spark, REPLICA))
    store.apply(table(spark, RAW), MERGE, run_id="r")
    store.initial_load(table(spark, REPLICA), overwrite=True)
    assert store.epoch == 1 and values(store.read()) == sorted(r[3] for r in REPLICA)
    store.apply(table(spark, RAW), MERGE, run_id="r")
    assert values(store.read()) == expected(spark, MERGE)
    store.apply(table(spark, RAW), MERGE, run_id="r")
    assert values(store.read()) == expected(spark, MERGE)
    report = store.stage_report().groupBy("epoch").count().collect()
    assert sorted(tuple(r) for r in report) == [(0, 6), (1, 6)]


def test_schema_file_of_an_earlier_version(spark, new_store):  # noqa: F811
    store = new_store()
    store.initial_load(table(spark, REPLICA))
    path = f"{store.root}/_schema.json"
    bare = json.dumps(json.loads(store.files.read_text(path))["schema"])
    store.files.write_text(path, bare)
    again = ReplicaStore(spark, store.root)
    assert again.epoch == 0
    again.apply(table(spark, RAW), MERGE)
    assert values(again.read()) == expected(spark, MERGE)


@pytest.mark.parametrize("publish", ["move", "append"])
def test_batches_of_months(spark, new_store, monkeypatch, publish):  # noqa: F811
    """A rewrite in several jobs gives what one job gives."""
    store = new_store(publish=publish, batch_bytes=1)
    store.initial_load(table(spark, REPLICA))
    jobs = []
    write = store._write_batch

    def spy(replica, prepared, keys, batch, *rest):
        jobs.append({key[1] for key in batch})
        write(replica, prepared, keys, batch, *rest)

    monkeypatch.setattr(store, "_write_batch", spy)
    store.apply(table(spark, RAW), MERGE, run_id="r")
    assert values(store.read()) == expected(spark, MERGE)
    months = [month for job in jobs for month in job]
    assert len(jobs) >= 2 and len(months) == len(set(months)) == 3
    found = {(r.eff_to_month, r.eff_from_month) for r in store.read().collect()}
    assert directories(store) == {store._directory(p) for p in found}


def test_compaction_is_decided_for_each_partition(spark, new_store, monkeypatch):  # noqa: F811
    """One month of small files is brought together; the others are written as they are read."""
    store = new_store(tiny_bytes=0, crowded=1)
    replica = [*REPLICA, (3, "2024-02-05", "open", "c")]
    store.initial_load(table(spark, replica))
    (month,) = [p for p in directories(store) if p.startswith("eff_to_month=5999") and "2024-02" in p]
    kept = spark.read.parquet(f"{store.root}/{month}").collect()
    store.files.delete(f"{store.root}/{month}")
    schema = store.schema.fields[:4]
    for row in [*kept, None, None]:
        some = spark.createDataFrame([row] if row else [], StructType(schema)).coalesce(1)
        some.write.mode("append").parquet(f"{store.root}/{month}")
    assert len(store.files.names(f"{store.root}/{month}")) > 2
    seen = []
    content = store._content

    def spy(replica, prepared, keys, changes, loose):
        out = content(replica, prepared, keys, changes, loose)
        seen.append((changes, loose, out._jdf.queryExecution().optimizedPlan().toString()))
        return out

    monkeypatch.setattr(store, "_content", spy)
    raw = [(1, "2024-01-03", "2024-04-11", "A"), (2, "2024-02-03", "2024-04-10", "B")]
    store.apply(table(spark, raw), MERGE, run_id="r")
    assert values(store.read()) == sorted("ABcdemn")
    ((changes, loose, plan),) = seen
    rewritten = {key for key, c in changes.items() if c.action == "replace" and c.rows_before}
    compact = {key for key in rewritten if store._directory(key) == month}
    assert loose == rewritten - compact and loose and compact
    assert plan.count("RebalancePartitions") == 1
    assert plan.count("Join LeftAnti") == 2
