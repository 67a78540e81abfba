"""Properties that only matter on large or skewed data, checked on plans and random tables."""

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epochfold import APPEND_CLOSE, MERGE, ReplicaStore, append_close, merge, prepare
from epochfold.operators import apply, partitions
from epochfold.operators.increment import with_months
from epochfold.sources import catalog
from tests.test_edges import OPEN, REPLICA, SCHEMA, table
from tests.test_store import rows


@pytest.fixture
def conf(spark):
    changed = {}

    def set_all(values):
        for key, value in values.items():
            changed[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield set_all
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, tmp_path, copies):
    """A third of all replica rows carries one version key, a third of the increment another."""
    base = spark.range(0, 2 * copies, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 10).alias("id"),
        F.lit(date(2024, 1, 3)).alias("eff_from_dt"),
        F.lit(OPEN).alias("eff_to_dt"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"),
    )
    base.write.parquet(str(tmp_path / "replica"))
    replica = with_months(spark.read.parquet(str(tmp_path / "replica")))
    closing = base.where("id % 5 = 0").withColumn("eff_to_dt", F.lit(date(2024, 3, 1)))
    hot = closing.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies // 8))))
    return replica, prepare(closing.unionByName(hot.drop("n")), replica.schema)


@pytest.mark.parametrize("mode", [APPEND_CLOSE, MERGE])
def test_hot_replica_key_is_split(spark, tmp_path, conf, mode):
    conf(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        }
    )
    replica, incoming = skewed(spark, tmp_path, 30_000)
    if mode == APPEND_CLOSE:
        result = apply.surviving_open(replica, incoming)
        assert result.count() == replica.where("id % 5 <> 0").count()
    else:
        # A merge wants each key once; the increment arrives as files, in no order of the key.
        path = str(tmp_path / "increment")
        incoming.dropDuplicates(["id", "eff_from_dt"]).write.parquet(path)
        incoming = spark.read.parquet(path)
        result = merge(replica, incoming)
        expected = replica.where("id % 5 <> 0").count() + incoming.count()
        assert result.count() == expected
    assert "skew=true" in final_plan(result)


def test_hot_key_is_one_row_a_task_where_keys_are_counted(spark, tmp_path, conf):
    """The join of `merge_actions` and `merge_conflicts` meets each replica key once."""
    conf(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        }
    )
    replica, incoming = skewed(spark, tmp_path, 3_000)
    hot = replica.groupBy("id").count().where("count > 1").first()["count"]
    for result, rows_in in (
        (apply.merge_actions(replica, incoming), None),
        (apply.merge_conflicts(replica, incoming), 1),
    ):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        join = plan.index("Join Inner")
        assert "count(1) AS target_rows" in plan[join:]
        physical = final_plan(result)
        assert "partial_count(1)" in physical
        if rows_in is not None:
            assert result.count() == rows_in
    actions = {r.action: r["rows"] for r in apply.merge_actions(replica, incoming).collect()}
    assert actions["update"] == replica.where("id % 5 = 0").count()
    assert hot > 1_000


@pytest.mark.parametrize("operator", ["merge", "surviving_open", "touched_partitions", "merge_conflicts"])
def test_other_months_are_pruned(spark, tmp_path, conf, operator):
    """Only the months that keys start in are joined; the others are read and not shuffled."""
    conf(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        }
    )
    store = ReplicaStore(spark, str(tmp_path / "replica"))
    months = [(i, f"2024-{m:02d}-03", "open", f"{i}-{m}") for m in range(1, 13) for i in range(1, 4)]
    store.initial_load(table(spark, months))
    raw = [(1, "2024-05-03", "2024-06-03", "x"), (1, "2024-05-03", "2024-06-03", "y")]
    incoming = prepare(table(spark, raw if operator == "merge_conflicts" else raw[:1]), store.schema)
    replica = store.read()
    if operator == "touched_partitions":
        result = partitions.touched_partitions(replica, incoming, MERGE)
        assert result.count() == 2
    else:
        result = getattr(apply, operator)(replica, incoming)
        assert result.count() == {"merge": 36, "surviving_open": 35, "merge_conflicts": 1}[operator]
    result.collect()
    scans = {}

    def walk(node, shuffled):
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            text = node.toString()
            if "array_contains" in text:
                read = node.metrics().apply("numFiles").value()
                scans.setdefault("NOT" in text.split("PartitionFilters")[1].split("array_contains")[0], []).append((read, shuffled))
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan(), shuffled)
        if name.endswith("QueryStage"):
            return walk(node.plan(), shuffled)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), shuffled or "Exchange" == name)

    walk(result._jdf.queryExecution().executedPlan(), False)
    assert {read for read, _ in scans[False]} == {1}
    assert all(not shuffled and read == 11 for read, shuffled in scans.get(True, []))
    assert (True in scans) is (operator in ("merge", "surviving_open"))


def test_repeated_keys_are_combined_before_the_shuffle(spark, tmp_path):
    replica, incoming = skewed(spark, tmp_path, 3_000)
    plan = apply.surviving_open(replica, incoming)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [id" in plan
    physical = apply.surviving_open(replica, incoming)._jdf.queryExecution().executedPlan()
    assert physical.toString().count("HashAggregate(keys=[id") == 2


def test_closed_history_is_not_shuffled(spark, tmp_path, conf):
    conf(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        }
    )
    store = ReplicaStore(spark, str(tmp_path / "replica"))
    store.initial_load(table(spark, REPLICA))
    incoming = prepare(table(spark, [(1, "2024-01-03", "2024-02-03", "x")]), store.schema)
    plan = append_close(store.read(), incoming)._jdf.queryExecution().executedPlan().toString()
    branches = plan.split("FileScan")
    # closed history, open months with keys, other open months, and the increment's own scan
    assert len(branches) == 4
    assert "NOT (eff_to_month" in plan and "Exchange" not in branches[0]
    assert "hashpartitioning" in branches[1] and "hashpartitioning" not in branches[3]


def test_broadcast_needs_a_bound(spark, tmp_path):
    store = ReplicaStore(spark, str(tmp_path / "replica"))
    store.initial_load(table(spark, REPLICA))
    incoming = prepare(table(spark, [(1, "2024-01-03", "2024-02-03", "x")]), store.schema)
    for i, (bound, small) in enumerate([(1, True), (10_000_000, False)]):
        staged = store._stage_keys(incoming, MERGE, str(tmp_path / f"stage{i}"))
        keys, chosen = store._hinted(staged, bound)
        assert chosen is small
        joined = apply.on_version(store.read(), keys, "left_anti", store.contract)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) is small
        assert ("SortMergeJoin" in plan) is not small


@pytest.mark.parametrize("tiny_bytes", [0, 1 << 20])
def test_kept_rows_are_written_from_where_they_were_read(
    spark, tmp_path, monkeypatch, tiny_bytes
):
    """Next to a broadcast key set only the increment is shuffled, unless files are tiny."""
    plans = []
    store = ReplicaStore(spark, str(tmp_path / "replica"), tiny_bytes=tiny_bytes)
    store.initial_load(table(spark, REPLICA))
    write = store._write

    def spy(rows, path, *mode):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, path, *mode)

    monkeypatch.setattr(store, "_write", spy)
    store.apply(table(spark, [(1, "2024-01-03", "2024-02-03", "x")]), APPEND_CLOSE)
    (plan,) = plans
    assert plan.count("REBALANCE") == 1 and "SortMergeJoin" not in plan
    kept_rows_shuffled = plan.index("REBALANCE") < plan.index("Union")
    assert kept_rows_shuffled is (tiny_bytes > 0)


def test_few_replaced_keys_of_a_large_increment_are_broadcast(spark, tmp_path, monkeypatch):
    plans = []
    store = ReplicaStore(spark, str(tmp_path / "replica"), tiny_bytes=0, broadcast_bytes=200)
    store.initial_load(table(spark, REPLICA))
    write = store._write

    def spy(rows, path, *mode):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, path, *mode)

    monkeypatch.setattr(store, "_write", spy)
    fresh = [(100 + i, "2024-01-03", "open", "x") for i in range(5)]
    store.apply(table(spark, [*fresh, (1, "2024-01-03", "2024-02-03", "A")]), MERGE)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert plans[0].count("REBALANCE") == 1
    assert sorted(r.v for r in store.read().collect()) == sorted("Abdemn") + ["x"] * 5


def test_shuffles_widen_with_the_data(spark, tmp_path, monkeypatch):
    given = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr("epochfold.sources.replica._BYTES_PER_TASK", 100)
    widths = []
    store = ReplicaStore(spark, str(tmp_path / "replica"))
    write = store._write

    def spy(*args):
        widths.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        write(*args)

    monkeypatch.setattr(store, "_write", spy)
    table(spark, REPLICA).write.parquet(str(tmp_path / "source"))
    store.initial_load(spark.read.parquet(str(tmp_path / "source")))
    store.apply(table(spark, [(1, "2024-01-03", "2024-02-03", "x")]), APPEND_CLOSE)
    assert min(widths) > int(given)
    assert spark.conf.get("spark.sql.shuffle.partitions") == given


def test_catalog_merge_is_complete_up_to_the_table_format(spark):
    """Names and types resolve; what the container lacks is a table that takes row changes."""
    spark.sql("DROP TABLE IF EXISTS plain_replica")
    table(spark, REPLICA).write.saveAsTable("plain_replica")
    raw = table(spark, [(1, "2024-01-03", "2024-02-03", "x")])
    with pytest.raises(Exception, match="MERGE"):
        catalog.merge_into_table(spark, "plain_replica", raw)
    with pytest.raises(Exception):
        catalog.merge_into_table(spark, "plain_replica", raw.drop("eff_from_dt"))
    with pytest.raises(Exception, match="(?i)partition|transform|replace"):
        catalog.create_replica_table(table(spark, REPLICA), "monthly_replica", provider="orc")
    catalog.drop_table(spark, "plain_replica")
    assert not spark.catalog.tableExists("plain_replica")


START = date(2024, 1, 1)
ids = st.integers(min_value=1, max_value=8)
days = st.integers(min_value=0, max_value=120)


@st.composite
def histories(draw):
    """A replica with closed and open versions and a conforming increment for it."""
    replica, incoming, payload = [], [], iter(range(1000))
    for key in draw(st.sets(ids, min_size=1)):
        start = START + timedelta(days=draw(days))
        for _ in range(draw(st.integers(0, 2))):
            end = start + timedelta(days=draw(days))
            replica.append((key, start, end, str(next(payload))))
            start = end + timedelta(days=1)
        replica.append((key, start, OPEN, str(next(payload))))
        if draw(st.booleans()):
            end = start + timedelta(days=draw(days))
            incoming.append((key, start, end, str(next(payload))))
            if draw(st.booleans()):
                successor = end + timedelta(days=1)
                incoming.append((key, successor, OPEN, str(next(payload))))
    for key in draw(st.sets(st.integers(min_value=20, max_value=24))):
        incoming.append((key, START, OPEN, str(next(payload))))
    return replica, incoming


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(histories())
def test_both_modes_agree_on_conforming_increments(spark, pair):
    replica = with_months(spark.createDataFrame(pair[0], SCHEMA))
    incoming = prepare(spark.createDataFrame(pair[1], SCHEMA), replica.schema)
    appended, merged = append_close(replica, incoming), merge(replica, incoming)
    assert rows(appended) == rows(merged)
    assert rows(merge(merged, incoming)) == rows(merged)
