"""The rules for unusual increments, one small table each."""

from datetime import date

import pytest

from epochfold import APPEND_CLOSE, MERGE, Contract, append_close, merge, prepare
from epochfold.model import text_months
from epochfold.operators import apply, increment, partitions, reconcile
from epochfold.operators.increment import with_months

OPEN = date(5999, 12, 31)
SCHEMA = "id long, eff_from_dt date, eff_to_dt date, v string"


def d(text):
    return date.fromisoformat(text) if text else None


def table(spark, rows):
    return spark.createDataFrame(
        [(i, d(a), OPEN if b == "open" else d(b), v) for i, a, b, v in rows], SCHEMA
    )


REPLICA = [
    (1, "2024-01-03", "open", "a"),
    (2, "2024-02-03", "open", "b"),
    (4, "2024-01-09", "2024-03-01", "d"),
    (5, "2024-01-20", "open", "e"),
    (None, "2024-01-05", "open", "n"),
    (8, None, "open", "m"),
]

CASES = {
    "emptied": ([(2, "2024-02-03", "2024-04-10", "B")], "a B d e m n", "a B d e m n"),
    "new_and_closed": ([(9, "2024-05-01", "2024-05-20", "x")], "a b d e m n x", "a b d e m n x"),
    "late": ([(4, "2024-01-09", "2024-03-05", "d2")], "a b d d2 e m n", "a b d2 e m n"),
    "redelivered": ([(1, "2024-01-03", "open", "a2")], "a a2 b d e m n", "a2 b d e m n"),
    "null_id": ([(None, "2024-01-05", "2024-02-01", "N")], "a b d e m N n", "a b d e m N n"),
    "open_by_month": ([(7, "2024-06-01", "5999-12-15", "z")], "a b d e m n z", "a b d e m n z"),
    "null_end": ([(1, "2024-01-03", None, "h")], "a b d e h m n", "b d e h m n"),
    "null_start": ([(8, None, "2024-07-01", "m2")], "a b d e m m2 n", "a b d e m m2 n"),
    "empty": ([], "a b d e m n", "a b d e m n"),
    "repeated": (
        [(1, "2024-01-03", "2024-02-10", "p"), (1, "2024-01-03", "2024-02-11", "q")],
        "b d e m n p q",
        None,
    ),
    "repeated_new": (
        [(1, "2030-01-03", "2030-02-10", "p"), (1, "2030-01-03", "2030-02-11", "q")],
        "a b d e m n p q",
        "a b d e m n p q",
    ),
}


def values(df):
    return sorted(r.v for r in df.collect())


@pytest.mark.parametrize("name", CASES)
def test_case(spark, name):
    rows, appended, merged = CASES[name]
    replica = with_months(table(spark, REPLICA))
    incoming = prepare(table(spark, rows), replica.schema)
    assert values(append_close(replica, incoming)) == sorted(appended.split())
    if merged is None:
        with pytest.raises(Exception, match="several increment rows"):
            merge(replica, incoming).collect()
        conflicts = apply.merge_conflicts(replica, incoming).collect()
        assert [(r.id, r.source_rows, r.target_rows) for r in conflicts] == [(1, 2, 1)]
    else:
        assert values(merge(replica, incoming)) == sorted(merged.split())
        assert apply.merge_conflicts(replica, incoming).count() == 0


@pytest.mark.parametrize("mode", [APPEND_CLOSE, MERGE])
@pytest.mark.parametrize("name", [n for n in CASES if CASES[n][2]])
def test_touched_partitions_add_up(spark, name, mode):
    replica = with_months(table(spark, REPLICA))
    incoming = prepare(table(spark, CASES[name][0]), replica.schema)
    result = (append_close if mode == APPEND_CLOSE else merge)(replica, incoming)
    after = {(r[0], r[1]): r[2] for r in partitions.partition_counts(result).collect()}
    before = {(r[0], r[1]): r[2] for r in partitions.partition_counts(replica).collect()}
    for r in partitions.touched_partitions(replica, incoming, mode).collect():
        key = (r.eff_to_month, r.eff_from_month)
        assert (r.rows_before, r.rows_after) == (before.pop(key, 0), after.pop(key, 0))
    assert before == after


def test_merge_actions_with_null_keys(spark):
    replica = with_months(table(spark, REPLICA))
    rows = [(None, "2024-01-05", "2024-02-01", "N"), (1, "2024-01-03", "open", "a2")]
    incoming = prepare(table(spark, rows), replica.schema)
    found = {r.action: r.rows for r in apply.merge_actions(replica, incoming).collect()}
    assert found == {"update": 1, "keep": 5, "insert": 1}
    nothing = prepare(table(spark, []), replica.schema)
    found = {r.action: r.rows for r in apply.merge_actions(replica, nothing).collect()}
    assert found == {"update": 0, "keep": 6, "insert": 0}


def test_null_and_unknown_ids_are_new(spark):
    replica = with_months(table(spark, REPLICA))
    rows = [
        (None, "2024-01-05", "open", "x"),
        (9, "2024-01-05", "open", "y"),
        (9, "2024-02-05", "open", "z"),
        (1, "2024-02-05", "open", "w"),
    ]
    found = {r.id: r.rows for r in reconcile.new_entities(replica, table(spark, rows)).collect()}
    assert found == {None: 1, 9: 2}


def test_count_check_reports_a_mismatch(spark):
    replica = with_months(table(spark, REPLICA))
    incoming = prepare(table(spark, CASES["new_and_closed"][0]), replica.schema)
    result = append_close(replica, incoming)
    checks = reconcile.check_counts(replica, incoming, result, APPEND_CLOSE)
    # Id 9 is above the six initial rows, so the equation expects it to be open.
    found = {r.check: (r.expected, r.actual, r.ok) for r in checks.collect()}
    assert found["open"] == (7, 5, False)
    with pytest.raises(reconcile.ReconciliationError, match="open"):
        reconcile.assert_ok(checks)


def test_key_checks_see_lost_and_surplus_rows(spark):
    replica = with_months(table(spark, REPLICA))
    incoming = prepare(table(spark, CASES["emptied"][0]), replica.schema)
    good = append_close(replica, incoming)
    reconcile.assert_ok(reconcile.check_keys(replica, incoming, good, APPEND_CLOSE))
    reconcile.assert_ok(
        reconcile.check_keys(replica, incoming, merge(replica, incoming), MERGE)
    )
    bad = good.where("v not in ('B', 'd')").unionByName(replica.where("v in ('b', 'e')"))
    found = {
        r.check: r.violations
        for r in reconcile.check_keys(replica, incoming, bad, APPEND_CLOSE).collect()
    }
    assert found == {
        "increment_rows_present": 1,
        "kept_rows_present": 1,
        "closed_keys_not_open": 1,
        "one_row_per_version": 1,
        "one_open_row_per_id": 1,
    }


def test_increment_is_aligned(spark):
    replica = with_months(
        spark.createDataFrame([(1, d("2024-01-03"), OPEN, 1.0)], "id long, eff_from_dt date, "
                              "eff_to_dt date, `a b``c-d` double")
    )
    rows = spark.createDataFrame(
        [(2.5, "extra", "2000-01-01", OPEN, d("2024-01-31"), 7)],
        "`a b``c-d` float, more string, eff_from_month string, eff_to_dt date, "
        "eff_from_dt date, id int",
    )
    prepared = prepare(rows, replica.schema)
    assert prepared.columns == replica.columns
    assert [f.dataType for f in prepared.schema] == [f.dataType for f in replica.schema]
    assert prepared.first().eff_from_month == "2024-01-31"
    assert append_close(replica, prepared).count() == 2
    with pytest.raises(ValueError, match="eff_to_dt"):
        increment.align(rows.drop("eff_to_dt"), replica.schema)
    late = rows.withColumn("eff_from_dt", rows.eff_from_dt.cast("timestamp"))
    with pytest.raises(TypeError, match="timestamp -> date"):
        prepare(late, replica.schema)


def test_timestamps_keep_their_time_of_day(spark):
    replica = with_months(
        spark.sql(
            "SELECT 1L AS id, timestamp'2024-01-03 08:00:00' AS eff_from_dt, "
            "timestamp'5999-12-31 10:00:00' AS eff_to_dt, 'a' AS v"
        )
    )
    rows = spark.sql(
        "SELECT 1L AS id, timestamp'2024-01-03 12:00:00' AS eff_from_dt, "
        "timestamp'2024-02-01 00:00:00' AS eff_to_dt, 'b' AS v"
    )
    assert values(append_close(replica, prepare(rows, replica.schema))) == ["a", "b"]
    assert partitions.open_view(replica).count() == 1


def test_nested_payload_passes_through(spark):
    replica = with_months(
        spark.sql(
            "SELECT 1L AS id, date'2024-01-03' AS eff_from_dt, date'5999-12-31' AS eff_to_dt, "
            "map('k', array(1, 2)) AS tags, named_struct('x', 1.5D) AS s"
        )
    )
    closing = prepare(
        replica.selectExpr("id", "eff_from_dt", "date'2024-05-01' AS eff_to_dt", "tags", "s"),
        replica.schema,
    )
    result = append_close(replica, closing)
    assert [r.tags for r in result.collect()] == [{"k": [1, 2]}]
    reconcile.assert_ok(reconcile.check_keys(replica, closing, result, APPEND_CLOSE))


def test_other_names_and_sentinel(spark):
    contract = Contract("key", "since", "until", "since_month", "until_month", date(9999, 1, 1))
    assert contract.open_month == "9999-01-31"
    replica = with_months(
        spark.sql("SELECT 'k' AS key, date'2024-01-03' AS since, date'9999-01-01' AS until"),
        contract,
    )
    closing = replica.selectExpr("key", "since", "date'2024-02-01' AS until")
    prepared = prepare(closing, replica.schema, contract)
    for result in (append_close(replica, prepared, contract), merge(replica, prepared, contract)):
        assert [str(r.until) for r in result.collect()] == ["2024-02-01"]
    with pytest.raises(ValueError, match="identifier"):
        Contract(from_month="from month")


def test_month_columns_are_text(spark):
    schema = text_months(with_months(table(spark, REPLICA)).schema)
    assert {schema["eff_to_month"].dataType.simpleString()} == {"string"}
