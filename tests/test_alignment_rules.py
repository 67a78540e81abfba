"""Names, types, time zones and filters between an increment and its replica."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from epochfold import APPEND_CLOSE, MERGE, Contract, ReplicaStore, merge, prepare
from epochfold.functions.months import closed_by_end, closed_by_month
from epochfold.model import align
from epochfold.operators import increment
from epochfold.operators.increment import with_months
from epochfold.sources.replica import LoadError
from tests.test_edges import CASES, REPLICA, table, values


@pytest.fixture
def setting(spark):
    changed = {}

    def change(key, value):
        changed.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.set(key, value)


def upper(df):
    return df.toDF(*[c.upper() for c in df.columns])


@pytest.mark.parametrize("mode", [APPEND_CLOSE, MERGE])
def test_names_by_the_sessions_case_rule(spark, tmp_path, setting, mode):
    raw, *expected = CASES["emptied"]
    store = ReplicaStore(spark, str(tmp_path / "r"))
    store.initial_load(table(spark, REPLICA))
    columns = store.read().columns
    store.apply(upper(table(spark, raw)), mode)
    assert values(store.read()) == sorted(expected[mode == MERGE].split())
    assert store.read().columns == columns
    start = with_months(table(spark, REPLICA))
    merged = merge(start, prepare(upper(table(spark, raw)), start.schema))
    assert merged.columns == start.columns and values(merged) == sorted(expected[1].split())
    both = table(spark, raw).withColumnRenamed("v", "x").selectExpr("*", "x as v").toDF("id", "eff_from_dt", "eff_to_dt", "V", "v")
    with pytest.raises(ValueError, match="several"):
        align(both, table(spark, raw).schema)
    setting("spark.sql.caseSensitive", "true")
    with pytest.raises(ValueError, match="lacks"):
        align(upper(table(spark, raw)), table(spark, raw).schema)
    assert align(both, table(spark, raw).schema).columns == ["id", "eff_from_dt", "eff_to_dt", "v"]


@pytest.mark.parametrize(
    ("source", "target", "fits"),
    [
        ("decimal(8,2)", "decimal(10,2)", True),
        ("decimal(8,2)", "decimal(10,4)", True),
        ("decimal(8,2)", "decimal(9,4)", False),
        ("decimal(10,2)", "decimal(8,2)", False),
        ("int", "decimal(12,2)", True),
        ("bigint", "decimal(20,2)", False),
        ("bigint", "decimal(19,0)", True),
        ("double", "decimal(20,2)", False),
        ("timestamp", "date", False),
    ],
)
def test_widening_without_loss(spark, source, target, fits):
    have = spark.sql(f"SELECT CAST(NULL AS {source}) AS a")
    want = spark.sql(f"SELECT CAST(NULL AS {target}) AS a").schema
    if fits:
        assert align(have, want).schema == want
    else:
        with pytest.raises(TypeError, match="do not fit"):
            align(have, want)


def test_decimals_in_a_store(spark, tmp_path):
    store = ReplicaStore(spark, str(tmp_path / "r"))
    store.initial_load(table(spark, REPLICA).withColumn("n", F.lit("1.50").cast("decimal(12,2)")))
    raw = table(spark, CASES["late"][0]).withColumn("n", F.lit("2.5").cast("decimal(4,1)"))
    store.apply(raw, MERGE)
    assert {r.n for r in store.read().collect()} == {Decimal("1.50"), Decimal("2.50")}


def test_months_keep_their_zone(spark, tmp_path, setting):
    """The first hour of a month is the month before in a zone further west."""
    setting("spark.sql.session.timeZone", "UTC")
    schema = "id long, eff_from_dt timestamp, eff_to_dt timestamp, v string"
    far = datetime(5999, 12, 31)
    contract = Contract(open_date=date(5999, 12, 31))
    rows = spark.sql(
        "SELECT 1L AS id, TIMESTAMP '2024-03-01 00:30:00' AS eff_from_dt, "
        "TIMESTAMP '5999-12-31 00:00:00' AS eff_to_dt, 'a' AS v"
    )
    assert rows.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString() and far
    store = ReplicaStore(spark, str(tmp_path / "r"), contract)
    store.initial_load(rows)
    closing = rows.withColumn("eff_to_dt", F.expr("TIMESTAMP '2024-05-02 00:00:00'"))
    setting("spark.sql.session.timeZone", "America/New_York")
    again = ReplicaStore(spark, store.root, contract)
    with pytest.raises(LoadError, match="zone UTC"):
        again.apply(closing, APPEND_CLOSE)
    setting("spark.sql.session.timeZone", "UTC")
    again.apply(closing, APPEND_CLOSE)
    assert [r.eff_to_month for r in again.read().collect()] == ["2024-05-31"]


def test_closed_filter_reaches_the_reader(spark, tmp_path):
    days = ["2024-01-31", "5999-11-30", "5999-12-01", "5999-12-15", "5999-12-31", "6000-01-01", None]
    raw = [(i, "2024-01-03", end, str(i)) for i, end in enumerate(days)]
    table(spark, raw).write.parquet(str(tmp_path / "raw"))
    schema = with_months(table(spark, REPLICA)).schema
    incoming = prepare(spark.read.parquet(str(tmp_path / "raw")), schema)
    closed = incoming.where(closed_by_end(Contract()))
    assert values(closed) == values(incoming.where(closed_by_month(Contract()))) == ["0", "1", "5"]
    plan = increment.closed_keys(incoming)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "LessThan(eff_to_dt,5999-12-01)" in pushed and "GreaterThanOrEqual(eff_to_dt,6000-01-01)" in pushed


def test_last_month_of_the_calendar_as_open(spark):
    contract = Contract(open_date=date(9999, 12, 31))
    rows = with_months(table(spark, [(1, "2024-01-03", "9999-12-05", "a"), (2, "2024-01-03", "2024-02-01", "b")]), contract)
    assert values(rows.where(closed_by_end(contract))) == ["b"]
