
from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochfold.functions import months
from epochfold.model import APPEND_CLOSE, MERGE
from epochfold.operators import apply, increment, partitions, reconcile
from epochfold.plans import orders_history as history
from epochfold.plans.scratch import shared_folder
from epochfold.sources.catalog import drop_external
from epochfold.sources.replica import MergeConflictError, ReplicaStore

try:  # the training-data operators and their pipeline can be left out as a whole
    import corpus_pipeline
    from epochfold.llm import queries as llm
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "epochfold.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: all rows of the replica after an append-close load, at sf0.001."""
    return append_close(spark, "/root/testdata/sf0.001")


def _inputs(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    orders = history.orders(spark, sf_dir)
    replica = history.replica(orders)
    return replica, increment.prepare(history.increment(orders, **options), replica.schema)


def _loaded(
    spark: SparkSession,
    sf_dir: str,
    mode: str,
    publish: str = "auto",
    table: str | None = None,
    **options,
) -> ReplicaStore:
    """A stored replica with the first increment applied to it."""
    orders = history.orders(spark, sf_dir)
    root = shared_folder(spark, f"replica-{mode}")
    store = ReplicaStore(spark, root, publish=publish, table=table)
    store.initial_load(history.initial(orders))
    store.apply(history.increment(orders, **options), mode, run_id="first")
    return store


def _by_name(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """A stored, once loaded replica, read as a table of the session's catalog."""
    name = f"epochfold_{mode}"
    drop_external(spark, name)
    _loaded(spark, sf_dir, mode, table=name)
    return spark.table(name)


def _late(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A stored, once loaded replica and the late increment for it."""
    loaded = _loaded(spark, sf_dir, APPEND_CLOSE).read()
    return loaded, increment.prepare(history.late_increment(loaded), loaded.schema)


# -- applying an increment --------------------------------------------------------------------


def append_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.append_close(*_inputs(spark, sf_dir))


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.merge(*_inputs(spark, sf_dir))


def append_close_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.append_close(*_late(spark, sf_dir))


def merge_upsert_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.merge(*_late(spark, sf_dir))


def increment_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inputs(spark, sf_dir)[1]


def closed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increment.closed_keys(_inputs(spark, sf_dir)[1])


def closed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Increment rows that close a version, by a range of end dates."""
    return _inputs(spark, sf_dir)[1].where(months.closed_by_end(history.CONTRACT))


def surviving_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.surviving_open(*_inputs(spark, sf_dir))


def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.merge_actions(*_inputs(spark, sf_dir))


def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.merge_conflicts(*_inputs(spark, sf_dir, repeat=True))


# -- stored replicas: initial load, staged publish, read back ---------------------------------


def store_append_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, APPEND_CLOSE).read()


def store_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, MERGE).read()


def store_merge_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments in a row; the second moves rows between partitions and empties some."""
    store = _loaded(spark, sf_dir, APPEND_CLOSE)
    store.apply(history.late_increment(store.read()), MERGE, run_id="late")
    return store.read()


def store_copy_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publish for file systems without a cheap rename."""
    return _loaded(spark, sf_dir, APPEND_CLOSE, publish="copy").read()


def store_append_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publish for object stores: append once, record, delete what was replaced; two loads."""
    orders = history.orders(spark, sf_dir)
    store = ReplicaStore(spark, shared_folder(spark, "replica-appended"), publish="append")
    store.initial_load(history.initial(orders))
    store.apply(history.increment(orders), APPEND_CLOSE, run_id="first")
    store.apply(history.late_increment(store.read()), MERGE, run_id="late")
    return store.read()


def store_reinitialised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica that is loaded anew after a load, and then by the same run id again."""
    orders = history.orders(spark, sf_dir)
    store = _loaded(spark, sf_dir, MERGE)
    store.initial_load(history.initial(orders), overwrite=True)
    store.apply(history.increment(orders), APPEND_CLOSE, run_id="first")
    return store.read()


def store_batched_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that rewrites its months in several jobs."""
    orders = history.orders(spark, sf_dir)
    root = shared_folder(spark, "replica-batched")
    ReplicaStore(spark, root).initial_load(history.initial(orders))
    size = ReplicaStore(spark, root).files.usage(root)[0]
    store = ReplicaStore(spark, root, batch_bytes=max(size // 3, 1))
    store.apply(history.increment(orders), MERGE, run_id="first")
    return store.read()


def store_other_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An increment whose column names differ from the replica's by case."""
    orders = history.orders(spark, sf_dir)
    store = ReplicaStore(spark, shared_folder(spark, "replica-names"))
    store.initial_load(history.initial(orders))
    raw = history.increment(orders)
    store.apply(raw.toDF(*[c.upper() for c in raw.columns]), APPEND_CLOSE, run_id="first")
    return store.read()


def store_open_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open view of a table in the catalog: one directory level is read."""
    return partitions.open_view(_by_name(spark, sf_dir, APPEND_CLOSE))


def store_check_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a run by the partitions that it changed."""
    store = _loaded(spark, sf_dir, APPEND_CLOSE)
    return store.audit("first", history.increment(history.orders(spark, sf_dir)))


def store_check_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of late rows in an append-close replica: versions are there twice."""
    store = _loaded(spark, sf_dir, APPEND_CLOSE)
    late = history.late_increment(store.read())
    kept = ReplicaStore(spark, shared_folder(spark, "late-rows"))
    kept.initial_load(late)
    late = kept.read()
    store.apply(late, APPEND_CLOSE, run_id="late")
    return store.audit("late", late)


def store_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All attempts: the initial load, one that fails on a repeated version, one that succeeds."""
    orders = history.orders(spark, sf_dir)
    store = ReplicaStore(spark, shared_folder(spark, "replica-attempts"))
    store.initial_load(history.initial(orders))
    with suppress(MergeConflictError):
        store.apply(history.increment(orders, repeat=True), MERGE, run_id="first")
    store.apply(history.increment(orders), MERGE, run_id="first")
    columns = ("run_id", "stage", "status", "rows_in", "rows_out")
    return store.attempt_report().select(*columns)


def store_partition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load changed, from the run report."""
    report = _loaded(spark, sf_dir, APPEND_CLOSE).partition_report()
    return report.select(
        F.col("to_month").alias("eff_to_month"),
        F.col("from_month").alias("eff_from_month"),
        "action",
        "rows_before",
        "replaced",
        "incoming",
        "rows_after",
    )


def store_stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of a load without their times."""
    report = _loaded(spark, sf_dir, MERGE).stage_report()
    return report.select("run_id", "mode", "stage", "partitions", "rows_in", "rows_out")


# -- views and partitions ---------------------------------------------------------------------


def open_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.open_view(append_close(spark, sf_dir))


def closed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.closed_view(append_close(spark, sf_dir))


def init_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.partition_counts(history.replica(history.orders(spark, sf_dir)))


def increment_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.partition_counts(_inputs(spark, sf_dir)[1])


def merge_month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.month_counts(merge_upsert(spark, sf_dir))


def open_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.open_partitions(append_close(spark, sf_dir))


def touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.touched_partitions(*_inputs(spark, sf_dir), APPEND_CLOSE)


def touched_partitions_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.touched_partitions(*_inputs(spark, sf_dir, year=1997), MERGE)


# -- reconciliation ---------------------------------------------------------------------------


def new_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.new_entities(*_inputs(spark, sf_dir))


def check_counts_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica, prepared = _inputs(spark, sf_dir)
    target = apply.append_close(replica, prepared)
    return reconcile.check_counts(replica, prepared, target, APPEND_CLOSE)


def check_counts_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge target is a table of the catalog, scanned by name."""
    replica, prepared = _inputs(spark, sf_dir)
    return reconcile.check_counts(replica, prepared, _by_name(spark, sf_dir, MERGE), MERGE)


def check_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica, prepared = _inputs(spark, sf_dir)
    target = apply.append_close(replica, prepared)
    return reconcile.check_keys(replica, prepared, target, APPEND_CLOSE)


def check_keys_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows break the key checks of an append-close replica; the counts show by how much."""
    loaded, late = _late(spark, sf_dir)
    target = apply.append_close(loaded, late)
    return reconcile.check_keys(loaded, late, target, APPEND_CLOSE)


_QUERIES: list[Query] = [
    append_close,
    merge_upsert,
    append_close_late,
    merge_upsert_late,
    increment_prepared,
    closed_keys,
    closed_rows,
    surviving_open,
    merge_actions,
    merge_conflicts,
    store_append_close,
    store_merge_upsert,
    store_merge_late,
    store_copy_publish,
    store_append_publish,
    store_reinitialised,
    store_batched_months,
    store_other_names,
    store_open_by_name,
    store_check_keys,
    store_check_late,
    store_attempts,
    store_partition_report,
    store_stage_report,
    open_view,
    closed_view,
    init_partition_counts,
    increment_partition_counts,
    merge_month_partitions,
    open_partitions,
    touched_partitions,
    touched_partitions_narrow,
    new_entities,
    check_counts_append,
    check_counts_merge,
    check_keys,
    check_keys_late,
]


def _text_dates(query: Query) -> Query:
    """Date columns as ISO text: year 5999 is beyond a nanosecond timestamp in either engine."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
        return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df

    return run


def queries() -> dict[str, Query]:
    own = {query.__name__: _text_dates(query) for query in _QUERIES}
    return own | _llm_queries()


def _llm_queries() -> dict[str, Query]:
    if llm is None:
        return {}
    return {query.__name__: query for query in llm.QUERIES} | {"pipeline": corpus_pipeline.run}


def _llm_sql() -> dict[str, str]:
    if llm is None:
        return {}
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return llm.ORACLE_SQL | whole


# -- SQL counterparts -------------------------------------------------------------------------

_COLUMNS = "id, eff_from_dt, eff_to_dt, cust_id, status, amount, eff_from_month, eff_to_month"
_ROW = (
    "id, CAST(eff_from_dt AS VARCHAR) AS eff_from_dt, CAST(eff_to_dt AS VARCHAR) AS eff_to_dt, "
    "cust_id, status, amount, eff_from_month, eff_to_month"
)


def _with(year: int | None = None, repeat: bool = False) -> str:
    """Replica, increment, both results and the late increment as common table expressions."""
    chosen = f"AND year(eff_from_dt) = {year}" if year else ""
    closing = (
        "SELECT id, eff_from_dt, eff_from_dt + CAST(id % 90 + 1 AS INT) AS eff_to_dt, "
        "cust_id, status, amount FROM base WHERE id % 20 = 3 "
    )
    again = f"UNION ALL {closing} AND id % 3 = 0" if repeat else ""
    return f"""
WITH base AS (
  SELECT o_orderkey + 1 AS id, CAST(o_orderdate AS DATE) AS eff_from_dt,
         o_custkey AS cust_id, o_orderstatus AS status, o_totalprice AS amount FROM orders),
n AS (SELECT MAX(id) AS n FROM base),
replica AS (
  SELECT id, eff_from_dt, DATE '5999-12-31' AS eff_to_dt, cust_id, status, amount,
         CAST(last_day(eff_from_dt) AS VARCHAR) AS eff_from_month,
         '5999-12-31' AS eff_to_month FROM base),
incr_raw AS (
  {closing} {chosen}
  {again}
  UNION ALL
  SELECT id, eff_from_dt + CAST(id % 90 + 2 AS INT), DATE '5999-12-31',
         cust_id, 'U', amount + 1.0 FROM base WHERE id % 20 = 3 {chosen}
  UNION ALL
  SELECT base.id + n.n, DATE '2001-09-01', DATE '5999-12-31', cust_id, 'N', amount
    FROM base CROSS JOIN n WHERE id % 20 = 7 {chosen}),
incr AS (
  SELECT id, eff_from_dt, eff_to_dt, cust_id, status, amount,
         CAST(last_day(eff_from_dt) AS VARCHAR) AS eff_from_month,
         CAST(last_day(eff_to_dt) AS VARCHAR) AS eff_to_month FROM incr_raw),
closed AS (SELECT DISTINCT id, eff_from_dt FROM incr WHERE eff_to_month <> '5999-12-31'),
survivors AS (
  SELECT {_COLUMNS} FROM replica r WHERE eff_to_month = '5999-12-31' AND NOT EXISTS (
    SELECT 1 FROM closed c WHERE c.id = r.id AND c.eff_from_dt = r.eff_from_dt)),
v1 AS (
  SELECT {_COLUMNS} FROM replica WHERE eff_to_month IS DISTINCT FROM '5999-12-31'
  UNION ALL SELECT {_COLUMNS} FROM survivors
  UNION ALL SELECT {_COLUMNS} FROM incr),
v2 AS (
  SELECT {_COLUMNS} FROM replica r WHERE NOT EXISTS (
    SELECT 1 FROM incr i WHERE i.id = r.id AND i.eff_from_dt = r.eff_from_dt)
  UNION ALL SELECT {_COLUMNS} FROM incr),
late AS (
  SELECT id, eff_from_dt, eff_to_dt + 5 AS eff_to_dt, cust_id, 'L' AS status, amount,
         eff_from_month, CAST(last_day(eff_to_dt + 5) AS VARCHAR) AS eff_to_month
    FROM v1 WHERE eff_to_month <> '5999-12-31' AND id % 3 = 0
  UNION ALL
  SELECT id, eff_from_dt, eff_to_dt, cust_id, 'R', amount, eff_from_month, eff_to_month
    FROM v1 WHERE eff_to_month = '5999-12-31' AND id % 1000 = 1),
late_v1 AS (
  SELECT {_COLUMNS} FROM v1 r WHERE NOT (eff_to_month = '5999-12-31' AND EXISTS (
    SELECT 1 FROM late i WHERE i.eff_to_month <> '5999-12-31'
       AND i.id = r.id AND i.eff_from_dt = r.eff_from_dt))
  UNION ALL SELECT {_COLUMNS} FROM late),
late_v2 AS (
  SELECT {_COLUMNS} FROM v1 r WHERE NOT EXISTS (
    SELECT 1 FROM late i WHERE i.id = r.id AND i.eff_from_dt = r.eff_from_dt)
  UNION ALL SELECT {_COLUMNS} FROM late),
matched AS (
  SELECT r.eff_to_month, r.eff_from_month FROM replica r WHERE EXISTS (
    SELECT 1 FROM incr i WHERE i.id = r.id AND i.eff_from_dt = r.eff_from_dt)),
touched AS (
  SELECT eff_to_month, eff_from_month, CAST(SUM(b) AS BIGINT) AS rows_before,
         CAST(SUM(x) AS BIGINT) AS replaced, CAST(SUM(i) AS BIGINT) AS incoming,
         CAST(SUM(b) - SUM(x) + SUM(i) AS BIGINT) AS rows_after
    FROM (SELECT eff_to_month, eff_from_month, 1 AS b, 0 AS x, 0 AS i FROM replica
          UNION ALL SELECT eff_to_month, eff_from_month, 0, 1, 0 FROM matched
          UNION ALL SELECT eff_to_month, eff_from_month, 0, 0, 1 FROM incr) AS every
   GROUP BY eff_to_month, eff_from_month HAVING SUM(x) > 0 OR SUM(i) > 0)
"""


def _counts(target: str, is_open: str, is_closed: str) -> str:
    return f"""{_with()},
expected AS (
  SELECT (SELECT COUNT(*) FROM replica)
       + (SELECT COUNT(*) FROM incr WHERE id > (SELECT COUNT(*) FROM replica)) AS open_rows,
         (SELECT COUNT(*) FROM incr WHERE eff_to_dt <> DATE '5999-12-31') AS closed_rows),
actual AS (
  SELECT COUNT(*) FILTER (WHERE {is_open}) AS open_rows,
         COUNT(*) FILTER (WHERE {is_closed}) AS closed_rows FROM {target})
SELECT 'open' AS "check", CAST(e.open_rows AS BIGINT) AS expected,
       CAST(a.open_rows AS BIGINT) AS actual, e.open_rows = a.open_rows AS ok
  FROM expected e, actual a
UNION ALL
SELECT 'closed', CAST(e.closed_rows AS BIGINT), CAST(a.closed_rows AS BIGINT),
       e.closed_rows = a.closed_rows FROM expected e, actual a"""


def _keys(old: str, incr: str, target: str) -> str:
    kept = f"""SELECT {_COLUMNS} FROM {old} r WHERE NOT (eff_to_month = '5999-12-31' AND EXISTS (
      SELECT 1 FROM {incr} i WHERE i.eff_to_month <> '5999-12-31'
         AND i.id = r.id AND i.eff_from_dt = r.eff_from_dt))"""
    return f"""{_with()},
violations AS (
  SELECT 'increment_rows_present' AS name, (SELECT COUNT(*) FROM (
    SELECT {_COLUMNS} FROM {incr} EXCEPT ALL
    (SELECT {_COLUMNS} FROM {target} EXCEPT ALL {kept})) AS d) AS bad
  UNION ALL SELECT 'kept_rows_present', (SELECT COUNT(*) FROM (
    {kept} EXCEPT ALL SELECT {_COLUMNS} FROM {target}) AS d)
  UNION ALL SELECT 'closed_keys_not_open', (SELECT COUNT(*) FROM {target} t
    WHERE t.eff_to_month = '5999-12-31' AND EXISTS (SELECT 1 FROM {incr} i
      WHERE i.eff_to_month <> '5999-12-31' AND i.id = t.id AND i.eff_from_dt = t.eff_from_dt))
  UNION ALL SELECT 'one_row_per_version', (SELECT COUNT(*) FROM {target})
    - (SELECT COUNT(*) FROM (SELECT DISTINCT id, eff_from_dt FROM {target}) AS d)
  UNION ALL SELECT 'one_open_row_per_id',
    (SELECT COUNT(*) FROM {target} WHERE eff_to_month = '5999-12-31')
    - (SELECT COUNT(DISTINCT id) FROM {target} WHERE eff_to_month = '5999-12-31'))
SELECT name AS "check", CAST(bad AS BIGINT) AS violations, bad = 0 AS ok FROM violations"""


def _audit(incr: str, target: str) -> str:
    """Every partition holds what it should; the increment's versions are in the target."""
    own = f"""{target} t WHERE EXISTS (
    SELECT 1 FROM {incr} i WHERE i.id = t.id AND i.eff_from_dt = t.eff_from_dt)"""
    return f"""{_with()},
violations AS (
  SELECT 'partition_rows' AS name, 0 AS bad
  UNION ALL SELECT 'increment_rows_present', (SELECT COUNT(*) FROM (
    SELECT {_COLUMNS} FROM {incr} EXCEPT ALL SELECT {_COLUMNS} FROM {target}) AS d)
  UNION ALL SELECT 'closed_keys_not_open', (SELECT COUNT(*) FROM {target} t
    WHERE t.eff_to_month = '5999-12-31' AND EXISTS (SELECT 1 FROM {incr} i
      WHERE i.eff_to_month <> '5999-12-31' AND i.id = t.id AND i.eff_from_dt = t.eff_from_dt))
  UNION ALL SELECT 'one_row_per_version', (SELECT COUNT(*) FROM {own})
    - (SELECT COUNT(*) FROM (SELECT DISTINCT id, eff_from_dt FROM {own}) AS d))
SELECT name AS "check", CAST(bad AS BIGINT) AS violations, bad = 0 AS ok FROM violations"""


def _partition_counts(table: str) -> str:
    return f"""{_with()}
SELECT eff_to_month, eff_from_month, CAST(COUNT(*) AS BIGINT) AS "rows"
  FROM {table} GROUP BY eff_to_month, eff_from_month"""


def oracle_sql() -> dict[str, str]:
    return _llm_sql() | {
        "append_close": f"{_with()} SELECT {_ROW} FROM v1",
        "merge_upsert": f"{_with()} SELECT {_ROW} FROM v2",
        "append_close_late": f"{_with()} SELECT {_ROW} FROM late_v1",
        "merge_upsert_late": f"{_with()} SELECT {_ROW} FROM late_v2",
        "increment_prepared": f"{_with()} SELECT {_ROW} FROM incr",
        "closed_keys": f"""{_with()}
SELECT DISTINCT id, eff_from_month, CAST(eff_from_dt AS VARCHAR) AS eff_from_dt
  FROM incr WHERE eff_to_month <> '5999-12-31'""",
        "closed_rows": f"{_with()} SELECT {_ROW} FROM incr WHERE eff_to_month <> '5999-12-31'",
        "surviving_open": f"{_with()} SELECT {_ROW} FROM survivors",
        "merge_actions": f"""{_with()}
SELECT 'update' AS action, CAST(COUNT(*) AS BIGINT) AS "rows" FROM matched
UNION ALL
SELECT 'keep', CAST((SELECT COUNT(*) FROM replica) - (SELECT COUNT(*) FROM matched) AS BIGINT)
UNION ALL
SELECT 'insert', CAST(COUNT(*) AS BIGINT) FROM incr i WHERE NOT EXISTS (
  SELECT 1 FROM replica r WHERE i.id = r.id AND i.eff_from_dt = r.eff_from_dt)""",
        "merge_conflicts": f"""{_with(repeat=True)}
SELECT i.id, CAST(i.eff_from_dt AS VARCHAR) AS eff_from_dt, i.source_rows,
       CAST(COUNT(*) AS BIGINT) AS target_rows
  FROM (SELECT id, eff_from_dt, CAST(COUNT(*) AS BIGINT) AS source_rows
          FROM incr GROUP BY id, eff_from_dt HAVING COUNT(*) > 1) AS i
  JOIN replica r ON i.id = r.id AND i.eff_from_dt = r.eff_from_dt
 GROUP BY i.id, i.eff_from_dt, i.source_rows""",
        "store_append_close": f"{_with()} SELECT {_ROW} FROM v1",
        "store_merge_upsert": f"{_with()} SELECT {_ROW} FROM v2",
        "store_merge_late": f"{_with()} SELECT {_ROW} FROM late_v2",
        "store_copy_publish": f"{_with()} SELECT {_ROW} FROM v1",
        "store_append_publish": f"{_with()} SELECT {_ROW} FROM late_v2",
        "store_reinitialised": f"{_with()} SELECT {_ROW} FROM v1",
        "store_other_names": f"{_with()} SELECT {_ROW} FROM v1",
        "store_batched_months": f"{_with()} SELECT {_ROW} FROM v2",
        "store_open_by_name": f"{_with()} SELECT {_ROW} FROM v1 WHERE eff_to_month = '5999-12-31'",
        "store_check_keys": _audit("incr", "v1"),
        "store_check_late": _audit("late", "late_v1"),
        "store_attempts": f"""{_with()},
t AS (SELECT SUM(rows_before) AS before_rows, SUM(replaced) AS replaced, SUM(incoming) AS incoming,
             SUM(rows_after) AS after_rows,
             SUM(CASE WHEN replaced > 0 THEN rows_before ELSE 0 END) AS rewritten,
             SUM(CASE WHEN replaced > 0 OR rows_before = 0 THEN rows_after
                      ELSE incoming END) AS staged FROM touched),
again AS (SELECT COUNT(*) AS n FROM base WHERE id % 20 = 3 AND id % 3 = 0),
keys AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT id, eff_from_dt FROM incr)),
whole AS (SELECT COUNT(*) AS n FROM replica),
s AS (
  SELECT 'initial-load' AS run_id, stage, 'done' AS status, n AS rows_in, n AS rows_out
    FROM whole, (VALUES ('profile'), ('stage'), ('verify')) AS v(stage)
  UNION ALL SELECT 'first', 'profile', 'done', incoming + n, incoming + n FROM t, again
  UNION ALL SELECT 'first', 'keys', 'done', incoming + again.n, keys.n FROM t, again, keys
  UNION ALL SELECT 'first', 'detect', 'failed', 0, 0
  UNION ALL SELECT 'first', 'profile', 'done', incoming, incoming FROM t
  UNION ALL SELECT 'first', 'keys', 'done', incoming, n FROM t, keys
  UNION ALL SELECT 'first', 'detect', 'done', before_rows, replaced FROM t
  UNION ALL SELECT 'first', 'stage', 'done', rewritten + incoming, staged FROM t
  UNION ALL SELECT 'first', 'verify', 'done', staged, staged FROM t)
SELECT run_id, stage, status, CAST(rows_in AS BIGINT) AS rows_in,
       CAST(rows_out AS BIGINT) AS rows_out FROM s""",
        "store_partition_report": f"""{_with()}
SELECT eff_to_month, eff_from_month,
       CASE WHEN rows_after = 0 THEN 'remove' WHEN replaced > 0 OR rows_before = 0 THEN 'replace'
            ELSE 'append' END AS action, rows_before, replaced, incoming, rows_after
  FROM touched""",
        "store_stage_report": f"""{_with()},
t AS (SELECT COUNT(*) AS parts, SUM(rows_before) AS before_rows, SUM(replaced) AS replaced,
             SUM(incoming) AS incoming, SUM(rows_after) AS after_rows,
             SUM(CASE WHEN replaced > 0 THEN rows_before ELSE 0 END) AS rewritten,
             SUM(CASE WHEN replaced > 0 OR rows_before = 0 THEN rows_after
                      ELSE incoming END) AS staged FROM touched),
s AS (
  SELECT 'profile' AS stage, (SELECT COUNT(*) FROM touched WHERE incoming > 0) AS parts,
         incoming AS rows_in, incoming AS rows_out FROM t
  UNION ALL SELECT 'keys', (SELECT COUNT(DISTINCT eff_from_month) FROM incr), incoming,
         (SELECT COUNT(*) FROM (SELECT DISTINCT id, eff_from_dt FROM incr)) FROM t
  UNION ALL SELECT 'detect', parts, before_rows, replaced FROM t
  UNION ALL SELECT 'stage', parts, rewritten + incoming, staged FROM t
  UNION ALL SELECT 'verify', parts, staged, staged FROM t
  UNION ALL SELECT 'publish', parts, after_rows, after_rows FROM t)
SELECT 'first' AS run_id, 'merge' AS mode, stage, CAST(parts AS BIGINT) AS "partitions",
       CAST(rows_in AS BIGINT) AS rows_in, CAST(rows_out AS BIGINT) AS rows_out FROM s""",
        "open_view": f"{_with()} SELECT {_ROW} FROM v1 WHERE eff_to_month = '5999-12-31'",
        "closed_view": f"{_with()} SELECT {_ROW} FROM v1 WHERE eff_to_month <> '5999-12-31'",
        "init_partition_counts": _partition_counts("replica"),
        "increment_partition_counts": _partition_counts("incr"),
        "merge_month_partitions": f"""{_with()}
SELECT CAST(CAST(date_trunc('month', eff_to_dt) AS DATE) AS VARCHAR) AS month,
       CAST(COUNT(*) AS BIGINT) AS "rows" FROM v2 GROUP BY date_trunc('month', eff_to_dt)""",
        "open_partitions": f"""{_with()}
SELECT eff_from_month, CAST(COUNT(*) AS BIGINT) AS "rows" FROM v1
 WHERE eff_to_month = '5999-12-31' GROUP BY eff_from_month ORDER BY eff_from_month""",
        "touched_partitions": f"{_with()} SELECT * FROM touched",
        "touched_partitions_narrow": f"{_with(year=1997)} SELECT * FROM touched",
        "new_entities": f"""{_with()}
SELECT id, CAST(COUNT(*) AS BIGINT) AS "rows" FROM incr i
 WHERE NOT EXISTS (SELECT 1 FROM replica r WHERE r.id = i.id) GROUP BY id""",
        "check_counts_append": _counts(
            "v1", "eff_to_month = '5999-12-31'", "eff_to_month <> '5999-12-31'"
        ),
        "check_counts_merge": _counts(
            "v2", "eff_to_dt = DATE '5999-12-31'", "eff_to_dt <> DATE '5999-12-31'"
        ),
        "check_keys": _keys("replica", "incr", "v1"),
        "check_keys_late": _keys("v1", "late", "late_v1"),
    }
