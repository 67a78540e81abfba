"""Applying an increment to a replica. Lazy: nothing here starts a job.

Every function takes a *prepared* increment (see ``increment.prepare``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epochfold.functions.months import open_by_month
from epochfold.model import APPEND_CLOSE, Contract, check_mode, col
from epochfold.operators.increment import ROWS, closed_keys, version_keys

_ID, _FROM, KEY_ROWS = "__key_id", "__key_from", "__key_rows"
CARDINALITY_ERROR = "MERGE: several increment rows carry the key of one replica row"


def on_version(rows: DataFrame, keys: DataFrame, how: str, contract: Contract) -> DataFrame:
    """Join rows to distinct version keys, leaving the rows' own columns and their order alone."""
    marks = keys.select(
        col(contract.id).alias(_ID),
        col(contract.valid_from).alias(_FROM),
        *([col(ROWS).alias(KEY_ROWS)] if ROWS in keys.columns else []),
    )
    same = (col(contract.id) == F.col(_ID)) & (col(contract.valid_from) == F.col(_FROM))
    return rows.join(marks, same, how)


def not_open(contract: Contract) -> Column:
    """True for closed versions and for those without an end date."""
    return ~col(contract.to_month).eqNullSafe(F.lit(contract.open_month))


def by_touched_months(
    replica: DataFrame, keys: DataFrame, contract: Contract
) -> tuple[DataFrame, DataFrame]:
    """Replica rows of the months that the keys start in, and all others.

    The months are asked for by a subquery of the same plan, one value per month of the calendar. Where
    they are directories both filters prune them before a file is opened, so the other months' rows
    enter neither a join nor a shuffle. A month that is NULL is among the others: NULL never matches.
    """
    months = keys.agg(F.collect_set(col(contract.from_month))).scalar()
    touched = F.coalesce(F.array_contains(months, col(contract.from_month)), F.lit(False))
    return replica.where(touched), replica.where(~touched)


def surviving_open(
    replica: DataFrame,
    prepared: DataFrame,
    contract: Contract = Contract(),
) -> DataFrame:
    """Open replica rows whose version the increment does not close."""
    keys = closed_keys(prepared, contract)
    touched, others = by_touched_months(replica.where(open_by_month(contract)), keys, contract)
    return on_version(touched, keys, "left_anti", contract).unionByName(others)


def kept_rows(
    replica: DataFrame, prepared: DataFrame, mode: str, contract: Contract = Contract()
) -> DataFrame:
    """Replica rows that stay as they are when the increment is applied."""
    if check_mode(mode) == APPEND_CLOSE:
        # Two disjoint partition filters, not one scan: closed history never enters a shuffle.
        closed = replica.where(not_open(contract))
        return closed.unionByName(surviving_open(replica, prepared, contract))
    keys = version_keys(prepared, contract)
    touched, others = by_touched_months(replica, keys, contract)
    return on_version(touched, keys, "left_anti", contract).unionByName(others)


def append_close(
    replica: DataFrame, prepared: DataFrame, contract: Contract = Contract()
) -> DataFrame:
    """Closed history, open rows the increment leaves open, and the whole increment."""
    return kept_rows(replica, prepared, APPEND_CLOSE, contract).unionByName(prepared)


def merge(replica: DataFrame, prepared: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Update rows with the increment's version keys in full, insert the rest.

    As in SQL ``MERGE``, running the result fails if a replica row has more than one counterpart
    in the increment. The check rides on the join that finds the updated rows. Rows of months in
    which no key starts are not joined.
    """
    keys = version_keys(prepared, contract)
    touched, others = by_touched_months(replica, keys, contract)
    matched = on_version(touched, keys, "left", contract)
    ambiguous = F.raise_error(F.lit(CARDINALITY_ERROR)).cast("boolean")
    keep = (
        F.when(F.col(KEY_ROWS).isNull(), F.lit(True))
        .when(F.col(KEY_ROWS) > 1, ambiguous)
        .otherwise(F.lit(False))
    )
    kept = matched.where(keep).drop(_ID, _FROM, KEY_ROWS)
    return kept.unionByName(others).unionByName(prepared)


def _matches(
    replica: DataFrame, prepared: DataFrame, contract: Contract, keys: DataFrame
) -> DataFrame:
    """Per matched version key: its rows in the increment and in the replica.

    Both sides have a row per key by the time they are joined. The replica's rows are counted on the
    map side first, so a key on a third of them is one row a task.
    """
    touched, _ = by_touched_months(replica, keys, contract)
    versions = touched.groupBy(*(col(c) for c in contract.version_key)).agg(
        F.count(F.lit(1)).alias("target_rows")
    )
    return on_version(versions, keys, "inner", contract).select(
        *(col(c) for c in contract.version_key), F.col(KEY_ROWS).alias(ROWS), "target_rows"
    )


def merge_actions(
    replica: DataFrame, prepared: DataFrame, contract: Contract = Contract()
) -> DataFrame:
    """Rows per action of a merge: replica rows updated and kept, increment rows inserted.

    Only matched keys are aggregated; the rest follows from two row counts.
    """
    matched = _matches(replica, prepared, contract, version_keys(prepared, contract))
    target_total = replica.agg(F.count(F.lit(1))).scalar()
    source_total = prepared.agg(F.count(F.lit(1))).scalar()
    return (
        matched.agg(
            F.coalesce(F.sum("target_rows"), F.lit(0)).alias("updated"),
            F.coalesce(F.sum(ROWS), F.lit(0)).alias("used"),
        )
        .withColumns({"kept": target_total - F.col("updated"), "new": source_total - F.col("used")})
        .select(
            F.stack(
                F.lit(3),
                F.lit("update"), F.col("updated"),
                F.lit("keep"), F.col("kept"),
                F.lit("insert"), F.col("new"),
            ).alias("action", "rows")
        )
    )


def merge_conflicts(
    replica: DataFrame, prepared: DataFrame, contract: Contract = Contract()
) -> DataFrame:
    """Version keys for which ``merge`` fails: repeated in the increment, present in the replica."""
    repeated = version_keys(prepared, contract).where(F.col(ROWS) > 1)
    return _matches(replica, prepared, contract, repeated)
