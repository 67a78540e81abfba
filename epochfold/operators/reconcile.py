"""Checks of a loaded replica against what it was loaded from. Each returns a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochfold.functions.months import (
    closed_by_date,
    closed_by_month,
    open_by_date,
    open_by_month,
)
from epochfold.model import APPEND_CLOSE, Contract, check_mode, col
from epochfold.operators.apply import kept_rows, on_version
from epochfold.operators.increment import ROWS, closed_keys


class ReconciliationError(RuntimeError):
    """A load check did not hold."""


def new_entities(
    replica: DataFrame, increment: DataFrame, contract: Contract = Contract()
) -> DataFrame:
    """Ids of the increment that the replica does not know, with their increment rows.

    Both sides are counted by id in one aggregation instead of joined, so an id that holds a
    large part of either side shrinks to one row per map task before the shuffle. A NULL id
    equals no other id and is always new.
    """
    ids = col(contract.id).alias("id")
    both = replica.select(ids, F.lit(1).alias("known"), F.lit(0).alias("rows")).unionAll(
        increment.select(ids, F.lit(0).alias("known"), F.lit(1).alias("rows"))
    )
    return (
        both.groupBy("id")
        .agg(F.max("known").alias("known"), F.sum("rows").alias("rows"))
        .where((F.col("rows") > 0) & ((F.col("known") == 0) | F.col("id").isNull()))
        .select("id", "rows")
    )


def check_counts(
    initial: DataFrame,
    increment: DataFrame,
    target: DataFrame,
    mode: str,
    contract: Contract = Contract(),
) -> DataFrame:
    """The two count equations of a first load onto a replica of open rows with ids 1..N.

    Open: initial rows plus increment rows with ids above N. Closed: closed increment rows.
    The append-close target is split by partition month, the merge target by exact date.
    Each input is read once.
    """
    if check_mode(mode) == APPEND_CLOSE:
        is_open, is_closed = open_by_month(contract), closed_by_month(contract)
    else:
        is_open, is_closed = open_by_date(contract), closed_by_date(contract)
    initial_rows = initial.agg(F.count(F.lit(1))).scalar()
    expected = increment.agg(
        F.struct(
            F.count_if(col(contract.id) > initial_rows).alias("new"),
            F.count_if(closed_by_date(contract)).alias("closed"),
        )
    ).scalar()
    return (
        target.agg(F.count_if(is_open).alias("open"), F.count_if(is_closed).alias("closed"))
        .withColumns({"initial": initial_rows, "increment": expected})
        .select(
            F.stack(
                F.lit(2),
                F.lit("open"), F.col("initial") + F.col("increment.new"), F.col("open"),
                F.lit("closed"), F.col("increment.closed"), F.col("closed"),
            ).alias("check", "expected", "actual")
        )
        .withColumn("ok", F.col("expected") == F.col("actual"))
    )


def check_keys(
    replica: DataFrame,
    prepared: DataFrame,
    target: DataFrame,
    mode: str,
    contract: Contract = Contract(),
) -> DataFrame:
    """Checks that need no dense ids, with the number of violations of each.

    ``increment_rows_present`` and ``kept_rows_present`` compare whole rows as bags,
    ``closed_keys_not_open``, ``one_row_per_version`` and ``one_open_row_per_id`` compare keys.
    Everything but the closed-key test is a map-side combined count, so copies and hot keys
    shrink before they are shuffled. The bag comparison shuffles whole rows; to audit a load on a
    large replica, pass its touched partitions only.
    """
    keys = closed_keys(prepared, contract)
    still_open = on_version(
        target.where(open_by_month(contract)).select(*(col(c) for c in contract.version_key)),
        keys,
        "inner",
        contract,
    ).agg(F.count(F.lit(1)).alias("violations"))
    parts = [
        _missing_rows(kept_rows(replica, prepared, mode, contract), prepared, target),
        still_open.select(F.lit("closed_keys_not_open").alias("check"), "violations"),
        _surplus_rows(target, contract),
    ]
    return reduce(DataFrame.unionAll, parts).withColumn("ok", F.col("violations") == 0)


def check_partition_rows(
    expected: DataFrame, counts: DataFrame, contract: Contract = Contract()
) -> DataFrame:
    """Rows by which partitions differ from what a report says they hold.

    ``expected`` has (to_month, from_month, rows_now), ``counts`` is ``partition_counts`` of the
    partitions as they are. Both have a row per month pair; NULL months are compared too.
    """
    to, start = (col(c) for c in contract.partition_columns)
    said = expected.select("to_month", "from_month", F.col("rows_now").alias("rows"))
    found = counts.select(to.alias("to_month"), start.alias("from_month"), (-F.col("rows")).alias("rows"))
    off = said.unionByName(found).groupBy("to_month", "from_month").agg(F.sum("rows").alias("off"))
    return off.agg(F.coalesce(F.sum(F.abs("off")), F.lit(0)).alias("violations")).select(
        F.lit("partition_rows").alias("check"), "violations", (F.col("violations") == 0).alias("ok")
    )


def check_increment(
    prepared: DataFrame,
    target: DataFrame,
    siblings: DataFrame,
    keys: DataFrame,
    contract: Contract = Contract(),
) -> DataFrame:
    """Checks of the increment's own versions in a loaded replica, whatever else it holds.

    ``target`` are the replica's rows that may be the increment's, ``siblings`` those that start in
    the same months; ``keys`` are ``version_keys`` of the increment, with or without a hint. Only rows
    of those versions, and rows with a NULL in the key, enter a comparison. ``increment_rows_present``
    compares whole rows as bags, ``closed_keys_not_open`` and ``one_row_per_version`` count rows by
    version. The last does not hold where the increment itself repeats a version, or where an
    append-close load got late rows.
    """
    id_, start = (col(c) for c in contract.version_key)
    names, zero = target.columns, F.lit(0)
    keys = keys.drop(ROWS)

    def tagged(df: DataFrame, have: int, names: list[str]) -> DataFrame:
        sides = [F.lit(1 - have).alias("__incr"), F.lit(have).alias("__have")]
        return df.select(*(col(c) for c in names), *sides)

    own = on_version(target, keys, "left_semi", contract)
    own = own.unionAll(target.where(id_.isNull() | start.isNull()))
    every = tagged(prepared, 0, names).unionAll(tagged(own, 1, names))
    lacking = F.greatest(F.sum("__incr") - F.sum("__have"), zero).alias("lacking")
    bags = every.groupBy(*(col(c) for c in names)).agg(lacking)
    present = bags.agg(F.coalesce(F.sum("lacking"), zero).alias("violations"))

    names = [*contract.version_key, contract.to_month]
    own = siblings.select(*(col(c) for c in names))
    own = on_version(own, keys, "left_semi", contract)
    every = tagged(prepared, 0, names).unionAll(tagged(own, 1, names))
    closes = F.max(F.when(F.col("__have") == 0, closed_by_month(contract))).alias("closes")
    is_open = F.when((F.col("__have") == 1) & open_by_month(contract), 1).otherwise(0)
    versions = every.where(id_.isNotNull() & start.isNotNull()).groupBy(id_, start)
    versions = versions.agg(closes, F.sum(is_open).alias("open"), F.sum("__have").alias("rows"))
    counted = versions.agg(
        F.coalesce(F.sum(F.when(F.col("closes"), F.col("open"))), zero).alias("open"),
        F.coalesce(F.sum(F.greatest(F.col("rows") - 1, zero)), zero).alias("again"),
    ).select(
        F.stack(
            F.lit(2),
            F.lit("closed_keys_not_open"), F.col("open"),
            F.lit("one_row_per_version"), F.col("again"),
        ).alias("check", "violations")
    )
    checks = present.select(F.lit("increment_rows_present").alias("check"), "violations")
    return checks.unionAll(counted).withColumn("ok", F.col("violations") == 0)


def _surplus_rows(target: DataFrame, contract: Contract) -> DataFrame:
    """Rows beyond the first of a version key, and open rows beyond the first of an id.

    Keys with a NULL are not comparable and do not count. One pass: versions first, then ids.
    """
    id_, start, zero = col(contract.id), col(contract.valid_from), F.lit(0)
    is_open = F.when(open_by_month(contract), 1).otherwise(0)
    versions = (
        target.where(id_.isNotNull())
        .groupBy(id_, start)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(is_open).alias("open"))
    )
    again = F.when(start.isNotNull(), F.col("rows") - 1).otherwise(0)
    ids = versions.groupBy(id_).agg(F.sum(again).alias("again"), F.sum("open").alias("open"))
    return ids.agg(
        F.coalesce(F.sum("again"), zero).alias("again"),
        F.coalesce(F.sum(F.greatest(F.col("open") - 1, zero)), zero).alias("open"),
    ).select(
        F.stack(
            F.lit(2),
            F.lit("one_row_per_version"), F.col("again"),
            F.lit("one_open_row_per_id"), F.col("open"),
        ).alias("check", "violations")
    )


def _missing_rows(kept: DataFrame, prepared: DataFrame, target: DataFrame) -> DataFrame:
    """Kept and increment rows that the target holds less often than it should.

    Where both a kept row and an increment row want the same target row, the kept one is served
    first.
    """
    names = target.columns
    sides = ("__kept", "__incr", "__have")

    def tagged(df: DataFrame, side: str) -> DataFrame:
        flags = [F.lit(int(s == side)).alias(s) for s in sides]
        return df.select(*(col(c) for c in names), *flags)

    every = reduce(
        DataFrame.unionAll,
        [tagged(df, s) for df, s in zip((kept, prepared, target), sides, strict=True)],
    )
    have, kept_n, incr_n = (F.sum(s) for s in ("__have", "__kept", "__incr"))
    zero = F.lit(0)
    bags = every.groupBy(*(col(c) for c in names)).agg(
        F.greatest(kept_n - have, zero).alias("kept"),
        F.greatest(incr_n - F.greatest(have - kept_n, zero), zero).alias("incr"),
    )
    return (
        bags.agg(
            F.coalesce(F.sum("incr"), zero).alias("incr"),
            F.coalesce(F.sum("kept"), zero).alias("kept"),
        )
        .select(
            F.stack(
                F.lit(2),
                F.lit("increment_rows_present"), F.col("incr"),
                F.lit("kept_rows_present"), F.col("kept"),
            ).alias("check", "violations")
        )
    )


def assert_ok(checks: DataFrame) -> None:
    """Raise if a row of a check result is not ok. The result has a handful of rows."""
    failed = checks.where(~F.coalesce(F.col("ok"), F.lit(False))).collect()
    if failed:
        raise ReconciliationError("; ".join(str(row.asDict()) for row in failed))
