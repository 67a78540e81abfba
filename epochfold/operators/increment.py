"""From a raw increment to rows in the replica's shape, and the version keys it displaces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochfold.functions.months import closed_by_end, month_end
from epochfold.model import APPEND_CLOSE, Contract, align, check_mode, col, text_months

ROWS = "source_rows"


def with_months(df: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Set both month columns from the interval; values the input may carry are not trusted."""
    return df.withColumns(
        {
            contract.from_month: month_end(col(contract.valid_from)),
            contract.to_month: month_end(col(contract.valid_to)),
        }
    )


def prepare(
    increment: DataFrame, replica_schema: T.StructType, contract: Contract = Contract()
) -> DataFrame:
    """The increment with fresh month columns and exactly the replica's columns."""
    return align(with_months(increment, contract), text_months(replica_schema, contract))


def version_keys(prepared: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """One row per version key with the number of rows that carry it.

    Keys with a NULL never match a replica row, so they are left out here. The aggregation
    combines on the map side: a key repeated in a third of the increment is shuffled once per
    map task. ``from_month`` follows from the key and costs nothing as a grouping column, but it
    keeps the result's partitioning from serving a join on the key. The join then shuffles the
    (narrow) keys itself, which is the plan shape in which AQE can split a replica partition that
    is skewed by one hot key.
    """
    return (
        prepared.where(col(contract.id).isNotNull() & col(contract.valid_from).isNotNull())
        .groupBy(col(contract.id), col(contract.from_month), col(contract.valid_from))
        .agg(F.count(F.lit(1)).alias(ROWS))
    )


def closed_keys(prepared: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Distinct keys of the versions the increment closes."""
    return version_keys(prepared.where(closed_by_end(contract)), contract).drop(ROWS)


def displacing_keys(prepared: DataFrame, mode: str, contract: Contract = Contract()) -> DataFrame:
    """Keys whose old replica rows go, with their row counts in the increment."""
    if check_mode(mode) == APPEND_CLOSE:
        prepared = prepared.where(closed_by_end(contract))
    return version_keys(prepared, contract)
