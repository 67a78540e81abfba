"""Views and row counts by partition month.

On a stored replica the month columns are directories: the filters prune, and the plain row
counts are answered from file footers without reading a data column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epochfold.functions.months import closed_by_month, month_start, open_by_month
from epochfold.model import APPEND_CLOSE, Contract, check_mode, col
from epochfold.operators.apply import KEY_ROWS, by_touched_months, on_version
from epochfold.operators.increment import displacing_keys

Partition = tuple[str | None, str | None]
_NONE = "-"


def open_view(replica: DataFrame, contract: Contract = Contract()) -> DataFrame:
    return replica.where(open_by_month(contract))


def closed_view(replica: DataFrame, contract: Contract = Contract()) -> DataFrame:
    return replica.where(closed_by_month(contract))


def partition_counts(replica: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Rows per ``(to_month, from_month)``."""
    return replica.groupBy(*(col(c) for c in contract.partition_columns)).agg(
        F.count(F.lit(1)).alias("rows")
    )


def month_counts(replica: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Rows per calendar month of the interval's end, as a ``months()`` partitioning has them."""
    months = replica.drop(*contract.partition_columns)
    return months.groupBy(month_start(col(contract.valid_to)).alias("month")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def open_partitions(replica: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """The open sub-partitions in order, with their rows."""
    return (
        open_view(replica, contract)
        .groupBy(col(contract.from_month))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(col(contract.from_month))
    )


def replaced_rows(
    replica: DataFrame, keys: DataFrame, mode: str, contract: Contract = Contract()
) -> DataFrame:
    """Version key and partition of the rows whose version is in ``keys``.

    Reads only the key columns of the replica.
    """
    if check_mode(mode) == APPEND_CLOSE:
        replica = replica.where(open_by_month(contract))
    wanted = [col(c) for c in contract.version_key + contract.partition_columns]
    versions = replica.select(*wanted)
    return on_version(versions, keys, "inner", contract).select(*wanted, col(KEY_ROWS))


def replaced_counts(replaced: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Replaced rows per partition, and how many of them have several counterparts."""
    return replaced.groupBy(*(col(c) for c in contract.partition_columns)).agg(
        F.count(F.lit(1)).alias("replaced"), F.count_if(col(KEY_ROWS) > 1).alias("ambiguous")
    )


def touched_partitions(
    replica: DataFrame, prepared: DataFrame, mode: str, contract: Contract = Contract()
) -> DataFrame:
    """Partitions an increment changes, with their rows before and after it."""
    keys = displacing_keys(prepared, mode, contract)
    parts = contract.partition_columns
    before = partition_counts(replica, contract).withColumnRenamed("rows", "rows_before")
    touched, _ = by_touched_months(replica, keys, contract)
    replaced = replaced_counts(replaced_rows(touched, keys, mode, contract), contract)
    replaced = replaced.drop("ambiguous")
    incoming = partition_counts(prepared, contract).withColumnRenamed("rows", "incoming")
    every = before.unionByName(replaced, True).unionByName(incoming, True)
    total = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ("rows_before", "replaced", "incoming")}
    return (
        every.groupBy(*(col(c) for c in parts))
        .agg(*(value.alias(name) for name, value in total.items()))
        .where((F.col("replaced") > 0) | (F.col("incoming") > 0))
        .withColumn(
            "rows_after", F.col("rows_before") - F.col("replaced") + F.col("incoming")
        )
    )


def in_partitions(partitions: list[Partition], contract: Contract) -> Column:
    """A null-safe filter for a list of partitions, made of the month columns only.

    One hash lookup of the partition's name, however long the list is.
    """
    names = ["/".join(_NONE if month is None else month for month in p) for p in partitions]
    months = (F.coalesce(col(c), F.lit(_NONE)) for c in contract.partition_columns)
    return F.concat_ws("/", *months).isin(names)
