"""Replicas in a catalog: stored ones by name, and tables whose format does the rewrite.

A stored replica is an external table of any catalog with partitions, as Spark's own. The merge
needs a catalog with ``MERGE INTO`` support; plain Parquet and ORC tables refuse it and are served by
:class:`epochfold.sources.replica.ReplicaStore`.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epochfold.model import Contract, col

if TYPE_CHECKING:
    from epochfold.sources.replica import ReplicaStore

#: Partitions that one statement adds or drops.
_PARTITIONS_A_CALL = 500


def create_replica_table(
    source: DataFrame,
    table: str,
    contract: Contract = Contract(),
    *,
    provider: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Create or replace a table of the source's rows, partitioned by ``months(valid_to)``."""
    writer = source.drop(*contract.partition_columns).writeTo(table)
    if provider:
        writer = writer.using(provider)
    for name, value in (properties or {}).items():
        writer = writer.tableProperty(name, value)
    writer.partitionedBy(F.partitioning.months(col(contract.valid_to))).createOrReplace()


def merge_into_table(
    spark: SparkSession, table: str, increment: DataFrame, contract: Contract = Contract()
) -> None:
    """Update the versions the increment carries in full and insert the others.

    The increment is merged as it is; copying it to a table first would only write it twice.
    """
    same = " AND ".join(f"target.{_quoted(c)} = source.{_quoted(c)}" for c in contract.version_key)
    spark.sql(
        f"MERGE INTO {table} AS target USING {{increment}} AS source ON {same} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
        increment=increment,
    )


def sync_table(store: ReplicaStore, table: str) -> None:
    """Make ``table`` the external table of a stored replica, with the partitions there are now.

    What is not yet there is created; partitions are added and dropped by the difference between
    the replica's directories and the catalog, so a repeated or late call does no harm. Dropping
    the table, or a partition of it, leaves the files. A table of that name with other columns or at
    another place is an error, unless the replica was loaded anew with other columns.
    """
    spark, quoted = store.spark, ".".join(_quoted(part) for part in table.split("."))
    names = store.contract.partition_columns
    if spark.catalog.tableExists(quoted):
        place = store.files.qualified(store.root)
        found = _location(spark, quoted)
        if found is None or store.files.qualified(found) != place:
            raise ValueError(f"table {table} is not the replica at {place}")
        types = [(f.name, f.dataType) for f in store.schema.fields]
        if [(f.name, f.dataType) for f in spark.table(quoted).schema.fields] != types:
            drop_external(spark, table)
    if not spark.catalog.tableExists(quoted):
        columns = ", ".join(
            f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in store.schema.fields
        )
        parts = ", ".join(map(_quoted, names))
        place = store.root.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {quoted} ({columns}) USING {store.format} "
            f"PARTITIONED BY ({parts}) LOCATION '{place}'"
        )
    none = "__HIVE_DEFAULT_PARTITION__"
    listed = [row[0].split("/") for row in spark.sql(f"SHOW PARTITIONS {quoted}").collect()]
    known = {
        tuple(None if (v := part.split("=", 1)[1]) in (none, "null") else v for part in parts)
        for parts in listed
    }
    there = set(store.partitions())
    for verb, some in (("ADD IF NOT EXISTS", there - known), ("DROP IF EXISTS", known - there)):
        comma = ", " if verb.startswith("DROP") else " "
        ordered = sorted(some, key=str)
        for i in range(0, len(ordered), _PARTITIONS_A_CALL):
            specs = [
                "PARTITION ("
                + ", ".join(
                    f"{_quoted(n)}=" + ("null" if v is None else f"'{v}'")
                    for n, v in zip(names, pair, strict=True)
                )
                + ")"
                for pair in ordered[i : i + _PARTITIONS_A_CALL]
            ]
            spark.sql(f"ALTER TABLE {quoted} {verb} {comma.join(specs)}")
    spark.catalog.refreshTable(quoted)


def _location(spark: SparkSession, quoted: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def drop_external(spark: SparkSession, table: str) -> None:
    """Forget the table of a stored replica; its files stay."""
    spark.sql("DROP TABLE IF EXISTS " + ".".join(_quoted(part) for part in table.split(".")))


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table} PURGE")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
