"""The three jobs of a load, by path: initialise, apply an increment, check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epochfold.model import APPEND_CLOSE, Contract
from epochfold.operators import reconcile
from epochfold.sources.replica import ReplicaStore


def initialise(
    spark: SparkSession,
    source: str,
    root: str,
    contract: Contract = Contract(),
    *,
    overwrite: bool = False,
    **store,
) -> ReplicaStore:
    """Load the Parquet files at ``source`` into a partitioned replica at ``root``."""
    replica = ReplicaStore(spark, root, contract, **store)
    replica.initial_load(spark.read.parquet(source), overwrite=overwrite)
    return replica


def apply_increment(
    spark: SparkSession,
    increment: str,
    root: str,
    mode: str = APPEND_CLOSE,
    contract: Contract = Contract(),
    *,
    run_id: str | None = None,
    **store,
) -> DataFrame:
    """Apply the Parquet files at ``increment`` and return the run's stage report.

    Schedulers that retry a failed run should pass the same ``run_id`` again.
    """
    replica = ReplicaStore(spark, root, contract, **store)
    return replica.apply(spark.read.parquet(increment), mode, run_id)


def check_load(
    spark: SparkSession,
    source: str,
    increment: str,
    root: str,
    mode: str = APPEND_CLOSE,
    contract: Contract = Contract(),
    *,
    strict: bool = True,
    **store,
) -> DataFrame:
    """Count checks after a first load. With ``strict`` a failed check raises."""
    checks = reconcile.check_counts(
        spark.read.parquet(source),
        spark.read.parquet(increment),
        ReplicaStore(spark, root, contract, **store).read(),
        mode,
        contract,
    )
    if strict:
        reconcile.assert_ok(checks)
    return checks
