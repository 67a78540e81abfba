"""Full-history (SCD2) replicas of tables, kept current by periodic increments, on Spark."""

from epochfold.model import APPEND_CLOSE, MERGE, Contract
from epochfold.operators.apply import append_close, merge
from epochfold.operators.increment import prepare
from epochfold.sources.replica import ReplicaStore

__all__ = ["APPEND_CLOSE", "MERGE", "Contract", "ReplicaStore", "append_close", "merge", "prepare"]
