"""A replica as a directory of month partitions, and the publish that keeps it replayable.

Layout below the root::

    to_month=.../from_month=.../   data files
    _schema.json                   columns, number of the generation, time zone of the months
    _initial_load                  only while the first content is being written
    _owner                         the load that may change the replica, while there is one
    _staging/<run_id>/             keys, new content and manifest of an unfinished load
    _runs/stages/<run_id>.json     report of a finished load; its presence means "published"
    _runs/partitions/<run_id>.json row counts of the partitions that load changed

Names with a leading underscore are invisible to readers of the root. A replica that is loaded anew
begins a generation, whose run records have its number in their names.

A load is published by two lists of files: those to add, whose names are unique, and those to delete,
which held what was replaced. Additions come first, and nothing is deleted unless every addition is in
its place. So each step can be repeated, also by two processes at once, and no step can destroy what
another has added. Readers can see a publish half done.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochfold.model import APPEND_CLOSE, Contract, align, check_mode, col, text_months
from epochfold.operators.apply import CARDINALITY_ERROR, on_version
from epochfold.operators.increment import (
    displacing_keys,
    prepare,
    version_keys,
    with_months,
)
from epochfold.operators.partitions import (
    Partition,
    in_partitions,
    partition_counts,
    replaced_counts,
    replaced_rows,
)
from epochfold.operators.reconcile import check_increment, check_partition_rows
from epochfold.sources.catalog import sync_table
from epochfold.sources.files import Files
from epochfold.sources.owner import FencedError, Owner

_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
_TREE = "__tree"
_REPLACE, _APPEND = "replace", "append"
_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
# Generous size of one (number, date) key in a hash table on an executor.
_KEY_BYTES = 96
_WIDTH = "spark.sql.shuffle.partitions"
# Compressed file bytes per shuffle task, several times as much once decoded.
_BYTES_PER_TASK = 128 << 20
_INITIAL = "initial-load"
# Of an error's message in a report.
_ERROR_CHARS = 2000
_FIXED_WIDTH = (T.NumericType, T.DatetimeType, T.BooleanType)

STAGES = (
    "run_id string, mode string, stage string, partitions long, rows_in long, rows_out long, "
    "seconds double, epoch long"
)
PARTITIONS = (
    "run_id string, to_month string, from_month string, action string, "
    "rows_before long, replaced long, incoming long, rows_after long, epoch long, finished double"
)
ATTEMPTS = (
    "attempt string, run_id string, mode string, stage string, status string, partitions long, "
    "rows_in long, rows_out long, seconds double, error string, epoch long, started double"
)


class LoadError(RuntimeError):
    """A load was stopped before it changed the replica."""


class MergeConflictError(LoadError):
    """Several increment rows carry the key of one replica row."""


@dataclass
class PartitionChange:
    """Row counts of one partition that a load changes."""

    to_month: str | None
    from_month: str | None
    rows_before: int = 0
    replaced: int = 0
    incoming: int = 0
    rows_after: int = 0
    action: str = _APPEND

    @property
    def key(self) -> Partition:
        return (self.to_month, self.from_month)


class Attempt(list):
    """The stage rows of one attempt at a load, and the file that they are written to."""

    def __init__(self, path: str, about: dict):
        super().__init__()
        self.path, self.about = path, about


class ReplicaStore:
    """Reads and writes one replica.

    ``publish`` is ``"move"`` (stage files and rename them into place), ``"append"`` (append them to
    the replica at once and list them, for stores where a rename is a copy), ``"copy"`` (stage them
    and rewrite partitions with a dynamic overwrite) or ``"auto"``, one of the first two.

    ``broadcast_bytes`` bounds the key set that may be broadcast. A partition that is rewritten is
    also compacted if it holds more than ``crowded`` files per ``file_bytes`` of data, or files of
    less than ``tiny_bytes`` on average. Months are rewritten in batches of ``batch_bytes``, so that a
    load of any size is a row of jobs of a bounded one.

    ``table`` names an external table of the session's catalog that every load brings up to date
    (``sources.catalog.sync_table``).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        contract: Contract = Contract(),
        *,
        format: str = "parquet",
        write_options: dict[str, str] | None = None,
        publish: str = "auto",
        broadcast_bytes: int = 64 << 20,
        file_bytes: int = 64 << 20,
        crowded: int = 4,
        tiny_bytes: int = 1 << 20,
        batch_bytes: int = 1 << 40,
        table: str | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.contract = contract
        self.format = format
        self.write_options = {"compression": "zstd", **(write_options or {})}
        self.files = Files(spark, self.root)
        if publish == "auto":
            publish = "move" if self.files.renames else "append"
        if publish not in ("move", "append", "copy"):
            raise ValueError("publish must be 'move', 'append', 'copy' or 'auto'")
        if publish == "append":
            self.files.renames = False
        self.owner = Owner(Files(spark, self.root), f"{self.root}/_owner")
        self.publish_by = publish
        self.broadcast_bytes = broadcast_bytes
        self.file_bytes = file_bytes
        self.crowded = crowded
        self.tiny_bytes = tiny_bytes
        self.batch_bytes = batch_bytes
        self.table = table
        self._unfinished = f"{self.root}/_initial_load"
        self._schema: T.StructType | None = None

    # -- reading -------------------------------------------------------------------------------

    @property
    def schema(self) -> T.StructType:
        """The replica's columns, month columns last and as text."""
        if self._schema is None:
            if self.files.exists(self._unfinished):
                raise LoadError(f"the initial load of {self.root} did not finish; repeat it")
            found = self._described().get("schema")
            if found is not None:
                self._schema = T.StructType.fromJson(found)
            else:
                found = self.spark.read.format(self.format).load(self.root).schema
                self._schema = text_months(found, self.contract)
        return self._schema

    @property
    def epoch(self) -> int:
        """How often the replica was loaded anew."""
        return self._described().get("epoch", 0)

    def _described(self) -> dict:
        """The schema file; replicas of an earlier version have the bare schema there."""
        path = f"{self.root}/_schema.json"
        if not self.files.exists(path):
            return {}
        found = json.loads(self.files.read_text(path))
        return found if "schema" in found else {"schema": found}

    def read(self) -> DataFrame:
        """The replica as it is now. Read again after a load: file lists are taken here."""
        return self.spark.read.format(self.format).schema(self.schema).load(self.root)

    def stage_report(self) -> DataFrame:
        """One row per stage of every finished load."""
        return self._report("stages", STAGES)

    def partition_report(self) -> DataFrame:
        """One row per partition that a finished load changed."""
        return self._report("partitions", PARTITIONS)

    def attempt_report(self) -> DataFrame:
        """One row per stage of every attempt at a load, initial or not, written as the stage ends.

        The last row of an attempt that failed has the status ``failed`` and the error; an attempt
        whose process died has the stages that ended.
        """
        return self._report("attempts", ATTEMPTS)

    def partitions(self) -> list[Partition]:
        """The partitions there are: as many as month pairs, from one listing."""
        to, start = self.contract.partition_columns
        paths = self.files.glob(self.root, f"{to}=*/{start}=*")
        values = ([part.split("=", 1)[1] for part in path.split("/")] for path in paths)
        none = {_NO_MONTH: None}
        return sorted({tuple(none.get(v, v) for v in pair) for pair in values}, key=str)

    def changed_partitions(self, run_id: str) -> DataFrame:
        """(to_month, from_month, incoming, rows_now, last_run) of the partitions that a run changed.

        ``rows_now`` are the rows that a partition must have by the last run of this generation that
        changed it, ``last_run``.
        """
        report = self.partition_report().where(F.col("epoch") == self.epoch)
        finished, own = F.coalesce("finished", F.lit(0.0)), F.col("run_id") == run_id
        found = report.groupBy("to_month", "from_month").agg(
            F.sum(F.when(own, F.col("incoming"))).alias("incoming"),
            F.max_by("rows_after", finished).alias("rows_now"),
            F.max_by("run_id", finished).alias("last_run"),
        )
        return found.where("incoming is not null")

    def audit(self, run_id: str, increment: DataFrame | None = None) -> DataFrame:
        """Check a published run by the partitions it changed; (check, violations, ok).

        ``partition_rows`` counts the rows by which partitions differ from the reports; it needs
        file footers only. With the run's increment, ``reconcile.check_increment`` is asked too: whole
        rows of those partitions, and the key columns of the months that its versions start in. Rows
        of a run may be replaced by a later one, so the increment can be checked only while no later
        run has changed its partitions.
        """
        changed = self.changed_partitions(run_id)
        found = changed.collect()  # as many as month pairs
        if not found and not self.files.exists(self._recorded("stages", run_id, self.epoch)):
            raise LoadError(f"no published run {run_id!r} in this generation of {self.root}")
        contract = self.contract
        pairs = {(r["to_month"], r["from_month"]) for r in found}
        replica = self.read()
        target = replica.where(in_partitions(sorted(pairs, key=str), contract))
        checks = check_partition_rows(changed, partition_counts(target, contract), contract)
        if increment is None:
            return checks
        if any(r["last_run"] != run_id for r in found):
            raise LoadError(f"a later run has changed partitions of {run_id!r}")
        # A version's rows all start in one month, whenever they end.
        months = sorted({r["from_month"] for r in found if r["incoming"] and r["from_month"]})
        siblings = replica.where(col(contract.from_month).isin(months))
        prepared = prepare(increment, self.schema, contract)
        keys, _ = self._hinted(version_keys(prepared, contract), sum(r["incoming"] for r in found))
        return checks.unionAll(check_increment(prepared, target, siblings, keys, contract))

    def _report(self, kind: str, schema: str) -> DataFrame:
        path = f"{self.root}/_runs/{kind}"
        if not self.files.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("pathGlobFilter", "*.json").json(path)

    # -- loading -------------------------------------------------------------------------------

    def initial_load(
        self, source: DataFrame, overwrite: bool = False, clustered: bool = False
    ) -> None:
        """Write the first content, month columns derived from the intervals.

        Rows are brought together by month first; a source that is ``clustered`` by the interval's
        dates already is written without that shuffle. Replacing an existing replica needs
        ``overwrite`` and goes through staging, so it may read the replica itself and survives a
        crash like any load.
        """
        rows = with_months(source, self.contract)
        payload = [c for c in rows.columns if c not in self.contract.partition_columns]
        rows = rows.select(*(col(c) for c in payload + self.contract.partition_columns))
        self.files.make(self.root)
        with self._owning(_INITIAL):
            self._initial(rows, overwrite, clustered)
            self._sync()

    def _initial(self, rows: DataFrame, overwrite: bool, clustered: bool) -> None:
        """Both ways count the rows of each partition first and compare them with what was written."""
        if not overwrite and not self.files.exists(self._unfinished) and self._partition_roots():
            raise LoadError(f"{self.root} already holds a replica")
        report = self._attempt(_INITIAL, _INITIAL, self.epoch)
        with self._stage(report, "profile") as row:
            incoming = self._incoming(rows)
            total = sum(c.incoming for c in incoming.values())
            row.update(partitions=len(incoming), rows_in=total, rows_out=total)
        self._write_initial(rows, clustered, report, incoming)

    def _write_initial(
        self,
        rows: DataFrame,
        clustered: bool,
        report: Attempt,
        incoming: dict[Partition, PartitionChange],
    ) -> None:
        total = sum(c.incoming for c in incoming.values())
        schema = text_months(rows.schema, self.contract)
        size = 0 if clustered else _planned_bytes(rows)
        if not clustered:
            rows = self._rebalanced(rows)
        if self.files.exists(self._unfinished):
            self._each(lambda n: self.files.delete(f"{self.root}/{n}"), self._partition_roots())
        if not self._partition_roots():
            epoch = self.epoch + 1 if self.files.exists(f"{self.root}/_runs/stages") else 0
            self.files.write_text(self._unfinished, "")
            with self._stage(report, "stage") as row, self._shuffling(size):
                self._write(rows, self.root, "append")
                row.update(partitions=len(incoming), rows_in=total, rows_out=total)
            with self._stage(report, "verify") as row:
                reader = self.spark.read.format(self.format).schema(schema)
                counts = self._partition_roots() and partition_counts(
                    reader.load(self.root), self.contract
                ).collect()
                found = self._verify(counts, incoming)
                row.update(partitions=len(incoming), rows_in=total, rows_out=found)
            self.owner.check()
            self._set_schema(schema, epoch, self._zone(schema))
            self.files.delete(self._unfinished)
            return
        self._finish_others()
        stage = self._new_stage(f"initial-{uuid.uuid4().hex}")
        old = self._files(None)
        try:
            with self._stage(report, "stage") as row, self._shuffling(size):
                if self.publish_by == "append":
                    self._announce(stage, None)
                    self._write(rows, self.root, "append")
                else:
                    self._write(rows.withColumn(_TREE, F.lit(_REPLACE)), f"{stage}/content")
                row.update(partitions=len(incoming), rows_in=total, rows_out=total)
            with self._stage(report, "verify") as row:
                new = self._added(stage, None) if self.publish_by == "append" else []
                found = self._verify(self._counts_of(stage, new, schema), incoming)
                row.update(partitions=len(incoming), rows_in=total, rows_out=found)
            self.owner.check()
        except FencedError:
            raise
        except Exception:
            self._abandon(stage)
            raise
        manifest = {
            "schema": schema.jsonValue(),
            "epoch": self.epoch + 1,
            "zone": self._zone(schema),
        }
        if self.publish_by == "copy":
            staged = {
                (r[self.contract.to_month], r[self.contract.from_month])
                for r in self._staged_counts(stage, schema)
            }
            columns = self.read().select(*self.contract.partition_columns).distinct().collect()
            before = {(r[0], r[1]) for r in columns}
            manifest |= {
                "replace": sorted(staged, key=str),
                "remove": sorted(before - staged, key=str),
            }
        else:
            manifest |= {"new": self._added(stage, None), "old": old}
        self._commit(stage, manifest)

    def apply(self, increment: DataFrame, mode: str, run_id: str | None = None) -> DataFrame:
        """Apply an increment and return the run's stage report.

        Repeating a ``run_id`` that was published does nothing, and repeating one that is under way
        takes it over. While any other load is under way this one is refused (``owner.BusyError``). The
        increment is read up to three times (twice for a few columns only), so it should come from
        files, not from a long plan.
        """
        check_mode(mode)
        run_id = run_id or uuid.uuid4().hex
        if not _RUN_ID.fullmatch(run_id):
            raise ValueError(f"run_id {run_id!r} is not a plain file name")
        if self.files.exists(self._unfinished):
            raise LoadError(f"the initial load of {self.root} did not finish; repeat it")
        with self._owning(run_id):
            self._finish_others()
            if not self.files.exists(self._recorded("stages", run_id, self.epoch)):
                self._load(increment, mode, run_id)
            self._sync()
        done = (F.col("run_id") == run_id) & (F.col("epoch") == self.epoch)
        return self.stage_report().where(done)

    def recover(self) -> list[str]:
        """Finish every load that was staged in full; drop the remains of all others.

        This takes the replica over from a load that is thought dead. If it is not, it stops at its
        next step, and neither of the two loses a row.
        """
        if not self.files.exists(self.root):
            return []
        with self._owning("recovery", over=True):
            finished = self._finish_others()
            if not self.files.exists(self._unfinished):
                self._sync()
            return finished

    def _sync(self) -> None:
        if self.table is not None:
            self.owner.check()
            sync_table(self, self.table)

    @contextmanager
    def _owning(self, run_id: str, over: bool = False):
        """Own the replica. A process that dies stays the owner until it is taken over."""
        self.owner.take(run_id, over)
        try:
            yield
        except Exception:
            self.owner.drop()
            raise
        self.owner.drop()

    def _finish_others(self) -> list[str]:
        finished = []
        for run_id in sorted(self.files.names(f"{self.root}/_staging")):
            self.owner.check()
            stage = f"{self.root}/_staging/{run_id}"
            manifest = self._manifest(stage)
            if manifest is not None and self._complete(stage, manifest):
                self._publish(stage, manifest)
                finished.append(run_id)
            else:
                self._abandon(stage)
        return finished

    def _manifest(self, stage: str) -> dict | None:
        path = f"{stage}/manifest.json"
        return json.loads(self.files.read_text(path)) if self.files.exists(path) else None

    def _load(self, increment: DataFrame, mode: str, run_id: str) -> None:
        stage = self._new_stage(run_id)
        try:
            report = self._attempt(run_id, mode, self.epoch)
            self._check_zone()
            prepared = prepare(increment, self.schema, self.contract)
            replica = self.read()

            with self._stage(report, "profile") as row:
                changes = self._incoming(prepared)
                total_in = sum(c.incoming for c in changes.values())
                row.update(partitions=len(changes), rows_in=total_in, rows_out=total_in)

            with self._stage(report, "keys") as row:
                key_rows, key_months = self._key_bound(changes, mode)
                keys, small = None, False
                if key_rows:
                    with self._shuffling(self._key_bytes(prepared)):
                        keys = self._stage_keys(prepared, mode, stage)
                # From the footers of what was written: exact, whatever executors were lost.
                written = keys.count() if key_rows else 0
                if key_rows:
                    keys, small = self._hinted(keys, written)
                row.update(partitions=len(key_months), rows_in=key_rows, rows_out=written)

            with self._stage(report, "detect") as row:
                if keys is not None:
                    with self._shuffling(self._key_bytes(replica)):
                        found = self._find_replaced(replica, keys, key_months, mode, stage, small)
                        self._count_replaced(found, mode, changes)
                self._count_before(replica, changes)
                replaced = sum(c.replaced for c in changes.values())
                if replaced and not small:
                    # Of a large increment few keys may meet an old row: those are enough.
                    found, small = self._hinted(found, replaced)
                    keys = found if small else keys
                before = sum(c.rows_before for c in changes.values())
                row.update(partitions=len(changes), rows_in=before, rows_out=replaced)

            with self._stage(report, "stage") as row:
                rewritten = [c for c in changes.values() if c.action == _REPLACE]
                old = self._files([c.key for c in changes.values() if c.action != _APPEND])
                if self.publish_by == "append":
                    self._announce(stage, list(changes))
                usages = self._usage([c for c in rewritten if c.rows_before])
                for batch in self._batches(changes, usages, _planned_bytes(prepared), total_in):
                    self.owner.check()
                    self._write_batch(replica, prepared, keys, batch, usages, small, stage)
                row.update(
                    partitions=len(changes),
                    rows_in=sum(c.rows_before for c in rewritten) + total_in,
                )

            with self._stage(report, "verify") as row:
                new = self._added(stage, list(changes))
                staged = self._verify(self._counts_of(stage, new), changes)
                report[-2]["rows_out"] = staged
                row.update(partitions=len(changes), rows_in=staged, rows_out=staged)
            self.owner.check()
        except FencedError:
            raise
        except Exception:
            self._abandon(stage)
            raise

        lists = {
            "replace": [c.key for c in changes.values() if c.action == _REPLACE],
            "remove": [c.key for c in changes.values() if c.action == "remove"],
        }
        if self.publish_by != "copy":
            lists = {"new": new, "old": old}
        self._commit(
            stage,
            lists
            | {
                "run_id": run_id,
                "mode": mode,
                "epoch": self.epoch,
                "stages": report,
                "partitions": [asdict(c) for c in changes.values()],
            },
        )

    def _incoming(self, prepared: DataFrame) -> dict[Partition, PartitionChange]:
        """Increment rows per partition. As many entries as month pairs, whatever the data size."""
        found = partition_counts(prepared, self.contract).collect()
        return {
            (r[0], r[1]): PartitionChange(r[0], r[1], incoming=r[2])
            for r in sorted(found, key=str)
        }

    def _key_bound(
        self, changes: dict[Partition, PartitionChange], mode: str
    ) -> tuple[int, list[str]]:
        """An upper bound of the displacing keys, and the months they start in."""
        open_month = self.contract.open_month
        carriers = [
            c
            for c in changes.values()
            if c.from_month is not None
            and (mode != APPEND_CLOSE or c.to_month not in (None, open_month))
        ]
        months = sorted({c.from_month for c in carriers})
        return sum(c.incoming for c in carriers), months

    def _stage_keys(self, prepared: DataFrame, mode: str, stage: str) -> DataFrame:
        """The displacing keys as a table: used twice, and the same both times."""
        return self._staged_table(displacing_keys(prepared, mode, self.contract), f"{stage}/keys")

    def _staged_table(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _hinted(self, keys: DataFrame, bound: int) -> tuple[DataFrame, bool]:
        """Keys with a join hint, and whether that is to broadcast them.

        They are broadcast only if their number, known beforehand, and their fixed width prove
        them small. Otherwise the join is told to shuffle, rather than left to judge by the
        compressed size of the files.
        """
        fixed = all(
            isinstance(keys.schema[c].dataType, _FIXED_WIDTH) for c in self.contract.version_key
        )
        small = fixed and bound * _KEY_BYTES <= self.broadcast_bytes
        return (F.broadcast(keys) if small else keys.hint("merge")), small

    def _find_replaced(
        self,
        replica: DataFrame,
        keys: DataFrame,
        months: list[str],
        mode: str,
        stage: str,
        small: bool,
    ) -> DataFrame:
        """Keys and partitions of replaced rows, from the key columns of the months concerned.

        After a shuffle the result is written, as its keys may serve the next join.
        """
        candidates = replica.where(col(self.contract.from_month).isin(months))
        found = replaced_rows(candidates, keys, mode, self.contract)
        return found if small else self._staged_table(found, f"{stage}/replaced")

    def _count_replaced(
        self, found: DataFrame, mode: str, changes: dict[Partition, PartitionChange]
    ) -> None:
        ambiguous = 0
        for to, start, replaced, clashes in replaced_counts(found, self.contract).collect():
            change = changes.setdefault((to, start), PartitionChange(to, start))
            change.replaced, change.action = replaced, _REPLACE
            ambiguous += clashes
        if ambiguous and mode != APPEND_CLOSE:
            raise MergeConflictError(f"{CARDINALITY_ERROR}: {ambiguous} replica rows")

    def _count_before(
        self, replica: DataFrame, changes: dict[Partition, PartitionChange]
    ) -> None:
        touched = replica.where(in_partitions(list(changes), self.contract))
        for to, start, rows in partition_counts(touched, self.contract).collect():
            changes[to, start].rows_before = rows
        for change in changes.values():
            change.rows_after = change.rows_before - change.replaced + change.incoming
            if change.rows_after == 0:
                change.action = "remove"
            elif change.rows_before == 0 or self.publish_by == "copy":
                change.action = _REPLACE

    def _batches(
        self,
        changes: dict[Partition, PartitionChange],
        usages: dict[Partition, tuple[int, int]],
        incoming_bytes: int,
        incoming_rows: int,
    ) -> list[dict[Partition, PartitionChange]]:
        """The changes in groups of start months, each of about ``batch_bytes`` to be rewritten.

        A month is not divided: within one, AQE divides the work.
        """
        months: dict[str | None, list[PartitionChange]] = {}
        for change in changes.values():
            if change.action != "remove":
                months.setdefault(change.from_month, []).append(change)
        batches: list[dict[Partition, PartitionChange]] = []
        held = 0
        for month in sorted(months, key=str):
            size = sum(
                usages.get(c.key, (0, 0))[0] + incoming_bytes * c.incoming // max(incoming_rows, 1)
                for c in months[month]
            )
            if not batches or held + size > self.batch_bytes:
                batches.append({})
                held = 0
            held += size
            batches[-1].update({c.key: c for c in months[month]})
        return batches

    def _write_batch(
        self,
        replica: DataFrame,
        prepared: DataFrame,
        keys: DataFrame | None,
        batch: dict[Partition, PartitionChange],
        usages: dict[Partition, tuple[int, int]],
        small: bool,
        stage: str,
    ) -> None:
        """Write the new content of some partitions."""
        used = {key: usage for key, usage in usages.items() if key in batch}
        loose = {key for key, usage in used.items() if small and not self._wants_compaction(usage)}
        incoming = prepared
        if any(c.incoming for c in batch.values()):
            incoming = prepared.where(in_partitions(list(batch), self.contract))
        content = self._content(replica, incoming, keys, batch, loose)
        shuffled = sum(size for key, (size, _) in used.items() if key not in loose)
        with self._shuffling(shuffled + _planned_bytes(prepared)):
            if self.publish_by == "append":
                self._write(content.drop(_TREE), self.root, "append")
            else:
                self._write(content, f"{stage}/content", "append")

    def _content(
        self,
        replica: DataFrame,
        prepared: DataFrame,
        keys: DataFrame | None,
        changes: dict[Partition, PartitionChange],
        loose: set[Partition],
    ) -> DataFrame:
        """New content of the changed partitions, in the tree it will be published from.

        Partitions that only gain rows contribute nothing but those rows, unless the publish has
        to rewrite them anyway. Rows kept next to a broadcast key set still sit in their
        partitions' files, and those of ``loose`` partitions are written as they are read. The rest
        and the increment are shuffled: partitions that want compaction, and after a shuffled join,
        when every task holds rows of every partition, all of them.
        """
        gaining = in_partitions(
            [c.key for c in changes.values() if c.action == _APPEND], self.contract
        )
        shuffled = prepared.withColumn(_TREE, F.when(gaining, _APPEND).otherwise(_REPLACE))
        as_read: list[DataFrame] = []

        def add(partitions: list[Partition], losing: bool) -> None:
            nonlocal shuffled
            for compact in (True, False):
                some = [key for key in partitions if (key not in loose) is compact]
                if not some:
                    continue
                kept = replica.where(in_partitions(some, self.contract))
                if losing:
                    kept = on_version(kept, keys, "left_anti", self.contract)
                kept = kept.withColumn(_TREE, F.lit(_REPLACE))
                if compact:
                    shuffled = shuffled.unionByName(kept)
                else:
                    as_read.append(kept)

        rewritten = [c for c in changes.values() if c.action == _REPLACE]
        add([c.key for c in rewritten if c.replaced], losing=True)
        add([c.key for c in rewritten if not c.replaced and c.rows_before], losing=False)
        every = self._rebalanced(shuffled)
        for kept in as_read:
            every = every.unionByName(kept)
        return every

    def _usage(self, changes: list[PartitionChange]) -> dict[Partition, tuple[int, int]]:
        """Bytes and files of each partition."""
        usages: dict[Partition, tuple[int, int]] = {}
        self._each(
            lambda c: usages.update(
                {c.key: self.files.usage(f"{self.root}/{self._directory(c.key)}")}
            ),
            changes,
        )
        return usages

    def _wants_compaction(self, usage: tuple[int, int]) -> bool:
        """Whether a partition holds too many files, or files too small to be worth opening."""
        size, files = usage
        return files > self.crowded * (1 + size // self.file_bytes) or size < files * self.tiny_bytes

    def _key_bytes(self, rows: DataFrame) -> int:
        return _planned_bytes(rows.select(*(col(c) for c in self.contract.version_key)))

    @contextmanager
    def _shuffling(self, size: int):
        """Shuffle partitions for ``size`` bytes of files, if the session has fewer.

        AQE joins partitions it does not need but cannot split evenly filled ones, so a load much
        larger than the session was set up for would otherwise spill all the way.
        """
        given = self.spark.conf.get(_WIDTH)
        wanted = size // _BYTES_PER_TASK
        if wanted <= int(given):
            yield
            return
        self.spark.conf.set(_WIDTH, str(wanted))
        try:
            yield
        finally:
            self.spark.conf.set(_WIDTH, given)

    def _verify(self, counts: list, changes: dict[Partition, PartitionChange]) -> int:
        """Compare the new rows of each partition with the counts taken before; return all."""
        staged = {
            (r[self.contract.to_month], r[self.contract.from_month]): r["rows"] for r in counts
        }
        for change in changes.values():
            expected = change.incoming if change.action == _APPEND else change.rows_after
            found = staged.pop(change.key, 0)
            if found != expected:
                raise LoadError(
                    f"staged {found} instead of {expected} rows for {change.key}: "
                    "the increment or the replica changed during the load"
                )
        if staged:
            raise LoadError(f"staged unexpected partitions {sorted(staged, key=str)}")
        return sum(
            c.incoming if c.action == _APPEND else c.rows_after for c in changes.values()
        )

    # -- files ---------------------------------------------------------------------------------

    def _rebalanced(self, rows: DataFrame) -> DataFrame:
        """Bring the rows of a partition together; AQE splits a hot month and joins small ones."""
        return rows.hint("rebalance", *(col(c) for c in self.contract.partition_columns))

    def _write(self, rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
        tree = [_TREE] if _TREE in rows.columns else []
        (
            rows.write.format(self.format)
            .options(**self.write_options)
            .mode(mode)
            .partitionBy(*tree, *self.contract.partition_columns)
            .save(path)
        )

    def _staged(self, stage: str, schema: T.StructType) -> DataFrame:
        tree = T.StructField(_TREE, T.StringType())
        full = T.StructType([*schema.fields, tree])
        return self.spark.read.format(self.format).schema(full).load(f"{stage}/content")

    def _staged_counts(self, stage: str, schema: T.StructType) -> list:
        if not self.files.exists(f"{stage}/content"):
            return []
        return partition_counts(self._staged(stage, schema), self.contract).collect()

    def _counts_of(self, stage: str, new: list[str], schema: T.StructType | None = None) -> list:
        """New rows per partition: of what was staged, or of the files appended to the replica."""
        schema = schema or self.schema
        if self.publish_by != "append":
            return self._staged_counts(stage, schema)
        if not new:
            return []
        reader = self.spark.read.format(self.format).schema(schema)
        rows = reader.option("basePath", self.root).load([f"{self.root}/{name}" for name in new])
        return partition_counts(rows, self.contract).collect()

    def _files(self, partitions: list[Partition] | None) -> list[str]:
        """Files of some partitions, or of all, by their path below the root."""
        if partitions is None:
            return self._listed(["*"])
        paths = {self._directory(p) for p in partitions}
        found = self._listed(sorted({path.split("/")[0].split("=", 1)[1] for path in paths}))
        return [name for name in found if name.rsplit("/", 1)[0] in paths]

    def _listed(self, months: list[str]) -> list[str]:
        """Files of all partitions that end in these months: one call each."""
        found: list[str] = []
        to, start = self.contract.partition_columns
        self._each(
            lambda m: found.extend(self.files.glob(self.root, f"{to}={m}/{start}=*/*")), months
        )
        return sorted(name for name in found if name.rsplit("/", 1)[1][0] not in "_.")

    def _announce(self, stage: str, partitions: list[Partition] | None) -> None:
        """Note the files there are before others are appended to the replica itself."""
        self.files.make(stage)
        paths = None if partitions is None else [self._directory(p) for p in partitions]
        note = {"paths": paths, "before": self._files(partitions)}
        self.files.write_text(f"{stage}/appending.json", json.dumps(note))

    def _added(self, stage: str, partitions: list[Partition] | None) -> list[str]:
        """Files that this load adds, by the path that they have or will have below the root."""
        if self.publish_by == "append":
            note = json.loads(self.files.read_text(f"{stage}/appending.json"))
            return sorted(set(self._files(partitions)) - set(note["before"]))
        return sorted(self._staged_paths(stage))

    def _new_stage(self, run_id: str) -> str:
        return f"{self.root}/_staging/{run_id}"

    def _directory(self, partition: Partition) -> str:
        names = self.contract.partition_columns
        values = [_NO_MONTH if v is None else v for v in partition]
        return "/".join(f"{n}={v}" for n, v in zip(names, values, strict=True))

    def _partition_roots(self) -> list[str]:
        """Anything a reader of the root would see."""
        return [n for n in self.files.names(self.root) if not n.startswith(("_", "."))]

    def _zone(self, schema: T.StructType) -> str | None:
        """The session's zone, if the months of these columns depend on it."""
        ends = (self.contract.valid_from, self.contract.valid_to)
        zoned = any(isinstance(schema[c].dataType, T.TimestampType) for c in ends)
        return self.spark.conf.get("spark.sql.session.timeZone") if zoned else None

    def _check_zone(self) -> None:
        """Months of zoned timestamps were derived in one zone, and partitions are pruned by them."""
        zone, here = self._described().get("zone"), self._zone(self.schema)
        if zone is not None and zone != here:
            raise LoadError(f"the months of {self.root} are those of zone {zone}, not {here}")

    def _set_schema(self, schema: T.StructType, epoch: int, zone: str | None) -> None:
        described = {"epoch": epoch, "zone": zone, "schema": schema.jsonValue()}
        self.files.write_text(f"{self.root}/_schema.json", json.dumps(described))
        self._schema = schema

    # -- publishing ----------------------------------------------------------------------------

    def _commit(self, stage: str, manifest: dict) -> None:
        """From the manifest on, a load is finished by this process or by the next ``recover``."""
        manifest["publish"] = self.publish_by
        self.owner.check()
        self.files.write_text(f"{stage}/manifest.json", json.dumps(manifest))
        self._publish(stage, manifest)

    def _complete(self, stage: str, manifest: dict) -> bool:
        """Whether all that a manifest adds is there, in the staging area or in its place."""
        if manifest["publish"] == "copy":
            return not manifest["replace"] or self.files.exists(f"{stage}/content")
        staged = self._staged_paths(stage) if manifest["publish"] == "move" else {}
        missing = {name for name in manifest["new"] if name not in staged}
        months = sorted({name.split("/")[0].split("=", 1)[1] for name in missing})
        return missing <= set(self._listed(months))

    def _staged_paths(self, stage: str) -> dict[str, str]:
        """Where each staged file is, by the path it will have below the root."""
        content = f"{stage}/content"
        found = self.files.glob(content, f"{_TREE}=*/*/*/*")
        return {
            path.split("/", 1)[1]: f"{content}/{path}"
            for path in found
            if path.rsplit("/", 1)[1][0] not in "_."
        }

    def _publish(self, stage: str, manifest: dict) -> None:
        """Put new files in place and delete replaced ones. Every step may be repeated."""
        started = time.monotonic()
        self.owner.check()
        if "schema" in manifest:
            schema = T.StructType.fromJson(manifest["schema"])
            self._set_schema(schema, manifest.get("epoch", 0), manifest.get("zone"))
        # What was staged depends on the method, so a replay keeps to it.
        if manifest["publish"] == "copy":
            self._overwrite_partitions(stage, manifest)
            self.owner.check()
            self._each(
                lambda p: self.files.delete(f"{self.root}/{self._directory(p)}"),
                manifest["remove"],
            )
        else:
            if manifest["publish"] == "move":
                self._move_in(self._staged_paths(stage))
            if not self._complete(stage, manifest):
                raise LoadError(f"files of {stage} are gone; nothing was deleted")
            self.owner.check()
            self._each(lambda n: self.files.delete(f"{self.root}/{n}"), manifest["old"])
            self._drop_empty(manifest["old"], manifest["new"])
        self.owner.check()
        if "run_id" in manifest:
            self._record(manifest, time.monotonic() - started)
        self.owner.check()
        self.files.delete(stage)

    def _move_in(self, staged: dict[str, str]) -> None:
        """Move staged files, which have unique names, to their partitions.

        A file that is no longer where it was staged may have been moved by another process; whether
        all are in place is asked afterwards.
        """
        to, start = self.contract.partition_columns
        here = set(self.files.glob(self.root, f"{to}=*/{start}=*"))
        months = {path.split("/")[0] for path in here}
        trees: dict[str, dict[str, list[str]]] = {}
        for name, path in staged.items():
            month, first, _ = name.split("/")
            tree = path[: -len(name) - 1]
            trees.setdefault(month, {}).setdefault(tree, []).append(f"{month}/{first}")
        # A directory that the replica lacks is moved as a whole. It can only come into being by a move
        # of the same directory, so two processes cannot put one into the other.
        whole: dict[str, str] = {}
        for month, found in trees.items():
            if month not in months and len(found) == 1:
                (tree,) = found
                whole[month] = f"{tree}/{month}"
                continue
            for tree, paths in found.items():
                whole |= {path: f"{tree}/{path}" for path in paths if path not in here}
        self._each(
            lambda month: self.files.make(f"{self.root}/{month}"),
            sorted({path.split("/")[0] for path in whole if "/" in path} - months),
        )
        covered = {*whole}

        def move(item: tuple[str, str]) -> None:
            path, source = item
            try:
                self.files.move(source, f"{self.root}/{path}")
            except OSError:
                if self.files.exists(source):
                    raise

        self._each(move, list(whole.items()))
        single = {
            name: path
            for name, path in staged.items()
            if name.split("/")[0] not in covered and name.rsplit("/", 1)[0] not in covered
        }
        self._each(move, list(single.items()))

    def _drop_empty(self, deleted: list[str], added: list[str]) -> None:
        """Remove directories that the deleted files have left empty."""
        if not self.files.renames:
            return  # object stores have no directories
        filled = {name.rsplit("/", 1)[0] for name in added}
        starts = sorted({name.rsplit("/", 1)[0] for name in deleted} - filled)
        for paths in (starts, sorted({path.rsplit("/", 1)[0] for path in starts})):
            self._each(lambda path: self.files.delete_if_empty(f"{self.root}/{path}"), paths)

    def _abandon(self, stage: str) -> None:
        """Drop what is left of a load that did not get as far as its manifest."""
        note = f"{stage}/appending.json"
        if self.files.exists(note):
            found = json.loads(self.files.read_text(note))
            paths = found["paths"]
            before = set(found["before"])
            there = self._files(None)
            if paths is not None:
                there = [name for name in there if name.rsplit("/", 1)[0] in set(paths)]
            self.owner.check()
            self._each(
                lambda n: self.files.delete(f"{self.root}/{n}"), [n for n in there if n not in before]
            )
        self.files.delete(stage)

    @staticmethod
    def _each(action, items: list) -> None:
        """Metadata calls wait for the file system, so several are kept under way."""
        with ThreadPoolExecutor(max_workers=8) as pool:
            for _ in pool.map(action, items):
                pass

    def _overwrite_partitions(self, stage: str, manifest: dict) -> None:
        """Dynamic overwrite from staging, which stays whole until the load is recorded."""
        if not manifest["replace"]:
            return
        staged = self._staged(stage, self.schema).where(F.col(_TREE) == _REPLACE).drop(_TREE)
        (
            align(staged, self.schema)
            .write.format(self.format)
            .options(**self.write_options)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.contract.partition_columns)
            .save(self.root)
        )

    def _record(self, manifest: dict, seconds: float) -> None:
        """Write the reports; the stage report comes last and marks the run as published."""
        run_id, changes = manifest["run_id"], manifest["partitions"]
        epoch = manifest.get("epoch", 0)
        rows = sum(c["rows_after"] for c in changes)
        publish = {
            "stage": "publish",
            "partitions": len(changes),
            "rows_in": rows,
            "rows_out": rows,
            "seconds": seconds,
        }
        stages = [
            {"run_id": run_id, "mode": manifest["mode"], "epoch": epoch, **s}
            for s in [*manifest["stages"], publish]
        ]
        self.files.make(f"{self.root}/_runs/partitions")
        self.files.make(f"{self.root}/_runs/stages")
        common = {"run_id": run_id, "epoch": epoch, "finished": time.time()}
        partitions = [common | c for c in changes]
        self.files.write_text(self._recorded("partitions", run_id, epoch), _lines(partitions))
        self.files.write_text(self._recorded("stages", run_id, epoch), _lines(stages))

    def _recorded(self, kind: str, run_id: str, epoch: int) -> str:
        """A run's record. Those of the first generation have no number, as ever."""
        name = run_id if not epoch else f"{run_id}.epoch-{epoch}"
        return f"{self.root}/_runs/{kind}/{name}.json"

    def _attempt(self, run_id: str, mode: str, epoch: int) -> Attempt:
        self.files.make(f"{self.root}/_runs/attempts")
        name = uuid.uuid4().hex
        about = {"attempt": name, "run_id": run_id, "mode": mode, "epoch": epoch}
        return Attempt(f"{self.root}/_runs/attempts/{name}.json", about | {"started": time.time()})

    @contextmanager
    def _stage(self, report: Attempt, name: str):
        """A stage of a load; its row is written as it ends, in one way or the other."""
        started = time.monotonic()
        row = {"stage": name, "partitions": 0, "rows_in": 0, "rows_out": 0}
        report.append(row)
        try:
            yield row
        except Exception as error:
            row["seconds"] = time.monotonic() - started
            self._note(report, f"{type(error).__name__}: {error}"[:_ERROR_CHARS])
            raise
        row["seconds"] = time.monotonic() - started
        self._note(report)

    def _note(self, report: Attempt, error: str | None = None) -> None:
        rows = [{**report.about, "status": "done", "error": None, **row} for row in report]
        if error is not None:
            rows[-1] |= {"status": "failed", "error": error}
        self.files.write_text(report.path, _lines(rows))


def _planned_bytes(rows: DataFrame) -> int:
    """Spark's size estimate of a plan, or 0 if it has none."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def _lines(rows: list[dict]) -> str:
    return "\n".join(json.dumps(row) for row in rows) + "\n"
