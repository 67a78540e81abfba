"""What several operators share: picking columns, text tasks, tables that cut lineage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, suppress

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochfold.plans.scratch import shared_folder
from epochfold.sources.files import Files

#: A task works on texts of about so many bytes at a time.
SLICE_BYTES = 1 << 20
#: Spark removes the shuffle files of a query when it ends, not when its frames are collected.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Columns by exact name, also if others differ only by case or repeat a name (the first counts).

    `renamed` has the old names by the new ones.
    """
    at = {}
    for i, column in enumerate(df.columns):
        at.setdefault(column, i)
    wanted = {name: name for name in names} | renamed
    if missing := [old for old in wanted.values() if old not in at]:
        raise ValueError(f"no column {', '.join(missing)} among {', '.join(df.columns)}")
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{at[old]}").alias(new) for new, old in wanted.items()])


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the folder that all executors share and read back: short lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of queries begun in this block go when they end. A query run again repeats them."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


class Scratch:
    """Stored tables of one run by name, which can be deleted after their last use."""

    def __init__(self, spark: SparkSession, name: str):
        self._spark, self._path = spark, shared_folder(spark, name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self._path}/{name}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def free(self, *names: str) -> None:
        files = Files(self._spark, self._path)
        for name in names:
            files.delete(f"{self._path}/{name}")


def slices(batch: pa.RecordBatch, column: int = 1, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts take about `most` bytes; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin = held = 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > most:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def release() -> None:
    """Give memory that a task no longer needs back to the system: Python workers live on."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list], list[pa.Array]]],
    added: str,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    arrow: bool = False,
) -> DataFrame:
    """The columns `keep`, and columns computed from the texts.

    `make` runs once a task; what it returns gets texts and gives one array for each column of
    `added`. Texts come as a list of str or None (bytes if the column is binary), or as they are.
    """
    rows = df.select(*keep, F.col(text_col).alias("text of row"))
    fields = [rows.schema[c] for c in keep] + T.StructType.fromDDL(added).fields
    schema = T.StructType(fields)

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, len(keep)):
                texts = part.column(len(keep))
                arrays = [*part.columns[:-1], *work(texts if arrow else texts.to_pylist())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        del work
        release()

    return rows.mapInArrow(run, schema)
