"""The column contract of a replica and the two ways of applying an increment."""

from __future__ import annotations

import calendar
import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Closed increment rows replace the open row of the same version; everything else is appended.
APPEND_CLOSE = "append_close"
# Every increment row replaces whatever rows hold its version key, open or closed.
MERGE = "merge"

_DIRECTORY_SAFE = re.compile(r"[A-Za-z][A-Za-z0-9_]*")


@dataclass(frozen=True)
class Contract:
    """Names of the columns the loader works on. All other columns are payload."""

    id: str = "id"
    valid_from: str = "eff_from_dt"
    valid_to: str = "eff_to_dt"
    from_month: str = "eff_from_month"
    to_month: str = "eff_to_month"
    open_date: date = date(5999, 12, 31)

    def __post_init__(self):
        for name in self.partition_columns:
            if not _DIRECTORY_SAFE.fullmatch(name):
                raise ValueError(f"{name!r} names directories, so it must be a plain identifier")

    @property
    def version_key(self) -> list[str]:
        return [self.id, self.valid_from]

    @property
    def partition_columns(self) -> list[str]:
        """Directory levels of a replica: open and closed history part at the first one."""
        return [self.to_month, self.from_month]

    @property
    def open_month(self) -> str:
        """The ``to_month`` value shared by all open versions."""
        last = calendar.monthrange(self.open_date.year, self.open_date.month)[1]
        return self.open_date.replace(day=last).isoformat()


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_mode(mode: str) -> str:
    if mode not in (APPEND_CLOSE, MERGE):
        raise ValueError(f"mode must be {APPEND_CLOSE!r} or {MERGE!r}, not {mode!r}")
    return mode


def text_months(schema: T.StructType, contract: Contract = Contract()) -> T.StructType:
    """``schema`` with both month columns as text: Spark would infer dates from the directories."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType(), True) if f.name in contract.partition_columns else f
            for f in schema.fields
        ]
    )


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in its order.

    Names match by the session's case rule. Extra columns go; a missing one is an error, and so are
    several that match one. A type may differ only where Spark can widen it without loss: integers and
    decimals may gain digits, but a timestamp never becomes a date, because that would merge versions
    of one day.
    """
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    have: dict[str, list[T.StructField]] = {}
    for found in df.schema.fields:
        have.setdefault(found.name if sensitive else found.name.lower(), []).append(found)
    matches = {f.name: have.get(f.name if sensitive else f.name.lower(), []) for f in schema.fields}
    if missing := [name for name, found in matches.items() if not found]:
        raise ValueError(f"increment lacks replica columns {missing}")
    if several := {name: [f.name for f in found] for name, found in matches.items() if len(found) > 1}:
        raise ValueError(f"increment has several columns for one of the replica: {several}")
    out, wrong = [], []
    for field in schema.fields:
        source, target = matches[field.name][0].dataType, field.dataType
        if source.simpleString() == target.simpleString():
            out.append(col(field.name).alias(field.name))
        elif _widens(source, target):
            out.append(col(field.name).cast(target).alias(field.name))
        else:
            wrong.append(f"{field.name}: {source.simpleString()} -> {target.simpleString()}")
    if wrong:
        raise TypeError(f"increment types do not fit the replica: {'; '.join(wrong)}")
    return df.select(*out)


_INTEGRALS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def _widens(source: T.DataType, target: T.DataType) -> bool:
    if isinstance(target, T.DecimalType):
        if type(source) in _INTEGRALS:
            whole, scale = (3, 5, 10, 19)[_INTEGRALS.index(type(source))], 0
        elif isinstance(source, T.DecimalType):
            whole, scale = source.precision - source.scale, source.scale
        else:
            return isinstance(source, T.NullType)
        return target.scale >= scale and target.precision - target.scale >= whole
    if type(source) in _INTEGRALS and type(target) in _INTEGRALS:
        return _INTEGRALS.index(type(source)) <= _INTEGRALS.index(type(target))
    if isinstance(source, T.NullType):
        return True
    if isinstance(source, T.DateType):
        return isinstance(target, (T.TimestampType, T.TimestampNTZType))
    return isinstance(source, T.FloatType) and isinstance(target, T.DoubleType)
