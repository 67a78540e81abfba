"""An SCD2 replica of ``orders`` and increments for it, derived row by row from the table.

The input of the registered queries, the bench and the tests. ``o_orderkey`` is dense from 0, so
ids run from 1 to the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epochfold.functions.months import closed_by_month, month_end, open_by_month
from epochfold.model import Contract
from epochfold.operators.increment import with_months

CONTRACT = Contract()
_NEW_FROM = "2001-09-01"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        (F.col("o_orderkey") + 1).alias("id"),
        F.col("o_orderdate").cast("date").alias("eff_from_dt"),
        F.col("o_custkey").alias("cust_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
    )


def initial(orders: DataFrame) -> DataFrame:
    """Every order as one open version, without month columns."""
    end = F.lit(CONTRACT.open_date).alias("eff_to_dt")
    return orders.select("id", "eff_from_dt", end, "cust_id", "status", "amount")


def replica(orders: DataFrame) -> DataFrame:
    return with_months(initial(orders), CONTRACT)


def increment(orders: DataFrame, year: int | None = None, repeat: bool = False) -> DataFrame:
    """The raw increment: 5 % of the orders closed and reopened, 5 % new entities.

    ``year`` restricts it to orders of one year. ``repeat`` delivers the closed rows of ids
    divisible by 3 twice, which a merge has to refuse.
    """
    top = orders.agg(F.max("id")).scalar()
    base = orders if year is None else orders.where(F.year("eff_from_dt") == year)
    days = (F.col("id") % 90).cast("int")
    closed = _version(end=F.date_add("eff_from_dt", days + 1))
    successor = _version(
        start=F.date_add("eff_from_dt", days + 2), status=F.lit("U"), amount=F.col("amount") + 1.0
    )
    fresh = _version(
        id=F.col("id") + top, start=F.lit(_NEW_FROM).cast("date"), status=F.lit("N")
    )
    update = F.array(closed, successor)
    if repeat:
        twice = F.array(closed, closed, successor)
        update = F.when(F.col("id") % 3 == 0, twice).otherwise(update)
    # One scan of the table: each order yields its increment rows as an array.
    versions = F.when(F.col("id") % 20 == 3, update).when(F.col("id") % 20 == 7, F.array(fresh))
    return base.select(F.inline(versions))


def late_increment(loaded: DataFrame) -> DataFrame:
    """Late ends for a third of the closed versions, and some open versions delivered again."""
    is_late = closed_by_month(CONTRACT) & (F.col("id") % 3 == 0)
    is_again = open_by_month(CONTRACT) & (F.col("id") % 1000 == 1)
    end = F.when(is_late, F.date_add("eff_to_dt", 5)).otherwise(F.col("eff_to_dt"))
    return loaded.where(is_late | is_again).select(
        "id",
        "eff_from_dt",
        end.alias("eff_to_dt"),
        "cust_id",
        F.when(is_late, F.lit("L")).otherwise(F.lit("R")).alias("status"),
        "amount",
        "eff_from_month",
        month_end(end).alias("eff_to_month"),
    )


def _version(
    id: Column | None = None,
    start: Column | None = None,
    end: Column | None = None,
    status: Column | None = None,
    amount: Column | None = None,
) -> Column:
    given = {"id": id, "eff_from_dt": start, "status": status, "amount": amount}
    fields = {n: F.col(n) if c is None else c for n, c in given.items()}
    fields["eff_to_dt"] = F.lit(CONTRACT.open_date) if end is None else end
    fields["cust_id"] = F.col("cust_id")
    order = ("id", "eff_from_dt", "eff_to_dt", "cust_id", "status", "amount")
    return F.struct(*(fields[n].alias(n) for n in order))
