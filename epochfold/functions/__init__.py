from epochfold.functions.months import (
    closed_by_date,
    closed_by_month,
    month_end,
    month_start,
    open_by_date,
    open_by_month,
)

__all__ = [
    "closed_by_date",
    "closed_by_month",
    "month_end",
    "month_start",
    "open_by_date",
    "open_by_month",
]
