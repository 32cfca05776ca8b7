"""Calendar columns, among them the July-June farming campaign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAMPAIGN_FIRST_MONTH = 7


def campaign_start_year(date: Column) -> Column:
    """Year in which the campaign holding this date began."""
    began_last_year = F.month(date) < CAMPAIGN_FIRST_MONTH
    return (F.year(date) - began_last_year.cast("int")).cast("bigint")


def campaign_name(start_year: Column) -> Column:
    """``2019/2020`` for the campaign begun in 2019."""
    return F.concat(start_year.cast("string"), F.lit("/"), (start_year + 1).cast("string"))


def with_calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add year, month, quarter, Monday week start, month start and the campaign."""
    date = F.col(date_col)
    return df.withColumns(
        {
            "calendar_year": F.year(date).cast("bigint"),
            "calendar_month": F.month(date).cast("bigint"),
            "calendar_quarter": F.quarter(date).cast("bigint"),
            "week_start": F.trunc(date, "week"),
            "month_start": F.trunc(date, "month"),
            "campaign_start_year": campaign_start_year(date),
            "campaign_name": campaign_name(campaign_start_year(date)),
        }
    )
