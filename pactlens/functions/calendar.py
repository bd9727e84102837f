"""Reporting periods."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.config import ReportConfig


def month_start(day: date) -> date:
    return day.replace(day=1)


def add_months(day: date, count: int) -> date:
    """First day of the month ``count`` months away."""
    index = day.year * 12 + day.month - 1 + count
    return date(index // 12, index % 12 + 1, 1)


def month_end(day: date) -> date:
    return add_months(day, 1) - timedelta(days=1)


@dataclass(frozen=True)
class Period:
    period_id: str
    horizon: str
    start: date
    end: date


def reporting_month(cfg: ReportConfig) -> date:
    """First day of the month before the as-of month."""
    return add_months(month_start(cfg.as_of), -1)


def reporting_end(cfg: ReportConfig) -> date:
    return month_end(reporting_month(cfg))


def horizons(cfg: ReportConfig) -> list[Period]:
    current = reporting_month(cfg)
    end = month_end(current)
    year_ago = add_months(current, -12)
    prior_end = month_end(year_ago)
    rolling = add_months(current, -11)
    return [
        Period("current_month", "current_month", current, end),
        Period("prior_month", "current_month", year_ago, prior_end),
        Period("ytd", "ytd", date(current.year, 1, 1), end),
        Period("prior_ytd", "ytd", date(current.year - 1, 1, 1), prior_end),
        Period("rolling12", "rolling12", rolling, end),
        Period("prior_rolling12", "rolling12", add_months(rolling, -12), prior_end),
        Period("prior_year", "prior_year", date(current.year - 1, 1, 1), date(current.year - 1, 12, 31)),
        Period("inception", "inception", cfg.inception_start, end),
    ]


def months(cfg: ReportConfig, count: int = 24) -> list[Period]:
    current = reporting_month(cfg)
    starts = [add_months(current, k - count + 1) for k in range(count)]
    return [Period(s.strftime("%Y-%m"), "month", s, month_end(s)) for s in starts]


# the four horizons dimension tables are computed for
DIMENSION_HORIZONS = ("inception", "rolling12", "ytd", "current_month")


def pick(cfg: ReportConfig, *period_ids: str) -> list[Period]:
    every = {p.period_id: p for p in horizons(cfg)}
    return [every[i] for i in period_ids]


def period_frame(spark: SparkSession, periods: list[Period]) -> DataFrame:
    """The periods as a table: at most 8 horizons and 24 months, so always fit to broadcast."""
    rows = ", ".join(
        f"('{p.period_id}', '{p.horizon}', date'{p.start}', date'{p.end}')" for p in periods
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(period_id, horizon, period_start, period_end)"
    )


def month_spine(spark: SparkSession, cfg: ReportConfig, count: int = 24) -> DataFrame:
    """One row per month up to the reporting month, present or not in the data."""
    current = reporting_month(cfg)
    first = add_months(current, 1 - count)
    spine = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(first), F.lit(current), F.expr("interval 1 month"))
        ).alias("period_start")
    )
    return spine.select(
        F.date_format("period_start", "yyyy-MM").alias("period_id"),
        "period_start",
        F.last_day("period_start").alias("period_end"),
    )


def elapsed_months(start: str, end: str) -> str:
    """Calendar months touched from start to end, both counted; 0 if start is later (SQL text)."""
    return (
        f"CASE WHEN {start} > {end} THEN 0 ELSE (year({end}) - year({start})) * 12"
        f" + month({end}) - month({start}) + 1 END"
    )


def sql_date(day: date) -> str:
    return f"date'{day.isoformat()}'"
