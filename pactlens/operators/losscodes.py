"""Loss codes and vehicle makes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pactlens.config import ReportConfig
from pactlens.functions import calendar as cal
from pactlens.functions import scalars as s
from pactlens.operators.dimensions import numbered_top
from pactlens.operators.metrics import CLAIM_ID

MIN_SHARE = 0.02


def _in(period: cal.Period) -> str:
    return f"activity_date BETWEEN {cal.sql_date(period.start)} AND {cal.sql_date(period.end)}"


def _money(value: str, name: str):
    return F.expr(f"cast(sum({value}) AS {s.MONEY_SUM}) AS {name}")


def loss_code_kpis(claims: DataFrame, periods: DataFrame) -> DataFrame:
    """Paid amount, distinct claims and distinct codes per period; empty periods included."""
    hit = claims.join(
        F.broadcast(periods), F.expr("activity_date BETWEEN period_start AND period_end")
    ).selectExpr("period_id", f"{CLAIM_ID} AS claim_id", "loss_code", "paid_amount")
    # claims and codes are counted in turn on ever smaller tables, not on one doubled table
    per_claim_code = hit.groupBy("period_id", "claim_id", "loss_code").agg(
        F.sum("paid_amount").alias("paid")
    )
    codes = (
        per_claim_code.groupBy("period_id", "loss_code")
        .agg(F.sum("paid").alias("paid"))
        .groupBy("period_id")
        .agg(_money("paid", "total_paid"), F.count("*").alias("loss_code_count"))
    )
    counts = (
        per_claim_code.groupBy("period_id", "claim_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("period_id")
        .agg(F.count("*").alias("claim_count"))
    )
    return (
        periods.join(codes, "period_id", "left")
        .join(counts, "period_id", "left")
        .selectExpr(
            "period_id",
            f"coalesce(total_paid, cast(0 AS {s.MONEY_SUM})) AS total_paid",
            "coalesce(claim_count, 0L) AS claim_count",
            "coalesce(loss_code_count, 0L) AS loss_code_count",
            f"{s.ratio('total_paid', 'claim_count')} AS average_paid_per_claim",
        )
    )


def preferred_descriptions(claims: DataFrame) -> DataFrame:
    """Most frequent description of each code, the first in the alphabet among equals."""
    counted = (
        claims.where(F.col("loss_description") != s.NO_LOSS_TEXT)
        .groupBy("loss_code", "loss_description")
        .agg(F.count("*").alias("uses"))
    )
    best = counted.groupBy("loss_code").agg(
        F.expr("min_by(loss_description, struct(-uses, loss_description)) AS description")
    )
    return claims.select("loss_code").distinct().join(best, "loss_code", "left").selectExpr(
        "loss_code", f"coalesce(description, '{s.NO_LOSS_TEXT}') AS description"
    )


def loss_code_rows(claims: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Month, year-to-date and rolling-12 payments per code with share and coverage names."""
    month, ytd, rolling = cal.pick(cfg, "current_month", "ytd", "rolling12")
    recent = claims.where(_in(rolling))
    per_claim = recent.groupBy("loss_code", F.expr(CLAIM_ID).alias("claim_id")).agg(
        F.expr(f"sum(paid_amount) FILTER (WHERE {_in(month)}) AS month_paid"),
        F.expr(f"sum(paid_amount) FILTER (WHERE {_in(ytd)}) AS ytd_paid"),
        F.sum("paid_amount").alias("rolling_paid"),
    )
    rows = per_claim.groupBy("loss_code").agg(
        _money("coalesce(month_paid, 0)", "current_month_paid"),
        _money("coalesce(ytd_paid, 0)", "year_to_date_paid"),
        _money("rolling_paid", "rolling12_paid"),
        F.count("*").alias("rolling12_claim_count"),
    )
    coverages = (
        recent.selectExpr(
            "loss_code", f"{s.or_else('coverage_name', s.quoted(s.NO_COVERAGE_NAME))} AS name"
        )
        .distinct()
        .groupBy("loss_code")
        .agg(F.array_sort(F.collect_list("name")).alias("coverage_names"))
    )
    total = rows.agg(F.sum("rolling12_paid").alias("all_paid"))
    return (
        rows.join(preferred_descriptions(recent), "loss_code")
        .join(coverages, "loss_code")
        .crossJoin(F.broadcast(total))
        .selectExpr(
            "loss_code",
            "description",
            "coverage_names",
            "current_month_paid",
            "year_to_date_paid",
            "rolling12_paid",
            "CASE WHEN all_paid <> 0 THEN cast(rolling12_paid AS double) / cast(all_paid AS double)"
            " END AS rolling12_share",
            "rolling12_claim_count",
            f"{s.ratio('rolling12_paid', 'rolling12_claim_count')} AS rolling12_average",
        )
    )


def visible_rows(rows: DataFrame, least: float = MIN_SHARE) -> DataFrame:
    """Codes with at least two percent of the payments."""
    return rows.where(f"coalesce(rolling12_share, 0D) >= {least}D")


def chart_segments(rows: DataFrame) -> DataFrame:
    """Positive rows with their share of what is shown."""
    shown = rows.where("rolling12_paid > 0")
    total = shown.agg(F.sum("rolling12_paid").alias("shown_paid"))
    return shown.crossJoin(F.broadcast(total)).selectExpr(
        "loss_code", "description", "rolling12_paid",
        f"{s.ratio('rolling12_paid', 'shown_paid')} AS segment_share",
    )


def portfolio_top(rows: DataFrame, limit: int = 5) -> DataFrame:
    """Largest codes with their first two coverages and a class by share."""
    top = numbered_top(rows, ["rolling12_paid DESC", "loss_code ASC"], limit)
    return top.selectExpr(
        "rank",
        "loss_code",
        f"{s.or_else('description', s.quoted('Component Failure'))} AS description",
        f"{s.or_else('''array_join(slice(coverage_names, 1, 2), ', ')''', s.quoted('VSC / GAP'))}"
        " AS coverage_lines",
        "rolling12_paid",
        "rolling12_claim_count",
        "coalesce(rolling12_average, 0D) AS rolling12_average",
        "coalesce(rolling12_share, 0D) AS rolling12_share",
        # fixed values: the labels
        "CASE WHEN rolling12_share > 0.15D THEN 'Primary Enterprise Loss Driver'"
        " ELSE 'Standard Exposure' END AS classification",
    )


def top_makes(claims: DataFrame, period: cal.Period, limit: int = 10) -> DataFrame:
    """Makes by payments with distinct claims and share of all payments of the period."""
    per_claim = (
        claims.where(_in(period))
        .groupBy("vehicle_make", F.expr(CLAIM_ID).alias("claim_id"))
        .agg(F.sum("paid_amount").alias("paid"))
    )
    makes = per_claim.groupBy("vehicle_make").agg(
        _money("paid", "paid_amount"), F.count("*").alias("claim_count")
    )
    total = makes.agg(F.sum("paid_amount").alias("all_paid"))
    rows = (
        makes.crossJoin(F.broadcast(total))
        .where("paid_amount > 0")
        .selectExpr(
            "vehicle_make",
            "paid_amount",
            "claim_count",
            "CASE WHEN all_paid <> 0 THEN cast(paid_amount AS double) / cast(all_paid AS double)"
            " END AS paid_share",
        )
    )
    return numbered_top(rows, ["paid_amount DESC", "vehicle_make ASC"], limit)


def top_codes_per_entity(claims: DataFrame, entity: str, limit: int = 15) -> DataFrame:
    """Largest codes of each entity by payments, with lines, and the first description seen."""
    return top_codes(code_sums(claims, [entity]), entity, limit)


def code_sums(claims: DataFrame, groups: list[str]) -> DataFrame:
    """Lines, payments and the first line's place and description of each code within each group."""
    return claims.groupBy(*groups, "loss_code").agg(
        F.count("*").alias("line_count"),
        _money("paid_amount", "total_paid"),
        F.expr("min(struct(place, source_id, loss_description))").alias("first_line"),
    )


def top_codes(code_sums: DataFrame, entity: str, limit: int = 15) -> DataFrame:
    """The largest of ``code_sums`` of each entity."""
    sums = code_sums.withColumn("description", F.col("first_line.loss_description")).drop("first_line")
    window = W.partitionBy(entity).orderBy(F.desc("total_paid"), F.asc("loss_code"))
    return sums.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= limit)


