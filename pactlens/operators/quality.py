"""Data quality and reconciliation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.config import ReportConfig
from pactlens.functions import calendar as cal
from pactlens.functions import components as comp
from pactlens.functions import scalars as s
from pactlens.operators.dimensions import ordered

AGENT_LABEL = (
    "CASE WHEN agent_name <> '' THEN concat(agent_name, ' (', "
    + s.or_else("agent", "'N/A'")
    + f", ')') ELSE {s.or_else('agent', s.quoted(s.NO_AGENT))} END"
)



def _severities():
    return [
        F.expr("count_if(severity = 'Error') AS errors"),
        F.expr("count_if(severity = 'Warning') AS warnings"),
        F.expr("count_if(severity IN ('Error', 'Warning')) AS total"),
    ]


def issues_by_category(issues: DataFrame) -> DataFrame:
    key = s.or_else("category", "'Uncategorized'")
    return issues.groupBy(F.expr(key).alias("category")).agg(*_severities())


def issues_by_agent(issues: DataFrame, limit: int = 15) -> DataFrame:
    return (
        issues.groupBy(F.expr(AGENT_LABEL).alias("agent_label"))
        .agg(*_severities())
        .orderBy(*ordered("total DESC", "agent_label ASC"))
        .limit(limit)
    )


def issue_log(issues: DataFrame) -> DataFrame:
    return issues.selectExpr(
        "severity", "category", "contract_number", f"{AGENT_LABEL} AS agent_label", "dealer_name",
        "source_id", "message",
    )


def source_counts(
    contracts: DataFrame, claims_raw: DataFrame, transactions: DataFrame, claims: DataFrame,
    issues: DataFrame,
) -> DataFrame:
    """Documents per feed, unique rows after dedupe, and issues."""
    feeds = contracts.groupBy().agg(
        F.expr("count_if(feed = 0) AS c"), F.expr("count_if(feed = 1) AS x")
    ).selectExpr(
        "inline(array(named_struct('stage', 'Contract source documents', 'documents', c),"
        " named_struct('stage', 'Cancellation source documents', 'documents', x)))"
    )
    rows = feeds
    for label, df in (
        ("Claim source documents", claims_raw),
        ("Unique normalized contract transactions", transactions),
        ("Unique paid claim transactions", claims),
        ("Data-quality issues", issues),
    ):
        rows = rows.unionByName(
            df.agg(F.count("*").alias("documents")).select(F.lit(label).alias("stage"), "documents")
        )
    return rows


def audit_reconciliation(audits: DataFrame) -> DataFrame:
    """Audits with status; small differences pass if everything processed was uploaded."""
    units = "coalesce(unique_count, uploaded_count)"
    tolerance = f"greatest(2, {s.half_up('portal_count * 0.001D')})"
    return audits.selectExpr(
        "*", f"{units} AS unique_units", f"{units} - portal_count AS unit_variance"
    ).selectExpr(
        "job_type",
        "portal_count",
        "unique_units",
        "uploaded_count",
        "unit_variance",
        "file_name",
        f"CASE WHEN (is_match AND status = 'PASSED') OR (abs(unit_variance) <= {tolerance}"
        " AND processed_count = uploaded_count) THEN 'PASSED' ELSE status END AS status",
    )


def volumetric_integrity(contract_rows: DataFrame, claim_rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Ingested rows per job type against what the audits say was uploaded."""
    cancelled = "transaction_type = 'Cancellation'"
    counts = contract_rows.where("feed < 2").agg(
        F.expr(f"count_if(NOT ({cancelled})) AS written"),
        F.expr(f"count_if({cancelled}) AS cancelled"),
    ).selectExpr(
        "inline(array(named_struct('job_type', 'Contract', 'ingested', written),"
        " named_struct('job_type', 'Cancel', 'ingested', cancelled)))"
    )
    counts = counts.unionByName(
        claim_rows.agg(F.count("*").alias("ingested")).select(F.lit("Claim").alias("job_type"), "ingested")
    )
    return (
        audits.join(counts, "job_type", "left")
        .selectExpr(
            "job_type",
            "portal_count",
            "uploaded_count",
            "coalesce(ingested, 0L) AS ingested",
            "coalesce(ingested, 0L) - uploaded_count AS variance",
            "status = 'PASSED' OR is_match AS audit_passed",
        )
        .selectExpr(
            "job_type", "portal_count", "uploaded_count", "ingested", "variance",
            "if(variance = 0 AND audit_passed, 'PASSED', 'DISCREPANCY') AS status",
        )
    )


def is_clean(integrity: DataFrame) -> DataFrame:
    return integrity.agg(F.expr("coalesce(bool_and(status = 'PASSED'), true) AS is_clean"))


def dealer_profile(raw: DataFrame, dealer_number: str) -> DataFrame:
    """Documents of one dealer by contract status and by activation month."""
    month = (
        f"coalesce(date_format({s.lenient_date('activation')}, 'yyyy-MM'),"
        f" substr({s.or_else('activation', s.quoted('Unknown'))}, 1, 7))"
    )
    status = s.or_else("status_text", "'Unknown'")
    return (
        raw.where(F.col("dealer_number_text") == dealer_number)
        .selectExpr(
            f"inline(array(named_struct('profile', 'status', 'value', {status}),"
            f" named_struct('profile', 'month', 'value', {month})))"
        )
        .groupBy("profile", "value")
        .agg(F.count("*").alias("documents"))
    )


def contract_dealers(raw: DataFrame) -> DataFrame:
    """Documents of each contract number under each dealer."""
    number = s.business_id("contract_no")
    return (
        raw.where(f"{number} <> ''")
        .groupBy(F.expr(number).alias("contract_number"), "dealer_number_text")
        .agg(F.count("*").alias("documents"))
    )


def multi_dealer_members(raw: DataFrame) -> DataFrame:
    """The dealers of contract numbers seen under more than one, a row each."""
    pairs = contract_dealers(raw).where("dealer_number_text IS NOT NULL")
    several = pairs.groupBy("contract_number").agg(F.count("*").alias("dealers")).where("dealers > 1")
    return pairs.join(several, "contract_number").select(
        "contract_number", F.col("dealer_number_text").alias("dealer_number"), "documents", "dealers"
    )


def multi_dealer_contracts(raw: DataFrame) -> DataFrame:
    """Contract numbers seen under more than one dealer, with documents and dealers.

    The list is for display; ``multi_dealer_members`` is the table without it.
    """
    return (
        contract_dealers(raw)
        .groupBy("contract_number")
        .agg(
            F.sum("documents").alias("documents"),
            F.count("dealer_number_text").alias("dealers"),
            F.array_sort(F.collect_list("dealer_number_text")).alias("dealer_list"),
        )
        .where("dealers > 1")
    )


# The cells the admin reconciliation adds up.
ADMIN_CELLS = [
    ("ADMIN", "ADMIN"),
    ("ADMIN", "BASEADMINMS"),
    ("ADMIN", "BASEADMINOS"),
    ("ADMIN", "MARKETINGFEE"),
    ("RESERVE", "ADMIN"),
]


def _cell(container: str, category: str, component: str) -> str:
    value = f"try_element_at(try_element_at({container}, '{category}'), '{component}')"
    return s.lenient_number(value)


def admin_reconciliation(
    raw: DataFrame, dealer_number: str, cutoff: date, cells: list[tuple[str, str]] = ADMIN_CELLS
) -> DataFrame:
    """Admin amounts of one dealer's raw documents by the reason a row would be left out."""
    amount = lambda side: " + ".join(_cell(side, c, n) for c, n in cells)
    reason = (
        "CASE WHEN feed = 1 THEN 'CANCELLED' WHEN status_text = 'V' THEN 'VOID'"
        " WHEN coalesce(activation, '') = '' THEN 'MISSING_DATE'"
        f" WHEN {s.lenient_date('activation')} > {cal.sql_date(cutoff)} THEN 'FUTURE'"
        " ELSE 'COUNTED' END"
    )
    signed = f"CASE WHEN feed = 1 THEN -({amount('cancelled')}) ELSE {amount('written')} END"
    return (
        raw.where(F.col("dealer_number_text") == dealer_number)
        .groupBy(F.expr(reason).alias("reason"))
        .agg(
            F.count("*").alias("documents"),
            F.expr(f"cast(sum({signed}) AS {s.MONEY_SUM}) AS admin"),
        )
    )


def dropped_reserve_reconciliation(raw: DataFrame, export: DataFrame, dealer_name: str) -> DataFrame:
    """Base reserve of an exported file against what raw documents of the dealer leave out.

    A void document without a date is left out for both reasons and counts twice, as in the
    report.
    """
    exported = export.where(
        (F.col("DealerName") == dealer_name) | (F.coalesce("DealerName", F.lit("")) == "")
    ).agg(
        F.expr(
            f"cast(coalesce(sum({s.lenient_number('`WrittenAmount.RESERVE.BASERESERVE`')}), 0)"
            f" AS {s.MONEY_SUM}) AS exported"
        )
    )
    cell = _cell("written", "RESERVE", "BASERESERVE")
    dropped = (
        raw.where(F.col("dealer_name_text") == dealer_name)
        .where("feed = 0")
        .agg(
            F.expr(
                f"cast(coalesce(sum(CASE WHEN coalesce(activation, '') = '' THEN {cell} END), 0)"
                f" AS {s.MONEY_SUM}) AS missing_date"
            ),
            F.expr(
                f"cast(coalesce(sum(CASE WHEN status_text = 'V' THEN {cell} END), 0)"
                f" AS {s.MONEY_SUM}) AS voided"
            ),
        )
    )
    return exported.crossJoin(dropped).selectExpr(
        "exported",
        "missing_date",
        "voided",
        f"cast(missing_date + voided AS {s.MONEY_SUM}) AS excluded",
    )


# What the raw reserve check leaves out.
RAW_RESERVE_NAMES = ["CLIPFEE", "PREMIUMTAX", "CEDINGFEE", "ADMIN"]
RAW_RESERVE_PARTS = ["PREMIUM TAX", "CEEDING", "CEDING", "CLIP FEE"]


def raw_net_reserve(raw: DataFrame, dealer_number: str, before: date) -> DataFrame:
    """Net reserve of one dealer from its raw documents dated before a day."""
    out = comp.named("f.key", RAW_RESERVE_NAMES, comp.COMMON_PARTS + RAW_RESERVE_PARTS)
    amount = lambda side: comp.total(
        f"filter(map_entries(try_element_at({side}, 'RESERVE')), f -> NOT {out})",
        s.lenient_number("e.value"),
    )
    day = cal.sql_date(before)
    return (
        raw.where(F.col("dealer_number_text") == dealer_number)
        .agg(
            F.expr(
                f"cast(coalesce(sum(CASE WHEN feed = 0 AND {s.lenient_date('activation')} < {day}"
                f" THEN {amount('written')} END), 0) AS {s.MONEY_SUM}) AS written"
            ),
            F.expr(
                f"cast(coalesce(sum(CASE WHEN feed = 1 AND {s.lenient_date('cancel_bill')} < {day}"
                f" THEN {amount('cancelled')} END), 0) AS {s.MONEY_SUM}) AS cancelled"
            ),
        )
        .selectExpr(
            "written", "cancelled", f"cast(written - cancelled AS {s.MONEY_SUM}) AS net_reserve"
        )
    )


def unread_dates(contracts: DataFrame, claims: DataFrame) -> DataFrame:
    """Date texts that are not empty and still gave no date, per field (of evaluated documents)."""
    def unread(df: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
        rows = ", ".join(
            f"CASE WHEN {s.text(t)} <> '' AND {d} IS NULL THEN '{t}' END" for t, d in fields
        )
        rows += (
            f", CASE WHEN exists(extraction, t -> {s.text('t')} <> '' AND {s.lenient_timestamp('t')} IS NULL)"
            " THEN 'extraction' END"
        )
        return df.selectExpr(f"explode(array_compact(array({rows}))) AS field")

    rows = unread(
        contracts,
        [
            ("activation", "activation_date"), ("cancel_bill", "cancel_date"),
            ("effective", "stated_effective_date"),
        ],
    ).unionByName(
        unread(claims, [("date_paid", "paid_date"), ("date_reported", "reported_date")])
    )
    return rows.groupBy("field").agg(F.count("*").alias("documents"))
