"""Period metrics from the contract ledger and the payment lines.

All periods are computed together. A ledger row already is the whole state of its contract, so
joined with the (at most 32) periods it yields that contract's share of every measure on the
spot; what is left is one partial-then-final aggregation whose shuffle carries a row per task,
group and period. Adding a dimension only widens the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.functions import scalars as s
from pactlens.operators import dedupe as dd

MEASURES = [
    "contracts_written", "active_contracts", "contracts_cancelled", "net_contracts",
    "admin_written", "admin_cancelled", "net_admin",
    "reserve_written", "reserve_cancelled", "net_reserve", "earned_reserve",
    "claims_paid", "claim_count", "claim_frequency", "claim_severity", "underwriting_profit",
    "gross_income_written", "gross_income_cancelled", "gross_income",
    "earned_loss_ratio", "percent_earned", "cancellation_rate", "admin_per_contract",
]

# Key figures of the comparison tables, in display order.
KPIS = [
    "contracts_written", "active_contracts", "contracts_cancelled", "gross_income", "net_admin",
    "admin_per_contract", "net_reserve", "earned_reserve", "claims_paid", "underwriting_profit",
    "earned_loss_ratio", "percent_earned", "cancellation_rate",
]


_SIDE = [
    "snapshot_ts", "transaction_type", "contract_status", "activity_date", "admin_amount",
    "reserve_amount", "gross_income_amount",
]
_EARNING = ["effective_date", "has_schedule", "earning_schedule"]


def ledger_state(ledger: DataFrame, dims: list[str] = (), carry: list[str] = ()) -> DataFrame:
    """Flat state of each contract, once for each dimension value one of its sides carries.

    ``own_w`` and ``own_k`` tell which sides stand under the value. A contract that changed
    dealers between its written and its cancelled state thus stays open for the first dealer.
    Fields are taken out of the sides one by one, so a scan reads no others.
    """
    names = dd.NAMES if dims else []
    flat = ledger.selectExpr(
        *carry,
        "contract_number = '' AS is_blank",
        "w_place",
        "k_place",
        "w.transaction_type IS NOT NULL AS has_w",
        "k.transaction_type IS NOT NULL AS has_k",
        *[f"w.{f} AS w_{f}" for f in [*_SIDE, *_EARNING, *names]],
        *[f"k.{f} AS k_{f}" for f in [*_SIDE, *names]],
    )
    if dims:
        values = ", ".join(
            f"CASE WHEN has_w THEN named_struct('dim', '{d}', 'dim_value', w_{d},"
            f" 'own_w', true, 'own_k', has_k AND k_{d} = w_{d}) END,"
            f" CASE WHEN has_k AND (NOT has_w OR k_{d} <> w_{d}) THEN"
            f" named_struct('dim', '{d}', 'dim_value', k_{d}, 'own_w', false, 'own_k', true) END"
            for d in dims
        )
        owned = [f"inline(array_compact(array({values})))"]
    else:
        owned = ["has_w AS own_w", "has_k AS own_k"]
    return flat.selectExpr("*", *owned).selectExpr(
        "*",
        "own_k AND (NOT own_w OR k_snapshot_ts > w_snapshot_ts"
        " OR (k_snapshot_ts = w_snapshot_ts AND k_place > w_place)) AS late",
    )


def contract_measures(state: DataFrame, periods: DataFrame, groups: list[str]) -> DataFrame:
    """Sums and counts over the contract states of each group and period."""
    return pooled(contract_sums(state, periods, groups))


_TOTALS = [
    "admin_written", "admin_cancelled", "reserve_written", "reserve_cancelled",
    "gross_income_written", "gross_income_cancelled", "net_admin",
]


def contract_sums(state: DataFrame, periods: DataFrame, groups: list[str]) -> DataFrame:
    """What ``pooled`` makes measures of; sums of parts of the contracts can be merged (``merged_sums``)."""
    flat = state.selectExpr(
        *groups,
        "is_blank",
        "w_place",
        "CASE WHEN own_w THEN w_activity_date END AS w_day",
        "CASE WHEN own_k THEN k_activity_date END AS k_day",
        "w_transaction_type <> 'Unknown' AS counts",
        "w_admin_amount AS wa",
        "w_reserve_amount AS wr",
        "w_gross_income_amount AS wg",
        "abs(k_admin_amount) AS ka",
        "abs(k_reserve_amount) AS kr",
        "abs(k_gross_income_amount) AS kg",
        "w_effective_date AS effective",
        "w_has_schedule AS has_schedule",
        "w_earning_schedule AS schedule",
        "NOT is_blank AND own_w AND NOT late AND w_contract_status = 'A' AS is_active",
        "NOT is_blank AND if(late, k_contract_status, w_contract_status) = 'E' AS is_expired",
    )
    hit = flat.join(
        F.broadcast(periods),
        F.expr(
            "w_day BETWEEN period_start AND period_end OR k_day BETWEEN period_start AND period_end"
        ),
    ).selectExpr(
        "*",
        "coalesce(w_day BETWEEN period_start AND period_end, false) AS w_in",
        "coalesce(k_day BETWEEN period_start AND period_end, false) AS k_in",
    )
    zero = f"cast(0 AS {s.MONEY})"
    shares = hit.selectExpr(
        *groups,
        "period_id",
        "is_blank",
        "w_place",
        "w_in AND counts AS is_written",
        "k_in",
        "is_active",
        "coalesce(is_active AND w_in, false) AS counts_active",
        *[f"CASE WHEN w_in AND counts THEN {v} ELSE {zero} END AS {v}" for v in ("wa", "wr", "wg")],
        *[f"CASE WHEN k_in THEN {v} ELSE {zero} END AS {v}" for v in ("ka", "kr", "kg")],
        f"CASE WHEN is_expired THEN cast(1 AS {s.FACTOR}) ELSE"
        f" {dd.schedule_factor('effective', 'has_schedule', 'schedule', 'period_end')} END"
        " AS factor",
    ).selectExpr("*", f"{dd.earned('wr', 'kr', 'factor')} AS earned")
    total = lambda v, name: F.expr(f"cast(sum({v}) AS {s.MONEY_SUM}) AS {name}")
    return shares.groupBy(*groups, "period_id").agg(
        F.expr("count_if(NOT is_blank AND is_written) AS contracts_written"),
        F.expr("count_if(NOT is_blank AND k_in) AS contracts_cancelled"),
        F.expr("max(if(is_blank AND is_written, 1, 0)) AS any_blank_written"),
        F.expr("max(if(is_blank AND k_in, 1, 0)) AS any_blank_cancelled"),
        F.expr("count_if(counts_active) AS active_contracts"),
        total("wa", "admin_written"),
        total("ka", "admin_cancelled"),
        total("wr", "reserve_written"),
        total("kr", "reserve_cancelled"),
        total("wg", "gross_income_written"),
        total("kg", "gross_income_cancelled"),
        total("CASE WHEN is_active THEN wa - ka ELSE 0 END", "net_admin"),
        F.expr("sum(CASE WHEN NOT is_blank THEN earned END) AS earned"),
        F.expr("sum(CASE WHEN is_blank THEN wr END) AS blank_written"),
        F.expr("sum(CASE WHEN is_blank THEN kr END) AS blank_cancelled"),
        F.expr("max(struct(w_place, factor)) FILTER (WHERE is_blank AND is_written) AS blank_last"),
    )


def merged_sums(parts: DataFrame, groups: list[str]) -> DataFrame:
    """The sums of several parts of the contracts as those of all of them."""
    return parts.groupBy(*groups, "period_id").agg(
        *[F.sum(c).alias(c) for c in ("contracts_written", "contracts_cancelled", "active_contracts")],
        *[F.expr(f"cast(sum({c}) AS {s.MONEY_SUM}) AS {c}") for c in _TOTALS],
        *[F.sum(c).alias(c) for c in ("earned", "blank_written", "blank_cancelled")],
        *[F.max(c).alias(c) for c in ("any_blank_written", "any_blank_cancelled", "blank_last")],
    )


def pooled(sums: DataFrame) -> DataFrame:
    """Measures of the sums.

    All contracts with a blank number count as one contract per group: their amounts are pooled
    before the earning rule is applied, and they have no latest state.
    """
    rest = dd.earned("blank_written", "coalesce(blank_cancelled, 0)", "blank_last.factor")
    counts = ("contracts_written", "any_blank_written"), ("contracts_cancelled", "any_blank_cancelled")
    return sums.withColumns(
        {
            **{n: F.expr(f"{n} + {blank}") for n, blank in counts},
            "earned_reserve": F.expr(
                f"cast(round(coalesce(earned, 0) + coalesce({rest}, 0), 4) AS {s.MONEY_SUM})"
            ),
        }
    ).drop("earned", "blank_written", "blank_cancelled", "blank_last", "any_blank_written", "any_blank_cancelled")


CLAIM_ID = s.or_else("claim_number", "source_id")


def claim_measures(claims: DataFrame, periods: DataFrame, groups: list[str]) -> DataFrame:
    hit = claims.join(
        F.broadcast(periods), F.expr("activity_date BETWEEN period_start AND period_end")
    )
    # one row per claim first: repeated lines of a claim are combined before the count
    per_claim = hit.groupBy(*groups, "period_id", F.expr(CLAIM_ID).alias("claim_id")).agg(
        F.sum("paid_amount").alias("paid")
    )
    return per_claim.groupBy(*groups, "period_id").agg(
        F.expr(f"cast(sum(paid) AS {s.MONEY_SUM}) AS claims_paid"),
        F.count("*").alias("claim_count"),
    )


_COUNTED = ["contracts_written", "contracts_cancelled", "active_contracts", "claim_count"]
_SUMMED = [
    "admin_written", "admin_cancelled", "reserve_written", "reserve_cancelled",
    "gross_income_written", "gross_income_cancelled", "net_admin", "earned_reserve", "claims_paid",
]


def finalize(df: DataFrame) -> DataFrame:
    """Differences and guarded ratios of the summed measures; missing sums count as zero."""
    kept = [c for c in df.columns if c not in _COUNTED + _SUMMED]
    filled = df.selectExpr(
        *kept,
        *[f"coalesce(cast({c} AS bigint), 0) AS {c}" for c in _COUNTED],
        *[f"coalesce(cast({c} AS {s.MONEY_SUM}), cast(0 AS {s.MONEY_SUM})) AS {c}" for c in _SUMMED],
    )
    minus = lambda a, b, name: f"cast({a} - {b} AS {s.MONEY_SUM}) AS {name}"
    netted = filled.selectExpr(
        "*",
        "contracts_written - contracts_cancelled AS net_contracts",
        minus("reserve_written", "reserve_cancelled", "net_reserve"),
        minus("gross_income_written", "gross_income_cancelled", "gross_income"),
        minus("earned_reserve", "claims_paid", "underwriting_profit"),
    )
    ratios = {
        "earned_loss_ratio": ("claims_paid", "earned_reserve"),
        "percent_earned": ("earned_reserve", "net_reserve"),
        "cancellation_rate": ("contracts_cancelled", "contracts_written"),
        "claim_frequency": ("claim_count", "contracts_written"),
        "claim_severity": ("claims_paid", "claim_count"),
        "admin_per_contract": ("net_admin", "active_contracts"),
    }
    return netted.selectExpr(
        *kept,
        *[f"{s.ratio(*ratios[c])} AS {c}" if c in ratios else c for c in MEASURES],
    )


def period_metrics(
    ledger: DataFrame | None, claims: DataFrame, periods: DataFrame, sold: DataFrame | None = None
) -> DataFrame:
    """All 23 measures of every period, empty periods included. ``sold`` are the contract measures, where
    they are known already."""
    if sold is None:
        sold = contract_measures(ledger_state(ledger), periods, [])
    return finalize(
        periods.join(sold, "period_id", "left").join(
            claim_measures(claims, periods, []), "period_id", "left"
        )
    )


def _kpi_rows(df: DataFrame, keep: list[str]) -> DataFrame:
    """A row per key figure; missing ratios read as zero in these tables."""
    wide = df.selectExpr(*keep, *[f"coalesce(cast({k} AS double), 0D) AS {k}" for k in KPIS])
    return wide.unpivot(keep, KPIS, "kpi", "value")


def period_comparison(metrics: DataFrame, low_admin: float = 20.0) -> DataFrame:
    """Current against prior-year value of each key figure."""
    rows = _kpi_rows(metrics, ["period_id", "horizon"]).where(
        "horizon IN ('current_month', 'ytd', 'rolling12')"
    )
    pairs = rows.groupBy("horizon", "kpi").agg(
        F.expr("max(value) FILTER (WHERE NOT startswith(period_id, 'prior_')) AS current_value"),
        F.expr("max(value) FILTER (WHERE startswith(period_id, 'prior_')) AS prior_value"),
    )
    change = s.variance("current_value", "prior_value")
    return pairs.selectExpr(
        "horizon",
        "kpi",
        "current_value",
        "prior_value",
        "current_value - prior_value AS change",
        f"{change} AS change_pct",
    ).selectExpr(
        "*",
        f"{s.change_is_good('kpi', 'change_pct')} AS change_is_good",
        f"kpi = 'admin_per_contract' AND {s.low_admin_flag('current_value', low_admin)}"
        " AS low_admin_flag",
    )


def period_snapshot(metrics: DataFrame, low_admin: float = 20.0) -> DataFrame:
    """Key figures of the prior calendar year and of all time."""
    rows = _kpi_rows(metrics.where("period_id IN ('prior_year', 'inception')"), ["period_id"])
    return rows.selectExpr(
        "*",
        f"kpi = 'admin_per_contract' AND {s.low_admin_flag('value', low_admin)} AS low_admin_flag",
    )


# Figures of the trend matrix.
TREND_KPIS = [
    "net_reserve", "earned_reserve", "claims_paid", "earned_loss_ratio", "percent_earned",
    "net_admin",
]


def trend_matrix(metrics: DataFrame, month_ids: list[str]) -> DataFrame:
    """A row per figure, a column per month (newest first) and one for all time."""
    ids = sorted(month_ids, reverse=True)[:12] + ["inception"]
    wide = metrics.where(F.col("period_id").isin(ids)).selectExpr(
        "period_id", *[f"coalesce(cast({k} AS double), 0D) AS {k}" for k in TREND_KPIS]
    )
    rows = wide.unpivot(["period_id"], TREND_KPIS, "kpi", "value")
    return rows.groupBy("kpi").pivot("period_id", ids).agg(F.max("value"))


# Horizons of the scorecard with their labels.
SCORECARD = {
    "current_month": "Current Month",
    "ytd": "Year to Date",
    "rolling12": "Rolling 12-Month",
    "prior_year": "Prior Calendar Year",
    "inception": "Inception to Date",
}


def horizon_scorecard(metrics: DataFrame, warning: float, high: float) -> DataFrame:
    labels = ", ".join(f"'{k}', '{v}'" for k, v in SCORECARD.items())
    return (
        metrics.where(F.col("period_id").isin(list(SCORECARD)))
        .selectExpr(
            f"map({labels})[period_id] AS name",
            "contracts_written",
            "net_reserve",
            "earned_reserve",
            "claims_paid",
            "coalesce(earned_loss_ratio, 0D) AS loss_ratio",
            "percent_earned",
        )
        .selectExpr(
            "*",
            f"CASE WHEN loss_ratio <= {warning}D THEN 'Profitable (<65%)'"
            f" WHEN loss_ratio <= {high}D THEN 'Warning Zone (65-80%)'"
            " ELSE 'Adverse (>80%)' END AS status",
        )
    )


def sql_service_metrics(rows: DataFrame, claims: DataFrame, periods: DataFrame) -> DataFrame:
    """The other definition of the same measures.

    Every type but cancellation counts as written, active contracts are the newest raw rows,
    net admin is the admin of active rows, and the earned reserve is the net reserve.
    """
    inside = F.expr("activity_date BETWEEN period_start AND period_end")
    narrow = rows.where("feed < 2").select(
        "feed", "ingest_ord", "snapshot_ts", "contract_number", "contract_status",
        "transaction_type", "activity_date", "admin_amount", "reserve_amount",
        "gross_income_amount",
    )
    written = "transaction_type <> 'Cancellation'"
    sums = []
    for a in ("admin", "reserve", "gross_income"):
        for side, keep, value in (
            ("written", written, f"{a}_amount"),
            ("cancelled", f"NOT ({written})", f"abs({a}_amount)"),
        ):
            sums.append((f"{a}_{side}", f"sum(CASE WHEN {keep} THEN {value} END)"))
    # a contract has several rows in a period only under different types: one row each first
    per_contract = (
        dd.sql_service_contracts(narrow)
        .join(F.broadcast(periods), inside)
        .groupBy("period_id", "contract_number")
        .agg(
            F.expr(f"max(if({written}, 1, 0)) AS w"),
            F.expr(f"max(if({written}, 0, 1)) AS c"),
            *[F.expr(f"{e} AS {name}") for name, e in sums],
        )
    )
    totals = per_contract.groupBy("period_id").agg(
        F.sum("w").alias("contracts_written"),
        F.sum("c").alias("contracts_cancelled"),
        *[F.expr(f"cast(sum({name}) AS {s.MONEY_SUM}) AS {name}") for name, _ in sums],
    )
    newest = dd.latest_by(
        narrow.where("contract_number <> ''"),
        ["contract_number"],
        ["snapshot_ts", "feed", "ingest_ord"],
    )
    active = (
        newest.where(f"contract_status = 'A' AND {written}")
        .join(F.broadcast(periods), inside)
        .groupBy("period_id")
        .agg(
            F.count("*").alias("active_contracts"),
            F.expr(f"cast(sum(admin_amount) AS {s.MONEY_SUM}) AS net_admin"),
        )
    )
    paid = claim_measures(dd.sql_service_claims(claims), periods, [])
    return finalize(
        periods.join(totals, "period_id", "left")
        .join(active, "period_id", "left")
        .join(paid, "period_id", "left")
        .withColumn("earned_reserve", F.expr("reserve_written - reserve_cancelled"))
    )


