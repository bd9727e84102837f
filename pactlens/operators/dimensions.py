"""Metrics by dealer, agent and product."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pactlens.functions import scalars as s
from pactlens.operators import dedupe as dd
from pactlens.operators import metrics as m
from pactlens.operators.ranking import ranked

DIMENSIONS = ["dealer", "agent", "product"]


def attribute_claims(claims: DataFrame, lookup: DataFrame, dims: list[str]) -> DataFrame:
    """Each claim line under the dimension values it counts for.

    Products come from the contract first. Otherwise the claim's own value counts unless it is
    a placeholder, in which case the contract's value does. ``is_direct`` marks values that are
    a reason on their own for the value to be listed.
    """
    own = {d: f"coalesce(nullif(found.{d}, ''), {d})" if d == "product" else d for d in dims}
    pairs = ", ".join(
        f"named_struct('dim', '{d}',"
        f" 'dim_value', CASE WHEN {s.is_sentinel(own[d])} THEN found.{d} ELSE {own[d]} END,"
        f" 'is_direct', NOT {s.is_sentinel(own[d])})"
        for d in dims
    )
    return (
        dd.with_lookup(claims, lookup)
        .selectExpr(*claims.columns, f"inline(array({pairs}))")
        .where("dim_value IS NOT NULL")
    )


def dimension_metrics(
    ledger: DataFrame,
    claims: DataFrame,
    lookup: DataFrame,
    periods: DataFrame,
    dims: list[str] = DIMENSIONS,
    sold: DataFrame | None = None,
    partners: DataFrame | None = None,
) -> DataFrame:
    """All measures per dimension value and period, with display name and related entities.

    A value is listed for any transaction in the period, or for a claim of its own. ``sold`` are the
    contract measures and ``partners`` the ``related_pairs``, where they are known already.
    """
    key = ["dim", "dim_value", "period_id"]
    state = m.ledger_state(ledger, dims)
    if sold is None:
        sold = m.contract_measures(state, periods, ["dim", "dim_value"])
    sold = sold.withColumn("is_listed", F.lit(True))
    name = lambda c: (
        f"min(CASE WHEN {c} <> '' THEN struct(place, source_id, {c} AS name) END) AS {c}"
    )
    hit = attribute_claims(claims, lookup, dims).join(
        F.broadcast(periods), F.expr("activity_date BETWEEN period_start AND period_end")
    )
    paid = (
        hit.groupBy(*key, F.expr(m.CLAIM_ID).alias("claim_id"))
        .agg(
            F.sum("paid_amount").alias("paid"),
            F.max("is_direct").alias("is_direct"),
            F.expr(name("dealer_name")),
            F.expr(name("agent_name")),
        )
        .groupBy(*key)
        .agg(
            F.expr(f"cast(sum(paid) AS {s.MONEY_SUM}) AS claims_paid"),
            F.count("*").alias("claim_count"),
            F.max("is_direct").alias("is_direct"),
            F.expr("min(dealer_name).name AS claim_dealer_name"),
            F.expr("min(agent_name).name AS claim_agent_name"),
        )
    )
    listed = m.finalize(
        sold.join(paid, key, "full")
        .where("coalesce(is_listed, false) OR coalesce(is_direct, false)")
        .drop("is_listed", "is_direct")
    )
    return (
        listed.join(_first_names(state), ["dim", "dim_value"], "left")
        .join(_related(related_pairs(state, periods) if partners is None else partners), key, "left")
        .selectExpr(
            *key,
            "CASE dim WHEN 'dealer' THEN coalesce(first_dealer_name, claim_dealer_name)"
            " WHEN 'agent' THEN coalesce(claim_agent_name, first_agent_name, dim_value) END"
            " AS display_name",
            "CASE WHEN dim = 'dealer' THEN coalesce(related, array()) END AS related_agents",
            "CASE WHEN dim = 'agent' THEN coalesce(related, array()) END AS related_dealers",
            *m.MEASURES,
        )
    )


def _first_names(state: DataFrame) -> DataFrame:
    """First name listed for each value over all of its transactions."""
    def first(name: str) -> Column:
        sides = ", ".join(
            f"CASE WHEN own_{x} AND {x}_{name} <> ''"
            f" THEN struct({x}_place AS place, {x}_{name} AS name) END"
            for x in ("w", "k")
        )
        return F.expr(f"min(least({sides})).name AS first_{name}")

    return (
        state.where("dim IN ('dealer', 'agent')")
        .groupBy("dim", "dim_value")
        .agg(first("dealer_name"), first("agent_name"))
    )


def related_pairs(state: DataFrame, periods: DataFrame) -> DataFrame:
    """Agents of a dealer and dealers of an agent, in period: (dim, dim_value, period_id, partner), distinct."""
    sides = ", ".join(
        f"CASE WHEN own_{x} THEN named_struct('day', {x}_activity_date, 'partner',"
        f" CASE WHEN dim = 'dealer' THEN {x}_agent"
        f" ELSE {s.or_else(f'{x}_dealer_name', f'{x}_dealer_number')} END) END"
        for x in ("w", "k")
    )
    return (
        state.where("dim IN ('dealer', 'agent')")
        .selectExpr("dim", "dim_value", f"inline(array_compact(array({sides})))")
        .where(
            f"partner <> '' AND partner <> '{s.NO_AGENT}'"
            f" AND (dim = 'dealer' OR partner <> '{s.NO_DEALER}')"
        )
        .join(F.broadcast(periods), F.expr("day BETWEEN period_start AND period_end"))
        .select("dim", "dim_value", "period_id", "partner")
        .distinct()
    )


def _related(pairs: DataFrame) -> DataFrame:
    """The pairs as sorted lists, for display."""
    return pairs.groupBy("dim", "dim_value", "period_id").agg(
        F.array_sort(F.collect_list("partner")).alias("related")
    )


RANKING = ["net_admin DESC", "net_reserve DESC", "dim_value ASC"]


def ordered(*order: str) -> list[Column]:
    """Sort columns written as in SQL: a name, optionally with ASC or DESC."""
    pairs = [o.split() for o in order]
    return [F.desc(p[0]) if p[-1] == "DESC" else F.asc(p[0]) for p in pairs]


def top_table(dims: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of each dimension and period, ranked.

    The ranking is cut in every task before rows of a group meet.
    """
    window = W.partitionBy("dim", "period_id").orderBy(*ordered(*RANKING))
    return dims.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= limit)


def whole_table(dims: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All rows of each dimension and period, ranked; ``keep`` writes a table and reads it back."""
    return ranked(dims, ["dim", "period_id"], ordered(*RANKING), keep)


def numbered_top(df: DataFrame, order: list[str], limit: int) -> DataFrame:
    """First ``limit`` rows of the whole frame with their rank."""
    top = df.orderBy(*ordered(*order)).limit(limit)
    window = W.partitionBy(F.lit(1)).orderBy(*ordered(*order))
    return top.withColumn("rank", F.row_number().over(window))


def sql_top_dealers(rows: DataFrame, start, end, limit: int = 20) -> DataFrame:
    """Dealers by net reserve straight from the deduplicated rows, blank numbers left out."""
    written = "transaction_type <> 'Cancellation'"
    amounts = []
    for a in ("reserve", "admin"):
        v = f"{a}_amount"
        amounts += [
            f"sum(if({written}, {v}, 0)) AS {a}_written",
            f"sum(if({written}, 0, abs({v}))) AS {a}_cancelled",
            f"sum(if({written}, {v}, -abs({v}))) AS net_{a}",
        ]
    return (
        rows.where(F.col("activity_date").between(F.lit(start), F.lit(end)))
        .where("dealer_number <> ''")
        .groupBy("dealer_number", "dealer_name")
        .agg(*[F.expr(a) for a in amounts])
        .orderBy(F.desc("net_reserve"), "dealer_number", "dealer_name")
        .limit(max(1, limit))
    )


def worst_dealers(dealers: DataFrame, count_net: bool, limit: int = 20) -> DataFrame:
    """Dealers by earned loss ratio among those with earnings, claims and five contracts.

    The dashboard also lets five net contracts qualify (``count_net``), the snapshot does not.
    """
    volume = "contracts_written >= 5 OR active_contracts >= 5"
    if count_net:
        volume += " OR net_contracts >= 5"
    eligible = dealers.where(f"earned_reserve > 0 AND claims_paid > 0 AND ({volume})")
    named = eligible.withColumn("dealer_name", F.coalesce("display_name", "dim_value"))
    return numbered_top(named, ["earned_loss_ratio DESC", "dim_value ASC"], limit)


def sub_dealers(partners: DataFrame, dealers: DataFrame) -> DataFrame:
    """All-time figures of the dealers of each agent; unknown dealers get zeros.

    ``partners`` are the agents' ``related_pairs``, so no list of dealers is ever in one row. Of several dealers known under one name the last in ranking order is meant.
    """
    figures = ["contracts_written", "active_contracts", "claims_paid", "earned_reserve"]
    kept = ", ".join(["display_name", *figures, "earned_loss_ratio"])
    by_name = (
        dealers.selectExpr(
            "explode(array_distinct(array_compact(array(dim_value, display_name)))) AS dealer_name",
            "named_struct('a', -net_admin, 'b', -net_reserve, 'c', dim_value) AS place",
            f"struct({kept}) AS d",
        )
        .groupBy("dealer_name")
        .agg(F.max_by("d", "place").alias("d"))
    )
    return (
        partners.selectExpr("dim_value AS agent", "partner AS dealer_name")
        .join(by_name, "dealer_name", "left")
        .selectExpr(
            "agent",
            "dealer_name",
            "coalesce(d.display_name, dealer_name) AS display_name",
            *[f"coalesce(d.{c}, 0) AS {c}" for c in figures],
            "d.earned_loss_ratio AS earned_loss_ratio",
        )
    )


def product_mix(products: DataFrame) -> DataFrame:
    """Shares of net reserve and of net admin, and claims with their loss ratio, per product."""
    shown = products.where("net_reserve > 0 OR claims_paid > 0 OR net_admin > 0")
    charts = ", ".join(
        f"CASE WHEN {v} > 0 THEN named_struct('chart', '{c}', 'amount', {v},"
        f" 'rate', {rate}) END"
        for c, v, rate in (
            ("reserve", "net_reserve", "cast(NULL AS double)"),
            ("admin", "net_admin", "cast(NULL AS double)"),
            ("claims", "claims_paid", "earned_loss_ratio"),
        )
    )
    rows = shown.selectExpr("dim_value AS product", f"inline(array_compact(array({charts})))")
    totals = rows.groupBy("chart").agg(F.sum("amount").alias("total"))
    return rows.join(totals, "chart").selectExpr(
        "chart",
        "product",
        "amount",
        f"CASE WHEN chart = 'claims' THEN rate ELSE {s.ratio('amount', 'total')} END AS share",
    )


_COUNTS = ["written_contracts", "cancelled_contracts", "net_contracts"]
_SUMS = [
    "written_reserve", "cancelled_reserve", "net_reserve", "earned_reserve", "claims_paid",
    "uw_profit",
]


def product_figures(transactions: DataFrame, claims: DataFrame, groups: list[str]) -> DataFrame:
    """Counts, reserves, earnings and claims per product within each group.

    ``claims`` carry the product they count for in ``claim_product``.
    """
    cancelled = "transaction_type = 'Cancellation'"
    money = lambda v, n: F.expr(f"cast(sum({v}) AS {s.MONEY_SUM}) AS {n}")
    sold = (
        transactions.groupBy(*groups, "product", "contract_number")
        .agg(
            F.expr(f"max(if({cancelled}, 0, 1)) AS w"),
            F.expr(f"max(if({cancelled}, 1, 0)) AS k"),
            F.expr(f"sum(if({cancelled}, 0, reserve_amount)) AS wr"),
            F.expr(f"sum(if({cancelled}, abs(reserve_amount), 0)) AS kr"),
            F.expr(f"sum(if({cancelled}, 0, earned_reserve_amount)) AS er"),
        )
        .groupBy(*groups, "product")
        .agg(
            F.sum("w").alias("written_contracts"),
            F.sum("k").alias("cancelled_contracts"),
            money("wr", "written_reserve"),
            money("kr", "cancelled_reserve"),
            money("er", "earned_reserve"),
        )
    )
    paid = claims.groupBy(*groups, F.col("claim_product").alias("product")).agg(
        money("paid_amount", "claims_paid")
    )
    return joined_figures(sold, paid, groups)


SOLD_PARTS = ["w", "k", "blank_w", "blank_k", "wr", "kr", "er"]


def sold_parts(transactions: DataFrame) -> DataFrame:
    """Transactions with what ``sold_figures`` makes of the sums of ``SOLD_PARTS``.

    A contract number has at most one side of each kind in the ledger, so sides are counted; all
    blank numbers are one contract.
    """
    cancelled, blank = "transaction_type = 'Cancellation'", "contract_number = ''"
    return transactions.selectExpr(
        "*",
        f"cast(if(NOT ({blank}) AND NOT ({cancelled}), 1, 0) AS bigint) AS w",
        f"cast(if(NOT ({blank}) AND {cancelled}, 1, 0) AS bigint) AS k",
        f"cast(if({blank} AND NOT ({cancelled}), 1, 0) AS bigint) AS blank_w",
        f"cast(if({blank} AND {cancelled}, 1, 0) AS bigint) AS blank_k",
        f"cast(if({cancelled}, 0, reserve_amount) AS {s.MONEY_SUM}) AS wr",
        f"cast(if({cancelled}, abs(reserve_amount), 0) AS {s.MONEY_SUM}) AS kr",
        f"cast(if({cancelled}, 0, earned_reserve_amount) AS {s.MONEY_SUM}) AS er",
    )


def sold_figures(sums: DataFrame, groups: list[str]) -> DataFrame:
    return sums.selectExpr(
        *groups,
        "product",
        "w + if(blank_w > 0, 1, 0) AS written_contracts",
        "k + if(blank_k > 0, 1, 0) AS cancelled_contracts",
        "wr AS written_reserve",
        "kr AS cancelled_reserve",
        "er AS earned_reserve",
    )


def joined_figures(sold: DataFrame, paid: DataFrame, groups: list[str]) -> DataFrame:
    """Product figures of what was sold and what was paid."""
    zero = f"cast(0 AS {s.MONEY_SUM})"
    return (
        sold.join(paid, [*groups, "product"], "full")
        .selectExpr(
            *groups,
            "product",
            *[f"coalesce({c}, 0L) AS {c}" for c in _COUNTS[:2]],
            *[
                f"coalesce({c}, {zero}) AS {c}"
                for c in ("written_reserve", "cancelled_reserve", "earned_reserve", "claims_paid")
            ],
        )
        .selectExpr(
            "*",
            "written_contracts - cancelled_contracts AS net_contracts",
            f"cast(written_reserve - cancelled_reserve AS {s.MONEY_SUM}) AS net_reserve",
            f"cast(earned_reserve - claims_paid AS {s.MONEY_SUM}) AS uw_profit",
        )
        .select(*groups, "product", *_COUNTS, *_SUMS)
    )


def product_buckets(figures: DataFrame) -> DataFrame:
    """Rounded percentages and status of the drill-down's product table."""
    earned = f"coalesce({s.ratio('earned_reserve', 'net_reserve')}, 0D)"
    loss = f"coalesce({s.ratio('claims_paid', 'earned_reserve')}, 0D)"
    return figures.selectExpr(
        "*",
        f"round({earned} * 100, 2) AS percent_earned",
        f"round({loss} * 100, 1) AS loss_ratio",
        f"CASE WHEN {loss} * 100 > 100 THEN 'CRITICAL LOSS' WHEN uw_profit < 0"
        " THEN 'LOSS DEFICIT' ELSE 'PROFIT SURPLUS' END AS status",
    )


def claim_products(
    claims: DataFrame, transactions: DataFrame, groups: list[str], skip_cancelled: bool = True
) -> DataFrame:
    """Claims with the product of the contract they belong to, within each group.

    The last listed transaction of the contract decides; without one the claim's own product.
    """
    rows = transactions.where("contract_number <> ''")
    if skip_cancelled:
        rows = rows.where("transaction_type <> 'Cancellation'")
    sold = rows.groupBy(*groups, "contract_number").agg(
        F.max_by("product", "place").alias("own_product")
    )
    own = s.or_else("own_product", "product", "'Standard'")
    return claims.join(sold, [*groups, "contract_number"], "left").selectExpr(
        "*", f"{own} AS claim_product"
    )


def with_total(figures: DataFrame, groups: list[str]) -> DataFrame:
    """Product rows and a total row per group."""
    rolled = figures.groupingSets([[*groups, "product"], [*groups]], *groups, "product").agg(
        F.grouping("product").alias("is_total"),
        *[F.sum(c).alias(c) for c in _COUNTS],
        *[F.expr(f"cast(sum({c}) AS {s.MONEY_SUM}) AS {c}") for c in _SUMS],
    )
    return rolled.selectExpr(
        *groups,
        "if(is_total = 1, 'TOTAL (ALL PRODUCTS)', product) AS product",
        *_COUNTS,
        *_SUMS,
        f"{s.ratio('earned_reserve', 'net_reserve')} AS percent_earned",
        f"{s.ratio('claims_paid', 'earned_reserve')} AS loss_ratio",
    )


def result_status(profit: str, critical: str, good: str) -> str:
    """Label of an underwriting result (SQL text)."""
    return (
        f"CASE WHEN {profit} < -10000 THEN '{critical}' WHEN {profit} < 0 THEN 'LOSS DEFICIT'"
        f" WHEN {profit} = 0 THEN 'BREAK-EVEN' ELSE '{good}' END"
    )


def product_scorecard(figures: DataFrame, groups: list[str]) -> DataFrame:
    """Product lines by underwriting result with claim share, driver flag, status and finding."""
    totals = figures.groupBy(*groups).agg(F.sum("claims_paid").alias("total_claims"))
    joined = figures.join(totals, groups) if groups else figures.crossJoin(totals)
    shown = joined.where("claims_paid > 0 OR written_reserve > 0").selectExpr(
        "*",
        f"{s.ratio('claims_paid', 'earned_reserve')} AS loss_ratio",
        f"coalesce({s.ratio('claims_paid', 'total_claims')}, 0D) AS claim_share",
    )
    tail = f"' (', {s.percent('loss_ratio')}, ' LR)'"
    return shown.selectExpr(
        *groups,
        "product",
        "claims_paid",
        "earned_reserve",
        "uw_profit",
        "loss_ratio",
        "claim_share",
        "written_reserve",
        "net_reserve",
        "uw_profit < 0 OR coalesce(loss_ratio > 1.0D, false) AS is_loss_driver",
        f"{result_status('uw_profit', 'CRITICAL LOSS', 'PROFIT SURPLUS')} AS status",
        f"CASE WHEN uw_profit < 0 THEN concat('Deficit -$', {s.dollars('-uw_profit')}, {tail})"
        f" ELSE concat('Surplus +$', {s.dollars('uw_profit')}, {tail}) END AS finding",
    )


def loss_attribution(scorecard: DataFrame, groups: list[str]) -> DataFrame:
    """Top loss driver, combined deficit and the product lines that offset it."""
    rank = "struct(uw_profit, product)"
    return scorecard.groupBy(*groups).agg(
        F.expr(f"min_by(product, {rank}) FILTER (WHERE uw_profit < 0) AS top_loss_driver"),
        F.expr("min(uw_profit) FILTER (WHERE uw_profit < 0) AS top_deficit"),
        F.expr(f"min_by(loss_ratio, {rank}) FILTER (WHERE uw_profit < 0) AS top_loss_ratio"),
        F.expr(f"cast(sum(least(uw_profit, 0)) AS {s.MONEY_SUM}) AS total_deficit"),
        F.expr(
            f"array_join(transform(array_sort(collect_list({rank}) FILTER (WHERE uw_profit > 0)),"
            f" p -> concat(p.product, ' (+$', {s.dollars('p.uw_profit')}, ')')), ', ')"
            " AS profitable_offsets"
        ),
    )


def entity_drilldown(dims: DataFrame) -> DataFrame:
    """One row per entity with its four horizons side by side and its related entities."""
    measures = f"struct({', '.join(m.MEASURES)})"
    at = lambda p: F.expr(f"any_value({measures}) FILTER (WHERE period_id = '{p}') AS {p}")
    first = lambda c: ", ".join(
        f"any_value({c}) FILTER (WHERE period_id = '{p}')" for p in ("inception", "rolling12")
    )
    related = "coalesce(related_agents, related_dealers)"
    return dims.groupBy("dim", "dim_value").agg(
        F.expr(f"coalesce({first('display_name')}, any_value(dim_value)) AS display_name"),
        F.expr(f"coalesce({first(related)}) AS related"),
        *[at(p) for p in ("current_month", "ytd", "rolling12", "inception")],
    )


def entity_lookup(
    dims: DataFrame, target: str, aliases: tuple[tuple[str, str], ...] = ()
) -> DataFrame:
    """Rolling and all-time rows of a dealer or agent given by code or display name."""
    wanted = target.strip().lower()
    code, name = F.lower("dim_value"), F.lower("display_name")
    hit = (code == wanted) | (name == wanted)
    for alias_code, alias_name in aliases:
        if wanted in (alias_code, alias_name):
            hit = hit | ((F.col("dim") == "agent") & ((code == alias_code) | (name == alias_name)))
    return dims.where("dim <> 'product' AND period_id IN ('rolling12', 'inception')").where(
        F.coalesce(hit, F.lit(False))
    )
