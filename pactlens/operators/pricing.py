"""Markup, coverage and claim-cost benchmarks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pactlens.config import ReportConfig
from pactlens.functions import scalars as s
from pactlens.operators.dimensions import numbered_top
from pactlens.operators.ranking import ranked


def claim_benchmark(
    claims: DataFrame,
    keep: Callable[[DataFrame], DataFrame],
    least: int = 5,
    width: float = 1.5,
    slice_rows: int = 4096,
) -> DataFrame:
    """Payment statistics per loss code and make, with the outlier threshold.

    The median is exact and found on value counts, payments of one amount being combined before the
    shuffle. The different amounts of a group are cut into slices by rank; sums of the slices tell
    which one or two hold the middle, and only those are summed up amount by amount. No task holds
    more than a slice of a group, or one sum for each of its slices. ``keep`` writes a table and
    reads it back.
    """
    key = ["loss_code", "vehicle_make"]
    rows = claims.where("loss_code <> '' AND vehicle_make <> ''")
    stats = (
        rows.groupBy(*key)
        .agg(
            F.count("*").alias("line_count"),
            F.expr("cast(sum(paid_amount) AS double) / count(*) AS mean_paid"),
            F.expr("stddev_samp(cast(paid_amount AS double)) AS stdev_paid"),
        )
        .where(F.col("line_count") >= least)
    )
    counted = rows.groupBy(*key, "paid_amount").agg(F.count("*").alias("uses"))
    sliced = ranked(counted, key, [F.asc("paid_amount")], keep).withColumn(
        "_slice", F.expr(f"rank div {slice_rows}")
    )
    earlier = W.partitionBy(*key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    running = W.partitionBy(*key, "_slice").orderBy("paid_amount").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    # the one or two middle positions of a group lie in these slices, and at these values
    at_middle = "{upto} >= (line_count + 1) div 2 AND {upto} - {uses} < line_count div 2 + 1"
    slices = (
        sliced.groupBy(*key, "_slice")
        .agg(F.sum("uses").alias("_uses"))
        .withColumn("_before", F.coalesce(F.sum("_uses").over(earlier), F.lit(0)))
        .join(stats.select(*key, "line_count"), key)
        .where(at_middle.format(upto="(_before + _uses)", uses="_uses"))
        .select(*key, "_slice", "_before", "line_count")
    )
    middle = (
        sliced.join(slices, [*key, "_slice"])
        .withColumn("upto", F.col("_before") + F.sum("uses").over(running))
        .where(at_middle.format(upto="upto", uses="uses"))
        .groupBy(*key)
        .agg(
            F.expr(
                "(cast(min(paid_amount) AS double) + cast(max(paid_amount) AS double)) / 2"
                " AS median_paid"
            )
        )
    )
    return stats.join(middle, key).selectExpr(
        *key, "line_count", "mean_paid", "median_paid", "stdev_paid",
        f"median_paid + {width}D * stdev_paid AS threshold",
    )


def outlier_claims(claims: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Payment lines above the threshold of their loss code and make."""
    return claims.join(
        benchmark.select("loss_code", "vehicle_make", "threshold"), ["loss_code", "vehicle_make"]
    ).where("cast(paid_amount AS double) > threshold")


def priced(raw: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Pricing documents with defaults, numbers, and whether they belong to the market."""
    state = f"upper({s.text('state')})"
    zips = "|".join(cfg.market_zip_prefixes)
    starts = " OR ".join(f"startswith({state}, upper({s.quoted(m)}))" for m in cfg.market_states)
    return raw.selectExpr(
        "ingest_ord",
        f"{s.or_else('contract_no', s.quoted(''))} AS contract_no",
        f"{s.or_else('dealer_name', s.quoted(s.NO_DEALER))} AS dealer_name",
        f"{s.or_else('dealer_number', s.quoted(''))} AS dealer_number",
        f"{s.or_else('dealer_city', s.quoted(''))} AS dealer_city",
        f"{state} AS state",
        f"{s.text('zip')} AS zip",
        f"{s.or_else('coverage_code', s.quoted('Unknown Code'))} AS coverage_code",
        f"{s.or_else('coverage_name', s.quoted(''))} AS coverage_name",
        f"{s.or_else('product_type', s.quoted(''))} AS product_type",
        *[f"{s.lenient_number(c)} AS {c}" for c in ("markup", "retail", "net")],
        f"{state} IN ({s.quoted(*cfg.market_states)})"
        f" OR coalesce({s.text('zip')} RLIKE '^({zips})', false) AS in_market",
        f"startswith({state}, upper({s.quoted(cfg.market_states[0])})) AS in_state",
        f"coalesce({s.text('zip')} RLIKE '^({zips})', false) AS zip_in_market",
        f"{starts} AS state_in_market",
    )


# Highest markup first; of equal ones the first document.
_TOP = "struct(markup, -ingest_ord, contract_no)"
_FIRST = "struct(ingest_ord, contract_no)"


def _markup_stats():
    return [
        F.expr("max(markup) AS max_markup"),
        F.expr("min(markup) AS min_markup"),
        F.expr("cast(sum(markup) AS double) / count(*) AS avg_markup"),
        F.count("*").alias("contract_count"),
    ]


def _labels():
    return [
        F.expr(f"min_by(coverage_name, {_FIRST}) AS coverage_name"),
        F.expr(f"min_by(product_type, {_FIRST}) AS product_type"),
    ]


def coverage_dealers(rows: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The dealers of each coverage, a row each, numbered by name; no task holds a coverage's dealers."""
    pairs = rows.groupBy("coverage_code", "dealer_name").agg(
        F.count("*").alias("contract_count"), F.expr("max(markup) AS max_markup")
    )
    return ranked(pairs, ["coverage_code"], [F.asc("dealer_name")], keep)


def coverage_summary(rows: DataFrame, listed: bool = True) -> DataFrame:
    """Per coverage: range of markups, the contract with the highest, and the dealers offering it.

    Dealers are reduced to one row each first. ``listed`` gathers their names, for display; the table
    without the list is ``coverage_dealers``.
    """
    top = "struct(contract_no, dealer_name, retail, net)"
    per_dealer = rows.groupBy("coverage_code", "dealer_name").agg(
        F.expr("max(markup) AS max_markup"),
        F.expr("min(markup) AS min_markup"),
        F.expr("sum(markup) AS markup"),
        F.count("*").alias("n"),
        F.expr(f"max_by({top}, {_TOP}) AS top"),
        F.expr(f"max({_TOP}) AS top_place"),
        F.expr(f"min_by(struct(coverage_name, product_type), {_FIRST}) AS label"),
        F.expr(f"min({_FIRST}) AS first_place"),
    )
    return (
        per_dealer.groupBy("coverage_code")
        .agg(
            F.expr("min_by(label, first_place) AS label"),
            F.expr("max(max_markup) AS max_markup"),
            F.expr("min(min_markup) AS min_markup"),
            F.expr("cast(sum(markup) AS double) / sum(n) AS avg_markup"),
            F.sum("n").alias("contract_count"),
            F.expr("max_by(top, top_place) AS top"),
            F.count("*").alias("dealer_count"),
            *([F.array_sort(F.collect_list("dealer_name")).alias("dealers")] if listed else []),
        )
        .selectExpr(
            "coverage_code",
            "label.coverage_name AS coverage_name",
            "label.product_type AS product_type",
            "max_markup",
            "top.contract_no AS max_contract",
            "top.dealer_name AS max_dealer",
            "top.retail AS max_retail",
            "top.net AS max_net",
            "min_markup",
            "avg_markup",
            "dealer_count",
            "contract_count",
            *(["dealers"] if listed else []),
        )
    )


def dealer_coverage(rows: DataFrame) -> DataFrame:
    """Markups per dealer and coverage with the contract of the highest."""
    return (
        rows.groupBy("dealer_name", "dealer_number", "coverage_code")
        .agg(
            F.expr(f"min_by(dealer_city, {_FIRST}) AS dealer_city"),
            F.expr(f"min_by(state, {_FIRST}) AS dealer_state"),
            *_labels(),
            *_markup_stats(),
            F.expr(f"max_by(struct(contract_no, retail, net), {_TOP}) AS top"),
        )
        .selectExpr(
            "dealer_name", "dealer_number", "coverage_code", "dealer_city", "dealer_state",
            "coverage_name", "product_type", "max_markup", "top.contract_no AS max_contract",
            "top.retail AS max_retail", "top.net AS max_net", "min_markup", "avg_markup",
            "contract_count",
        )
    )


def state_vs_nation(rows: DataFrame) -> DataFrame:
    """Each coverage in the whole country and in the market: counts and highest markups."""
    top = "struct(contract_no, dealer_name)"
    return (
        rows.groupBy("coverage_code")
        .agg(
            *_labels(),
            F.expr("max(markup) AS nation_max"),
            F.expr(f"max_by({top}, {_TOP}) AS nation_top"),
            F.count("*").alias("nation_contracts"),
            F.expr("count_if(in_market) AS market_contracts"),
            F.expr("max(markup) FILTER (WHERE in_market) AS market_max"),
            F.expr(f"max_by(contract_no, {_TOP}) FILTER (WHERE in_market) AS market_max_contract"),
        )
        .selectExpr(
            "coverage_code", "coverage_name", "product_type",
            "market_contracts > 0 AS sold_in_market", "market_contracts", "market_max",
            "market_max_contract", "nation_contracts", "nation_max",
            "nation_top.contract_no AS nation_max_contract",
            "nation_top.dealer_name AS nation_max_dealer",
        )
    )


def coverage_extremes(rows: DataFrame, limit: int = 5) -> DataFrame:
    """The coverages with the highest markup."""
    summary = coverage_summary(rows, listed=False)
    return numbered_top(summary, ["max_markup DESC", "coverage_code ASC"], limit)


def zip_exceptions(rows: DataFrame) -> DataFrame:
    """Dealers whose zip code is the market's but whose state is none of the market's."""
    zip_says = "zip_in_market AND NOT state_in_market"
    return rows.where(zip_says).groupBy("dealer_name", "state", "zip").agg(
        F.count("*").alias("documents")
    )


def market_coverage(rows: DataFrame) -> DataFrame:
    """Distinct dealers and coverages, in all and in the market by state or zip code."""
    tables = [
        rows.groupBy(F.col(c).alias("value"))
        .agg(F.max(F.expr("state_in_market OR zip_in_market")).alias("in_market"))
        .agg(F.count("*").alias("total"), F.expr("count_if(in_market) AS market"))
        .select(F.lit(label).alias("what"), "total", "market")
        for c, label in (("dealer_name", "dealers"), ("coverage_code", "coverage codes"))
    ]
    return tables[0].unionByName(tables[1])


def markup_presence(rows: DataFrame) -> DataFrame:
    """Documents of the state, those with a markup, and those sold above their net cost."""
    return rows.where("in_state").agg(
        F.count("*").alias("documents"),
        F.expr("count_if(markup <> 0) AS with_markup"),
        F.expr("count_if(retail > net) AS above_net"),
    )


def markup_samples(rows: DataFrame, limit: int = 5) -> DataFrame:
    """First documents of the state sold above their net cost."""
    return (
        rows.where("in_state AND retail > net")
        .orderBy("ingest_ord", "contract_no")
        .limit(limit)
        .selectExpr(
            "dealer_name", "coverage_code", "contract_no", "markup", "retail", "net",
            "cast(retail - net AS decimal(18,4)) AS difference",
        )
    )


def markup_documents(rows: DataFrame, limit: int = 5) -> DataFrame:
    """First documents of the state that carry a markup."""
    return (
        rows.where("in_state AND markup <> 0")
        .orderBy("ingest_ord", "contract_no")
        .limit(limit)
        .select(
            "dealer_name", "dealer_number", "coverage_code", "coverage_name", "contract_no",
            "markup", "retail", "net",
        )
    )


def states(rows: DataFrame) -> DataFrame:
    """Every spelling of a state with its documents, and whether it counts as the market."""
    return rows.groupBy("state", "state_in_market").agg(F.count("*").alias("documents"))


def state_profile(rows: DataFrame) -> DataFrame:
    """Number of documents of the state, their highest markup and margin."""
    return rows.where("in_state").agg(
        F.count("*").alias("documents"),
        F.expr("greatest(max(markup), 0) AS max_markup"),
        F.expr("greatest(max(retail - net), 0) AS max_margin"),
    )
