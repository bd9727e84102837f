"""Named queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.functions import calendar as cal
from pactlens.functions import components as comp
from pactlens.functions import scalars as s
from pactlens.operators import components as ct
from pactlens.operators import dedupe as dd
from pactlens.operators import dimensions as dm
from pactlens.operators import intel as it
from pactlens.operators import losscodes as lc
from pactlens.operators import metrics as m
from pactlens.operators import pricing as pr
from pactlens.operators import quality as q
from pactlens.plans.present import present
from pactlens.plans.report import Report
from pactlens.session import configure, scratch_path
from pactlens.sources import mapping as mp
from pactlens.sources import documents, readers, writers
from pactlens.sources.schemas import PII_FIELDS
from pactlens.streaming.state import StoredState

CFG = mp.CONFIG
DEALER = "D7"
AGENT = "NATION_3"
TOP_CODES = 15  # loss codes shown per dealer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def report(spark: SparkSession, sf_dir: str) -> Report:
    """The report over one data directory, set up once for a session and forgotten with it."""
    configure(spark)
    reports = spark.__dict__.setdefault("_pactlens_reports", {})
    if sf_dir not in reports:
        reports[sf_dir] = Report(
            spark,
            CFG,
            mp.contract_documents(spark, sf_dir),
            mp.claim_documents(spark, sf_dir),
            mp.audit_documents(spark, sf_dir),
        )
    return reports[sf_dir]


def on_report(fn: Callable[[Report], DataFrame]):
    """Register a query on the report's tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(report(spark, sf_dir)))

    QUERIES[fn.__name__] = run
    return fn


def on_tables(fn: Callable[[SparkSession, str], DataFrame]):
    """Register a query on the driver's tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(configure(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


# ---- sources and sinks


@on_tables
def contract_scan_pruned(spark, sf_dir):
    """Contracts activated from a day on, customer fields dropped at the scan."""
    holders = mp.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name AS CustomerFirstName", "c_name AS `Customer Email`",
        "c_mktsegment AS segment",
    )
    orders = mp.table(spark, sf_dir, "orders").where("o_orderdate >= timestamp'2000-01-01'")
    joined = orders.join(holders, F.expr("o_custkey = c_custkey"))
    kept = readers.drop_pii(joined)
    assert not set(kept.columns) & set(PII_FIELDS)
    return kept.select("o_orderkey", "o_orderstatus", "segment", "o_orderdate")


@on_report
def latest_audit(r):
    return readers.latest_audits(r.audits).drop("summary", "execution_date_text")


@on_report
def audit_table(r):
    return writers.flatten_audits(readers.latest_audits(r.audits)).drop("execution_date_text")


@on_report
def audit_reconciliation(r):
    return q.audit_reconciliation(readers.latest_audits(r.audits))


@on_report
def volumetric_integrity(r):
    return q.volumetric_integrity(r.contract_rows, r.claim_rows, readers.latest_audits(r.audits))


@on_report
def volumetric_clean(r):
    return q.is_clean(
        q.volumetric_integrity(r.contract_rows, r.claim_rows, readers.latest_audits(r.audits))
    )


@on_report
def source_counts(r):
    return r.source_counts


@on_report
def parquet_round_trip(r):
    """Deduplicated contracts and claims exported with all columns, and the rows that came back changed."""
    folder = scratch_path(r.spark, "export")
    writers.export_parquet(r.transactions, r.claims, folder)
    contracts = r.spark.read.parquet(f"{folder}/contracts")
    claims = r.spark.read.parquet(f"{folder}/claims")
    lost = _lost(r.transactions, contracts).unionByName(_lost(r.claims, claims)).agg(F.sum("lost").alias("lost"))
    found = contracts.groupBy(F.lit("contracts").alias("name"), F.year("activity_date").alias("y")).agg(
        F.count("*").alias("n"), F.sum("reserve_amount").alias("amount")
    ).unionByName(
        claims.groupBy(F.lit("claims").alias("name"), F.year("activity_date").alias("y")).agg(
            F.count("*").alias("n"), F.sum("paid_amount").alias("amount")
        )
    )
    return found.crossJoin(F.broadcast(lost))


def _lost(before: DataFrame, back: DataFrame) -> DataFrame:
    """How many rows did not come back as they were, in any column."""
    counted = _row_keys(before, before.columns).selectExpr("row", "1L AS n").unionByName(
        _row_keys(back, before.columns).selectExpr("row", "-1L AS n")
    )
    rest = counted.groupBy("row").agg(F.sum("n").alias("n"))
    return rest.agg(F.expr("coalesce(sum(greatest(n, 0L)), 0L) AS lost"))


def _row_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """32 bytes that tell each row from all others: the rows themselves are too wide to be shuffled whole."""
    # maps cannot be compared as they are
    return df.select(F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256)).alias("row"))


@on_report
def snapshot_upsert(r):
    """Writes the same as-of date twice and another once, with all measures; the first writing must be gone."""
    path = scratch_path(r.spark, "snapshots")
    rows = r.metrics.where("horizon <> 'month'").drop("horizon")
    writers.upsert_snapshot(rows.withColumn("claims_paid", F.lit(0).cast(s.MONEY_SUM)), path, date(2001, 6, 30))
    writers.upsert_snapshot(rows.where("period_id = 'ytd'"), path, date(2001, 5, 31))
    writers.upsert_snapshot(rows, path, date(2001, 6, 30))
    return r.spark.read.parquet(path)


@on_report
def entity_snapshot_upsert(r):
    """The stored drill-down of every dealer and agent: all measures of its four horizons."""
    path = scratch_path(r.spark, "entities")
    wide = dm.entity_drilldown(r.dimensions.where("dim <> 'product'"))
    writers.upsert_snapshot(wide, path, date(2001, 6, 30))
    horizons = ", ".join(f"'{p}', {p}" for p in cal.DIMENSION_HORIZONS)
    return (
        r.spark.read.parquet(path)
        .selectExpr("as_of", "dim", "dim_value", f"explode(map({horizons})) AS (period_id, figures)")
        .where("figures IS NOT NULL")
        .select("as_of", "dim", "dim_value", "period_id", "figures.*")
    )


@on_report
def entity_snapshot_parts(r):
    """The drill-down of every dealer and agent as one dated table per part."""
    folder = scratch_path(r.spark, "entity-parts")
    parts = {
        "horizons": dm.entity_drilldown(r.dimensions.where("dim <> 'product'")),
        "loss_codes": top_loss_codes_per_dealer(r).withColumn("dim", F.lit("dealer")),
        "products": product_buckets(r),
        "components": component_buckets(r),
        "sub_dealers": sub_dealers(r).withColumn("dim", F.lit("agent")),
    }
    amounts = {
        "horizons": "inception.net_reserve", "loss_codes": "total_paid", "products": "net_reserve",
        "components": "net", "sub_dealers": "claims_paid",
    }
    return _stored_parts(r, folder, parts, amounts, "dim")


def _stored_parts(r: Report, folder: str, parts: dict[str, DataFrame], amounts: dict[str, str], *groups: str) -> DataFrame:
    """Each part written as a dated table; what stands there, counted and summed."""
    counted = []
    for name, rows in parts.items():
        writers.upsert_snapshot(rows, f"{folder}/{name}", date(2001, 6, 30))
        back = r.spark.read.parquet(f"{folder}/{name}")
        counted.append(
            back.groupBy(F.lit(name).alias("part"), "as_of", *groups).agg(
                F.count("*").alias("n"), F.expr(f"cast(sum({amounts[name]}) AS double)").alias("amount")
            )
        )
    return reduce(DataFrame.unionByName, counted)


@on_report
def portfolio_snapshot_parts(r):
    """The portfolio's stored snapshot as one dated table per part, all columns of each."""
    parts = {
        "horizons": r.metrics.where("horizon <> 'month'"),
        "months": r.metrics.where("horizon = 'month'"),
        "worst_dealers": worst_dealers_snapshot(r),
        "dealers": dealer_metrics(r),
        "agents": agent_metrics(r),
        "products": product_metrics(r),
        "loss_codes": loss_code_rows(r),
        "makes": top_makes(r),
        "source_counts": source_counts(r),
    }
    return _stored_parts(r, scratch_path(r.spark, "portfolio-parts"), parts, _PORTFOLIO_AMOUNTS)


_PORTFOLIO_AMOUNTS = {
    "horizons": "net_reserve", "months": "net_reserve", "worst_dealers": "claims_paid",
    "dealers": "net_reserve", "agents": "claims_paid", "products": "earned_reserve",
    "loss_codes": "rolling12_paid", "makes": "paid_amount", "source_counts": "documents",
}


@on_tables
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    rows = pr.dealer_coverage(pr.priced(mp.pricing_documents(spark, sf_dir), CFG).where("in_market"))
    writers.write_csv(
        rows.selectExpr("dealer_name AS DealerName", "coverage_code",
                        "max_markup AS `WrittenAmount.RESERVE.BASERESERVE`"),
        path,
    )
    back = readers.read_csv(
        spark, path,
        "DealerName string, coverage_code string, `WrittenAmount.RESERVE.BASERESERVE` string",
    )
    return back.groupBy("coverage_code").agg(
        F.count("*").alias("n"),
        F.expr("sum(cast(`WrittenAmount.RESERVE.BASERESERVE` AS decimal(18,4))) AS amount"),
    )


@on_tables
def sql_parameterised(spark, sf_dir):
    return readers.query(
        spark,
        "SELECT o_orderstatus, count(*) AS n, min(o_orderdate) AS first_day FROM contract_orders"
        " WHERE o_orderdate >= :start AND o_orderpriority = :priority GROUP BY o_orderstatus",
        {"contract_orders": mp.table(spark, sf_dir, "orders")},
        start=date(1999, 1, 1),
        priority="2-HIGH",
    )


# ---- the same rows by way of JSON documents


def _document_report(r: Report, activated_from: date | None = None) -> Report:
    """The report over the documents written as JSON and read again."""
    folder = scratch_path(r.spark, "documents")
    for feed, name in ((0, "contracts"), (1, "cancellations")):
        documents.write_contract_documents(r.contract_documents.where(f"feed = {feed}"), f"{folder}/{name}")
    documents.write_claim_documents(r.claim_documents, f"{folder}/claims")
    r.audits.write.json(f"{folder}/audits")
    contracts = readers.read_contracts(r.spark, f"{folder}/contracts", activated_from)
    return Report(
        r.spark, r.cfg,
        contracts.unionByName(readers.read_cancellations(r.spark, f"{folder}/cancellations")),
        readers.read_claims(r.spark, f"{folder}/claims"),
        readers.read_audits(r.spark, f"{folder}/audits"),
    )


@on_report
def document_contracts(r):
    return contract_normalize(_document_report(r))


@on_report
def document_contracts_from(r):
    """Contract documents activated from a day on; cancellations are always read."""
    rows = _document_report(r, date(2000, 1, 1)).contract_rows
    return rows.where("feed = 0").select("source_id", "activity_date", "reserve_amount")


@on_report
def stored_contracts_from(r):
    """The same from a store by month of activation, where the bound prunes folders."""
    path = scratch_path(r.spark, "contract-store")
    writers.write_contract_store(r.contract_documents, path)
    found = readers.read_contract_store(r.spark, path, r.contract_documents.schema, date(2000, 1, 1))
    rows = Report(r.spark, r.cfg, found, r.claim_documents, r.audits).contract_rows
    return rows.where("feed = 0").select("source_id", "activity_date", "reserve_amount")


@on_report
def document_claims(r):
    return claim_normalize(_document_report(r))


@on_report
def document_audits(r):
    return latest_audit(_document_report(r))


@on_tables
def document_pricing(spark, sf_dir):
    path = scratch_path(spark, "pricing-documents")
    documents.write_pricing_documents(mp.pricing_documents(spark, sf_dir), path)
    rows = pr.priced(readers.read_pricing(spark, path), CFG)
    return pr.dealer_coverage(rows.where("in_market"))


@on_report
def stored_tables(r):
    """Normalised contracts, claims and audits written and read back: all columns, no row lost."""
    folder = scratch_path(r.spark, "stored")
    audits = readers.latest_audits(r.audits)
    writers.write_rows(r.all_contract_rows, f"{folder}/contracts")
    writers.write_rows(r.all_claim_rows, f"{folder}/claims")
    writers.write_audits(audits, f"{folder}/audits")
    counted = []
    tables = {"contracts": r.all_contract_rows, "claims": r.all_claim_rows, "audits": writers.flatten_audits(audits)}
    for name, before in tables.items():
        back = r.spark.read.parquet(f"{folder}/{name}")
        lost = _lost(before, back)
        counted.append(
            back.agg(F.count("*").alias("n")).crossJoin(F.broadcast(lost)).select(F.lit(name).alias("name"), "n", "lost")
        )
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def _stored_state(r: Report) -> StoredState:
    """The report's documents as files of two days, taken in and brought up to date after each."""
    folder = scratch_path(r.spark, "state")
    state = StoredState(r.spark, f"{folder}/store", r.cfg)
    for day in (0, 1):
        of_day = f"pmod(xxhash64(source_id), 2) = {day}"
        for feed, name in ((0, "contracts"), (1, "cancellations")):
            documents.write_contract_documents(
                r.contract_documents.where(f"feed = {feed} AND {of_day}"), f"{folder}/{name}/day-{day}"
            )
        documents.write_claim_documents(r.claim_documents.where(of_day), f"{folder}/claims/day-{day}")
        state.take_in(*[f"{folder}/{n}/*" for n in ("contracts", "cancellations", "claims")])
        state.update()
    return state


@on_report
def incremental_metrics(r):
    """All period metrics, from stored state that two days of files have changed in turn."""
    return _stored_state(r).metrics.where("horizon <> 'month'").drop("horizon")


# ---- normalisation


@on_tables
def normalize_ids_numbers_dates(spark, sf_dir):
    """Dirty spellings of keys, amounts and days, made from the orders."""
    dirty = mp.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS key",
        "concat('  c ', o_orderkey, '\\t x ') AS id_text",
        "CASE o_orderkey % 6 WHEN 0 THEN concat('$', format_number(o_orderkey, 0), '.50')"
        " WHEN 1 THEN concat(' ', o_orderkey, ' % ') WHEN 2 THEN concat(o_orderkey, 'd')"
        " WHEN 3 THEN 'Infinity' WHEN 4 THEN '' ELSE concat('-', o_orderkey, '.125') END AS amount_text",
        "CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'M/d/yyyy')"
        " WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd')"
        " WHEN 2 THEN date_format(o_orderdate, 'MM/dd/yyyy HH:mm:ss')"
        " WHEN 3 THEN 'soon' ELSE '' END AS day_text",
        "concat(lpad(lower(hex(unix_timestamp(o_orderdate))), 8, '0'), '0123456789abcdef') AS oid",
    )
    return dirty.selectExpr(
        "key",
        f"{s.business_id('id_text')} AS business_id",
        f"{s.lenient_number('amount_text')} AS amount",
        f"{s.lenient_date('day_text')} AS day",
        f"{s.object_id_timestamp('oid')} AS oid_day",
        f"{s.object_id_timestamp('id_text')} AS no_oid_day",
    )


@on_report
def classify_tx(r):
    return r.evaluated_contracts.groupBy("feed", "own_type", "transaction_type").agg(
        F.count("*").alias("n"),
        F.expr("count_if(is_forced) AS forced"),
        F.expr("count_if(is_test) AS test_rows"),
        F.expr("count_if(activity_date IS NULL) AS undated"),
    )


@on_report
def contract_normalize(r):
    return r.contract_rows.selectExpr(
        "feed", "source_id", "snapshot_ts", "contract_number", "contract_status",
        "transaction_type", "activity_date", "effective_date", "agent", "dealer", "product",
        "company", "admin_amount", "reserve_amount", "gross_income_amount", "has_schedule",
        "schedule_last_month", "cardinality(earning_schedule) AS schedule_months",
        "cast(earning_schedule[schedule_last_month] AS double) AS last_factor",
    )


@on_tables
def dimension_defaults(spark, sf_dir):
    """Where contract and claim defaults part: an empty text against a missing one."""
    rows = mp.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS key",
        "CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN o_orderpriority END AS first_choice",
        "CASE o_orderkey % 2 WHEN 0 THEN o_orderstatus ELSE '' END AS second_choice",
    )
    first, second = s.text("first_choice"), s.text("second_choice")
    return rows.selectExpr(
        "key",
        f"{s.or_else(first, second, s.quoted(s.NO_AGENT))} AS contract_side",
        f"{s.or_else(s.text('coalesce(first_choice, second_choice)'), s.quoted(s.NO_AGENT))}"
        " AS claim_side",
    )


@on_report
def claim_normalize(r):
    return r.claim_rows.select(
        "source_id", "snapshot_ts", "payment_key", "claim_number", "contract_number",
        "activity_date", "status", "paid_amount", "agent", "dealer", "dealer_name", "product",
        "coverage_name", "vehicle_make", "loss_code", "loss_description",
    )


@on_report
def kpi_variance_flags(r):
    return m.period_comparison(r.metrics, CFG.low_admin_fee)


@on_report
def period_snapshot_kpis(r):
    return m.period_snapshot(r.metrics, CFG.low_admin_fee)


@on_report
def loss_ratio_bands(r):
    return r.dimension("dealer", "rolling12").selectExpr(
        "dim_value",
        "earned_loss_ratio",
        f"{s.loss_ratio_band('earned_loss_ratio')} AS band",
        f"{s.loss_ratio_alert('earned_loss_ratio', CFG.warning_loss_ratio, CFG.high_loss_ratio)}"
        " AS alert",
        f"{s.low_admin_flag('admin_per_contract', CFG.low_admin_fee)} AS low_admin",
    )


# ---- components


@on_report
def component_amounts(r):
    return r.contract_rows.where("feed < 2").groupBy("feed", "product").agg(
        F.sum("admin_amount").alias("admin"),
        F.sum("reserve_amount").alias("reserve"),
        F.sum("gross_income_amount").alias("gross"),
    )


@on_tables
def component_exclusions(spark, sf_dir):
    """The exclusion rules on names made from parts of the tables."""
    parts = ["DEALERCOMM", "ADMIN", "SURCHARGE", "CLIPFEE", "PREMTAX", "OEM TRANSPORT 1",
             "LOANPMT", "F&I FEE", "roadside akmc x", "BASE"]
    names = ", ".join(f"'{p}'" for p in parts)
    rows = mp.line_components(spark, sf_dir).selectExpr(
        "category",
        f"concat(' ', element_at(array({names}), cast(l_orderkey % {len(parts)} AS int) + 1)) AS name",
        "amount",
    )
    return rows.groupBy("category", "name").agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount")
    ).selectExpr(
        "category", "name", "n", "amount",
        f"{comp.excluded_component('name', 'RESERVE', CFG)} AS not_reserve",
        f"{comp.excluded_component('name', 'ADMIN', CFG)} AS not_admin",
        f"{comp.gross_income_excluded('category', 'name', CFG)} AS not_gross",
    )


@on_report
def component_pivot(r):
    cells = [f"{c} - {n}" for c, names in mp.COMPONENTS.items() for n in names]
    wide = ct.component_pivot(r.transactions, ["transaction_type", "product"], cells)
    return wide.groupBy("transaction_type", "product").agg(
        *[F.sum(f"`{c}`").alias(c.lower().replace(" - ", "_")) for c in cells]
    )


@on_report
def undeclared_components(r):
    """What a pivot without the surcharges would leave out."""
    cells = [f"{c} - {n}" for c, names in mp.COMPONENTS.items() for n in names if n != "SURCHARGE"]
    return ct.undeclared_components(r.transactions, cells)


@on_report
def component_buckets(r):
    tables = []
    for dim in ("dealer", "agent"):
        code, name = _entity_columns(dim)
        sums = ct.component_buckets(r.transactions, [code, name])
        found = r.sums_of_entities(sums, dim, code, name, ["category", "component"], ["written", "cancelled", "net"])
        tables.append(found.withColumn("dim", F.lit(dim)))
    return tables[0].unionByName(tables[1])


@on_report
def included_components(r):
    return ct.included_components(r.transactions, CFG)


@on_report
def gross_income_components(r):
    return ct.gross_income_components(r.transactions, CFG)


# ---- dedupe, joins


@on_report
def dedupe_two_feeds(r):
    """Newest row of each feed."""
    rows = r.contract_rows.where("feed < 2").withColumn(
        "key", F.expr("coalesce(nullif(contract_number, ''), source_id)")
    )
    newest = dd.latest_by(rows, ["feed", "key"], ["snapshot_ts", "ingest_ord"])
    return newest.select("feed", "key", "source_id", "snapshot_ts", "transaction_type")


@on_report
def transaction_list(r):
    return r.transactions.select(
        "source_id", "contract_number", "contract_status", "transaction_type", "activity_date",
        "dealer", "reserve_amount", "is_latest_state",
    )


@on_report
def written_reference(r):
    return r.transactions.where("source_id LIKE '%:written-reference'").select(
        "source_id", "contract_number", "contract_status", "activity_date", "reserve_amount"
    )


@on_report
def dedupe_claims_dup(r):
    return r.claims.select(
        "payment_key", "occurrence", "source_id", "snapshot_ts", "paid_amount", "activity_date"
    )


@on_report
def sql_dedupe_views(r):
    contracts = dd.sql_service_contracts(r.contract_rows).selectExpr(
        "'contract' AS kind", "source_id", "snapshot_ts"
    )
    claims = dd.sql_service_claims(r.claim_rows).selectExpr("'claim' AS kind", "source_id", "snapshot_ts")
    return contracts.unionByName(claims)


@on_report
def latest_state(r):
    return r.transactions.where("is_latest_state").groupBy("contract_status", "transaction_type").agg(
        F.count("*").alias("contracts"), F.sum("reserve_amount").alias("reserve")
    )


@on_report
def claim_contract_lookup(r):
    joined = dd.with_lookup(r.claims, r.lookup)
    return joined.selectExpr(
        "source_id", "found.product AS product", "found.agent AS agent", "found.dealer AS dealer"
    )


@on_report
def written_product_lookup(r):
    joined = dd.with_lookup(r.claims, dd.written_lookup(r.ledger))
    return joined.groupBy(F.col("found.product").alias("product")).agg(
        F.count("*").alias("line_count"), F.sum("paid_amount").alias("paid")
    )


@on_report
def entity_fanout(r):
    return dd.entity_fanout(r.transactions, ["agent", "agent_name"]).groupBy("entity").agg(
        F.count("*").alias("n"), F.sum("reserve_amount").alias("reserve")
    )


@on_report
def entity_keys(r):
    return r.entity_keys


@on_report
def entity_union(r):
    """Every dealer, by code and by display name, and agent seen, with the horizons it was seen in."""
    names = "if(dim = 'dealer', array_distinct(array(dim_value, display_name)), array(dim_value))"
    rows = r.dimensions.where("dim <> 'product'").selectExpr(
        "dim", f"explode(filter({names}, x -> x <> '')) AS dim_value", "period_id"
    )
    return rows.groupBy("dim", "dim_value").agg(
        F.expr("array_join(array_sort(collect_set(period_id)), ',') AS horizons")
    )


@on_report
def effective_lookup(r):
    return dd.effective_lookup(r.transactions)


# ---- calendar


@on_report
def period_spine(r):
    """Every reporting period with the activity it covers."""
    counted = r.transactions.join(
        F.broadcast(r.periods), F.expr("activity_date BETWEEN period_start AND period_end")
    ).groupBy("period_id").agg(F.count("*").alias("n"))
    return r.periods.join(counted, "period_id", "left").selectExpr(
        "period_id", "period_start", "period_end", "coalesce(n, 0L) AS transactions"
    )


@on_report
def month_spine(r):
    end = cal.sql_date(cal.reporting_end(CFG))
    rows = r.transactions.groupBy(F.date_format("activity_date", "yyyy-MM").alias("period_id")).agg(
        F.count("*").alias("transactions"),
        F.expr(f"max({cal.elapsed_months('activity_date', end)}) AS elapsed"),
    )
    return cal.month_spine(r.spark, CFG).join(rows, "period_id", "left").selectExpr(
        "period_id", "period_start", "period_end", "coalesce(transactions, 0L) AS transactions",
        "elapsed",
    )


# ---- period metrics


@on_report
def period_metrics_core(r):
    return r.metrics.where("period_id = 'current_month'").drop("horizon")


@on_report
def period_metrics_all(r):
    return r.metrics.where("horizon <> 'month'").drop("horizon")


@on_report
def monthly_trend(r):
    return r.metrics.where("horizon = 'month'").drop("horizon")


@on_report
def trend_matrix(r):
    wide = m.trend_matrix(r.metrics, [p.period_id for p in cal.months(CFG)])
    return wide.select("kpi", *[F.col(f"`{c}`").alias("m_" + c.replace("-", "_")) for c in wide.columns[1:]])


@on_report
def horizon_scorecard(r):
    return m.horizon_scorecard(r.metrics, CFG.warning_loss_ratio, CFG.high_loss_ratio)


@on_report
def sql_service_metrics(r):
    periods = cal.period_frame(r.spark, cal.horizons(CFG))
    return m.sql_service_metrics(r.contract_rows, r.claim_rows, periods).drop("horizon")


@on_report
def earned_by_tx(r):
    return r.transactions.select("source_id", "contract_number", "earned_reserve_amount")


@on_report
def earned_detail(r):
    return it.earned_detail(it.target_contracts(r.transactions, [], [AGENT], CFG), CFG)


@on_report
def reconciliation_steps(r):
    contracts = it.target_contracts(r.transactions, [], [AGENT], CFG)
    claims = it.reached_claims(r.claims, dd.written_lookup(r.ledger), [], [AGENT], CFG)
    return it.reconciliation_steps(contracts, claims)


# ---- dimensions


@on_report
def dealer_metrics(r):
    return r.dimensions.where("dim = 'dealer'").drop("dim", "related_dealers")


@on_report
def agent_metrics(r):
    return r.dimensions.where("dim = 'agent'").drop("dim", "related_agents")


@on_report
def product_metrics(r):
    products = r.dimensions.where("dim = 'product'")
    return products.drop("dim", "related_agents", "related_dealers", "display_name")


@on_report
def claim_attribution(r):
    rows = dm.attribute_claims(r.claims, r.lookup, dm.DIMENSIONS)
    return rows.groupBy("dim", "dim_value", "is_direct").agg(
        F.count("*").alias("line_count"), F.sum("paid_amount").alias("paid")
    )


@on_report
def topn_tables(r):
    top = dm.top_table(r.dimensions.where("dim = 'dealer' AND period_id <> 'inception'"), 20)
    rest = dm.whole_table(
        r.dimensions.where("dim <> 'dealer' AND period_id <> 'inception'"), lambda df: r.keep(df, "ranking")
    )
    return top.unionByName(rest).select(
        "dim", "period_id", "rank", "dim_value", "net_admin", "net_reserve", "cancellation_rate"
    )


@on_report
def top_dealers_sql(r):
    rolling = cal.pick(CFG, "rolling12")[0]
    rows = dd.sql_service_contracts(r.contract_rows)
    return dm.sql_top_dealers(rows, rolling.start, rolling.end)


@on_report
def worst_dealers_dashboard(r):
    return dm.worst_dealers(r.dimension("dealer", "inception"), True).select(
        "rank", "dealer_name", "related_agents", "active_contracts", "claim_frequency",
        "claim_severity", "net_admin", "earned_reserve", "earned_loss_ratio", "percent_earned",
    )


@on_report
def worst_dealers_snapshot(r):
    return dm.worst_dealers(r.dimension("dealer", "inception"), False).select(
        "rank", "dealer_name", "active_contracts", "contracts_written", "net_reserve",
        "earned_reserve", "claims_paid", "underwriting_profit", "earned_loss_ratio",
    )


@on_report
def sub_dealers(r):
    return dm.sub_dealers(
        r.partners.where("dim = 'agent' AND period_id = 'inception'"), r.dimension("dealer", "inception")
    )


@on_report
def entity_partners(r):
    return r.partners


@on_report
def product_mix(r):
    return dm.product_mix(r.dimension("product", "inception"))


def _entity_columns(dim: str) -> tuple[str, str]:
    """Where transactions hold the code and the name of an entity."""
    return "dealer_number" if dim == "dealer" else "agent", f"{dim}_name"


def _entity_figures(r: Report, dim: str, skip_cancelled: bool) -> DataFrame:
    """Product figures of every entity of a dimension; no row is repeated for the entities of a shared name."""
    code, name = _entity_columns(dim)
    sums = r.sums_of_entities(dm.sold_parts(r.transactions), dim, code, name, ["product"], dm.SOLD_PARTS)
    paid = dd.entity_claim_products(r.claims, r.ledger, r.entity_keys, dim, dim, name, code, skip_cancelled)
    return dm.joined_figures(dm.sold_figures(sums, ["entity"]), paid, ["entity"])


def _agent_products(r: Report) -> DataFrame:
    claims = dm.claim_products(r.claims, r.transactions, [])
    return dm.product_figures(r.transactions, claims, [])


@on_report
def product_buckets(r):
    """Product table of every dealer and agent, known by code or by name."""
    tables = []
    for dim in ("dealer", "agent"):
        figures = dm.product_buckets(_entity_figures(r, dim, skip_cancelled=True))
        tables.append(figures.withColumn("dim", F.lit(dim)))
    return tables[0].unionByName(tables[1])


@on_report
def product_table(r):
    contracts = it.target_contracts(r.transactions, [], [AGENT], CFG)
    claims = it.reached_claims(r.claims, dd.written_lookup(r.ledger), [], [AGENT], CFG)
    figures = dm.product_figures(contracts, dm.claim_products(claims, r.transactions, []), [])
    return dm.with_total(figures, [])


@on_report
def product_scorecard(r):
    return dm.product_scorecard(_agent_products(r), [])


@on_report
def loss_attribution(r):
    return dm.loss_attribution(dm.product_scorecard(_agent_products(r), []), [])


@on_report
def entity_drilldown(r):
    wide = dm.entity_drilldown(r.dimensions)
    horizons = ("current_month", "ytd", "rolling12", "inception")
    return wide.selectExpr(
        "dim", "dim_value", "display_name", "related",
        *[f"{p}.{c} AS {p}_{c}" for p in horizons for c in ("net_reserve", "claims_paid")],
    )


@on_report
def entity_lookup(r):
    return dm.entity_lookup(r.dimensions, "nation_3 agency", CFG.entity_aliases).select(
        "dim", "dim_value", "period_id", "display_name", "contracts_written", "earned_reserve"
    )


# ---- loss codes and vehicles


@on_report
def loss_code_kpis(r):
    periods = cal.period_frame(r.spark, cal.pick(CFG, "current_month", "ytd", "rolling12"))
    return lc.loss_code_kpis(r.claims, periods)


@on_report
def loss_code_rows(r):
    return r.loss_codes


@on_report
def loss_code_description(r):
    return lc.preferred_descriptions(r.claims)


@on_report
def top_makes(r):
    return lc.top_makes(r.claims, cal.pick(CFG, "rolling12")[0])


@on_report
def visible_segments(r):
    return lc.chart_segments(lc.visible_rows(r.loss_codes))


@on_report
def top_loss_codes_per_dealer(r):
    sums = lc.code_sums(r.claims, ["dealer", "dealer_name"])
    found = r.sums_of_entities(
        sums, "dealer", "dealer", "dealer_name", ["loss_code"], ["line_count", "total_paid"], ["first_line"]
    )
    return lc.top_codes(found, "entity", TOP_CODES)


@on_report
def target_loss_codes(r):
    claims = it.reached_claims(r.claims, r.lookup, [], [AGENT], CFG)
    return lc.top_codes_per_entity(claims.withColumn("target", F.lit(AGENT)), "target", 5)


@on_report
def portfolio_top5(r):
    return lc.portfolio_top(r.loss_codes)


# ---- underwriting intelligence


@on_report
def target_filter(r):
    rows = it.target_contracts(r.transactions, [DEALER], [AGENT], CFG)
    return rows.groupBy("agent", "dealer").agg(
        F.count("*").alias("n"), F.sum("reserve_amount").alias("reserve")
    )


@on_report
def target_claim_sets(r):
    claims = it.reached_claims(r.claims, dd.written_lookup(r.ledger), ["S3", DEALER], [AGENT], CFG)
    return claims.select("source_id", "paid_amount")


@on_report
def agent_first_dates(r):
    return it.first_dates(r.transactions)


@on_report
def agent_maturity_status(r):
    return it.agent_ranking(r.dimension("agent", "inception"), r.transactions, CFG)


@on_report
def dealer_cohort(r):
    contracts = it.target_contracts(r.transactions, [], [AGENT], CFG)
    claims = it.target_claims(r.claims, ["S3", "S4"], [AGENT], CFG)
    return it.dealer_cohort(contracts, claims, CFG)


@on_report
def top_risk_agents(r):
    return it.risk_extremes(r.dimension("agent", "inception"))


@on_report
def time_to_loss(r):
    return it.time_to_loss(r.claims, dd.effective_lookup(r.transactions))


@on_report
def make_exposure(r):
    return it.make_exposure(r.claims)


@on_report
def pricing_benchmark(r):
    contracts = it.target_contracts(r.transactions, [], [AGENT], CFG)
    claims = it.target_claims(r.claims, ["S3", "S4"], [AGENT], CFG)
    rolling = r.metrics.where("period_id = 'rolling12'")
    return it.pricing_benchmark(contracts, claims, r.claims, rolling)


@on_report
def product_lines(r):
    contracts = it.target_contracts(r.transactions, [], [AGENT], CFG)
    claims = it.reached_claims(r.claims, r.lookup, [], [AGENT], CFG)
    return it.product_lines(contracts, claims)


def _summaries(r: Report) -> DataFrame:
    """Summaries of all dealers and agents, whose rows are found by code or by name."""
    found = []
    for dim in ("dealer", "agent"):
        code, name = _entity_columns(dim)
        days = r.transactions.selectExpr("*", f"{it.FIRST_DATE} AS first_date", "1L AS n")
        firsts = r.sums_of_entities(days, dim, code, name, [], ["n"], ["first_date"]).drop("n")
        paid = r.claims.withColumn("amount", F.col("paid_amount").cast(s.MONEY_SUM))
        codes = r.sums_of_entities(paid, dim, dim, name, ["loss_code"], ["amount"])
        lines = it.lines_of_figures(_entity_figures(r, dim, skip_cancelled=False), ["entity"])
        found.append(it.summaries_of(r.dimensions, firsts, codes, lines, CFG, dim))
    return found[0].unionByName(found[1])


@on_report
def target_summary(r):
    return _summaries(r).selectExpr(
        "dim", "dim_value", "display_name", "first_date", "tenure_months", "tenure_years", "maturity",
        "rolling_contracts", "rolling_reserve", "rolling_claims", "rolling_loss_ratio",
        "itd_contracts", "itd_reserve", "itd_earned_reserve", "itd_claims", "itd_loss_ratio",
        "itd_claim_frequency", "unearned_reserve", "percent_reserve_earned",
        "top_code.loss_code AS top_code", "losing.product AS losing_line",
        "winning.product AS winning_line",
    )


@on_report
def target_horizons(r):
    return it.target_horizons(_summaries(r), CFG)


@on_report
def target_narratives(r):
    return it.target_narratives(_summaries(r))


@on_report
def portfolio_narrative(r):
    worst = it.risk_extremes(r.dimension("agent", "inception"))
    return it.portfolio_narrative(r.metrics, worst, r.transactions, CFG)


@on_report
def contract_activity(r):
    return it.contract_activity(r.transactions, CFG).select(
        "source_id", "contract_number", "transaction_type", "dealer_name", "coverage_code",
        "admin_amount", "earned_reserve_amount", "earn_factor", "elapsed", "schedule_last_month",
        "factor_source",
    )


@on_report
def claim_activity(r):
    return it.claim_activity(r.claims).drop("payment_key", "snapshot_ts")


@on_report
def systematic_sample(r):
    rows = it.systematic_sample(r.transactions, "place", ["source_id"])
    return rows.select("source_id", "contract_number", "transaction_type")


# ---- data quality


@on_report
def dq_issues(r):
    return q.issue_log(r.issues)


@on_report
def dq_by_category(r):
    return q.issues_by_category(r.issues)


@on_report
def dq_by_agent(r):
    return q.issues_by_agent(r.issues)


@on_report
def dq_unread_dates(r):
    return q.unread_dates(r.evaluated_contracts, r.evaluated_claims)


@on_report
def dealer_profile(r):
    return q.dealer_profile(r.contract_documents, DEALER)


@on_report
def multi_dealer_contracts(r):
    return q.multi_dealer_contracts(r.contract_documents)


@on_report
def multi_dealer_members(r):
    return q.multi_dealer_members(r.contract_documents)


@on_report
def admin_reconciliation(r):
    cells = [("ADMIN", "ADMIN"), ("ADMIN", "BASEADMIN"), ("RESERVE", "ADMIN")]
    return q.admin_reconciliation(r.contract_documents, DEALER, date(2000, 6, 30), cells)


@on_report
def csv_reconciliation(r):
    """Base reserve of a written export against the rows the rules leave out."""
    name = "Customer#000000007"
    path = scratch_path(r.spark, "export-csv")
    rows = r.contract_rows.where("feed = 0").selectExpr(
        "dealer_name AS DealerName",
        "aggregate(filter(components, c -> c.category = 'RESERVE' AND c.component = 'BASERESERVE'),"
        " cast(0 AS decimal(18,4)), (a, c) -> cast(a + c.amount AS decimal(18,4)))"
        " AS `WrittenAmount.RESERVE.BASERESERVE`",
    )
    writers.write_csv(rows, path)
    export = readers.read_csv(
        r.spark, path, "DealerName string, `WrittenAmount.RESERVE.BASERESERVE` string"
    )
    return q.dropped_reserve_reconciliation(r.contract_documents, export, name)


@on_report
def dealer_reserve_recon(r):
    return q.raw_net_reserve(r.contract_documents, DEALER, date(2001, 7, 1))


# ---- pricing


def _priced(spark, sf_dir):
    return pr.priced(mp.pricing_documents(spark, sf_dir), CFG)


@on_report
def claim_benchmark(r):
    return r.benchmark


@on_report
def claim_benchmark_alerts(r):
    rows = pr.outlier_claims(r.claims, r.benchmark)
    return rows.groupBy("loss_code").agg(
        F.count("*").alias("line_count"), F.sum("paid_amount").alias("paid")
    )


@on_tables
def coverage_summary(spark, sf_dir):
    return pr.coverage_summary(_priced(spark, sf_dir).where("in_market"))


@on_tables
def coverage_dealers(spark, sf_dir):
    rows = _priced(spark, sf_dir).where("in_market")
    return pr.coverage_dealers(rows, lambda df: report(spark, sf_dir).keep(df, "coverage-dealers"))


@on_tables
def dealer_coverage(spark, sf_dir):
    return pr.dealer_coverage(_priced(spark, sf_dir).where("in_market"))


@on_tables
def coverage_state_only(spark, sf_dir):
    return pr.coverage_summary(_priced(spark, sf_dir).where("in_state"), listed=False)


@on_tables
def dealer_coverage_state_only(spark, sf_dir):
    return pr.dealer_coverage(_priced(spark, sf_dir).where("in_state"))


@on_tables
def state_vs_nation(spark, sf_dir):
    return pr.state_vs_nation(_priced(spark, sf_dir))


@on_tables
def coverage_extremes(spark, sf_dir):
    return pr.coverage_extremes(_priced(spark, sf_dir).where("in_state"))


@on_tables
def coverage_exceptions(spark, sf_dir):
    return pr.zip_exceptions(_priced(spark, sf_dir))


@on_tables
def market_coverage(spark, sf_dir):
    return pr.market_coverage(_priced(spark, sf_dir))


@on_tables
def markup_presence(spark, sf_dir):
    return pr.markup_presence(_priced(spark, sf_dir))


@on_tables
def markup_samples(spark, sf_dir):
    return pr.markup_samples(_priced(spark, sf_dir))


@on_tables
def markup_documents(spark, sf_dir):
    return pr.markup_documents(_priced(spark, sf_dir))


@on_tables
def market_states(spark, sf_dir):
    return pr.states(_priced(spark, sf_dir))


@on_tables
def state_profile(spark, sf_dir):
    return pr.state_profile(_priced(spark, sf_dir))
