"""Contract and claim documents derived from the order tables.

The driver's star schema holds no contracts, so each order is read as a contract document with
one to three snapshots, cancelled orders (status P) also as a cancellation document, and the
lines as written components or as claim payments. The rules also plant the irregular values the
operators must cope with: blank contract numbers, blank dates, test agents, unknown types.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.config import ReportConfig

CONFIG = ReportConfig(
    as_of=date(2001, 7, 15),
    inception_start=date(1995, 1, 1),
    company_name="Sample Protection",
    market_states=("NATION_7", "NATION_8"),
    market_zip_prefixes=("32", "33", "34"),
    entity_aliases=(("nation_3", "nation_3 agency"),),
)

# exact products of prices and discounts, so that every engine rounds the same number
_PRICE, _DISCOUNT = "cast(l_extendedprice AS decimal(12,2))", "cast(l_discount AS decimal(4,2))"
NET_PRICE = f"{_PRICE} * (1 - {_DISCOUNT})"
MARKUP = f"{_PRICE} * {_DISCOUNT}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# written components of the mapped documents
COMPONENTS = {
    "ADMIN": ["ADMIN", "BASEADMIN", "DEALERCOMM", "SURCHARGE"],
    "RESERVE": ["ADMIN", "BASERESERVE", "DEALERCOMM", "SURCHARGE"],
}


def line_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written component lines: category, component, amount per line."""
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag <> 'R'")
        .selectExpr(
            "l_orderkey",
            "CASE WHEN l_linestatus = 'F' THEN 'RESERVE' ELSE 'ADMIN' END AS category",
            "CASE WHEN l_returnflag = 'A' THEN if(l_linestatus = 'F', 'BASERESERVE', 'BASEADMIN')"
            " ELSE CASE l_linenumber % 3 WHEN 0 THEN 'DEALERCOMM' WHEN 1 THEN 'ADMIN'"
            " ELSE 'SURCHARGE' END END AS component",
            f"cast({NET_PRICE} * 0.01 AS decimal(18,2)) AS amount",
        )
    )


def _amounts_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = {
        category: [base, "DEALERCOMM", "ADMIN", "SURCHARGE"]
        for category, base in (("RESERVE", "BASERESERVE"), ("ADMIN", "BASEADMIN"))
    }
    # an order's lines lie all over the table: its sums, which are wide, are made where its lines meet
    sums = (
        line_components(spark, sf_dir)
        .repartition("l_orderkey")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            *[
                F.expr(
                    f"cast(sum(amount) FILTER (WHERE category = '{c}' AND component = '{n}')"
                    f" AS decimal(18,2)) AS {c}_{n}"
                )
                for c, names in cells.items()
                for n in names
            ]
        )
    )

    def container(scale: str) -> str:
        maps = []
        for c, names in cells.items():
            pairs = ", ".join(f"'{n}', cast({c}_{n}{scale} AS string)" for n in names)
            maps.append(f"'{c}', map_filter(map({pairs}), (k, v) -> v IS NOT NULL)")
        return f"map({', '.join(maps)})"

    return sums.selectExpr(
        "o_orderkey", f"{container('')} AS written", f"{container(' * 0.5')} AS cancelled"
    )


def _curves() -> str:
    """Linear earning curves over one to five years, as constants."""
    months = lambda r: range(1, 12 * (1 + r) + 1)
    curves = [", ".join(f"{m}, {m} / {12 * (1 + r)}D" for m in months(r)) for r in range(5)]
    return " ".join(f"WHEN {r} THEN map({curve})" for r, curve in enumerate(curves))


def contract_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both contract feeds in the shape of ``RAW_CONTRACT``."""
    holder = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .select("c_custkey", "c_name", "n_nationkey", "n_name", "r_name")
    )
    # both sides of the second join grow with the data: neither may be broadcast
    orders = table(spark, sf_dir, "orders").join(holder, F.expr("o_custkey = c_custkey"))
    base = (
        orders.join(_amounts_per_order(spark, sf_dir).hint("merge"), "o_orderkey", "left")
        .selectExpr(
            "o_orderkey AS key",
            "o_orderstatus AS status",
            "o_orderpriority AS priority",
            "cast(o_orderdate AS date) AS activated",
            "c_custkey", "c_name", "n_nationkey", "n_name", "r_name", "written", "cancelled",
        )
        .selectExpr(
            "*",
            "date_add(activated, cast(1 + key % 400 AS int)) AS cancel_day",
            f"CASE key % 5 {_curves()} END AS earning_curve",
        )
    )
    snapshots = (
        "transform(sequence(0, cast(key % 3 AS int)), k -> named_struct('feed', 0,"
        " 'source_id', concat('S', key, '-', k), 'ingest_ord', key * 10 + k,"
        " 'seen', date_add(activated, k)))"
    )
    cancellation = (
        "array(named_struct('feed', 1, 'source_id', concat('X', key),"
        " 'ingest_ord', key * 10 + 9, 'seen', cancel_day))"
    )
    # a cancelled order of low priority is known from its cancellation document only
    documents = base.selectExpr(
        "*",
        f"inline(CASE WHEN status <> 'P' THEN {snapshots}"
        f" WHEN priority = '5-LOW' THEN {cancellation}"
        f" ELSE concat({snapshots}, {cancellation}) END)",
    )
    return documents.selectExpr(
        "feed",
        "source_id",
        "ingest_ord",
        "CASE WHEN key % 101 = 0 THEN '' ELSE concat('c ', key) END AS contract_no",
        "CASE WHEN feed = 1 THEN 'Cancellation' WHEN key % 103 = 0 THEN 'mystery'"
        " WHEN priority = '1-URGENT' THEN ' New Business ' WHEN priority = '2-HIGH' THEN ''"
        " WHEN priority = '3-MEDIUM' THEN 'Adjustment' ELSE 'NewBusiness' END AS type_text",
        "CASE WHEN feed = 1 THEN 'C' WHEN key % 103 = 0 THEN 'V' WHEN status = 'O' THEN 'A'"
        " WHEN status = 'F' THEN 'E' ELSE 'C' END AS status_text",
        "CASE WHEN key % 97 = 0 THEN '' ELSE date_format(activated, 'MM/dd/yyyy') END AS activation",
        "CASE WHEN feed = 1 OR (status = 'P' AND priority = '4-NOT SPECIFIED')"
        " THEN date_format(cancel_day, 'MM/dd/yyyy') ELSE '' END AS cancel_bill",
        "'' AS effective",
        "CASE WHEN key % 89 = 0 THEN 'Test Agent' ELSE n_name END AS agent_text",
        "cast(NULL AS string) AS agent_number",
        "concat(n_name, ' Agency') AS agent_name_text",
        "CASE WHEN feed = 1 AND key % 11 = 0 THEN concat('DM', n_nationkey)"
        " ELSE concat('D', c_custkey) END AS dealer_number_text",
        "c_name AS dealer_name_text",
        "priority AS product_text",
        "concat('COV', key % 7) AS coverage_code_text",
        "r_name AS company_text",
        "r_name AS risk_entity_text",
        "array(cast(seen AS string)) AS extraction",
        "written",
        "cancelled",
        "earning_curve",
    )


def claim_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claim feed in the shape of ``RAW_CLAIM``.

    A line is scraped once, twice, or three times; the third time on the day of the second,
    which makes it a further payment of the same amount.
    """
    # The lines are narrow and what is made of them is not: spread here, a table of few splits costs little.
    # By part, as the join needs them where the parts are too many to be broadcast.
    lines = (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R'")
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_linestatus", "l_shipdate",
        )
        .repartition("l_partkey")
    )
    parts = table(spark, sf_dir, "part")
    base = (
        lines.join(parts, F.expr("l_partkey = p_partkey"))
        .selectExpr(
            "*",
            "l_orderkey AS key",
            "l_linenumber AS number",
            "cast(l_shipdate AS date) AS shipped",
            f"cast({NET_PRICE} * 0.005 AS decimal(18,2)) AS paid",
        )
        .selectExpr("*", "explode(sequence(0, number % 3)) AS j")
    )
    return base.selectExpr(
        "concat_ws('-', 'CLM', key, number, l_partkey, l_suppkey, j) AS source_id",
        "key * 100 + number * 10 + j AS ingest_ord",
        "CASE WHEN key % 107 = 0 THEN '' ELSE concat('CL', key, '-', number) END AS claim_no",
        "CASE WHEN key % 101 = 0 THEN '' ELSE concat('C', key) END AS contract_no",
        "CASE WHEN number = 6 THEN 'Payment Issued' ELSE '' END AS activity",
        "CASE WHEN l_quantity < 3 THEN 'Open' ELSE 'Paid' END AS claim_status",
        "'' AS detail_status",
        "concat('$', cast(paid AS string)) AS paid_text",
        "CASE WHEN number = 7 THEN 'PerRepair' ELSE 'Part' END AS claim_description",
        "CASE WHEN key % 113 = 0 THEN 'not-a-date' ELSE date_format(shipped, 'MM/dd/yyyy') END"
        " AS date_paid",
        "cast(NULL AS string) AS date_reported",
        "cast(NULL AS string) AS check_number",
        "'ACH' AS pay_method",
        "cast(NULL AS string) AS payee_name",
        "cast(NULL AS string) AS ro_number",
        "CASE WHEN number <= 2 THEN concat('NATION_', l_suppkey % 25) END AS agent_number",
        "CASE WHEN number <= 2 THEN concat('NATION_', l_suppkey % 25, ' Agency') END"
        " AS agent_name_spaced",
        "cast(NULL AS string) AS agent_name_joined",
        "CASE WHEN l_linestatus = 'F' THEN concat('S', l_suppkey) END AS dealer_number_text",
        "CASE WHEN l_linestatus = 'F' THEN concat('Shop ', l_suppkey) END AS selling_dealer_name",
        "cast(NULL AS string) AS dealer_name_joined",
        "cast(NULL AS string) AS product_text",
        "CASE WHEN p_size > 3 THEN concat('Cover ', p_size % 5) END AS coverage_name_text",
        "concat(' ', replace(p_brand, '#', '  ')) AS make_text",
        "CASE WHEN p_size > 2 THEN lower(p_type) END AS loss_code_text",
        "CASE WHEN p_size > 5 THEN p_name END AS loss_text",
        "array(cast(date_add(shipped, least(j, 1)) AS string)) AS extraction",
    )


def pricing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract documents with pricing fields, one per order line."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    holder = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .select("c_custkey", "c_name", "n_name")
    )
    base = (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.expr("l_partkey = p_partkey"))
        .join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .join(holder, F.expr("o_custkey = c_custkey"))
    )
    return base.selectExpr(
        "l_orderkey * 10 + l_linenumber AS ingest_ord",
        "concat_ws('-', concat('C', l_orderkey), l_linenumber, l_partkey, l_suppkey)"
        " AS contract_no",
        "c_name AS dealer_name",
        "concat('D', c_custkey) AS dealer_number",
        "concat('City ', c_custkey % 10) AS dealer_city",
        "CASE WHEN c_custkey % 13 <> 0 THEN n_name END AS state",
        "lpad(cast(c_custkey * 37 % 100000 AS string), 5, '0') AS zip",
        "concat(p_type, '-', l_partkey % 9) AS coverage_code",
        "p_type AS coverage_name",
        "p_type AS product_type",
        f"CASE WHEN l_discount = 0 THEN '0.00' ELSE cast({MARKUP} AS string) END AS markup",
        "cast(cast(l_extendedprice AS decimal(18,2)) AS string) AS retail",
        f"cast({NET_PRICE} AS string) AS net",
    )


def audit_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two audits per job type in the shape of ``AUDIT``; the claim audit is off by one."""
    orders = table(spark, sf_dir, "orders").agg(
        F.count("*").alias("o"), F.expr("count_if(o_orderstatus = 'P') AS p")
    )
    lines = table(spark, sf_dir, "lineitem").agg(F.expr("count_if(l_returnflag = 'R') AS r"))
    jobs = [
        ("Contract", "o", "NULL", "o", True, "PASSED"),
        ("Cancel", "p", "p", "p", True, "PASSED"),
        ("Claim", "r", "r + 1", "r + 1", False, "DISCREPANCY"),
        ("Other", "r", "r", "r", True, "PASSED"),
    ]
    documents = []
    for job, portal, unique, done, match, status in jobs:
        for run, seen in enumerate(("2001-06-01 04:00:00", "2001-07-01 04:00:00")):
            documents.append(
                f"named_struct('_id', '{job}-{run}', 'jobType', '{job}',"
                f" 'executionTimestamp', '{seen}', 'executionDateStr', '{seen[:10]}',"
                " 'dateRange', named_struct('startDate', '1995-01-01', 'endDate', '2001-06-30'),"
                f" 'counts', named_struct('portalCount', format_number({portal} - {1 - run}, 0),"
                f" 'uniqueCount', cast({unique} AS string), 'processedCount', cast({done} AS string),"
                f" 'uploadedCount', concat('{{\"$numberInt\": \"', {done}, '\"}}')),"
                f" 'reconciliation', named_struct('isMatch', {str(match).lower()},"
                f" 'portalVsProcessedDiff', cast({done} - {portal} AS string),"
                f" 'processedVsUploadedDiff', '0', 'status', '{status}', 'summary', ''),"
                f" 'fileMetadata', named_struct('fileName', '{job.lower()}-{run}.csv'),"
                " 'systemInfo', named_struct('environment', 'test', 'source', cast(NULL AS string)))"
            )
    return orders.crossJoin(lines).selectExpr(f"inline(array({', '.join(documents)}))")
