"""The named queries as DuckDB SQL over the same tables.

Written the long way round, with windows and joins in the order the rules are stated in, so that
it shares no method with the Spark side: the common part is only the mapping of orders to
documents.
"""

from __future__ import annotations

END = "DATE '2001-06-30'"


def d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def r(expr: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6)"


def div(a: str, b: str) -> str:
    return f"ROUND(CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END, 6)"


def n(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def t(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], body: str) -> None:
    CTE[name] = (needs, body)


def sql(needs: list[str], body: str) -> str:
    """The query with all common tables it needs, in order."""
    seen: list[str] = []

    def visit(name: str) -> None:
        if name in seen:
            return
        for other in CTE[name][0]:
            visit(other)
        seen.append(name)

    for name in needs:
        visit(name)
    tables = ",\n".join(f"{name} AS ({CTE[name][1]})" for name in seen)
    return f"WITH {tables}\n{body}" if seen else body


cte("base", [], """
    SELECT o_orderkey AS key, o_orderstatus AS st, o_orderpriority AS priority,
        CAST(o_orderdate AS DATE) AS od,
        CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 400 AS INTEGER) AS cday,
        c_custkey AS custkey, c_name, n_nationkey, n_name, r_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")

cte("comp", [], """
    SELECT l_orderkey AS key, CASE WHEN l_linestatus = 'F' THEN 'RESERVE' ELSE 'ADMIN' END AS cat,
        CASE WHEN l_returnflag = 'A'
                THEN CASE WHEN l_linestatus = 'F' THEN 'BASERESERVE' ELSE 'BASEADMIN' END
            WHEN l_linenumber % 3 = 0 THEN 'DEALERCOMM'
            WHEN l_linenumber % 3 = 1 THEN 'ADMIN' ELSE 'SURCHARGE' END AS comp,
        CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * 0.01 AS DECIMAL(18,2)))
            AS DECIMAL(18,2)) AS amt
    FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2, 3""")

cte("amounts", ["comp"], """
    SELECT key,
        CAST(coalesce(sum(amt) FILTER (WHERE cat = 'RESERVE'
            AND comp IN ('BASERESERVE', 'SURCHARGE')), 0) AS DECIMAL(18,2)) AS reserve,
        CAST(coalesce(sum(amt) FILTER (WHERE (cat = 'ADMIN' AND comp <> 'DEALERCOMM')
            OR (cat = 'RESERVE' AND comp = 'ADMIN')), 0) AS DECIMAL(18,2)) AS admin,
        CAST(coalesce(sum(amt) FILTER (WHERE comp <> 'DEALERCOMM'), 0) AS DECIMAL(18,2)) AS gross
    FROM comp GROUP BY key""")

cte("docs", ["base"], """
    SELECT 0 AS feed, base.*, 'S' || key || '-' || k AS source_id, key * 10 + k AS ord,
        od + CAST(k AS INTEGER) AS seen
    FROM base, (VALUES (0), (1), (2)) AS s(k)
    WHERE k <= key % 3 AND NOT (st = 'P' AND priority = '5-LOW')
    UNION ALL
    SELECT 1, base.*, 'X' || key, key * 10 + 9, cday FROM base WHERE st = 'P'""")

cte("ev0", ["docs"], """
    SELECT *, CASE WHEN key % 101 = 0 THEN '' ELSE 'C' || key END AS num, key % 89 = 0 AS is_test,
        CASE WHEN key % 89 = 0 THEN 'Test Agent' ELSE n_name END AS agent,
        n_name || ' Agency' AS agent_name,
        CASE WHEN key % 97 <> 0 THEN od END AS activation,
        CASE WHEN feed = 1 OR (st = 'P' AND priority = '4-NOT SPECIFIED') THEN cday END AS cancel_date,
        CASE WHEN feed = 1 THEN 'Cancellation' WHEN key % 103 = 0 THEN 'Unknown'
            WHEN priority = '2-HIGH' AND st = 'P' THEN 'Cancellation'
            WHEN priority = '3-MEDIUM' THEN 'Adjustment' ELSE 'NewBusiness' END AS own_type,
        CASE WHEN feed = 1 THEN 'C' WHEN key % 103 = 0 THEN 'V' WHEN st = 'O' THEN 'A'
            WHEN st = 'F' THEN 'E' ELSE 'C' END AS cstatus,
        CASE WHEN feed = 1 AND key % 11 = 0 THEN 'DM' || n_nationkey ELSE 'D' || custkey END
            AS dealer
    FROM docs""")

cte("ev1", ["ev0"], """
    SELECT *, feed = 0 AND own_type <> 'Cancellation' AND cancel_date IS NOT NULL AS forced,
        CASE WHEN feed = 1 OR cancel_date IS NOT NULL THEN 'Cancellation' ELSE own_type END AS type
    FROM ev0""")

cte("ev", ["ev1"], """
    SELECT *, CASE WHEN type = 'Cancellation' THEN cancel_date ELSE activation END AS activity
    FROM ev1""")

_KEPT = """seen, ord, num, agent, agent_name, dealer, c_name AS dealer_name, priority AS product,
        'COV' || ev.key % 7 AS cov, r_name AS company, activation AS eff,
        12 * (1 + ev.key % 5) AS term,
        ev.key AS key"""

cte("rows2", ["ev", "amounts"], f"""
    SELECT feed, source_id, cstatus, type, activity, {_KEPT},
        CAST(coalesce(admin, 0) * CASE WHEN type = 'Cancellation' THEN 0.5 ELSE 1.0 END
            AS DECIMAL(18,4)) AS admin,
        CAST(coalesce(reserve, 0) * CASE WHEN type = 'Cancellation' THEN 0.5 ELSE 1.0 END
            AS DECIMAL(18,4)) AS reserve,
        CAST(coalesce(gross, 0) * CASE WHEN type = 'Cancellation' THEN 0.5 ELSE 1.0 END
            AS DECIMAL(18,4)) AS gross
    FROM ev LEFT JOIN amounts ON ev.key = amounts.key
    WHERE NOT is_test AND activity <= {END}""")

cte("refs", ["ev", "amounts"], f"""
    SELECT 2 AS feed, source_id || ':written-reference' AS source_id, 'C' AS cstatus,
        'NewBusiness' AS type, activation AS activity, {_KEPT},
        CAST(coalesce(admin, 0) AS DECIMAL(18,4)) AS admin,
        CAST(coalesce(reserve, 0) AS DECIMAL(18,4)) AS reserve,
        CAST(coalesce(gross, 0) AS DECIMAL(18,4)) AS gross
    FROM ev LEFT JOIN amounts ON ev.key = amounts.key
    WHERE feed = 1 AND NOT is_test AND activation <= {END}""")

cte("newest", ["rows2"], """
    SELECT *, min(ord) OVER (PARTITION BY feed, coalesce(nullif(num, ''), source_id)) AS first_ord
    FROM rows2
    QUALIFY row_number() OVER (PARTITION BY feed, coalesce(nullif(num, ''), source_id)
        ORDER BY seen DESC, ord DESC) = 1""")

cte("listed", ["newest", "refs"], """
    SELECT * FROM newest
    UNION ALL
    SELECT *, ord FROM refs WHERE num <> ''
        AND num NOT IN (SELECT num FROM newest WHERE type <> 'Cancellation')
    QUALIFY row_number() OVER (PARTITION BY num ORDER BY ord) = 1""")

cte("tx0", ["listed"], """
    SELECT *, min(feed * 1000000000000 + first_ord) OVER (PARTITION BY
            CASE WHEN num <> '' THEN num || '|' || type ELSE source_id END) AS place
    FROM listed
    QUALIFY row_number() OVER (PARTITION BY
            CASE WHEN num <> '' THEN num || '|' || type ELSE source_id END
        ORDER BY seen DESC, feed DESC, ord DESC) = 1""")


def factor(eff: str, term: str, end: str) -> str:
    el = f"((year({end}) - year({eff})) * 12 + month({end}) - month({eff}) + 1)"
    return (
        f"CASE WHEN {eff} IS NULL THEN CAST(1 AS DECIMAL(14,10)) WHEN {eff} > {end} THEN 0"
        f" WHEN {el} <= {term} THEN CAST(CAST({el} AS DOUBLE) / {term} AS DECIMAL(14,10)) ELSE 1 END"
    )


cte("sides", ["tx0"], """
    SELECT num, sum(reserve) FILTER (WHERE type <> 'Cancellation') AS w,
        sum(abs(reserve)) FILTER (WHERE type = 'Cancellation') AS c,
        arg_max(eff, place) FILTER (WHERE type <> 'Cancellation') AS s_eff,
        arg_max(term, place) FILTER (WHERE type <> 'Cancellation') AS s_term
    FROM tx0 WHERE num <> '' GROUP BY num""")

cte("tx", ["tx0", "sides"], f"""
    SELECT tx0.*, CAST(CASE WHEN type = 'Cancellation' OR tx0.num = '' THEN 0
            WHEN coalesce(c, 0) > 0 AND w > 0 THEN greatest(w - c, 0)
            WHEN w > 0 THEN CAST(w AS DECIMAL(18,4)) * (CASE WHEN cstatus = 'E' THEN 1
                ELSE {factor('s_eff', 's_term', END)} END)
            ELSE 0 END AS DECIMAL(18,4)) AS earned,
        tx0.num <> '' AND row_number() OVER (PARTITION BY tx0.num ORDER BY seen DESC, place DESC) = 1
            AS is_latest
    FROM tx0 LEFT JOIN sides ON tx0.num = sides.num""")

cte("craw", [], """
    SELECT l_orderkey AS key, l_linenumber AS num, CAST(l_shipdate AS DATE) AS ship, j,
        l_quantity, p_name, p_type, p_size,
        concat_ws('-', 'CLM', l_orderkey, l_linenumber, l_partkey, l_suppkey, j) AS source_id,
        l_orderkey * 100 + l_linenumber * 10 + j AS ord,
        CASE WHEN l_orderkey % 107 = 0 THEN '' ELSE 'CL' || l_orderkey || '-' || l_linenumber END
            AS claim_number,
        CASE WHEN l_orderkey % 101 = 0 THEN '' ELSE 'C' || l_orderkey END AS cnum,
        CAST(CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 END
            * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * 0.005 AS DECIMAL(18,2)) AS DECIMAL(18,4))
            AS paid,
        CASE WHEN l_quantity < 3 THEN 'Open' ELSE 'Paid' END AS status,
        CASE WHEN l_orderkey % 113 <> 0 THEN CAST(l_shipdate AS DATE) END AS activity,
        CASE WHEN l_linestatus = 'F' THEN 'S' || l_suppkey ELSE 'Unknown Dealer' END AS dealer,
        CASE WHEN l_linestatus = 'F' THEN 'Shop ' || l_suppkey ELSE '' END AS dealer_name,
        CASE WHEN l_linenumber <= 2 THEN 'NATION_' || l_suppkey % 25 ELSE 'Unassigned' END AS agent,
        CASE WHEN l_linenumber <= 2 THEN 'NATION_' || l_suppkey % 25 || ' Agency' ELSE '' END
            AS agent_name,
        CASE WHEN p_size > 3 THEN 'Cover ' || p_size % 5 ELSE '' END AS coverage_name,
        upper(replace(p_brand, '#', ' ')) AS make,
        CASE WHEN p_size > 2 THEN upper(p_type) ELSE 'UNMAPPED' END AS code,
        CASE WHEN p_size > 5 THEN p_name ELSE 'Description unavailable' END AS descr,
        CAST(l_shipdate AS DATE) + CAST(least(j, 1) AS INTEGER) AS seen
    FROM lineitem JOIN part ON l_partkey = p_partkey, (VALUES (0), (1), (2)) AS s(j)
    WHERE l_returnflag = 'R' AND j <= l_linenumber % 3""")

cte("crow", ["craw"], f"""
    SELECT *, upper(concat_ws('|', claim_number, strftime(ship, '%m/%d/%Y'), '', 'ACH', '',
        CASE WHEN p_size > 2 THEN p_type ELSE '' END, '', CAST(paid AS VARCHAR))) AS payment_key
    FROM craw
    WHERE (status = 'Paid' OR num = 6) AND paid <> 0 AND activity <= {END}""")

cte("cnth", ["crow"], """
    SELECT *, row_number() OVER (PARTITION BY payment_key, seen ORDER BY ord, source_id) AS occurrence
    FROM crow""")

cte("cl", ["cnth"], """
    SELECT *, min(ord) OVER (PARTITION BY payment_key, occurrence) AS place,
        coalesce(nullif(claim_number, ''), source_id) AS cid
    FROM cnth
    QUALIFY row_number() OVER (PARTITION BY payment_key, occurrence
        ORDER BY seen DESC, ord DESC, source_id DESC) = 1""")

cte("horizons", [], """
    SELECT * FROM (VALUES
        ('current_month', DATE '2001-06-01', DATE '2001-06-30'),
        ('prior_month', DATE '2000-06-01', DATE '2000-06-30'),
        ('ytd', DATE '2001-01-01', DATE '2001-06-30'),
        ('prior_ytd', DATE '2000-01-01', DATE '2000-06-30'),
        ('rolling12', DATE '2000-07-01', DATE '2001-06-30'),
        ('prior_rolling12', DATE '1999-07-01', DATE '2000-06-30'),
        ('prior_year', DATE '2000-01-01', DATE '2000-12-31'),
        ('inception', DATE '1995-01-01', DATE '2001-06-30')) AS p(period_id, ps, pe)""")

cte("months24", [], """
    SELECT strftime(m, '%Y-%m') AS period_id, CAST(m AS DATE) AS ps,
        CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS pe
    FROM generate_series(TIMESTAMP '1999-07-01', TIMESTAMP '2001-06-01', INTERVAL 1 MONTH) AS g(m)""")

cte("per", ["horizons", "months24"], "SELECT * FROM horizons UNION ALL SELECT * FROM months24")
cte("per4", ["horizons"], """
    SELECT * FROM horizons WHERE period_id IN ('inception', 'rolling12', 'ytd', 'current_month')""")

# sold contracts for claims: the last new-business row per number, blank included
cte("lookup", ["tx"], """
    SELECT * FROM tx WHERE type = 'NewBusiness'
    QUALIFY row_number() OVER (PARTITION BY num ORDER BY place DESC) = 1""")

cte("g_all", ["tx"], "SELECT 'all' AS dim, 'all' AS v, tx.* FROM tx")
cte("c_all", ["cl"], "SELECT 'all' AS dim, 'all' AS v, true AS direct, cl.* FROM cl")
cte("g_dim", ["tx"], """
    SELECT 'dealer' AS dim, dealer AS v, tx.* FROM tx
    UNION ALL SELECT 'agent', agent, tx.* FROM tx
    UNION ALL SELECT 'product', product, tx.* FROM tx""")
cte("c_dim", ["cl", "lookup"], """
    SELECT * FROM (
        SELECT 'dealer' AS dim, CASE WHEN cl.dealer <> 'Unknown Dealer' THEN cl.dealer
            ELSE lookup.dealer END AS v, cl.dealer <> 'Unknown Dealer' AS direct, cl.*
        FROM cl LEFT JOIN lookup ON cl.cnum = lookup.num
        UNION ALL
        SELECT 'agent', CASE WHEN cl.agent <> 'Unassigned' THEN cl.agent ELSE lookup.agent END,
            cl.agent <> 'Unassigned', cl.* FROM cl LEFT JOIN lookup ON cl.cnum = lookup.num
        UNION ALL
        SELECT 'product', lookup.product, lookup.product IS NOT NULL, cl.*
        FROM cl LEFT JOIN lookup ON cl.cnum = lookup.num)
    WHERE v IS NOT NULL""")


def metric_tables(p: str, tx: str, claims: str, periods: str) -> None:
    """Common tables of one set of metrics, each name starting with ``p``."""
    cte(f"{p}latest", [tx], f"""
        SELECT * FROM {tx} WHERE num <> ''
        QUALIFY row_number() OVER (PARTITION BY dim, v, num ORDER BY seen DESC, place DESC) = 1""")
    sold = "type NOT IN ('Cancellation', 'Unknown')"
    cte(f"{p}state", [tx, periods], f"""
        SELECT period_id, pe, dim, v, num,
            count(*) FILTER (WHERE {sold}) AS nw,
            count(*) FILTER (WHERE type = 'Cancellation') AS nc,
            coalesce(sum(admin) FILTER (WHERE {sold}), 0) AS wa,
            coalesce(sum(reserve) FILTER (WHERE {sold}), 0) AS wr,
            coalesce(sum(gross) FILTER (WHERE {sold}), 0) AS wg,
            coalesce(sum(abs(admin)) FILTER (WHERE type = 'Cancellation'), 0) AS ca,
            coalesce(sum(abs(reserve)) FILTER (WHERE type = 'Cancellation'), 0) AS cr,
            coalesce(sum(abs(gross)) FILTER (WHERE type = 'Cancellation'), 0) AS cg,
            arg_max(key, place) FILTER (WHERE {sold}) AS s_key
        FROM {tx} JOIN {periods} ON activity BETWEEN ps AND pe GROUP BY ALL""")
    eff = f"(CASE WHEN s_key % 97 <> 0 THEN od END)"
    cte(f"{p}sums", [f"{p}state", f"{p}latest", "base"], f"""
        SELECT period_id, s.dim, s.v, count(*) FILTER (WHERE nw > 0) AS contracts_written,
            count(*) FILTER (WHERE nc > 0) AS contracts_cancelled,
            sum(wa) AS admin_written, sum(ca) AS admin_cancelled,
            sum(wr) AS reserve_written, sum(cr) AS reserve_cancelled,
            sum(wg) AS gross_written, sum(cg) AS gross_cancelled,
            coalesce(sum(wa - ca) FILTER (WHERE l.cstatus = 'A' AND l.type <> 'Cancellation'), 0)
                AS net_admin,
            round(sum(CASE WHEN cr > 0 AND wr > 0 THEN CAST(greatest(wr - cr, 0) AS DECIMAL(33,14))
                WHEN wr > 0 THEN CAST(CAST(wr AS DECIMAL(18,4)) * CAST(CASE WHEN l.cstatus = 'E'
                    THEN 1 ELSE {factor(eff, '(12 * (1 + s_key % 5))', 'pe')} END
                    AS DECIMAL(14,10)) AS DECIMAL(33,14))
                ELSE 0 END), 4) AS earned
        FROM {p}state s LEFT JOIN {p}latest l ON s.dim = l.dim AND s.v = l.v AND s.num = l.num
        LEFT JOIN base ON s.s_key = base.key
        GROUP BY 1, 2, 3""")
    cte(f"{p}active", [f"{p}latest", periods], f"""
        SELECT period_id, dim, v, count(*) AS active FROM {p}latest JOIN {periods}
            ON activity BETWEEN ps AND pe
        WHERE cstatus = 'A' AND type <> 'Cancellation' GROUP BY 1, 2, 3""")
    cte(f"{p}paid", [claims, periods], f"""
        SELECT period_id, dim, v, sum(paid) AS claims_paid, count(DISTINCT cid) AS claim_count,
            bool_or(direct) AS direct, arg_min(dealer_name, (place, source_id))
                FILTER (WHERE dealer_name <> '') AS claim_dealer_name
        FROM {claims} JOIN {periods} ON activity BETWEEN ps AND pe GROUP BY 1, 2, 3""")
    cte(f"{p}m0", [f"{p}sums", f"{p}active", f"{p}paid"], f"""
        SELECT coalesce(s.period_id, c.period_id) AS period_id, coalesce(s.dim, c.dim) AS dim,
            coalesce(s.v, c.v) AS v, claim_dealer_name,
            coalesce(contracts_written, 0) AS contracts_written, coalesce(active, 0) AS active_contracts,
            coalesce(contracts_cancelled, 0) AS contracts_cancelled,
            coalesce(admin_written, 0) AS admin_written, coalesce(admin_cancelled, 0) AS admin_cancelled,
            coalesce(net_admin, 0) AS net_admin,
            coalesce(reserve_written, 0) AS reserve_written,
            coalesce(reserve_cancelled, 0) AS reserve_cancelled,
            coalesce(gross_written, 0) AS gross_income_written,
            coalesce(gross_cancelled, 0) AS gross_income_cancelled,
            coalesce(earned, 0) AS earned_reserve,
            coalesce(claims_paid, 0) AS claims_paid, coalesce(claim_count, 0) AS claim_count
        FROM {p}sums s LEFT JOIN {p}active a
            ON s.period_id = a.period_id AND s.dim = a.dim AND s.v = a.v
        FULL JOIN {p}paid c ON s.period_id = c.period_id AND s.dim = c.dim AND s.v = c.v
        WHERE s.period_id IS NOT NULL OR c.direct""")
    cte(f"{p}m", [f"{p}m0"], f"""
        SELECT *, contracts_written - contracts_cancelled AS net_contracts,
            reserve_written - reserve_cancelled AS net_reserve,
            gross_income_written - gross_income_cancelled AS gross_income,
            earned_reserve - claims_paid AS underwriting_profit,
            CASE WHEN earned_reserve > 0 THEN {d('claims_paid')} / {d('earned_reserve')} END
                AS earned_loss_ratio,
            CASE WHEN reserve_written - reserve_cancelled > 0 THEN {d('earned_reserve')}
                / {d('reserve_written - reserve_cancelled')} END AS percent_earned,
            CASE WHEN contracts_written > 0 THEN {d('contracts_cancelled')} / contracts_written END
                AS cancellation_rate,
            CASE WHEN contracts_written > 0 THEN {d('claim_count')} / contracts_written END
                AS claim_frequency,
            CASE WHEN claim_count > 0 THEN {d('claims_paid')} / claim_count END AS claim_severity,
            CASE WHEN active_contracts > 0 THEN {d('net_admin')} / active_contracts END
                AS admin_per_contract
        FROM {p}m0""")


metric_tables("a_", "g_all", "c_all", "per")
metric_tables("d_", "g_dim", "c_dim", "per4")

COUNTS = ["contracts_written", "active_contracts", "contracts_cancelled", "net_contracts", "claim_count"]
VALUES = [
    "admin_written", "admin_cancelled", "net_admin", "reserve_written", "reserve_cancelled",
    "net_reserve", "earned_reserve", "claims_paid", "claim_frequency", "claim_severity",
    "underwriting_profit", "gross_income_written", "gross_income_cancelled", "gross_income",
    "earned_loss_ratio", "percent_earned", "cancellation_rate", "admin_per_contract",
]
ALL23 = ", ".join([f"{n(c)} AS {c}" for c in COUNTS] + [f"{r(c)} AS {c}" for c in VALUES])

# every period, empty ones with zeros
_ZERO = ", ".join(
    f"coalesce({c}, 0) AS {c}"
    for c in COUNTS + [v for v in VALUES if v not in (
        "claim_frequency", "claim_severity", "earned_loss_ratio", "percent_earned",
        "cancellation_rate", "admin_per_contract")]
)
cte("a_all", ["per", "a_m"], f"""
    SELECT per.period_id, ps, pe, {_ZERO}, claim_frequency, claim_severity, earned_loss_ratio,
        percent_earned, cancellation_rate, admin_per_contract
    FROM per LEFT JOIN a_m ON per.period_id = a_m.period_id""")

# names and partners of the dimension tables
cte("d_names", ["g_dim"], """
    SELECT dim, v, arg_min(dealer_name, place) FILTER (WHERE dealer_name <> '') AS dn,
        arg_min(agent_name, place) FILTER (WHERE agent_name <> '') AS an
    FROM g_dim GROUP BY 1, 2""")
cte("d_rel", ["g_dim", "per4"], """
    SELECT period_id, dim, v, list_sort(list(DISTINCT CASE WHEN dim = 'dealer' THEN agent
        ELSE dealer_name END)) AS related
    FROM g_dim JOIN per4 ON activity BETWEEN ps AND pe GROUP BY 1, 2, 3""")
cte("dims", ["d_m", "d_names", "d_rel"], """
    SELECT m.*, CASE m.dim WHEN 'dealer' THEN coalesce(dn, claim_dealer_name)
            WHEN 'agent' THEN coalesce(an, m.v) END AS display_name,
        coalesce(related, []) AS related
    FROM d_m m LEFT JOIN d_names x ON m.dim = x.dim AND m.v = x.v
    LEFT JOIN d_rel y ON m.dim = y.dim AND m.v = y.v AND m.period_id = y.period_id""")

cte("eff", ["tx"], """
    SELECT num, arg_min(eff, place) AS eff FROM tx WHERE eff IS NOT NULL GROUP BY num""")

cte("issues", ["ev", "craw"], f"""
    SELECT 'Warning' AS severity, 'Data Validation' AS category, num, agent, agent_name,
        c_name AS dealer_name, source_id, 'Counted as cancelled: it has a cancellation billing date, whatever its type and status say.' AS message
    FROM ev WHERE NOT is_test AND forced
    UNION ALL
    SELECT 'Error', CASE WHEN type = 'Cancellation' THEN 'Missing Cancel Bill Date'
            ELSE 'Missing Activation Date' END, num, agent, agent_name, c_name, source_id,
        CASE WHEN type = 'Cancellation'
            THEN 'Left out: a cancellation without a readable cancellation billing date.'
            ELSE 'Left out: a sale without a readable activation date.'
        END
    FROM ev WHERE NOT is_test AND activity IS NULL
    UNION ALL
    SELECT 'Error', 'Missing Contract Number', num, agent, agent_name, c_name, source_id,
        'The contract number is empty.'
    FROM ev WHERE NOT is_test AND activity <= {END} AND num = ''
    UNION ALL
    SELECT 'Warning', 'Unknown Transaction', num, agent, agent_name, c_name, source_id,
        'Neither type nor status tells what this is, so no key figure counts it.'
    FROM ev WHERE NOT is_test AND activity <= {END} AND type = 'Unknown'
    UNION ALL
    SELECT 'Error', 'Invalid Claim Date', cnum, agent, agent_name, dealer_name, source_id,
        'A payment without a readable day of payment or report.'
    FROM craw WHERE (status = 'Paid' OR num = 6) AND paid <> 0 AND activity IS NULL""")

_LABEL = "CASE WHEN agent_name <> '' THEN agent_name || ' (' || agent || ')' ELSE agent END"

ORACLE: dict[str, str] = {}

# ---- sources and sinks

ORACLE["contract_scan_pruned"] = f"""
    SELECT {n('o_orderkey')} AS o_orderkey, o_orderstatus, c_mktsegment AS segment,
        {t('CAST(o_orderdate AS DATE)')} AS o_orderdate
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= DATE '2000-01-01'"""

cte("jobs", [], """
    SELECT 'Contract' AS job, count(*) AS portal, NULL AS uniq, count(*) AS done, true AS ok,
        'PASSED' AS status FROM orders
    UNION ALL SELECT 'Cancel', count(*), count(*), count(*), true, 'PASSED' FROM orders
        WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'Claim', count(*), count(*) + 1, count(*) + 1, false, 'DISCREPANCY'
        FROM lineitem WHERE l_returnflag = 'R'""")

_AUDIT = f"""job AS job_type, '2001-07-01' AS execution_timestamp, '1995-01-01' AS start_date,
    '2001-06-30' AS end_date, {n('portal')} AS portal_count, %s AS unique_count,
    {n('done')} AS processed_count, {n('done')} AS uploaded_count, {n('ok')} AS is_match, %s
    status, lower(job) || '-1.csv' AS file_name"""
ORACLE["latest_audit"] = sql(["jobs"], "SELECT " + _AUDIT % (
    n("uniq"),
    f"{n('done - portal')} AS portal_vs_processed_diff, {n('0')} AS processed_vs_uploaded_diff,",
) + " FROM jobs")
ORACLE["audit_table"] = sql(["jobs"], "SELECT " + _AUDIT % (
    n("coalesce(uniq, done)"), f"'' AS summary, {n('done - portal')} AS variance,"
) + " FROM jobs")

ORACLE["audit_reconciliation"] = sql(["jobs"], f"""
    SELECT job AS job_type, {n('portal')} AS portal_count, {n('coalesce(uniq, done)')} AS unique_units,
        {n('done')} AS uploaded_count, {n('coalesce(uniq, done) - portal')} AS unit_variance,
        lower(job) || '-1.csv' AS file_name,
        CASE WHEN ok OR abs(coalesce(uniq, done) - portal)
            <= greatest(2, floor(portal * 0.001 + 0.5)) THEN 'PASSED' ELSE status END AS status
    FROM jobs""")

cte("ingested", ["rows2", "crow"], """
    SELECT 'Contract' AS job, count(*) AS ing FROM rows2 WHERE type <> 'Cancellation'
    UNION ALL SELECT 'Cancel', count(*) FROM rows2 WHERE type = 'Cancellation'
    UNION ALL SELECT 'Claim', count(*) FROM crow""")
ORACLE["volumetric_integrity"] = sql(["jobs", "ingested"], f"""
    SELECT jobs.job AS job_type, {n('portal')} AS portal_count, {n('done')} AS uploaded_count,
        {n('ing')} AS ingested, {n('ing - done')} AS variance,
        CASE WHEN ing = done AND ok THEN 'PASSED' ELSE 'DISCREPANCY' END AS status
    FROM jobs JOIN ingested ON jobs.job = ingested.job""")
ORACLE["volumetric_clean"] = sql(["jobs", "ingested"], f"""
    SELECT {n('bool_and(ing = done AND ok)')} AS is_clean
    FROM jobs JOIN ingested ON jobs.job = ingested.job""")

ORACLE["source_counts"] = sql(["docs", "craw", "tx", "cl", "issues"], f"""
    SELECT 'Contract source documents' AS stage, {n('count(*)')} AS documents FROM docs WHERE feed = 0
    UNION ALL SELECT 'Cancellation source documents', count(*) FROM docs WHERE feed = 1
    UNION ALL SELECT 'Claim source documents', count(*) FROM craw
    UNION ALL SELECT 'Unique normalized contract transactions', count(*) FROM tx
    UNION ALL SELECT 'Unique paid claim transactions', count(*) FROM cl
    UNION ALL SELECT 'Data-quality issues', count(*) FROM issues""")

ORACLE["parquet_round_trip"] = sql(["tx", "cl"], f"""
    SELECT 'contracts' AS name, {n('year(activity)')} AS y, {n('count(*)')} AS n,
        {r('sum(reserve)')} AS amount, {n('0')} AS lost FROM tx GROUP BY 2
    UNION ALL SELECT 'claims', {n('year(activity)')}, {n('count(*)')}, {r('sum(paid)')}, {n('0')}
    FROM cl GROUP BY 2""")


cte("prc", [], """
    SELECT l_orderkey * 10 + l_linenumber AS ord,
        concat_ws('-', 'C' || l_orderkey, l_linenumber, l_partkey, l_suppkey) AS contract_no,
        c_name AS dealer_name, 'D' || c_custkey AS dealer_number, 'City ' || c_custkey % 10 AS city,
        CASE WHEN c_custkey % 13 <> 0 THEN n_name ELSE '' END AS state,
        lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS zip,
        p_type || '-' || l_partkey % 9 AS code, p_type AS ptype,
        CASE WHEN l_discount = 0 THEN 0
            ELSE CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) END AS markup,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS retail,
        CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
cte("pr", ["prc"], """
    SELECT *, state IN ('NATION_7', 'NATION_8') OR left(zip, 2) IN ('32', '33', '34') AS in_market,
        state LIKE 'NATION\\_7%' ESCAPE '\\' AS in_state,
        regexp_matches(state, '^NATION_(7|8)') AS named, regexp_matches(zip, '^(32|33|34)') AS zipped
    FROM prc""")
cte("mkt", ["pr"], "SELECT * FROM pr WHERE in_market")
cte("sta", ["pr"], "SELECT * FROM pr WHERE in_state")

ORACLE["csv_round_trip"] = sql(["mkt"], f"""
    SELECT coverage_code, {n('count(*)')} AS n, {r('sum(mx)')} AS amount
    FROM (SELECT dealer_name, dealer_number, code AS coverage_code, max(markup) AS mx
        FROM mkt GROUP BY 1, 2, 3) GROUP BY 1""")

ORACLE["sql_parameterised"] = f"""
    SELECT o_orderstatus, {n('count(*)')} AS n, {t('CAST(min(o_orderdate) AS DATE)')} AS first_day
    FROM orders WHERE o_orderdate >= DATE '1999-01-01' AND o_orderpriority = '2-HIGH' GROUP BY 1"""

# ---- normalisation

ORACLE["normalize_ids_numbers_dates"] = f"""
    SELECT {n('o_orderkey')} AS key, 'C' || o_orderkey || 'X' AS business_id,
        {r('''CASE o_orderkey % 6 WHEN 0 THEN o_orderkey + 0.5 WHEN 1 THEN o_orderkey
            WHEN 5 THEN -(o_orderkey + 0.125) ELSE 0 END''')} AS amount,
        CASE WHEN o_orderkey % 5 < 3 THEN {t('CAST(o_orderdate AS DATE)')} END AS day,
        {t('CAST(o_orderdate AS DATE)')} AS oid_day, CAST(NULL AS VARCHAR) AS no_oid_day
    FROM orders"""

ORACLE["classify_tx"] = sql(["ev"], f"""
    SELECT {n('feed')} AS feed, own_type, type AS transaction_type, {n('count(*)')} AS n,
        {n('count(*) FILTER (WHERE forced)')} AS forced,
        {n('count(*) FILTER (WHERE is_test)')} AS test_rows,
        {n('count(*) FILTER (WHERE activity IS NULL)')} AS undated
    FROM ev GROUP BY feed, own_type, type""")

ORACLE["contract_normalize"] = sql(["rows2", "refs"], f"""
    SELECT {n('feed')} AS feed, source_id, {t('seen')} AS snapshot_ts, num AS contract_number,
        cstatus AS contract_status, type AS transaction_type, {t('activity')} AS activity_date,
        {t('eff')} AS effective_date, agent, dealer, product, company, {r('admin')} AS admin_amount,
        {r('reserve')} AS reserve_amount, {r('gross')} AS gross_income_amount,
        {n('1')} AS has_schedule, {n('term')} AS schedule_last_month, {n('term')} AS schedule_months,
        {d('1')} AS last_factor
    FROM (SELECT * FROM rows2 UNION ALL SELECT * FROM refs)""")

ORACLE["dimension_defaults"] = f"""
    SELECT {n('o_orderkey')} AS key, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority
            WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'Unassigned' END AS contract_side,
        CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority WHEN o_orderkey % 3 = 0 THEN 'Unassigned'
            WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'Unassigned' END AS claim_side
    FROM orders"""

ORACLE["claim_normalize"] = sql(["crow"], f"""
    SELECT source_id, {t('seen')} AS snapshot_ts, payment_key, claim_number, cnum AS contract_number,
        {t('activity')} AS activity_date, status, {r('paid')} AS paid_amount, agent,
        dealer, dealer_name, 'Unmapped Product Type' AS product, coverage_name,
        make AS vehicle_make, code AS loss_code, descr AS loss_description FROM crow""")

KPIS = ["contracts_written", "active_contracts", "contracts_cancelled", "gross_income", "net_admin",
        "admin_per_contract", "net_reserve", "earned_reserve", "claims_paid", "underwriting_profit",
        "earned_loss_ratio", "percent_earned", "cancellation_rate"]
cte("kpi", ["a_all"], " UNION ALL ".join(
    f"SELECT period_id, '{k}' AS kpi, coalesce({d(k)}, 0) AS value FROM a_all" for k in KPIS))
cte("pairs", ["kpi"], """
    SELECT c.period_id AS horizon, c.kpi, c.value AS cur, p.value AS pri
    FROM kpi c JOIN kpi p ON c.kpi = p.kpi AND (c.period_id, p.period_id) IN
        (('current_month', 'prior_month'), ('ytd', 'prior_ytd'), ('rolling12', 'prior_rolling12'))""")
ORACLE["kpi_variance_flags"] = sql(["pairs"], f"""
    SELECT horizon, kpi, {r('cur')} AS current_value, {r('pri')} AS prior_value,
        {r('cur - pri')} AS change,
        {r('CASE WHEN pri <> 0 THEN (cur - pri) / abs(pri) END')} AS change_pct,
        {n('''CASE WHEN pri <> 0 AND cur <> pri THEN (cur > pri) <> (kpi IN
            ('earned_loss_ratio', 'cancellation_rate', 'claims_paid')) END''')} AS change_is_good,
        {n("kpi = 'admin_per_contract' AND cur > 0 AND cur < 20")} AS low_admin_flag
    FROM pairs""")
ORACLE["period_snapshot_kpis"] = sql(["kpi"], f"""
    SELECT period_id, kpi, {r('value')} AS value,
        {n("kpi = 'admin_per_contract' AND value > 0 AND value < 20")} AS low_admin_flag
    FROM kpi WHERE period_id IN ('prior_year', 'inception')""")

ORACLE["loss_ratio_bands"] = sql(["dims"], f"""
    SELECT v AS dim_value, {r('earned_loss_ratio')} AS earned_loss_ratio,
        CASE WHEN earned_loss_ratio IS NULL THEN 'none' WHEN earned_loss_ratio >= 1 THEN 'red'
            WHEN earned_loss_ratio >= 0.85 THEN 'amber' ELSE 'green' END AS band,
        CASE WHEN earned_loss_ratio > 0.9 THEN 'high' WHEN earned_loss_ratio >= 0.75 THEN 'warning'
            ELSE 'normal' END AS alert,
        {n('coalesce(admin_per_contract > 0 AND admin_per_contract < 20, false)')} AS low_admin
    FROM dims WHERE dim = 'dealer' AND period_id = 'rolling12'""")

# ---- components

ORACLE["component_amounts"] = sql(["rows2"], f"""
    SELECT {n('feed')} AS feed, product, {r('sum(admin)')} AS admin, {r('sum(reserve)')} AS reserve,
        {r('sum(gross)')} AS gross FROM rows2 GROUP BY feed, product""")

ORACLE["component_exclusions"] = f"""
    SELECT cat AS category, ' ' || name AS name, {n('count(*)')} AS n, {r('sum(amt)')} AS amount,
        {n('''name IN ('DEALERCOMM', 'ADMIN', 'CLIPFEE', 'OEM TRANSPORT 1', 'LOANPMT', 'F&I FEE')''')}
            AS not_reserve,
        {n('''name IN ('DEALERCOMM', 'PREMTAX', 'LOANPMT', 'F&I FEE', 'roadside akmc x')''')}
            AS not_admin,
        {n('''name IN ('DEALERCOMM', 'LOANPMT', 'F&I FEE')''')} AS not_gross
    FROM (SELECT CASE WHEN l_linestatus = 'F' THEN 'RESERVE' ELSE 'ADMIN' END AS cat,
        ['DEALERCOMM', 'ADMIN', 'SURCHARGE', 'CLIPFEE', 'PREMTAX', 'OEM TRANSPORT 1', 'LOANPMT',
            'F&I FEE', 'roadside akmc x', 'BASE'][CAST(l_orderkey % 10 + 1 AS INTEGER)] AS name,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * 0.01 AS DECIMAL(18,2)) AS amt
        FROM lineitem WHERE l_returnflag <> 'R') GROUP BY 1, 2, cat, name"""

cte("txc", ["tx", "comp"], """
    SELECT tx.*, cat, comp,
        CAST(amt * CASE WHEN type = 'Cancellation' THEN 0.5 ELSE 1.0 END AS DECIMAL(18,4)) AS amt
    FROM tx JOIN comp ON tx.key = comp.key""")
_CELLS = [(c, x) for c, b in (("ADMIN", "BASEADMIN"), ("RESERVE", "BASERESERVE"))
          for x in ("ADMIN", b, "DEALERCOMM", "SURCHARGE")]
ORACLE["component_pivot"] = sql(["tx", "comp", "txc"], "SELECT a.*, " + ", ".join(
    f"coalesce({c.lower()}_{x.lower()}, 0) AS {c.lower()}_{x.lower()}" for c, x in _CELLS) + """
    FROM (SELECT DISTINCT type AS transaction_type, product FROM tx) a LEFT JOIN (
    SELECT type, product, """ + ", ".join(
    r(f"sum(amt) FILTER (WHERE cat = '{c}' AND comp = '{x}')") + f" AS {c.lower()}_{x.lower()}"
    for c, x in _CELLS) + """
    FROM txc GROUP BY type, product) b
    ON a.transaction_type = b.type AND a.product = b.product""")

ORACLE["undeclared_components"] = sql(["txc"], f"""
    SELECT cat AS category, comp AS component, {n('count(*)')} AS n, {r('sum(amt)')} AS amount
    FROM txc WHERE comp = 'SURCHARGE' GROUP BY 1, 2""")

_W = "sum(CASE WHEN type = 'Cancellation' THEN 0 ELSE amt END)"
_C = "sum(CASE WHEN type = 'Cancellation' THEN -abs(amt) ELSE 0 END)"
cte("ek0", ["dims"], """
    SELECT dim, v, coalesce(display_name, '') AS shown, net_admin, net_reserve FROM dims
    WHERE dim <> 'product' AND period_id = 'inception'""")
cte("ek", ["ek0"], """
    SELECT dim, entity, upper(trim(key)) AS key FROM (
        SELECT dim, v AS entity, v AS key FROM ek0
        UNION SELECT dim, v, shown FROM ek0
        UNION SELECT dim, shown, shown FROM ek0 WHERE dim = 'dealer'
        UNION SELECT dim, shown, arg_max(v, (-net_admin, -net_reserve, v)) FROM ek0
            WHERE dim = 'dealer' GROUP BY 1, 2)
    WHERE entity <> '' AND trim(key) <> '' GROUP BY ALL""")
for _dim in ("dealer", "agent"):
    for _rows in ("tx", "cl", "txc"):
        cte(f"{_rows}_{_dim}", [_rows, "ek"], f"""
            SELECT DISTINCT ek.entity, t.* FROM {_rows} t JOIN ek
            ON ek.dim = '{_dim}' AND ek.key IN (upper(t.{_dim}), upper(t.{_dim}_name))""")
ORACLE["component_buckets"] = sql(["txc_dealer", "txc_agent"], " UNION ALL ".join(f"""
    SELECT '{x}' AS dim, entity, cat AS category, comp AS component, {r(_W)} AS written,
        {r(_C)} AS cancelled, {r(f'{_W} + {_C}')} AS net FROM txc_{x} GROUP BY entity, cat, comp"""
    for x in ("dealer", "agent")))
ORACLE["entity_keys"] = sql(["ek"], "SELECT dim, entity, key FROM ek")
cte("act", ["tx"], """
    SELECT num FROM tx QUALIFY row_number() OVER (PARTITION BY num ORDER BY seen DESC, place DESC) = 1
        AND cstatus = 'A' AND type <> 'Cancellation'""")
cte("inc", ["txc", "act"], f"""
    SELECT cat AS category, comp AS component, {_W} AS written, {_C} AS cancelled, {_W} + {_C} AS net
    FROM txc WHERE comp <> 'DEALERCOMM' AND ((cat = 'RESERVE' AND comp <> 'ADMIN')
        OR (cat = 'ADMIN' AND num IN (SELECT num FROM act)))
    GROUP BY 1, 2 HAVING {_W} + {_C} <> 0 OR {_W} <> 0""")
ORACLE["included_components"] = sql(["inc"], f"""
    SELECT category, component, {r('written')} AS written, {r('cancelled')} AS cancelled,
        {r('net')} AS net FROM inc
    UNION ALL SELECT category, 'TOTAL', {r('sum(written)')}, {r('sum(cancelled)')}, {r('sum(net)')}
    FROM inc GROUP BY category""")
cte("gro", ["txc"], f"""
    SELECT comp = 'DEALERCOMM' AS ex, cat AS category, comp AS component, {_W} AS written,
        {_C} AS cancelled, {_W} + {_C} AS net FROM txc GROUP BY 1, 2, 3""")
ORACLE["gross_income_components"] = sql(["gro"], f"""
    SELECT {n('ex')} AS is_excluded, category, component, {r('written')} AS written,
        {r('cancelled')} AS cancelled, {r('net')} AS net FROM gro
    UNION ALL SELECT {n('ex')}, 'TOTAL', 'TOTAL', {r('sum(written)')}, {r('sum(cancelled)')},
        {r('sum(net)')} FROM gro GROUP BY ex""")

# ---- dedupe, joins

ORACLE["dedupe_two_feeds"] = sql(["newest"], f"""
    SELECT {n('feed')} AS feed, coalesce(nullif(num, ''), source_id) AS key, source_id,
        {t('seen')} AS snapshot_ts, type AS transaction_type FROM newest""")
ORACLE["transaction_list"] = sql(["tx"], f"""
    SELECT source_id, num AS contract_number, cstatus AS contract_status, type AS transaction_type,
        {t('activity')} AS activity_date, dealer, {r('reserve')} AS reserve_amount,
        {n('is_latest')} AS is_latest_state FROM tx""")
ORACLE["written_reference"] = sql(["tx"], f"""
    SELECT source_id, num AS contract_number, cstatus AS contract_status,
        {t('activity')} AS activity_date, {r('reserve')} AS reserve_amount FROM tx WHERE feed = 2""")
ORACLE["dedupe_claims_dup"] = sql(["cl"], f"""
    SELECT payment_key, {n('occurrence')} AS occurrence, source_id, {t('seen')} AS snapshot_ts,
        {r('paid')} AS paid_amount, {t('activity')} AS activity_date FROM cl""")
ORACLE["sql_dedupe_views"] = sql(["rows2", "crow"], f"""
    SELECT 'contract' AS kind, source_id, {t('seen')} AS snapshot_ts FROM (SELECT * FROM rows2
        WHERE num <> '' QUALIFY row_number() OVER (PARTITION BY num, type
            ORDER BY seen DESC, feed DESC, ord DESC) = 1)
    UNION ALL SELECT 'claim', source_id, {t('seen')} FROM (SELECT * FROM crow
        QUALIFY row_number() OVER (PARTITION BY payment_key
            ORDER BY seen DESC, ord DESC, source_id DESC) = 1)""")
ORACLE["latest_state"] = sql(["tx"], f"""
    SELECT cstatus AS contract_status, type AS transaction_type, {n('count(*)')} AS contracts,
        {r('sum(reserve)')} AS reserve FROM tx WHERE is_latest GROUP BY 1, 2""")
ORACLE["claim_contract_lookup"] = sql(["cl", "lookup"], """
    SELECT cl.source_id, l.product, l.agent, l.dealer
    FROM cl LEFT JOIN lookup l ON cl.cnum = l.num""")
cte("wlookup", ["tx"], """
    SELECT * FROM tx WHERE num <> '' AND type <> 'Cancellation'
    QUALIFY row_number() OVER (PARTITION BY num ORDER BY place DESC) = 1""")
ORACLE["written_product_lookup"] = sql(["cl", "wlookup"], f"""
    SELECT l.product, {n('count(*)')} AS line_count, {r('sum(paid)')} AS paid
    FROM cl LEFT JOIN wlookup l ON cl.cnum = l.num GROUP BY 1""")
ORACLE["entity_fanout"] = sql(["tx"], f"""
    SELECT entity, {n('count(*)')} AS n, {r('sum(reserve)')} AS reserve FROM (
        SELECT upper(agent) AS entity, source_id, reserve FROM tx
        UNION SELECT upper(agent_name), source_id, reserve FROM tx) GROUP BY 1""")
ORACLE["entity_union"] = sql(["dims"], """
    SELECT dim, v AS dim_value, string_agg(period_id, ',' ORDER BY period_id) AS horizons
    FROM (SELECT dim, v, period_id FROM dims WHERE dim <> 'product'
        UNION SELECT dim, display_name, period_id FROM dims WHERE dim = 'dealer' AND display_name <> '')
    GROUP BY 1, 2""")
ORACLE["effective_lookup"] = sql(["eff"], f"""
    SELECT num AS contract_number, {t('eff')} AS effective_date FROM eff""")

# ---- calendar

ORACLE["period_spine"] = sql(["per", "tx"], f"""
    SELECT period_id, {t('ps')} AS period_start, {t('pe')} AS period_end,
        {n('count(num)')} AS transactions
    FROM per LEFT JOIN tx ON activity BETWEEN ps AND pe GROUP BY period_id, ps, pe""")
_MS_ELAPSED = n("datediff('month', ps, DATE '2001-06-30') + 1")
ORACLE["month_spine"] = sql(["months24", "tx"], f"""
    SELECT period_id, {t('ps')} AS period_start, {t('pe')} AS period_end,
        {n('count(num)')} AS transactions,
        CASE WHEN count(num) > 0 THEN {_MS_ELAPSED} END AS elapsed
    FROM months24 LEFT JOIN tx ON activity BETWEEN ps AND pe GROUP BY period_id, ps, pe""")

# ---- period metrics

_PERIOD = f"""SELECT a.period_id, {t('a.ps')} AS period_start, {t('a.pe')} AS period_end, {ALL23}
    FROM a_all a"""
ORACLE["period_metrics_core"] = sql(["a_all"], f"{_PERIOD} WHERE a.period_id = 'current_month'")
ORACLE["period_metrics_all"] = sql(
    ["a_all", "horizons"], f"{_PERIOD} WHERE a.period_id IN (SELECT period_id FROM horizons)")
ORACLE["monthly_trend"] = sql(
    ["a_all", "months24"], f"{_PERIOD} WHERE a.period_id IN (SELECT period_id FROM months24)")

_TREND = ["net_reserve", "earned_reserve", "claims_paid", "earned_loss_ratio", "percent_earned",
          "net_admin"]
_MONTHS = ["2000-07", "2000-08", "2000-09", "2000-10", "2000-11", "2000-12", "2001-01", "2001-02",
           "2001-03", "2001-04", "2001-05", "2001-06", "inception"]
ORACLE["trend_matrix"] = sql(["kpi"], "SELECT kpi, " + ", ".join(
    r(f"max(value) FILTER (WHERE period_id = '{p}')") + f" AS m_{p.replace('-', '_')}"
    for p in _MONTHS) + " FROM kpi WHERE kpi IN (" + ", ".join(f"'{k}'" for k in _TREND)
    + ") GROUP BY kpi")

ORACLE["horizon_scorecard"] = sql(["a_all"], f"""
    SELECT CASE period_id WHEN 'current_month' THEN 'Current Month' WHEN 'ytd' THEN 'Year to Date'
            WHEN 'rolling12' THEN 'Rolling 12-Month' WHEN 'prior_year' THEN 'Prior Calendar Year'
            ELSE 'Inception to Date' END AS name,
        {n('contracts_written')} AS contracts_written, {r('net_reserve')} AS net_reserve,
        {r('earned_reserve')} AS earned_reserve, {r('claims_paid')} AS claims_paid,
        {r('coalesce(earned_loss_ratio, 0)')} AS loss_ratio, {r('percent_earned')} AS percent_earned,
        CASE WHEN coalesce(earned_loss_ratio, 0) <= 0.75 THEN 'Profitable (<65%)'
            WHEN earned_loss_ratio <= 0.9 THEN 'Warning Zone (65-80%)' ELSE 'Adverse (>80%)' END
            AS status
    FROM a_all WHERE period_id IN ('current_month', 'ytd', 'rolling12', 'prior_year', 'inception')""")

cte("sv_c", ["rows2"], """
    SELECT * FROM rows2 WHERE num <> '' QUALIFY row_number() OVER (PARTITION BY num, type
        ORDER BY seen DESC, feed DESC, ord DESC) = 1""")
cte("sv_l", ["rows2"], """
    SELECT * FROM rows2 WHERE num <> '' QUALIFY row_number() OVER (PARTITION BY num
        ORDER BY seen DESC, feed DESC, ord DESC) = 1""")
cte("sv_p", ["crow"], """
    SELECT *, coalesce(nullif(claim_number, ''), source_id) AS cid FROM crow
    QUALIFY row_number() OVER (PARTITION BY payment_key
        ORDER BY seen DESC, ord DESC, source_id DESC) = 1""")
_K = "type = 'Cancellation'"
cte("sv_0", ["horizons", "sv_c", "sv_l", "sv_p"], f"""
    SELECT h.period_id, ps, pe, contracts_written, contracts_cancelled, active_contracts,
        contracts_written - contracts_cancelled AS net_contracts, admin_written, admin_cancelled,
        net_admin, reserve_written, reserve_cancelled, reserve_written - reserve_cancelled AS net_reserve,
        reserve_written - reserve_cancelled AS earned_reserve, claims_paid, claim_count,
        reserve_written - reserve_cancelled - claims_paid AS underwriting_profit,
        gross_income_written, gross_income_cancelled,
        gross_income_written - gross_income_cancelled AS gross_income
    FROM horizons h JOIN (SELECT period_id,
            count(DISTINCT CASE WHEN NOT {_K} THEN num END) AS contracts_written,
            count(DISTINCT CASE WHEN {_K} THEN num END) AS contracts_cancelled,
            sum(CASE WHEN {_K} THEN 0 ELSE admin END) AS admin_written,
            sum(CASE WHEN {_K} THEN abs(admin) ELSE 0 END) AS admin_cancelled,
            sum(CASE WHEN {_K} THEN 0 ELSE reserve END) AS reserve_written,
            sum(CASE WHEN {_K} THEN abs(reserve) ELSE 0 END) AS reserve_cancelled,
            sum(CASE WHEN {_K} THEN 0 ELSE gross END) AS gross_income_written,
            sum(CASE WHEN {_K} THEN abs(gross) ELSE 0 END) AS gross_income_cancelled
        FROM horizons JOIN sv_c ON activity BETWEEN ps AND pe GROUP BY 1) a
        ON h.period_id = a.period_id
    JOIN (SELECT period_id, count(*) AS active_contracts, sum(admin) AS net_admin
        FROM horizons JOIN sv_l ON activity BETWEEN ps AND pe AND cstatus = 'A' AND NOT {_K}
        GROUP BY 1) b ON h.period_id = b.period_id
    JOIN (SELECT period_id, sum(paid) AS claims_paid, count(DISTINCT cid) AS claim_count
        FROM horizons JOIN sv_p ON activity BETWEEN ps AND pe GROUP BY 1) c
        ON h.period_id = c.period_id""")
cte("sv", ["sv_0"], f"""
    SELECT *, {d('claims_paid')} / {d('earned_reserve')} AS earned_loss_ratio, 1.0 AS percent_earned,
        {d('contracts_cancelled')} / contracts_written AS cancellation_rate,
        {d('claim_count')} / contracts_written AS claim_frequency,
        {d('claims_paid')} / claim_count AS claim_severity,
        {d('net_admin')} / active_contracts AS admin_per_contract FROM sv_0""")
ORACLE["sql_service_metrics"] = sql(["sv"], f"""
    SELECT period_id, {t('ps')} AS period_start, {t('pe')} AS period_end, {ALL23} FROM sv""")

ORACLE["earned_by_tx"] = sql(["tx"], f"""
    SELECT source_id, num AS contract_number, {r('earned')} AS earned_reserve_amount FROM tx""")

_ME = "(agent IN ('NATION_3', 'nation_3') OR agent_name = 'NATION_3 Agency')"
cte("mine", ["tx"], f"SELECT * FROM tx WHERE {_ME}")
_EL = ("CASE WHEN eff > DATE '2001-06-30' THEN 0 ELSE (2001 - year(eff)) * 12 + 6 - month(eff) + 1 END")
ORACLE["earned_detail"] = sql(["mine"], f"""
    SELECT num AS contract_number, product, type AS transaction_type,
        {r("CASE WHEN type = 'Cancellation' THEN 0 ELSE reserve END")} AS written,
        {r("CASE WHEN type = 'Cancellation' THEN reserve ELSE 0 END")} AS cancelled,
        {r('reserve')} AS net, {r('earned')} AS earned,
        {r(f"CASE WHEN reserve <> 0 THEN {d('earned')} / {d('abs(reserve)')} END")} AS factor,
        {n(_EL)} AS elapsed, {n('1')} AS has_schedule
    FROM mine
    UNION ALL
    SELECT NULL, NULL, 'TOTALS (' || count(*) FILTER (WHERE type <> 'Cancellation')
            || ' written contracts, ' || count(*) FILTER (WHERE type = 'Cancellation')
            || ' cancellations)',
        {r("sum(reserve) FILTER (WHERE type <> 'Cancellation')")}, 0,
        {r("sum(reserve) FILTER (WHERE type <> 'Cancellation')")}, {r('sum(earned)')},
        {r(f'''{d('sum(earned)')} / {d("sum(reserve) FILTER (WHERE type <> 'Cancellation')")}''')},
        NULL, NULL
    FROM mine""")

cte("reach", ["cl", "wlookup"], f"""
    SELECT cl.* FROM cl LEFT JOIN wlookup l ON cl.cnum = l.num
    WHERE cl.agent = 'NATION_3' OR l.agent = 'NATION_3' OR l.agent_name = 'NATION_3 Agency'""")
ORACLE["reconciliation_steps"] = sql(["mine", "reach"], f"""
    SELECT step, name, {r('amount')} AS amount, {r('detail')} AS detail, {r('w')} AS written,
        {r('c')} AS cancelled, {r('greatest(w - c - e, 0)')} AS unearned
    FROM (SELECT {d("sum(reserve) FILTER (WHERE type <> 'Cancellation')")} AS w,
            {d("coalesce(sum(reserve) FILTER (WHERE type = 'Cancellation'), 0)")} AS c,
            {d('sum(earned)')} AS e FROM mine) a,
        (SELECT {d('sum(paid)')} AS p, count(DISTINCT cid) AS k FROM reach) b,
        LATERAL (VALUES (CAST(1 AS BIGINT), 'NET RESERVE', w - c, CAST(NULL AS DOUBLE)),
            (2, 'EARNED RESERVE', e, CASE WHEN w - c > 0 THEN e / (w - c) END),
            (3, 'CLAIMS PAID', p, CAST(k AS DOUBLE)), (4, 'UNDERWRITING PROFIT', e - p, NULL),
            (5, 'EARNED LOSS RATIO', CASE WHEN e > 0 THEN p / e END, NULL))
            AS s(step, name, amount, detail)""")

# ---- dimensions

_DIM = f"v AS dim_value, period_id, {ALL23}"
ORACLE["incremental_metrics"] = ORACLE["period_metrics_all"]

ORACLE["dealer_metrics"] = sql(["dims"], f"""
    SELECT {_DIM}, display_name, array_to_string(related, '|') AS related_agents
    FROM dims WHERE dim = 'dealer'""")
ORACLE["agent_metrics"] = sql(["dims"], f"""
    SELECT {_DIM}, display_name, array_to_string(related, '|') AS related_dealers
    FROM dims WHERE dim = 'agent'""")
ORACLE["product_metrics"] = sql(["dims"], f"SELECT {_DIM} FROM dims WHERE dim = 'product'")
ORACLE["claim_attribution"] = sql(["c_dim"], f"""
    SELECT dim, v AS dim_value, {n('direct')} AS is_direct, {n('count(*)')} AS line_count,
        {r('sum(paid)')} AS paid FROM c_dim GROUP BY dim, v, direct""")
ORACLE["topn_tables"] = sql(["dims"], f"""
    SELECT dim, period_id, {n('rk')} AS rank, v AS dim_value, {r('net_admin')} AS net_admin,
        {r('net_reserve')} AS net_reserve, {r('cancellation_rate')} AS cancellation_rate
    FROM (SELECT *, row_number() OVER (PARTITION BY dim, period_id
            ORDER BY net_admin DESC, net_reserve DESC, v) AS rk FROM dims)
    WHERE period_id <> 'inception' AND (dim <> 'dealer' OR rk <= 20)""")
ORACLE["top_dealers_sql"] = sql(["sv_c"], f"""
    SELECT dealer AS dealer_number, dealer_name, """ + ", ".join(
    f"{r(f'sum(CASE WHEN {_K} THEN 0 ELSE {a} END)')} AS {a}_written,"
    f" {r(f'sum(CASE WHEN {_K} THEN abs({a}) ELSE 0 END)')} AS {a}_cancelled,"
    f" {r(f'sum(CASE WHEN {_K} THEN -abs({a}) ELSE {a} END)')} AS net_{a}"
    for a in ("reserve", "admin")) + """
    FROM sv_c WHERE activity BETWEEN DATE '2000-07-01' AND DATE '2001-06-30'
    GROUP BY 1, 2 ORDER BY net_reserve DESC, 1, 2 LIMIT 20""")


def worst(extra: str) -> str:
    cond = f"earned_reserve > 0 AND claims_paid > 0 AND (contracts_written >= 5 OR active_contracts >= 5{extra})"
    return f"""(SELECT *, row_number() OVER (ORDER BY earned_loss_ratio DESC, v) AS rk FROM dims
        WHERE dim = 'dealer' AND period_id = 'inception' AND {cond}) WHERE rk <= 20"""


ORACLE["worst_dealers_dashboard"] = sql(["dims"], f"""
    SELECT {n('rk')} AS rank, coalesce(display_name, v) AS dealer_name,
        array_to_string(related, '|') AS related_agents, {n('active_contracts')} AS active_contracts,
        {r('claim_frequency')} AS claim_frequency, {r('claim_severity')} AS claim_severity,
        {r('net_admin')} AS net_admin, {r('earned_reserve')} AS earned_reserve,
        {r('earned_loss_ratio')} AS earned_loss_ratio, {r('percent_earned')} AS percent_earned
    FROM {worst(' OR net_contracts >= 5')}""")
ORACLE["worst_dealers_snapshot"] = sql(["dims"], f"""
    SELECT {n('rk')} AS rank, coalesce(display_name, v) AS dealer_name,
        {n('active_contracts')} AS active_contracts, {n('contracts_written')} AS contracts_written,
        {r('net_reserve')} AS net_reserve, {r('earned_reserve')} AS earned_reserve,
        {r('claims_paid')} AS claims_paid, {r('underwriting_profit')} AS underwriting_profit,
        {r('earned_loss_ratio')} AS earned_loss_ratio FROM {worst('')}""")

cte("dlr", ["dims"], "SELECT * FROM dims WHERE dim = 'dealer' AND period_id = 'inception'")
cte("byname", ["dlr"], """
    SELECT * FROM (SELECT v AS nm, * FROM dlr UNION SELECT display_name, * FROM dlr)
    WHERE nm IS NOT NULL QUALIFY row_number() OVER (PARTITION BY nm
        ORDER BY net_admin, net_reserve, v DESC) = 1""")
ORACLE["sub_dealers"] = sql(["dims", "byname"], f"""
    SELECT a.v AS agent, a.nm AS dealer_name, coalesce(b.display_name, a.nm) AS display_name,
        {n('coalesce(b.contracts_written, 0)')} AS contracts_written,
        {n('coalesce(b.active_contracts, 0)')} AS active_contracts,
        {r('coalesce(b.claims_paid, 0)')} AS claims_paid,
        {r('coalesce(b.earned_reserve, 0)')} AS earned_reserve,
        {r('b.earned_loss_ratio')} AS earned_loss_ratio
    FROM (SELECT v, unnest(related) AS nm FROM dims WHERE dim = 'agent' AND period_id = 'inception') a
    LEFT JOIN byname b ON a.nm = b.nm""")

ORACLE["entity_partners"] = sql(["dims"], """
    SELECT dim, v AS dim_value, period_id, unnest(related) AS partner FROM dims WHERE dim <> 'product'""")

cte("prod", ["dims"], "SELECT * FROM dims WHERE dim = 'product' AND period_id = 'inception'")
ORACLE["product_mix"] = sql(["prod"], f"""
    SELECT 'reserve' AS chart, v AS product, {r('net_reserve')} AS amount,
        {r(f"{d('net_reserve')} / {d('sum(net_reserve) OVER ()')}")} AS share
    FROM prod WHERE net_reserve > 0
    UNION ALL SELECT 'admin', v, {r('net_admin')},
        {r(f"{d('net_admin')} / {d('sum(net_admin) OVER ()')}")} FROM prod WHERE net_admin > 0
    UNION ALL SELECT 'claims', v, {r('claims_paid')}, {r('earned_loss_ratio')}
    FROM prod WHERE claims_paid > 0""")


def figures(name: str, tx: str, claims: str, groups: str) -> None:
    """Product figures of ``tx`` and ``claims`` (with ``cprod``), per group columns."""
    g = f"{groups}, " if groups else ""
    on = " AND ".join(f"a.{c.strip()} = b.{c.strip()}" for c in (g + "product").split(","))
    keys = ", ".join(f"coalesce(a.{c.strip()}, b.{c.strip()}) AS {c.strip()}"
                     for c in (g + "product").split(","))
    cte(name, [tx, claims], f"""
        SELECT {keys}, coalesce(w, 0) AS written_contracts, coalesce(k, 0) AS cancelled_contracts,
            coalesce(w, 0) - coalesce(k, 0) AS net_contracts, coalesce(wr, 0) AS written_reserve,
            coalesce(kr, 0) AS cancelled_reserve, coalesce(wr, 0) - coalesce(kr, 0) AS net_reserve,
            coalesce(er, 0) AS earned_reserve, coalesce(paid, 0) AS claims_paid,
            coalesce(er, 0) - coalesce(paid, 0) AS uw_profit
        FROM (SELECT {g}product, count(DISTINCT num) FILTER (WHERE type <> 'Cancellation') AS w,
                count(DISTINCT num) FILTER (WHERE type = 'Cancellation') AS k,
                sum(CASE WHEN type <> 'Cancellation' THEN reserve ELSE 0 END) AS wr,
                sum(CASE WHEN type = 'Cancellation' THEN abs(reserve) ELSE 0 END) AS kr,
                sum(CASE WHEN type <> 'Cancellation' THEN earned ELSE 0 END) AS er
            FROM {tx} GROUP BY {g}product) a
        FULL JOIN (SELECT {g}cprod AS product, sum(paid) AS paid FROM {claims} GROUP BY ALL) b ON {on}""")


cte("clp", ["cl", "wlookup"], """
    SELECT cl.*, coalesce(l.product, 'Unmapped Product Type') AS cprod
    FROM cl LEFT JOIN wlookup l ON cl.cnum = l.num""")
cte("reachp", ["reach", "wlookup"], """
    SELECT reach.*, coalesce(l.product, 'Unmapped Product Type') AS cprod
    FROM reach LEFT JOIN wlookup l ON reach.cnum = l.num""")
figures("fig_all", "tx", "clp", "")
figures("fig_mine", "mine", "reachp", "")

for _dim in ("dealer", "agent"):
    cte(f"own_{_dim}", [f"tx_{_dim}"], f"""
        SELECT entity, num, arg_max(product, place) AS product FROM tx_{_dim}
        WHERE num <> '' AND type <> 'Cancellation' GROUP BY 1, 2""")
    cte(f"clp_{_dim}", [f"cl_{_dim}", f"own_{_dim}"], f"""
        SELECT e.*, coalesce(o.product, 'Unmapped Product Type') AS cprod
        FROM cl_{_dim} e LEFT JOIN own_{_dim} o ON e.entity = o.entity AND e.cnum = o.num""")
    figures(f"fig_{_dim}", f"tx_{_dim}", f"clp_{_dim}", "entity")

_FIG = ", ".join(
    [f"{n(c)} AS {c}" for c in ("written_contracts", "cancelled_contracts", "net_contracts")]
    + [f"{r(c)} AS {c}" for c in ("written_reserve", "cancelled_reserve", "net_reserve",
                                  "earned_reserve", "claims_paid", "uw_profit")])
ORACLE["product_buckets"] = sql(["fig_dealer", "fig_agent"], " UNION ALL ".join(f"""
    SELECT '{x}' AS dim, entity, product, {_FIG},
        round(CASE WHEN net_reserve > 0 THEN {d('earned_reserve')} / {d('net_reserve')} ELSE 0 END
            * 100, 2) AS percent_earned,
        round(CASE WHEN earned_reserve > 0 THEN {d('claims_paid')} / {d('earned_reserve')} ELSE 0 END
            * 100, 1) AS loss_ratio,
        CASE WHEN earned_reserve > 0 AND {d('claims_paid')} / {d('earned_reserve')} * 100 > 100
            THEN 'CRITICAL LOSS' WHEN uw_profit < 0 THEN 'LOSS DEFICIT' ELSE 'PROFIT SURPLUS' END
            AS status
    FROM fig_{x}""" for x in ("dealer", "agent")))
_RATIOS = (f"{div('earned_reserve', 'net_reserve')} AS percent_earned,"
           f" {div('claims_paid', 'earned_reserve')} AS loss_ratio")
_SUMFIG = ", ".join(f"sum({c}) AS {c}" for c in (
    "written_contracts", "cancelled_contracts", "net_contracts", "written_reserve",
    "cancelled_reserve", "net_reserve", "earned_reserve", "claims_paid", "uw_profit"))
ORACLE["product_table"] = sql(["fig_mine"], f"""
    SELECT product, {_FIG}, {_RATIOS} FROM (SELECT * FROM fig_mine UNION ALL
        SELECT 'TOTAL (ALL PRODUCTS)', {_SUMFIG} FROM fig_mine)""")

_USD = "format('{{:,}}', CAST(floor({} + 0.5) AS BIGINT))"
_PCT = "printf('%.1f%%', coalesce({}, 0) * 100)"
cte("score", ["fig_all"], f"""
    SELECT *, CASE WHEN earned_reserve > 0 THEN {d('claims_paid')} / {d('earned_reserve')} END AS lr,
        {d('claims_paid')} / {d('sum(claims_paid) OVER ()')} AS cshare
    FROM fig_all""")
ORACLE["product_scorecard"] = sql(["score"], f"""
    SELECT product, {r('claims_paid')} AS claims_paid, {r('earned_reserve')} AS earned_reserve,
        {r('uw_profit')} AS uw_profit, {r('lr')} AS loss_ratio, {r('cshare')} AS claim_share,
        {r('written_reserve')} AS written_reserve, {r('net_reserve')} AS net_reserve,
        {n('uw_profit < 0 OR coalesce(lr > 1, false)')} AS is_loss_driver,
        CASE WHEN uw_profit < -10000 THEN 'CRITICAL LOSS' WHEN uw_profit < 0 THEN 'LOSS DEFICIT'
            WHEN uw_profit = 0 THEN 'BREAK-EVEN' ELSE 'PROFIT SURPLUS' END AS status,
        CASE WHEN uw_profit < 0 THEN 'Deficit -$' || {_USD.format('-uw_profit')}
            ELSE 'Surplus +$' || {_USD.format('uw_profit')} END
            || ' (' || {_PCT.format('lr')} || ' LR)' AS finding
    FROM score WHERE claims_paid > 0 OR written_reserve > 0""")
ORACLE["loss_attribution"] = sql(["score"], f"""
    SELECT arg_min(product, uw_profit) FILTER (WHERE uw_profit < 0) AS top_loss_driver,
        {r('min(uw_profit) FILTER (WHERE uw_profit < 0)')} AS top_deficit,
        {r('(list(lr ORDER BY uw_profit, product) FILTER (WHERE uw_profit < 0))[1]')} AS top_loss_ratio,
        {r('sum(least(uw_profit, 0))')} AS total_deficit,
        coalesce(string_agg(product || ' (+$' || {_USD.format('uw_profit')} || ')', ', '
            ORDER BY uw_profit, product) FILTER (WHERE uw_profit > 0), '') AS profitable_offsets
    FROM score WHERE claims_paid > 0 OR written_reserve > 0""")

_H = ("current_month", "ytd", "rolling12", "inception")
ORACLE["entity_drilldown"] = sql(["dims"], """
    SELECT dim, v AS dim_value, coalesce(max(display_name) FILTER (WHERE period_id = 'inception'),
            max(display_name) FILTER (WHERE period_id = 'rolling12'), v) AS display_name,
        CASE WHEN dim <> 'product' THEN array_to_string(coalesce(
            any_value(related) FILTER (WHERE period_id = 'inception'),
            any_value(related) FILTER (WHERE period_id = 'rolling12')), '|') END AS related, """
    + ", ".join(r(f"max({c}) FILTER (WHERE period_id = '{p}')") + f" AS {p}_{c}"
                for p in _H for c in ("net_reserve", "claims_paid"))
    + " FROM dims GROUP BY dim, v")
ORACLE["entity_lookup"] = sql(["dims"], f"""
    SELECT dim, v AS dim_value, period_id, display_name,
        {n('contracts_written')} AS contracts_written, {r('earned_reserve')} AS earned_reserve
    FROM dims WHERE dim = 'agent' AND v = 'NATION_3' AND period_id IN ('rolling12', 'inception')""")

# ---- loss codes and vehicles

ORACLE["loss_code_kpis"] = sql(["per4", "cl"], f"""
    SELECT period_id, {r('sum(paid)')} AS total_paid, {n('count(DISTINCT cid)')} AS claim_count,
        {n('count(DISTINCT code)')} AS loss_code_count,
        {r(f"{d('sum(paid)')} / count(DISTINCT cid)")} AS average_paid_per_claim
    FROM per4 JOIN cl ON activity BETWEEN ps AND pe WHERE period_id <> 'inception' GROUP BY 1""")


def preferred(claims: str) -> str:
    return f"""SELECT code, coalesce((SELECT descr FROM {claims} x WHERE x.code = c.code
        AND descr <> 'Description unavailable' GROUP BY descr ORDER BY count(*) DESC, descr LIMIT 1),
        'Description unavailable') AS description FROM (SELECT DISTINCT code FROM {claims}) c"""


cte("r12", ["cl"], "SELECT * FROM cl WHERE activity BETWEEN DATE '2000-07-01' AND DATE '2001-06-30'")
cte("r12desc", ["r12"], preferred("r12"))
cte("lcr", ["r12", "r12desc"], f"""
    SELECT r12.code, any_value(description) AS description,
        list_sort(list(DISTINCT CASE WHEN coverage_name = '' THEN 'Unmapped Coverage Name'
            ELSE coverage_name END)) AS covs,
        coalesce(sum(paid) FILTER (WHERE activity >= DATE '2001-06-01'), 0) AS mp,
        coalesce(sum(paid) FILTER (WHERE activity >= DATE '2001-01-01'), 0) AS yp,
        sum(paid) AS rp, {d('sum(paid)')} / {d('(SELECT sum(paid) FROM r12)')} AS share,
        count(DISTINCT cid) AS k, {d('sum(paid)')} / count(DISTINCT cid) AS av
    FROM r12 JOIN r12desc ON r12.code = r12desc.code GROUP BY r12.code""")
ORACLE["loss_code_rows"] = sql(["lcr"], f"""
    SELECT code AS loss_code, description, array_to_string(covs, '|') AS coverage_names,
        {r('mp')} AS current_month_paid, {r('yp')} AS year_to_date_paid, {r('rp')} AS rolling12_paid,
        {r('share')} AS rolling12_share, {n('k')} AS rolling12_claim_count,
        {r('av')} AS rolling12_average FROM lcr""")
ORACLE["loss_code_description"] = sql(
    ["cl"], f"SELECT code AS loss_code, description FROM ({preferred('cl')})")
ORACLE["top_makes"] = sql(["r12"], f"""
    SELECT make AS vehicle_make, {r('p')} AS paid_amount, {n('k')} AS claim_count,
        {r(f"{d('p')} / {d('(SELECT sum(paid) FROM r12)')}")} AS paid_share, {n('rk')} AS rank
    FROM (SELECT *, row_number() OVER (ORDER BY p DESC, make) AS rk FROM (
        SELECT make, sum(paid) AS p, count(DISTINCT cid) AS k FROM r12 GROUP BY 1) WHERE p > 0)
    WHERE rk <= 10""")
ORACLE["visible_segments"] = sql(["lcr"], f"""
    SELECT code AS loss_code, description, {r('rp')} AS rolling12_paid,
        {r(f"{d('rp')} / {d('sum(rp) OVER ()')}")} AS segment_share
    FROM lcr WHERE share >= 0.02 AND rp > 0""")
cte("dcodes", ["cl_dealer"], """
    SELECT entity, code, count(*) AS k, sum(paid) AS p, arg_min(descr, (place, source_id)) AS descr
    FROM cl_dealer GROUP BY 1, 2""")
ORACLE["top_loss_codes_per_dealer"] = sql(["dcodes"], f"""
    SELECT entity, code AS loss_code, {n('k')} AS line_count, {r('p')} AS total_paid,
        descr AS description, {n('rk')} AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY p DESC, code) AS rk FROM dcodes)
    WHERE rk <= 15""")
cte("soldreach", ["cl", "lookup"], """
    SELECT cl.* FROM cl LEFT JOIN lookup l ON cl.cnum = l.num
    WHERE cl.agent = 'NATION_3' OR l.agent = 'NATION_3' OR l.agent_name = 'NATION_3 Agency'""")
ORACLE["target_loss_codes"] = sql(["soldreach"], f"""
    SELECT 'NATION_3' AS target, code AS loss_code, {n('k')} AS line_count, {r('p')} AS total_paid,
        descr AS description, {n('rk')} AS rank
    FROM (SELECT code, count(*) AS k, sum(paid) AS p, arg_min(descr, (place, source_id)) AS descr,
        row_number() OVER (ORDER BY sum(paid) DESC, code) AS rk FROM soldreach GROUP BY 1)
    WHERE rk <= 5""")
ORACLE["portfolio_top5"] = sql(["lcr"], f"""
    SELECT {n('rk')} AS rank, code AS loss_code, description,
        array_to_string(covs[1:2], ', ') AS coverage_lines, {r('rp')} AS rolling12_paid,
        {n('k')} AS rolling12_claim_count, {r('av')} AS rolling12_average,
        {r('share')} AS rolling12_share, CASE WHEN share > 0.15
            THEN 'Primary Enterprise Loss Driver' ELSE 'Standard Exposure' END AS classification
    FROM (SELECT *, row_number() OVER (ORDER BY rp DESC, code) AS rk FROM lcr) WHERE rk <= 5""")

# ---- underwriting intelligence

ORACLE["target_filter"] = sql(["tx"], f"""
    SELECT agent, dealer, {n('count(*)')} AS n, {r('sum(reserve)')} AS reserve FROM tx
    WHERE agent = 'NATION_3' OR agent_name = 'NATION_3 Agency' OR dealer = 'D7' GROUP BY 1, 2""")
ORACLE["target_claim_sets"] = sql(["cl", "wlookup"], f"""
    SELECT cl.source_id, {r('paid')} AS paid_amount FROM cl LEFT JOIN wlookup l ON cl.cnum = l.num
    WHERE cl.dealer IN ('S3', 'D7') OR l.dealer IN ('S3', 'D7')
        OR cl.agent = 'NATION_3' OR l.agent = 'NATION_3'""")
cte("firsts", ["tx"], """
    SELECT k, min(coalesce(eff, activity)) AS first_date FROM (
        SELECT lower(agent) AS k, eff, activity FROM tx
        UNION ALL SELECT lower(agent_name), eff, activity FROM tx) GROUP BY 1""")
ORACLE["agent_first_dates"] = sql(["firsts"], f"""
    SELECT k AS agent_key, {t('first_date')} AS first_date FROM firsts""")

_TM = ("CASE WHEN first_date IS NULL THEN 0 ELSE greatest(1, floor((datediff('day', first_date,"
       " DATE '2001-06-30') + 86399.999 / 86400) / 30.4375 + 0.5)) END")


def tenured(name: str, source: str, volume: str, least: int) -> None:
    cte(f"{name}0", [source], f"""
        SELECT *, {n(_TM)} AS tenure_months, round({_TM} / 12.0, 1) AS tenure_years FROM {source}""")
    cte(name, [f"{name}0"], f"""
        SELECT *, CASE WHEN tenure_years >= 2 AND {volume} >= {least} THEN 'Seasoned'
            WHEN tenure_years >= 1 THEN 'Developing' ELSE 'New' END AS maturity FROM {name}0""")


_CRED = """CASE maturity WHEN 'Seasoned' THEN CASE WHEN lr > 0.9 OR lr > 0.75
            THEN 'Seasoned Adverse (Pay Attention)' WHEN lr <= 0.75 THEN 'Seasoned Profitable (<65%)'
            ELSE 'Seasoned Moderate Margin' END
        WHEN 'Developing' THEN 'Developing Cohort (Reserves Earning)'
        ELSE 'Immature Cohort (Sample Volatility)' END"""
cte("topag", ["dims", "firsts"], """
    SELECT rk, v, display_name, contracts_written, net_reserve, earned_reserve, claims_paid,
        coalesce(earned_loss_ratio, 0) AS lr, percent_earned,
        coalesce(a.first_date, b.first_date) AS first_date
    FROM (SELECT *, row_number() OVER (ORDER BY contracts_written DESC, net_admin DESC,
            net_reserve DESC, v) AS rk FROM dims WHERE dim = 'agent' AND period_id = 'inception') x
    LEFT JOIN firsts a ON lower(x.v) = a.k LEFT JOIN firsts b ON lower(display_name) = b.k
    WHERE rk <= 8""")
tenured("topag_t", "topag", "contracts_written", 50)
ORACLE["agent_maturity_status"] = sql(["topag_t"], f"""
    SELECT {n('rk')} AS rank, v AS agent, display_name, {n('contracts_written')} AS contracts_written,
        {r('net_reserve')} AS net_reserve, {r('earned_reserve')} AS earned_reserve,
        {r('claims_paid')} AS claims_paid, {r('lr')} AS loss_ratio,
        {r('percent_earned')} AS percent_earned, {t('first_date')} AS first_date, tenure_months,
        {r('tenure_years')} AS tenure_years, maturity, {_CRED} AS status FROM topag_t""")

cte("minec", ["cl"], "SELECT * FROM cl WHERE agent = 'NATION_3' OR dealer IN ('S3', 'S4')")
cte("coh", ["mine", "minec"], f"""
    SELECT coalesce(a.k, b.k) AS k, coalesce(an, bn) AS nm, coalesce(c, 0) AS contracts,
        coalesce(res, 0) AS res, coalesce(ress, 0) AS ress, coalesce(er, 0) AS er,
        coalesce(paid, 0) AS paid, first_date
    FROM (SELECT dealer AS k, arg_min(dealer_name, place) AS an,
            count(*) FILTER (WHERE type <> 'Cancellation') AS c, sum(reserve) AS res,
            sum(CASE WHEN type = 'Cancellation' THEN -abs(reserve) ELSE reserve END) AS ress,
            sum(earned) AS er, min(coalesce(eff, activity)) AS first_date FROM mine GROUP BY 1) a
    FULL JOIN (SELECT dealer AS k, arg_min(CASE WHEN dealer_name <> '' THEN dealer_name ELSE dealer
            END, (place, source_id)) AS bn, sum(paid) AS paid FROM minec GROUP BY 1) b ON a.k = b.k""")
tenured("coh_t", "coh", "contracts", 30)
cte("coh_l", ["coh_t"], f"""
    SELECT *, CASE WHEN res > 0 THEN {d('paid')} / {d('res')} WHEN paid > 0 THEN 9.99 ELSE 0 END AS lr
    FROM coh_t""")
ORACLE["dealer_cohort"] = sql(["coh_l"], f"""
    SELECT k AS dealer_key, nm AS dealer_name, {n('contracts')} AS contracts, {r('res')} AS reserve,
        {r('ress')} AS reserve_signed, {r('er')} AS earned_reserve, {r('paid')} AS claims,
        {t('first_date')} AS first_date, tenure_months, {r('tenure_years')} AS tenure_years, maturity,
        {r('lr')} AS loss_ratio,
        {r(f"CASE WHEN res > 0 THEN {d('er')} / {d('res')} ELSE 0 END")} AS percent_earned,
        {_CRED} AS status FROM coh_l""")

cte("agx", ["dims"], """
    SELECT *, coalesce(earned_loss_ratio, 0) AS lr FROM dims
    WHERE dim = 'agent' AND period_id = 'inception' AND contracts_written >= 50""")
ORACLE["top_risk_agents"] = sql(["agx"], f"""
    (SELECT 'top_risk' AS role, v AS dim_value, display_name, {r('lr')} AS loss_ratio,
        {r('claims_paid')} AS claims_paid FROM agx
        ORDER BY lr DESC, net_admin DESC, net_reserve DESC, v LIMIT 1)
    UNION ALL
    (SELECT 'most_profitable', v, display_name, {r('lr')}, {r('claims_paid')} FROM agx
        ORDER BY lr, net_admin DESC, net_reserve DESC, v LIMIT 1)""")

ORACLE["time_to_loss"] = sql(["cl", "eff"], f"""
    SELECT bucket, risk, {n('count(days)')} AS line_count, {r('coalesce(sum(paid), 0)')} AS paid,
        {r(f"CASE WHEN count(days) > 0 THEN {d('sum(paid)')} / count(days) ELSE 0 END")} AS average_paid,
        {r(f"{d('count(days)')} / (SELECT count(*) FROM cl)")} AS share
    FROM (VALUES ('0-90 Days', 0, 90, 'Immediate In-Service Emergence'),
        ('91-180 Days', 91, 180, 'First-Year Operational Wear'),
        ('181-365 Days', 181, 365, 'Expected Seasoned Degradation'),
        ('365+ Days', 366, 999999999, 'Mature Seasoned Wear')) AS b(bucket, lo, hi, risk)
    LEFT JOIN (SELECT greatest(0, activity - coalesce(eff, seen)) AS days, paid
        FROM cl LEFT JOIN eff ON cl.cnum = eff.num) ON days BETWEEN lo AND hi
    GROUP BY bucket, risk""")

cte("mk", ["cl"], """
    SELECT make, code, sum(paid) AS p, count(*) AS k, arg_min(descr, (place, source_id)) AS descr
    FROM cl GROUP BY 1, 2""")
cte("mk2", ["mk"], """
    SELECT make, code, descr, sum(p) OVER (PARTITION BY make) AS p, sum(k) OVER (PARTITION BY make) AS k
    FROM mk QUALIFY row_number() OVER (PARTITION BY make ORDER BY mk.p DESC, code) = 1""")
ORACLE["make_exposure"] = sql(["mk2"], f"""
    SELECT {n('rk')} AS rank, make AS vehicle_make, {r('p')} AS paid, {n('k')} AS line_count,
        {r(f"{d('p')} / {d('k')}")} AS average_paid, {r(f"{d('p')} / {d('tot')}")} AS share,
        code AS primary_code, descr AS primary_description, CASE WHEN {d('p')} / {d('tot')} > 0.25
            THEN 'High Concentration (>25%)' ELSE 'Normal distribution' END AS exposure
    FROM (SELECT *, sum(p) OVER () AS tot, row_number() OVER (ORDER BY p DESC, make) AS rk FROM mk2)
    WHERE rk <= 8""")

cte("bench", ["mine", "minec", "cl", "a_all"], f"""
    SELECT {d('sum(reserve)')} / greatest(count(*) FILTER (WHERE type <> 'Cancellation'), 1) AS tr,
        {d('sum(admin)')} / greatest(count(*) FILTER (WHERE type <> 'Cancellation'), 1) AS ta,
        (SELECT {d('sum(paid)')} / count(*) FROM minec) AS tc,
        (SELECT {d('net_reserve')} / contracts_written FROM a_all WHERE period_id = 'rolling12') AS pr,
        (SELECT {d('net_admin')} / contracts_written FROM a_all WHERE period_id = 'rolling12') AS pa,
        (SELECT {d('claims_paid')} FROM a_all WHERE period_id = 'rolling12')
            / (SELECT count(*) FROM cl) AS pc
    FROM mine""")
ORACLE["pricing_benchmark"] = sql(["bench"], f"""
    SELECT metric, {r('x')} AS target, {r('y')} AS portfolio, {r('x - y')} AS difference,
        CASE WHEN kind = 'c' THEN CASE WHEN x > y * 1.15 THEN 'Elevated Severity Above Benchmark'
                ELSE 'Severity In-Line With Benchmark' END
            WHEN x < y * 0.9 THEN 'Below Portfolio Benchmark'
            ELSE 'At or Above Portfolio Benchmark' END AS assessment
    FROM bench, LATERAL (VALUES ('Average Reserve Collected / Contract', tr, pr, 'i'),
        ('Average Net Admin / Contract', ta, pa, 'i'),
        ('Average Paid Severity / Claim', tc, pc, 'c')) AS s(metric, x, y, kind)""")

cte("mineown", ["mine"], """
    SELECT num, arg_max(product, place) AS product FROM mine WHERE num <> '' GROUP BY 1""")
cte("srp", ["soldreach", "mineown"], """
    SELECT s.*, coalesce(o.product, 'Unmapped Product Type') AS cprod
    FROM soldreach s LEFT JOIN mineown o ON s.cnum = o.num""")
figures("fig_line", "mine", "srp", "")
_ROLE = """CASE WHEN uw_profit < -10000 THEN 'CRITICAL LOSS DRIVER' WHEN uw_profit < 0
        THEN 'LOSS DEFICIT' WHEN uw_profit = 0 THEN 'BREAK-EVEN' ELSE 'PROFITABLE SUBSIDIZER' END"""
_LR = f"(CASE WHEN earned_reserve > 0 THEN {d('claims_paid')} / {d('earned_reserve')} END)"
ORACLE["product_lines"] = sql(["fig_line"], f"""
    SELECT product, {r('net_reserve')} AS written_reserve, {r('earned_reserve')} AS earned_reserve,
        {r('claims_paid')} AS claims_paid, {r('uw_profit')} AS uw_profit, {r(_LR)} AS loss_ratio,
        {_ROLE} AS role, CASE WHEN uw_profit < 0
            THEN 'Bleeding -$' || {_USD.format('-uw_profit')} || ' (' || {_PCT.format(_LR)} || ' LR)'
            ELSE 'Subsidizing with +$' || {_USD.format('uw_profit')} || ' surplus ('
                || {_PCT.format(_LR)} || ' LR)' END AS assessment
    FROM fig_line WHERE net_reserve > 0 OR earned_reserve > 0 OR claims_paid > 0""")

for _dim in ("dealer", "agent"):
    cte(f"lineown_{_dim}", [f"tx_{_dim}"], f"""
        SELECT entity, num, arg_max(product, place) AS product FROM tx_{_dim} WHERE num <> '' GROUP BY 1, 2""")
    cte(f"clline_{_dim}", [f"cl_{_dim}", f"lineown_{_dim}"], f"""
        SELECT e.*, coalesce(o.product, 'Unmapped Product Type') AS cprod
        FROM cl_{_dim} e LEFT JOIN lineown_{_dim} o ON e.entity = o.entity AND e.cnum = o.num""")
    figures(f"fig_line_{_dim}", f"tx_{_dim}", f"clline_{_dim}", "entity")


def summarised(dim: str) -> str:
    """Summary of every value of a dimension, whose rows are those under its code or its name."""
    return f"""
    SELECT '{dim}' AS dim, w.*, first_date, top_code, top_amount, lo.product AS losing, lo.uw_profit AS losing_profit,
        CASE WHEN lo.earned_reserve > 0 THEN {d('lo.claims_paid')} / {d('lo.earned_reserve')} END
            AS losing_lr,
        wi.product AS winning, wi.uw_profit AS winning_profit
    FROM (SELECT v, coalesce(max(display_name) FILTER (WHERE period_id = 'inception'),
                max(display_name) FILTER (WHERE period_id = 'rolling12'), upper(v)) AS display_name,
            """ + ", ".join(
    f"coalesce(max({c}) FILTER (WHERE period_id = '{p}'), 0) AS {s_}_{a}"
    for p, s_ in (("rolling12", "rolling"), ("inception", "itd"))
    for c, a in (("contracts_written", "contracts"), ("net_reserve", "reserve"),
                 ("earned_reserve", "earned"), ("claims_paid", "claims"),
                 ("earned_loss_ratio", "lr"), ("claim_frequency", "freq"))) + """
        FROM dims WHERE dim = '""" + dim + f"""' GROUP BY v) w
    LEFT JOIN (SELECT entity, min(coalesce(eff, activity)) AS first_date FROM tx_{dim} GROUP BY 1) f
        ON w.v = f.entity
    LEFT JOIN (SELECT entity, code AS top_code, sum(paid) AS top_amount FROM cl_{dim} GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY entity ORDER BY sum(paid) DESC, code) = 1) c
        ON w.v = c.entity
    LEFT JOIN (SELECT * FROM fig_line_{dim} WHERE uw_profit < 0 AND (net_reserve > 0 OR earned_reserve > 0
        OR claims_paid > 0) QUALIFY row_number() OVER (PARTITION BY entity
            ORDER BY uw_profit, product) = 1) lo ON w.v = lo.entity
    LEFT JOIN (SELECT * FROM fig_line_{dim} WHERE uw_profit > 0 AND (net_reserve > 0 OR earned_reserve > 0
        OR claims_paid > 0) QUALIFY row_number() OVER (PARTITION BY entity
            ORDER BY uw_profit, product) = 1) wi ON w.v = wi.entity"""


cte("summ0", ["dims", "fig_line_dealer", "fig_line_agent"],
    f"{summarised('dealer')} UNION ALL {summarised('agent')}")
tenured("summ1", "summ0", "itd_contracts", 50)
cte("summ", ["summ1"], f"""
    SELECT *, greatest(itd_reserve - itd_earned, 0) AS unearned,
        CASE WHEN itd_reserve > 0 THEN {d('itd_earned')} / {d('itd_reserve')} ELSE 0 END * 100 AS pe
    FROM summ1""")
ORACLE["target_summary"] = sql(["summ"], f"""
    SELECT dim, v AS dim_value, display_name, {t('first_date')} AS first_date, tenure_months,
        {r('tenure_years')} AS tenure_years, maturity, {n('rolling_contracts')} AS rolling_contracts,
        {r('rolling_reserve')} AS rolling_reserve, {r('rolling_claims')} AS rolling_claims,
        {r('rolling_lr')} AS rolling_loss_ratio, {n('itd_contracts')} AS itd_contracts,
        {r('itd_reserve')} AS itd_reserve, {r('itd_earned')} AS itd_earned_reserve,
        {r('itd_claims')} AS itd_claims, {r('itd_lr')} AS itd_loss_ratio,
        {r('itd_freq')} AS itd_claim_frequency, {r('unearned')} AS unearned_reserve,
        {r('pe')} AS percent_reserve_earned, top_code, losing AS losing_line, winning AS winning_line
    FROM summ""")
ORACLE["target_horizons"] = sql(["summ"], f"""
    SELECT dim, v AS dim_value, 'rolling12' AS horizon, {n('rolling_contracts')} AS contracts,
        {r('rolling_reserve')} AS net_reserve, {r('rolling_reserve')} AS earned_reserve,
        {r('rolling_claims')} AS claims_paid, {r('rolling_lr')} AS loss_ratio,
        {r('rolling_freq')} AS claim_frequency,
        {d('CASE WHEN rolling_reserve > 0 THEN 1 ELSE 0 END')} AS percent_earned,
        CASE WHEN rolling_lr <= 0.75 THEN 'Rolling: Favorable (<65%)' WHEN rolling_lr <= 0.9
            THEN 'Rolling: Warning (65-80%)' ELSE 'Rolling: Elevated (>80%)' END AS status
    FROM summ
    UNION ALL
    SELECT dim, v, 'inception', {n('itd_contracts')}, {r('itd_reserve')}, {r('itd_earned')},
        {r('itd_claims')}, {r('itd_lr')}, {r('itd_freq')}, {r('pe / 100')},
        CASE maturity WHEN 'Seasoned' THEN CASE WHEN itd_lr > 0.75
                THEN 'Seasoned Adverse Experience (Pay Attention)' ELSE 'Seasoned Profitable (<65%)' END
            WHEN 'Developing' THEN 'Developing Program (' || {n('floor(pe + 0.5)')} || '% Earned)'
            ELSE 'Immature Cohort (' || tenure_months || ' Mo, Sample Volatility)' END
    FROM summ""")
ORACLE["contract_activity"] = sql(["tx"], f"""
    SELECT source_id, num AS contract_number, type AS transaction_type, dealer_name,
        cov AS coverage_code, {r('admin')} AS admin_amount, {r('earned')} AS earned_reserve_amount,
        {r(f"CASE WHEN reserve <> 0 THEN {d('earned')} / {d('reserve')} END")} AS earn_factor,
        {n(_EL)} AS elapsed, {n('term')} AS schedule_last_month,
        CASE WHEN cstatus = 'E' THEN '1.0 (expired)' WHEN eff IS NULL THEN 'no schedule (1.0)'
            WHEN {_EL} > term OR {_EL} < 1 THEN '1.0 (default)'
            ELSE CAST(round(CAST(CAST(CAST({_EL} AS DOUBLE) / term AS DECIMAL(14,10)) AS DOUBLE), 6)
                AS VARCHAR) || ' (from schedule)' END AS factor_source
    FROM tx""")
ORACLE["claim_activity"] = sql(["cl"], f"""
    SELECT source_id, {t('activity')} AS activity_date, claim_number, cnum AS contract_number, status,
        {r('paid')} AS paid_amount, agent, dealer, 'Unmapped Product Type' AS product,
        code AS loss_code, descr AS loss_description FROM cl""")
ORACLE["systematic_sample"] = sql(["tx"], """
    SELECT source_id, num AS contract_number, type AS transaction_type FROM (
        SELECT *, row_number() OVER (ORDER BY place, source_id) AS rk FROM tx)
    WHERE (rk - 1) % 33 = 0""")

# ---- data quality

ORACLE["dq_issues"] = sql(["issues"], f"""
    SELECT severity, category, num AS contract_number, {_LABEL} AS agent_label, dealer_name,
        source_id, message FROM issues""")
_SEV = f"""{n("count(*) FILTER (WHERE severity = 'Error')")} AS errors,
        {n("count(*) FILTER (WHERE severity = 'Warning')")} AS warnings, {n('count(*)')} AS total"""
ORACLE["dq_by_category"] = sql(["issues"], f"SELECT category, {_SEV} FROM issues GROUP BY 1")
ORACLE["dq_by_agent"] = sql(["issues"], f"""
    SELECT {_LABEL} AS agent_label, {_SEV} FROM issues GROUP BY 1
    ORDER BY count(*) DESC, agent_label LIMIT 15""")
ORACLE["dq_unread_dates"] = sql(["craw"], f"""
    SELECT 'date_paid' AS field, {n('count(*)')} AS documents FROM craw WHERE activity IS NULL""")
ORACLE["dealer_profile"] = sql(["ev"], f"""
    SELECT 'status' AS profile, cstatus AS value, {n('count(*)')} AS documents FROM ev
    WHERE dealer = 'D7' GROUP BY 2
    UNION ALL SELECT 'month', coalesce(strftime(activation, '%Y-%m'), 'Unknown'), {n('count(*)')}
    FROM ev WHERE dealer = 'D7' GROUP BY 2""")
ORACLE["multi_dealer_contracts"] = sql(["ev"], f"""
    SELECT num AS contract_number, {n('count(*)')} AS documents, {n('count(DISTINCT dealer)')} AS dealers,
        array_to_string(list_sort(list(DISTINCT dealer)), '|') AS dealer_list
    FROM ev WHERE num <> '' GROUP BY 1 HAVING count(DISTINCT dealer) > 1""")
ORACLE["multi_dealer_members"] = sql(["ev"], f"""
    SELECT num AS contract_number, dealer AS dealer_number, {n('k')} AS documents, {n('dealers')} AS dealers
    FROM (SELECT num, dealer, count(*) AS k, count(*) OVER (PARTITION BY num) AS dealers
        FROM ev WHERE num <> '' AND dealer IS NOT NULL GROUP BY 1, 2) WHERE dealers > 1""")
cte("adm", ["comp"], """
    SELECT key, CAST(sum(amt) FILTER (WHERE (cat = 'ADMIN' AND comp IN ('ADMIN', 'BASEADMIN'))
            OR (cat = 'RESERVE' AND comp = 'ADMIN')) AS DECIMAL(18,2)) AS a,
        CAST(sum(amt) FILTER (WHERE cat = 'RESERVE' AND comp = 'BASERESERVE') AS DECIMAL(18,2)) AS br,
        CAST(sum(amt) FILTER (WHERE cat = 'RESERVE' AND comp NOT IN ('DEALERCOMM', 'ADMIN'))
            AS DECIMAL(18,2)) AS nr
    FROM comp GROUP BY 1""")
ORACLE["admin_reconciliation"] = sql(["ev", "adm"], f"""
    SELECT CASE WHEN feed = 1 THEN 'CANCELLED' WHEN cstatus = 'V' THEN 'VOID'
            WHEN activation IS NULL THEN 'MISSING_DATE'
            WHEN activation > DATE '2000-06-30' THEN 'FUTURE' ELSE 'COUNTED' END AS reason,
        {n('count(*)')} AS documents,
        {r('sum(CASE WHEN feed = 1 THEN -coalesce(a, 0) * 0.5 ELSE coalesce(a, 0) END)')} AS admin
    FROM ev LEFT JOIN adm ON ev.key = adm.key WHERE dealer = 'D7' GROUP BY 1""")
ORACLE["csv_reconciliation"] = sql(["ev", "rows2", "adm"], f"""
    SELECT {r('''(SELECT coalesce(sum(br * CASE WHEN type = 'Cancellation' THEN 0.5 ELSE 1 END), 0)
            FROM rows2 JOIN adm ON rows2.key = adm.key
            WHERE feed = 0 AND dealer_name = 'Customer#000000007')''')} AS exported,
        {r('coalesce(sum(br) FILTER (WHERE activation IS NULL), 0)')} AS missing_date,
        {r("coalesce(sum(br) FILTER (WHERE cstatus = 'V'), 0)")} AS voided,
        {r("coalesce(sum(br) FILTER (WHERE activation IS NULL), 0) + coalesce(sum(br) FILTER (WHERE cstatus = 'V'), 0)")} AS excluded
    FROM ev LEFT JOIN adm ON ev.key = adm.key WHERE feed = 0 AND c_name = 'Customer#000000007'""")
_RW = "coalesce(sum(nr) FILTER (WHERE feed = 0 AND activation < DATE '2001-07-01'), 0)"
_RC = "coalesce(sum(nr * 0.5) FILTER (WHERE feed = 1 AND cancel_date < DATE '2001-07-01'), 0)"
ORACLE["dealer_reserve_recon"] = sql(["ev", "adm"], f"""
    SELECT {r(_RW)} AS written, {r(_RC)} AS cancelled, {r(f'{_RW} - {_RC}')} AS net_reserve
    FROM ev LEFT JOIN adm ON ev.key = adm.key WHERE dealer = 'D7'""")

# ---- pricing

cte("bm", ["cl"], f"""
    SELECT code, make, count(*) AS k, {d('sum(paid)')} / count(*) AS mn,
        quantile_cont(CAST(paid AS DOUBLE), 0.5) AS md, stddev_samp(CAST(paid AS DOUBLE)) AS sd
    FROM cl GROUP BY 1, 2 HAVING count(*) >= 5""")
ORACLE["claim_benchmark"] = sql(["bm"], f"""
    SELECT code AS loss_code, make AS vehicle_make, {n('k')} AS line_count, {r('mn')} AS mean_paid,
        {r('md')} AS median_paid, {r('sd')} AS stdev_paid, {r('md + 1.5 * sd')} AS threshold FROM bm""")
ORACLE["claim_benchmark_alerts"] = sql(["bm", "cl"], f"""
    SELECT cl.code AS loss_code, {n('count(*)')} AS line_count, {r('sum(paid)')} AS paid
    FROM cl JOIN bm ON cl.code = bm.code AND cl.make = bm.make
    WHERE CAST(paid AS DOUBLE) > md + 1.5 * sd GROUP BY 1""")


def coverage(source: str, dealers: bool) -> str:
    listed = ", array_to_string(list_sort(list(DISTINCT dealer_name)), '|') AS dealers" if dealers else ""
    top = lambda c: f"arg_max({c}, (markup, -ord, contract_no))"
    return f"""
    SELECT code AS coverage_code, any_value(ptype) AS coverage_name, any_value(ptype) AS product_type,
        {r('max(markup)')} AS max_markup, {top('contract_no')} AS max_contract,
        {top('dealer_name')} AS max_dealer, {r(top('retail'))} AS max_retail, {r(top('net'))} AS max_net,
        {r('min(markup)')} AS min_markup, {r(f"{d('sum(markup)')} / count(*)")} AS avg_markup,
        {n('count(DISTINCT dealer_name)')} AS dealer_count, {n('count(*)')} AS contract_count{listed}
    FROM {source} GROUP BY code"""


def per_dealer(source: str) -> str:
    top = lambda c: f"arg_max({c}, (markup, -ord, contract_no))"
    return f"""
    SELECT dealer_name, dealer_number, code AS coverage_code, any_value(city) AS dealer_city,
        any_value(state) AS dealer_state, any_value(ptype) AS coverage_name,
        any_value(ptype) AS product_type, {r('max(markup)')} AS max_markup,
        {top('contract_no')} AS max_contract, {r(top('retail'))} AS max_retail,
        {r(top('net'))} AS max_net, {r('min(markup)')} AS min_markup,
        {r(f"{d('sum(markup)')} / count(*)")} AS avg_markup, {n('count(*)')} AS contract_count
    FROM {source} GROUP BY 1, 2, 3"""


ORACLE["coverage_summary"] = sql(["mkt"], coverage("mkt", True))
ORACLE["coverage_dealers"] = sql(["mkt"], f"""
    SELECT code AS coverage_code, dealer_name, {n('count(*)')} AS contract_count, {r('max(markup)')} AS max_markup,
        {n('row_number() OVER (PARTITION BY code ORDER BY dealer_name)')} AS rank FROM mkt GROUP BY 1, 2""")
ORACLE["coverage_state_only"] = sql(["sta"], coverage("sta", False))
ORACLE["dealer_coverage"] = sql(["mkt"], per_dealer("mkt"))
ORACLE["dealer_coverage_state_only"] = sql(["sta"], per_dealer("sta"))
ORACLE["state_vs_nation"] = sql(["pr"], f"""
    SELECT code AS coverage_code, any_value(ptype) AS coverage_name, any_value(ptype) AS product_type,
        {n('bool_or(in_market)')} AS sold_in_market,
        {n('count(*) FILTER (WHERE in_market)')} AS market_contracts,
        {r('max(markup) FILTER (WHERE in_market)')} AS market_max,
        arg_max(contract_no, (markup, -ord, contract_no)) FILTER (WHERE in_market)
            AS market_max_contract,
        {n('count(*)')} AS nation_contracts, {r('max(markup)')} AS nation_max,
        arg_max(contract_no, (markup, -ord, contract_no)) AS nation_max_contract,
        arg_max(dealer_name, (markup, -ord, contract_no)) AS nation_max_dealer
    FROM pr GROUP BY code""")
ORACLE["coverage_extremes"] = sql(["sta"], f"""
    SELECT *, {n('row_number() OVER (ORDER BY max_markup DESC, coverage_code)')} AS rank
    FROM ({coverage('sta', False)}) ORDER BY max_markup DESC, coverage_code LIMIT 5""")
ORACLE["coverage_exceptions"] = sql(["pr"], f"""
    SELECT dealer_name, state, zip, {n('count(*)')} AS documents FROM pr WHERE zipped AND NOT named
    GROUP BY 1, 2, 3""")
ORACLE["market_coverage"] = sql(["pr"], f"""
    SELECT 'dealers' AS what, {n('count(DISTINCT dealer_name)')} AS total,
        {n('count(DISTINCT dealer_name) FILTER (WHERE named OR zipped)')} AS market FROM pr
    UNION ALL SELECT 'coverage codes', {n('count(DISTINCT code)')},
        {n('count(DISTINCT code) FILTER (WHERE named OR zipped)')} FROM pr""")
ORACLE["market_states"] = sql(["pr"], f"""
    SELECT state, named AS state_in_market, {n('count(*)')} AS documents FROM pr GROUP BY 1, 2""")
ORACLE["markup_documents"] = sql(["sta"], f"""
    SELECT dealer_name, dealer_number, code AS coverage_code, ptype AS coverage_name, contract_no,
        {r('markup')} AS markup, {r('retail')} AS retail, {r('net')} AS net
    FROM sta WHERE markup <> 0 ORDER BY ord, contract_no LIMIT 5""")
ORACLE["markup_presence"] = sql(["sta"], f"""
    SELECT {n('count(*)')} AS documents, {n('count(*) FILTER (WHERE markup <> 0)')} AS with_markup,
        {n('count(*) FILTER (WHERE retail > net)')} AS above_net FROM sta""")
ORACLE["markup_samples"] = sql(["sta"], f"""
    SELECT dealer_name, code AS coverage_code, contract_no, {r('markup')} AS markup,
        {r('retail')} AS retail, {r('net')} AS net, {r('retail - net')} AS difference
    FROM sta WHERE retail > net ORDER BY ord, contract_no LIMIT 5""")
ORACLE["state_profile"] = sql(["sta"], f"""
    SELECT {n('count(*)')} AS documents, {r('greatest(max(markup), 0)')} AS max_markup,
        {r('greatest(max(retail - net), 0)')} AS max_margin
    FROM sta""")

# ---- narratives

_ONE = "printf('%.1f', {})"
_YEARS = "CASE WHEN tenure_years = floor(tenure_years) THEN CAST(CAST(tenure_years AS BIGINT) AS VARCHAR) ELSE CAST(CAST(tenure_years AS DOUBLE) AS VARCHAR) END"
_SINCE = "coalesce(strftime(first_date, '%m/%Y'), 'inception')"
_INT = "format('{{:,}}', CAST({} AS BIGINT))"
ORACLE["target_narratives"] = sql(["summ"], f"""
    SELECT dim, v AS dim_value, display_name || ' [' || v || ']: $'
        || {_USD.format('itd_claims')} || ' paid against $' || {_USD.format('itd_earned')}
        || ' of earned reserve since the first contract, a loss ratio of '
        || {_ONE.format('itd_lr * 100')} || '%. Last twelve months: '
        || {_INT.format('rolling_contracts')} || ' contracts written, loss ratio '
        || {_ONE.format('rolling_lr * 100')} || '%. ' || {_YEARS} || ' years on the books ('
        || CASE WHEN maturity = 'Seasoned' THEN 'from ' || {_SINCE} || '), '
            || {_INT.format('itd_contracts')} || ' contracts, ' || {_ONE.format('pe')}
            || '% of the reserve earned: the figures stand on firm ground and '
            || CASE WHEN itd_lr > 0.75 THEN 'show a lasting loss; look into it.'
                ELSE 'show a steady account.' END
        ELSE tenure_months || ' months from ' || {_SINCE} || '), ' || {_ONE.format('pe')}
            || '% of the reserve earned and $' || {_USD.format('unearned')}
            || ' still to come: too early to judge the ratio.' END
        || CASE WHEN losing IS NOT NULL AND winning IS NOT NULL
            THEN ' The product ' || losing || ' loses $' || {_USD.format('-losing_profit')}
                || ' (loss ratio ' || coalesce({_ONE.format('losing_lr * 100')} || '%', 'unknown')
                || '), which the $' || {_USD.format('winning_profit')} || ' gained with ' || winning
                || ' helps to hide.' ELSE '' END
        || CASE WHEN top_code IS NOT NULL THEN ' Most is paid for ' || top_code || ': $'
            || {_USD.format('top_amount')} || '.' ELSE '' END AS narrative
    FROM summ""")
tenured("agxt", "agxd", "contracts_written", 50)
cte("agxd", ["agx", "firsts"], """
    SELECT agx.*, least(a.first_date, b.first_date) AS first_date FROM agx
    LEFT JOIN firsts a ON a.k = lower(agx.v) LEFT JOIN firsts b ON b.k = lower(agx.display_name)""")
ORACLE["portfolio_narrative"] = sql(["a_all", "agxt"], f"""
    SELECT 'Sample Protection since inception: ' || {_INT.format('i.contracts_written')}
        || ' contracts, loss ratio ' || {_ONE.format('i.earned_loss_ratio * 100')}
        || '%, underwriting profit $' || {_USD.format('i.underwriting_profit')}
        || '. Last twelve months: ' || {_INT.format('x.contracts_written')}
        || ' contracts, loss ratio ' || {_ONE.format('x.earned_loss_ratio * 100')} || '% ('
        || CASE WHEN x.earned_loss_ratio > i.earned_loss_ratio THEN 'up on' ELSE 'no worse than' END
        || ' the whole time), underwriting profit $' || {_USD.format('x.underwriting_profit')} || '.'
        || coalesce((SELECT ' Agent with the highest loss ratio: ' || display_name
            || CASE WHEN tenure_years > 0 THEN ', ' || {_YEARS} || ' years on the books' ELSE '' END
            || ', ' || {_ONE.format('lr * 100')} || '% on $' || {_USD.format('claims_paid')}
            || ' of claims.' FROM agxt ORDER BY lr DESC, net_admin DESC, net_reserve DESC, v LIMIT 1), '')
        AS narrative
    FROM a_all i, a_all x WHERE i.period_id = 'inception' AND x.period_id = 'rolling12'""")

# ---- by way of documents

for _document, _direct in (("document_contracts", "contract_normalize"), ("document_claims", "claim_normalize"),
                           ("document_audits", "latest_audit"), ("document_pricing", "dealer_coverage")):
    ORACLE[_document] = ORACLE[_direct]
ORACLE["document_contracts_from"] = sql(["rows2"], f"""
    SELECT source_id, {t('activity')} AS activity_date, {r('reserve')} AS reserve_amount
    FROM rows2 WHERE feed = 0 AND eff >= DATE '2000-01-01'""")
ORACLE["stored_contracts_from"] = ORACLE["document_contracts_from"]
ORACLE["stored_tables"] = sql(["ev", "craw"], f"""
    SELECT 'contracts' AS name, {n("""count(*) FILTER (WHERE activity IS NOT NULL)
        + count(*) FILTER (WHERE feed = 1 AND activation IS NOT NULL)""")} AS n, {n('0')} AS lost
    FROM ev WHERE NOT is_test
    UNION ALL SELECT 'claims', {n('count(*)')}, {n('0')} FROM craw
    WHERE (status = 'Paid' OR num = 6) AND paid <> 0 AND activity IS NOT NULL
    UNION ALL SELECT 'audits', {n('3')}, {n('0')}""")

ORACLE["entity_snapshot_parts"] = sql(
    ["dims", "dcodes", "fig_dealer", "fig_agent", "txc_dealer", "txc_agent"], f"""
    SELECT part, '2001-06-30' AS as_of, dim, {n('count(*)')} AS n, {r('sum(amount)')} AS amount FROM (
        SELECT 'horizons' AS part, dim, v, sum(CASE WHEN period_id = 'inception' THEN net_reserve END) AS amount
        FROM dims WHERE dim <> 'product' GROUP BY 1, 2, 3
        UNION ALL SELECT 'loss_codes', 'dealer', code, p FROM (SELECT *, row_number() OVER (
            PARTITION BY entity ORDER BY p DESC, code) AS rk FROM dcodes) WHERE rk <= 15
        UNION ALL SELECT 'products', 'dealer', product, net_reserve FROM fig_dealer
        UNION ALL SELECT 'products', 'agent', product, net_reserve FROM fig_agent
        UNION ALL SELECT 'components', 'dealer', comp, {_W} + {_C} FROM txc_dealer GROUP BY entity, cat, comp
        UNION ALL SELECT 'components', 'agent', comp, {_W} + {_C} FROM txc_agent GROUP BY entity, cat, comp
        UNION ALL SELECT 'sub_dealers', 'agent', agent, claims_paid FROM ({ORACLE["sub_dealers"]}))
    GROUP BY part, dim""")

_WHOLE = ORACLE["period_metrics_all"]
ORACLE["snapshot_upsert"] = f"""
    SELECT *, '2001-06-30' AS as_of FROM ({_WHOLE})
    UNION ALL SELECT *, '2001-05-31' FROM ({_WHOLE}) WHERE period_id = 'ytd'"""

ORACLE["entity_snapshot_upsert"] = sql(["dims"], f"""
    SELECT '2001-06-30' AS as_of, dim, {_DIM} FROM dims WHERE dim <> 'product'""")

ORACLE["portfolio_snapshot_parts"] = " UNION ALL ".join(
    f"SELECT '{part}' AS part, '2001-06-30' AS as_of, {n('count(*)')} AS n, {r(f'sum({amount})')} AS amount"
    f" FROM ({ORACLE[query]})"
    for part, query, amount in (
        ("horizons", "period_metrics_all", "net_reserve"), ("months", "monthly_trend", "net_reserve"),
        ("worst_dealers", "worst_dealers_snapshot", "claims_paid"), ("dealers", "dealer_metrics", "net_reserve"),
        ("agents", "agent_metrics", "claims_paid"), ("products", "product_metrics", "earned_reserve"),
        ("loss_codes", "loss_code_rows", "rolling12_paid"), ("makes", "top_makes", "paid_amount"),
        ("source_counts", "source_counts", "documents"),
    )
)
