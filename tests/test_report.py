"""Worked examples with answers computed by hand."""

from datetime import date
from decimal import Decimal

import pytest
from documents import CANCELLED, cancellation, claim, contract, period, report

from pactlens.operators import intel as it
from pactlens.operators import losscodes as lc
from pactlens.sources.schemas import PII_FIELDS

D = Decimal


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("feeds")


def test_month_figures(spark, folder):
    rep = report(
        spark, folder,
        [
            contract("sale-1", "C1", "07/05/2026"),
            contract("sale-1-copy", " c 1 ", "07/05/2026"),
            contract("sale-2", "C2", "07/06/2026"),
            contract("august-sale", "C-AUG", "08/02/2026"),
            contract("invalid-date", "C-INVALID-DATE", "not-a-date"),
        ],
        [cancellation("cancel-1", "C2", "07/06/2026", "07/20/2026")],
        [claim("claim-1", "CL1", "C1", "07/10/2026", "$250.00")],
    )
    assert rep.transactions.count() == 3
    assert [r.category for r in rep.issues.collect()] == ["Missing Activation Date"]
    m = period(rep)
    assert (m["contracts_written"], m["contracts_cancelled"], m["net_contracts"]) == (2, 1, 1)
    assert m["active_contracts"] == 1
    assert (m["net_admin"], m["net_reserve"], m["gross_income"]) == (D(100), D(500), D(600))
    assert (m["earned_reserve"], m["claims_paid"], m["underwriting_profit"]) == (D(500), D(250), D(250))
    assert (m["earned_loss_ratio"], m["cancellation_rate"], m["claim_frequency"]) == (0.5, 0.5, 0.5)
    assert (m["claim_severity"], m["admin_per_contract"]) == (250.0, 100.0)
    assert not set(rep.contract_documents.columns) & set(PII_FIELDS)
    kpi = {r.period_id: r for r in lc.loss_code_kpis(rep.claims, rep.periods).collect()}
    assert kpi["current_month"].total_paid == D(250) and kpi["current_month"].loss_code_count == 1
    code = rep.loss_codes.first()
    assert (code.loss_code, code.rolling12_share) == ("EL016", 1.0)
    dealer = rep.dimension_table(["dealer"]).where("period_id = 'rolling12'").first()
    assert (dealer.dim_value, dealer.display_name) == ("D1", "Dealer One")
    assert dealer.related_agents == ["Agent One"] and dealer.claims_paid == D(250)


def test_period_bounds(spark, folder):
    rep = report(spark, folder, [contract("s", "C1", "07/05/2026")])
    bounds = {r.period_id: (r.period_start, r.period_end) for r in rep.periods.collect()}
    assert bounds["current_month"] == (date(2026, 7, 1), date(2026, 7, 31))
    assert bounds["prior_month"] == (date(2025, 7, 1), date(2025, 7, 31))
    assert bounds["ytd"] == (date(2026, 1, 1), date(2026, 7, 31))
    assert bounds["rolling12"] == (date(2025, 8, 1), date(2026, 7, 31))
    assert bounds["prior_rolling12"] == (date(2024, 8, 1), date(2025, 7, 31))
    assert bounds["prior_year"] == (date(2025, 1, 1), date(2025, 12, 31))
    assert len(bounds) == 32


def test_as_of_month_is_always_open(spark, folder):
    rep = report(spark, folder, [contract("s", "C1", "07/05/2026")], as_of=date(2026, 7, 31))
    assert period(rep)["period_end"] == date(2026, 6, 30)


def test_test_entities_are_dropped(spark, folder):
    rep = report(spark, folder, [contract("s", "C1", "07/05/2026", Agent=" Test ")])
    assert period(rep)["contracts_written"] == 0 and rep.issues.count() == 0


def test_cancellation_only_contract_has_a_written_reference(spark, folder):
    rep = report(spark, folder, [], [cancellation("x", "C9", "06/05/2026", "07/20/2026")])
    rows = {r.source_id: r for r in rep.transactions.collect()}
    assert set(rows) == {"x", "x:written-reference"}
    assert rows["x:written-reference"].contract_status == "C"
    june = period(rep, "2026-06")
    assert (june["contracts_written"], june["reserve_written"]) == (1, D(500))
    july = period(rep)
    assert (july["contracts_written"], july["contracts_cancelled"], july["active_contracts"]) == (0, 1, 0)


def test_cancel_date_forces_cancellation(spark, folder):
    doc = contract("s", "C1", "05/05/2026", CancelBillDate="07/01/2026")
    doc["CancelledAmount"] = CANCELLED
    rep = report(spark, folder, [doc])
    assert [r.transaction_type for r in rep.transactions.collect()] == ["Cancellation"]
    assert [r.category for r in rep.issues.collect()] == ["Data Validation"]


def test_newest_snapshot_wins_and_ties_go_to_the_last(spark, folder):
    rows = [
        contract("a", "C1", "07/05/2026", ExtractionDate="2026-07-09"),
        contract("b", "C1", "07/06/2026", ExtractionDate="2026-07-08"),
        contract("c", "C2", "07/05/2026", ExtractionDate="2026-07-09"),
        contract("d", "C2", "07/06/2026", ExtractionDate="2026-07-09"),
        contract("e", "C3", "07/05/2026", ExtractionDate="2026-07-01"),
        contract("f", "C3", "07/05/2026", kind="Adjustment", ExtractionDate="2026-07-02"),
    ]
    rep = report(spark, folder, rows)
    assert {r.source_id for r in rep.transactions.collect()} == {"a", "d", "f"}


def test_earning_curve(spark, folder):
    flat = {"RESERVE": {"BASERESERVE": 1000}}
    rep = report(
        spark, folder,
        [
            contract("a", "A", "06/15/2026", written=flat, curve={1: 0.1, 2: 0.25, 3: 0.5}),
            contract("b", "B", "06/15/2026", written=flat, curve={1: 0.1, 2: 0, 3: 0.5}),
            contract("c", "C", "06/15/2026", written=flat, curve={1: 0.1, 2: 0.2}, status="E"),
            contract("d", "D", "06/15/2026", written=flat),
            contract("e", "E", "06/15/2026", written=flat, curve={1: 0.1, 2: 0.2},
                     EffectiveDate="09/01/2026"),
        ],
    )
    earned = {r.contract_number: r.earned_reserve_amount for r in rep.transactions.collect()}
    # a factor of zero is read as missing, and a missing one as fully earned
    assert earned == {"A": D(250), "B": D(1000), "C": D(1000), "D": D(1000), "E": D(0)}
    assert period(rep, "2026-06")["earned_reserve"] == D(100 + 100 + 1000 + 1000 + 0)
    assert period(rep, "inception")["earned_reserve"] == D(250 + 1000 + 1000 + 1000)


def test_sale_and_cancellation_in_different_periods(spark, folder):
    flat = {"RESERVE": {"BASERESERVE": 1000}}
    back = {"RESERVE": {"BASERESERVE": -400}}
    rep = report(
        spark, folder,
        [contract("a", "A", "06/15/2026", written=flat, curve={1: 0.1, 2: 0.2})],
        [cancellation("x", "A", "06/15/2026", "07/10/2026", amounts=back)],
    )
    assert period(rep, "2026-06")["earned_reserve"] == D(100)
    july = period(rep)
    assert (july["earned_reserve"], july["reserve_cancelled"]) == (D(0), D(400))
    assert period(rep, "ytd")["earned_reserve"] == D(600)


def test_blank_numbers_count_as_one_contract(spark, folder):
    flat = {"RESERVE": {"BASERESERVE": 100}, "ADMIN": {"BASEADMIN": 10}}
    rep = report(
        spark, folder,
        [contract("a", "", "07/05/2026", written=flat), contract("b", " ", "07/06/2026", written=flat)],
    )
    assert rep.transactions.count() == 2
    m = period(rep)
    assert (m["contracts_written"], m["active_contracts"]) == (1, 0)
    assert (m["reserve_written"], m["earned_reserve"], m["net_admin"]) == (D(200), D(200), D(0))
    assert {r.earned_reserve_amount for r in rep.transactions.collect()} == {D(0)}


def test_unknown_type_is_not_written(spark, folder):
    rep = report(spark, folder, [contract("a", "A", "07/05/2026", kind="odd", status="V")])
    assert period(rep)["contracts_written"] == 0
    assert rep.transactions.first().earned_reserve_amount == D(500)
    assert [r.category for r in rep.issues.collect()] == ["Unknown Transaction"]


def test_moved_contract_stays_active_for_the_old_dealer(spark, folder):
    rep = report(
        spark, folder,
        [contract("a", "A", "06/05/2026")],
        [cancellation("x", "A", "06/05/2026", "07/10/2026", DealerNumber="D2", DealerName="Two")],
    )
    dealers = {
        r.dim_value: r
        for r in rep.dimension_table(["dealer"]).where("period_id = 'inception'").collect()
    }
    assert (dealers["D1"].active_contracts, dealers["D1"].net_admin) == (1, D(100))
    assert (dealers["D2"].active_contracts, dealers["D2"].contracts_cancelled) == (0, 1)
    assert period(rep, "inception")["active_contracts"] == 0


def test_component_rules(spark, folder):
    odd = {
        " reserve ": {"BASERESERVE": "$1,234.50", "ADMIN": "10", "SLUSH": 5, "x": "1d"},
        "ADMIN": {"BASEADMIN": 20, "Roadside AKMC 1": 7, "OTHERCOMM": 3},
        "NOTE": "no object",
        "FEES": {"DOC": 2, "F&I": 50, "LOANPMT": 4},
    }
    rep = report(spark, folder, [contract("a", "A", "07/05/2026", written=odd)])
    row = rep.transactions.first()
    assert row.reserve_amount == D("1234.50")
    assert row.admin_amount == D(30)
    assert row.gross_income_amount == D("1234.50") + 10 + 5 + 20 + 7 + 2
    assert {(c.category, c.component) for c in row.components} >= {("ADMIN", "BASEADMIN"), ("FEES", "DOC")}


def test_excluded_codes_are_configurable(spark, folder):
    rep = report(
        spark, folder, [contract("a", "A", "07/05/2026")], excluded_component_codes=("BASEADMIN",)
    )
    assert rep.transactions.first().admin_amount == D(0)


def test_repeated_payments(spark, folder):
    same = dict(contract_number="C1", day="07/10/2026", paid="50")
    rep = report(
        spark, folder, [contract("s", "C1", "07/05/2026")], [],
        [
            claim("a", "CL1", **same, ExtractionDate="2026-07-11"),
            claim("b", "CL1", **same, ExtractionDate="2026-07-11"),
            claim("c", "CL1", **same, ExtractionDate="2026-07-12"),
            claim("d", "CL2", "C1", "07/11/2026", "100", **{"Claim Description": "PerRepair"}),
            claim("e", "CL3", "C1", "bad", "5"),
            claim("f", "CL4", "C1", "07/11/2026", "9", **{"Claim Status": "Open"}),
            claim("g", "CL5", "C1", "07/11/2026", "9",
                  **{"Claim Status": "Open", "Activity": "Payment Issued"}),
            claim("h", "CL6", "C1", "07/11/2026", "Infinity"),
        ],
    )
    assert {r.source_id for r in rep.claims.collect()} == {"b", "c", "d", "g"}
    m = period(rep)
    assert (m["claims_paid"], m["claim_count"]) == (D(50 + 50 - 100 + 9), 3)
    assert [r.category for r in rep.issues.collect()] == ["Invalid Claim Date"]


def test_empty_text_and_null_differ_for_claims(spark, folder):
    rep = report(
        spark, folder,
        [contract("s", "C1", "07/05/2026", **{"Agent": "", "Agent Number": "A7"})], [],
        [
            claim("a", "CL1", "C1", "07/10/2026", "1", **{"Agent Number": "", "Agent": "A8"}),
            claim("b", "CL2", "C1", "07/10/2026", "1", **{"Agent Number": None, "Agent": "A8"}),
        ],
    )
    assert rep.transactions.first().agent == "A7"
    assert {r.source_id: r.agent for r in rep.claims.collect()} == {"a": "Unassigned", "b": "A8"}


def test_one_claim_with_many_codes(spark, folder):
    paid = [20 + 5 * k for k in range(16)]
    rep = report(
        spark, folder, [contract("s", "C1", "07/05/2026")], [],
        [
            claim(f"p{k}", "CL1", "C1", "07/10/2026", str(v), **{"Loss Code": f"CL{k:03d}"})
            for k, v in enumerate(paid)
        ],
    )
    kpi = lc.loss_code_kpis(rep.claims, rep.periods).where("period_id = 'rolling12'").first()
    assert (kpi.claim_count, kpi.loss_code_count, kpi.total_paid) == (1, 16, D(sum(paid)))
    shown = [r.loss_code for r in lc.visible_rows(rep.loss_codes).collect()]
    assert len(shown) == sum(1 for v in paid if v / sum(paid) >= 0.02)


def test_top_makes_are_limited(spark, folder):
    from pactlens.functions import calendar as cal

    rep = report(
        spark, folder, [contract("s", "C1", "07/05/2026")], [],
        [claim(f"m{k}", f"CL{k}", "C1", "07/10/2026", str(130 - 10 * k), Make=f"make {k:02d}")
         for k in range(1, 13)],
    )
    rows = lc.top_makes(rep.claims, cal.pick(rep.cfg, "rolling12")[0]).orderBy("rank").collect()
    assert [r.vehicle_make for r in rows] == [f"MAKE {k:02d}" for k in range(1, 11)]
    assert (rows[0].paid_amount, rows[-1].paid_amount) == (D(120), D(30))


def test_blank_claim_number_finds_blank_contract(spark, folder):
    rep = report(
        spark, folder, [contract("s", "", "07/05/2026", ProductType="GAP")], [],
        [claim("a", "CL1", "", "07/10/2026", "1")],
    )
    row = rep.dimension_table(["product"]).where("period_id = 'inception'").first()
    assert (row.dim_value, row.claims_paid) == ("GAP", D(1))


def test_a_target_has_the_rows_known_by_its_name_alone(spark, tmp_path):
    rep = report(
        spark, tmp_path,
        [contract("a", "C1", "07/05/2026", DealerNumber="D1", DealerName="Dealer One", Agent="AG1", AgentName="Agent One"),
         contract("b", "C2", "07/06/2025", DealerNumber="", DealerName="Dealer One", Agent="Agent One")],
        claims=[claim("p", "CL1", "C9", "07/10/2026", "70", **{"Selling Dealer Number": "", "Loss Code": "zz1"})],
    )
    rep._materialise = True
    rows = rep.of_entities(rep.transactions, "dealer", "dealer_number", "dealer_name")
    lines = rep.of_entities(rep.claims, "dealer", "dealer", "dealer_name")
    found = {r["dim_value"]: r for r in it.target_summaries(rep.dimensions, rows, lines, rep.cfg, "dealer").collect()}
    assert found["D1"]["top_code"]["loss_code"] == "ZZ1" and str(found["D1"]["top_code"]["amount"]).startswith("70")
    assert str(found["D1"]["first_date"]) < "2026"  # the contract sold under the name alone
