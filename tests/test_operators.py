"""Operators against brute force, invariants, sources and sinks."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from pactlens.config import ReportConfig, parse_as_of
from pactlens.functions import components as comp
from pactlens.functions import scalars as s
from pactlens.operators import dedupe as dd
from pactlens.operators import dimensions as dm
from pactlens.operators import pricing as pr
from pactlens.operators import ranking
from pactlens.plans.queries import CFG, QUERIES, report
from pactlens.sources import readers, writers
from pactlens.sources.schemas import PII_FIELDS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rep(spark):
    return report(spark, SF)


def test_entry_module_needs_no_session_to_import():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_parse_as_of():
    assert parse_as_of(["--as-of", "2026-07-31"]) == date(2026, 7, 31)
    assert parse_as_of(["x", "2026-07-30"]) == date(2026, 7, 30)
    assert parse_as_of([], today=date(2026, 1, 2)) == date(2026, 1, 2)
    with pytest.raises(ValueError):
        parse_as_of(["--as-of", "July"])


def test_config_limits():
    with pytest.raises(ValueError):
        ReportConfig(as_of=date(2026, 1, 1), top_dealer_count=0)
    env = {"EXCLUDED_COMPONENT_CODES": " fee, ,tax", "LOSS_RATIO_HIGH": "0.8"}
    cfg = ReportConfig.from_args(["2026-01-01"], env)
    assert cfg.excluded_component_codes == ("FEE", "TAX") and cfg.high_loss_ratio == 0.8


@pytest.mark.parametrize("width", [7, 1_000_000])
def test_number_within_matches_plain_numbering(spark, width):
    rng = random.Random(1)
    # one group holds most of the rows
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(5)}", i) for i in range(400)]
    rng.shuffle(rows)
    expected, seen = {}, defaultdict(int)
    for g, i in sorted(rows, key=lambda r: r[1]):
        seen[g] += 1
        expected[(g, i)] = seen[g]
    df = spark.createDataFrame(rows, "g string, o bigint")
    got = dd.number_within(df, ["g"], "o", [], width)
    assert {(r.g, r.o): r.n for r in got.collect()} == expected


def test_dedupe_is_idempotent(rep):
    again = dd.dedupe_claims(rep.claims.drop("occurrence", "place"))
    assert again.count() == rep.claims.count()


def test_one_shuffle_makes_the_ledger(rep):
    plan = dd.contract_ledger(rep.contract_rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_no_python_in_plans(rep, spark):
    for name in ("period_metrics_all", "dealer_metrics", "loss_code_rows", "coverage_summary"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan
        assert "CartesianProduct" not in plan


def test_only_needed_fields_are_scanned(rep):
    rep.spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = rep.metrics._jdf.queryExecution().executedPlan().toString()
    assert "earning_schedule" in plan
    assert "components" not in plan and "dealer_name" not in plan


def test_written_reserve_adds_up_over_dealers(rep):
    total = rep.metrics.where("period_id = 'inception'").first().reserve_written
    for dim in ("dealer", "agent", "product"):
        parts = rep.dimension(dim, "inception").agg(F.sum("reserve_written")).first()[0]
        assert parts == total


def test_months_add_up_to_the_rolling_year(rep):
    rows = {r.period_id: r for r in rep.metrics.collect()}
    year = [rows[f"2000-{m:02d}"] for m in range(7, 13)] + [rows[f"2001-{m:02d}"] for m in range(1, 7)]
    for c in ("claims_paid", "reserve_written", "admin_cancelled"):
        assert sum(r[c] for r in year) == rows["rolling12"][c]
    for r in rows.values():
        assert r.contracts_written <= rows["inception"].contracts_written


def test_an_earlier_day_from_rows_normalised_under_a_later_one(rep, spark):
    from pactlens.plans.report import Report

    earlier = replace(CFG, as_of=date(2000, 2, 10))
    documents = rep.contract_documents, rep.claim_documents, rep.audits
    fresh = Report(spark, earlier, *documents)
    reused = Report(spark, earlier, *documents)
    reused.__dict__.update(all_contract_rows=rep.all_contract_rows, all_claim_rows=rep.all_claim_rows)
    columns = ["period_id", "contracts_written", "earned_reserve", "claims_paid", "net_reserve"]
    a, b = (sorted(map(tuple, r.metrics.select(*columns).collect())) for r in (fresh, reused))
    assert a == b and any(row[2] for row in a)


def test_whole_curves_are_stored(rep):
    longest = rep.all_contract_rows.agg(F.expr("max(cardinality(earning_schedule))")).first()[0]
    assert longest == 60
    later = rep.all_contract_rows.where(f"activity_date > date'2001-06-30'").count()
    assert later + rep.contract_rows.count() == rep.all_contract_rows.count()


def test_shares_add_up(rep):
    for chart in ("reserve", "admin"):
        rows = dm.product_mix(rep.dimension("product", "inception")).where(f"chart = '{chart}'")
        assert abs(rows.agg(F.sum("share")).first()[0] - 1) < 1e-9


def test_no_customer_fields_anywhere(rep):
    for df in (rep.contract_rows, rep.claim_rows, rep.issues, rep.dimensions):
        assert not {c.lower() for c in df.columns} & {p.lower() for p in PII_FIELDS}


def test_drop_pii_reaches_into_metadata(spark):
    df = spark.createDataFrame(
        [("a", ("x", "y"), "z")], "VIN string, metadata struct<CustomerEmail:string,k:string>, k string"
    )
    kept = readers.drop_pii(df)
    assert kept.columns == ["metadata", "k"] and kept.schema["metadata"].dataType.names == ["k"]


def test_numbers_and_dates(spark):
    cases = [
        ("$1,234.50", "1234.5000", "7/5/2026", "2026-07-05 00:00:00"),
        ("12 %", "12.0000", "07/05/2026 3:04:05 PM", "2026-07-05 15:04:05"),
        ("1d", "0.0000", "2026-07-05T10:11:12.9Z", "2026-07-05 10:11:12"),
        ("NaN", "0.0000", "13/45/2026", None),
        ("1e3", "1000.0000", "", None),
        (None, "0.0000", None, None),
        ("\t5\u00a0\n", "5.0000", "\u00a07/5/2026\ufeff", "2026-07-05 00:00:00"),
        ("99999999999999.9999", "99999999999999.9999", "5/1/21", "2021-05-01 00:00:00"),
        ("-$1.00", "-1.0000", "5/1/75", "1975-05-01 00:00:00"),
        ("abc", "0.0000", "05/01/2021 13:05:06.123", "2021-05-01 13:05:06"),
        ("", "0.0000", "1/5/2024, 10:00:00 AM", "2024-01-05 10:00:00"),
        (" ", "0.0000", "2024-01-05 10:00 AM", "2024-01-05 10:00:00"),
        ("Infinity", "0.0000", "Jan 5, 2024", "2024-01-05 00:00:00"),
        ("1 000", "1000.0000", "January 5, 2024 3:04 PM", "2024-01-05 15:04:00"),
        ("$", "0.0000", "2024/01/05", "2024-01-05 00:00:00"),
        ("5%", "5.0000", "2024/1/5 23:59", "2024-01-05 23:59:00"),
        (".5", "0.5000", "01-05-2024", "2024-01-05 00:00:00"),
        ("5.", "5.0000", "12:30", None),
        ("--1", "0.0000", "T09:15", None),
        ("+7", "7.0000", "9:15 AM", None),
        ("0x10", "0.0000", "2024", "2024-01-01 00:00:00"),
        ("1,2", "12.0000", "2024-03", "2024-03-01 00:00:00"),
        ("1.23456", "1.2346", "2026-07-05T10:11:12+02:00", "2026-07-05 08:11:12"),
        ("1E2", "100.0000", "2026-07-05 10:11:12", "2026-07-05 10:11:12"),
        ("null", "0.0000", "soon", None),
        ("(5)", "0.0000", "2/30/2024", "2024-03-01 00:00:00"),
        ("5-", "0.0000", "12/31/1999 12:00:00 AM", "1999-12-31 00:00:00"),
        ("1,234,567.89", "1234567.8900", "Dec 31 1999", "1999-12-31 00:00:00"),
        ("\ufeff3", "3.0000", "5/1/2021x", None),
        ("3\u2003", "3.0000", "20240105", None),
    ]
    df = spark.createDataFrame([(a, d) for a, _, d, _ in cases], "a string, d string")
    rows = df.selectExpr(f"{s.lenient_number('a')} AS a", f"{s.lenient_timestamp('d')} AS d").collect()
    assert [(str(r.a), r.d and str(r.d)) for r in rows] == [(a, d) for _, a, _, d in cases]


def test_spellings_of_dates(spark):
    same_day = [
        "2024-1-5", "2024-01-5", "2024/1/5", "5 Jan 2024", "05 Jan 2024", "5-Jan-2024", "05-JAN-24", "Jan 5 24",
        "Fri Jan 05 2024", "Fri, 05 Jan 2024", "Friday, January 5, 2024", "January 5,2024", "jan. 5 2024", "1-5-24",
        "01 05 2024", "Fri, 05 Jan 2024 00:00:00 GMT", "Fri Jan 05 2024 00:00:00 GMT+0000 (Coordinated Universal Time)",
        "2024-01-05T00:00Z", "2024-01-05T05:30:00+05:30", "2024-01-04T19:00:00-0500", "2024-01-04 24:00:00",
        "1/5/2024 12:00 AM", "1/5/2024 12:00:00am", "2024-01-05T00:00:00.000Z", "2024-01-05 00:00:00.999999",
    ]
    other = [
        ("02/30/2024", "2024-03-01 00:00:00"), ("2023-02-31", "2023-03-03 00:00:00"), ("12/31/49", "2049-12-31 00:00:00"),
        ("12/31/50", "1950-12-31 00:00:00"), ("1/5/2024 12:30 PM", "2024-01-05 12:30:00"), ("0099-03", "0099-03-01 00:00:00"),
        ("5 Sept 2024 7:08", "2024-09-05 07:08:00"), ("2024-01-05 23:30:00 -01:00", "2024-01-06 00:30:00"),
        ("1969-12-31T23:59:59Z", "1969-12-31 23:59:59"),
        ("2/32/2024", None), ("0/5/2024", None), ("2024-13-01", None), ("5 Foo 2024", None), ("1/5/2024 13:00 PM", None),
        ("1/5/2024 24:00:01", None), ("1/5/2024 10:60", None), ("2024;01;05;;;;;", None), ("202", None), ("1/5", None),
        ("2024-01-05T", None), ("an fe 5 2024", None), ("1/5/20245", None), (";;;;;;;", None),
    ]
    cases = [(d, "2024-01-05 00:00:00") for d in same_day] + other
    df = spark.createDataFrame(cases, "d string, want string")
    rows = df.selectExpr("d", "want", f"cast({s.lenient_timestamp('d')} AS string) AS got").collect()
    assert [(r.d, r.got) for r in rows] == [(r.d, r.want) for r in rows]


def test_first_readable_extraction_date_counts(spark):
    df = spark.createDataFrame(
        [(["soon", None, "1/5/2024", "1/6/2024"], "x"), (["", None], "65920080aaaaaaaaaaaaaaaa"), ([], "x"), (None, "x")],
        "c array<string>, i string",
    )
    rows = df.selectExpr(f"cast({s.snapshot_timestamp('c', 'i')} AS string) AS t").collect()
    assert [r.t[:10] for r in rows] == ["2024-01-05", "2024-01-01", "1970-01-01", "1970-01-01"]


def test_documents_are_parsed_once(rep):
    rep.contract_rows, rep.claim_rows, rep.issues
    for df in (rep.all_contract_rows, rep.all_claim_rows, rep.issues, rep.evaluated_contracts, rep.evaluated_claims):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_replace" not in plan and "Join" not in plan
    files = set(rep.issues.inputFiles()) | set(rep.evaluated_claims.inputFiles()) | set(rep.evaluated_contracts.inputFiles())
    assert not any("/testdata/" in f for f in files)


def test_blanks_of_all_kinds_are_trimmed(spark):
    df = spark.createDataFrame([("\tA B\n",), ("\u00a0A B\u2003",), ("\ufeffA B ",), ("A B",)], "t string")
    rows = df.selectExpr(f"{s.text('t')} AS t", f"{s.business_id('t')} AS i").distinct().collect()
    assert [tuple(r) for r in rows] == [("A B", "AB")]


def test_an_amount_too_large_is_an_error(spark):
    df = spark.createDataFrame([("123456789012345",)], "a string")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        df.selectExpr(f"{s.lenient_number('a')} AS a").collect()


def test_component_names(spark):
    names = ["OEM Transport x", "premtax", "Comm", "Loan", "LOANPMT", "my code"]
    cfg = ReportConfig(as_of=date(2026, 1, 1), excluded_component_codes=("MY CODE",))
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.selectExpr(
        "n",
        f"{comp.excluded_component('n', 'RESERVE', cfg)} AS r",
        f"{comp.excluded_component('n', 'ADMIN', cfg)} AS a",
    ).collect()
    assert [r.n for r in rows if r.r] == ["OEM Transport x", "Comm", "LOANPMT", "my code"]
    assert [r.n for r in rows if r.a] == ["premtax", "Comm", "LOANPMT", "my code"]


def test_snapshot_upsert_replaces_one_day_only(spark, tmp_path):
    path = str(tmp_path / "snap")
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    writers.upsert_snapshot(df, path, date(2026, 6, 30))
    writers.upsert_snapshot(df, path, date(2026, 7, 31))
    writers.upsert_snapshot(df.withColumn("v", F.lit(2)), path, date(2026, 7, 31))
    rows = {str(r.as_of): r.v for r in spark.read.parquet(path).collect()}
    assert rows == {"2026-06-30": 1, "2026-07-31": 2}


def test_audits_are_normalised(spark, tmp_path):
    path = tmp_path / "audits.json"
    path.write_text(
        '{"_id":"1","jobType":"Claim","executionTimestamp":"2026-08-01T01:00:00Z",'
        '"counts":{"portalCount":"2,864","uniqueCount":"2865","processedCount":14400,'
        '"uploadedCount":14400},"reconciliation":{"isMatch":false,"status":"DISCREPANCY"}}\n'
        '{"_id":"0","jobType":"Claim","executionTimestamp":"2026-07-01T01:00:00Z","counts":{}}\n'
        '{"_id":"2","jobType":"Contract","executionTimestamp":"2026-08-01T01:00:00Z",'
        '"counts":{"portalCount":3,"processedCount":3,"uploadedCount":3},'
        '"reconciliation":{"isMatch":true,"status":"PASSED"}}\n'
    )
    from pactlens.operators import quality as q

    audits = readers.latest_audits(readers.read_audits(spark, str(path)))
    rows = {r.job_type: r for r in q.audit_reconciliation(audits).collect()}
    assert (rows["Claim"].status, rows["Claim"].unit_variance) == ("PASSED", 1)
    assert (rows["Contract"].status, rows["Contract"].unique_units) == ("PASSED", 3)


def test_extended_json_values(spark, tmp_path):
    path = tmp_path / "contracts.json"
    doc = (
        '{"_id":{"$oid":"64b0c0a0c0a0c0a0c0a0c0a0"},"metadata":{"Contract#":"C1","ActivationDate":%s,'
        '"EffectiveDate":{"$date":{"$numberLong":"1783468800000"}}},'
        '"WrittenAmount":{"ADMIN":{"BASEADMIN":{"$numberDecimal":"12.5"},"X":{"$numberInt":"3"}}},'
        '"CalculatedFields":{"EarningCurve":{"schedule":{"1":{"cumulativeFactor":{"$numberDouble":"0.25"}}}}}}\n'
    )
    path.write_text(doc % '{"$date":"2026-07-05T00:00:00Z"}' + doc % '"7/5/2026"')
    from pactlens.operators import normalize as nz

    cfg = ReportConfig(as_of=date(2026, 8, 1))
    rows = nz.normalize_contracts(nz.evaluate_contracts(readers.read_contracts(spark, str(path))), cfg).collect()
    assert len(rows) == 2
    for r in rows:
        assert (str(r.activity_date), str(r.effective_date)) == ("2026-07-05", "2026-07-08")
        assert str(r.admin_amount) == "15.5000" and str(r.earning_schedule[1]) == "0.2500000000"
    audits = tmp_path / "audits.json"
    audits.write_text(
        '{"_id":"1","jobType":"Claim","executionTimestamp":{"$date":"2026-08-01T01:00:00Z"},"counts":{"portalCount":1}}\n'
        '{"_id":"2","jobType":"Claim","executionTimestamp":{"$date":"2026-07-01T01:00:00Z"},"counts":{"portalCount":2}}\n'
    )
    assert readers.latest_audits(readers.read_audits(spark, str(audits))).first().portal_count == 1


def test_narratives_read_as_sentences(rep, spark):
    rows = QUERIES["target_narratives"](spark, SF).collect()
    assert len(rows) == rep.dimensions.where("dim <> 'product'").select("dim", "dim_value").distinct().count()
    assert all("since the first contract, a loss ratio of" in r.narrative for r in rows)
    text = QUERIES["portfolio_narrative"](spark, SF).first().narrative
    assert text.startswith(f"{CFG.company_name} since inception: ") and "years on the books" in text


@pytest.mark.parametrize("groups", [["g"], ["g", "h"], []])
def test_ranks_of_groups_over_many_partitions(spark, tmp_path, groups):
    df = spark.range(20_000).selectExpr(
        "id", "if(id % 10 < 7, 'hot', concat('g', id % 50)) AS g", "id % 2 AS h", "(id * 7919) % 1009 AS v"
    )
    kept = []

    def keep(x):
        path = str(tmp_path / "kept")
        x.write.mode("overwrite").parquet(path)
        kept.append(spark.read.parquet(path))
        return kept[0]

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = ranking.ranked(df, groups, [F.desc("v"), F.asc("id")], keep)
        by = f"PARTITION BY {', '.join(groups)}" if groups else ""
        wanted = df.selectExpr("*", f"cast(row_number() OVER ({by} ORDER BY v DESC, id) AS long) AS rank")
        assert found.exceptAll(wanted.select(found.columns)).count() == 0 and found.count() == 20_000
        # the hot group lies in many partitions
        assert kept[0].where("g = 'hot'").select("_part").distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("slice_rows", [1, 7, 4096])
def test_median_of_a_group_of_many_amounts(spark, tmp_path, slice_rows):
    rows = spark.range(6_001).selectExpr(
        "if(id % 3 < 2, 'hot', concat('c', id % 40)) AS loss_code", "if(id % 3 < 2, 'bmw', 'kia') AS vehicle_make",
        "cast(if(id % 3 < 2, id * 7919 % 5003, id % 2) AS decimal(18,4)) AS paid_amount",
    )
    kept = []

    def keep(df):
        kept.append(str(tmp_path / f"kept-{len(kept)}"))
        df.write.parquet(kept[-1])
        return spark.read.parquet(kept[-1])

    found = pr.claim_benchmark(rows, keep, slice_rows=slice_rows)
    wanted = rows.groupBy("loss_code", "vehicle_make").agg(
        F.count("*").alias("line_count"), F.expr("median(cast(paid_amount AS double)) AS median_paid")
    ).where("line_count >= 5")
    plain = lambda df: sorted(map(tuple, df.select("loss_code", "line_count", "median_paid").collect()))
    assert plain(found) == plain(wanted)
    # one sum is never taken over all amounts of the group: windows are over slices of its ranks
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(loss_code#" in plan and "paid_amount" in plan
    assert not [x for x in plan.split("\n") if "Window [sum(uses" in x and "_slice" not in x]


def test_a_bound_on_the_activation_prunes_folders(spark, tmp_path):
    rows = [(0, "a", "2026-01-31"), (0, "b", "2/1/2026"), (0, "c", "2026-02-14T10:00:00Z"), (0, "d", "14 Mar 2026"),
            (0, "e", None), (0, "f", "soon"), (1, "g", "2025-05-05"), (1, "h", None)]
    docs = spark.createDataFrame(rows, "feed int, source_id string, activation string")
    path = str(tmp_path / "store")
    writers.write_contract_store(docs.limit(0), path)
    writers.write_contract_store(docs.where("source_id < 'd'"), path)
    writers.write_contract_store(docs.where("source_id >= 'd'"), path)
    stored = lambda bound: readers.read_contract_store(spark, path, docs.schema, bound)
    assert sorted(map(tuple, stored(None).collect()), key=repr) == sorted(rows, key=repr)
    found = stored(date(2026, 2, 10))
    assert sorted(r.source_id for r in found.collect()) == ["c", "d", "g", "h"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*activation_month[^\]]*2026-02-01", plan)
