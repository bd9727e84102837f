"""Sizes of what the steps write and hold, on small input."""

import random
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pactlens.operators import dedupe as dd
from pactlens.operators import dimensions as dm
from pactlens.operators import normalize as nz
from pactlens.plans import queries as Q
from pactlens.plans.report import Report
from pactlens.sources import documents, mapping as mp, readers

SF = "/root/testdata/sf0.001"


def _files(path):
    return [f for f in Path(path).iterdir() if f.name.startswith("part-")]


def test_documents_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "_PER_FILE", 100)
    rows = mp.contract_documents(spark, SF).where("feed = 0")
    documents.write_contract_documents(rows, f"{tmp_path}/contracts")
    documents.write_claim_documents(mp.claim_documents(spark, SF), f"{tmp_path}/claims")
    for name, read, one in (
        ("contracts", readers.read_contracts, rows), ("claims", readers.read_claims, mp.claim_documents(spark, SF))
    ):
        files = _files(tmp_path / name)
        assert files and all(f.name.endswith(".gz") for f in files)
        lines = spark.read.text(f"{tmp_path}/{name}").selectExpr("sum(length(value) + 1)").first()[0]
        assert sum(f.stat().st_size for f in files) * 5 < lines
        assert max(spark.read.text(str(f)).count() for f in files) <= 100
        back = read(spark, f"{tmp_path}/{name}").select("source_id", "ingest_ord")
        assert sorted(back.collect()) == sorted(one.select("source_id", "ingest_ord").collect())


def _shared_name(spark, n):
    """``n`` dealers of one name with a row each by code and by name, and odd ones."""
    keys = [(f"D{i}", k) for i in range(n) for k in (f"D{i}", "SHARED")]
    keys += [("Shared", "SHARED"), ("Shared", "D3"), ("X", "X"), ("X", "Y"), ("X", "Z")]
    rows = [(f"d{i} ", "Shared", f"g{i % 2}", i) for i in range(n)]
    rows += [("SHARED", "d3", "g0", 100), ("x", " x", "g0", 7), ("y", "z", "g1", 9), (None, "Y", "g1", 11),
             ("Z", None, None, 13), ("nobody", "", "g0", 15), ("d4", "d5", "g1", 17)]
    return (
        spark.createDataFrame([("dealer", *k) for k in keys], "dim string, entity string, key string"),
        spark.createDataFrame(rows, "code string, name string, g string, v bigint"),
    )


def test_entity_sums_equal_sums_of_entity_rows(spark):
    keys, rows = _shared_name(spark, 8)
    expected = dd.entity_rows(rows, keys, "dealer", "code", "name").groupBy("entity", "g").agg(
        F.sum("v").alias("v"), F.min("v").alias("first")
    )
    found = dd.entity_sums(
        rows.withColumn("first", F.col("v")), keys, "dealer", "code", "name", ["g"], ["v"], ["first"]
    )
    key = lambda r: (r.entity, r.g or "", r.v, r["first"])
    columns = ["entity", "g", "v", "first"]
    assert sorted(found.select(columns).collect(), key=key) == sorted(expected.select(columns).collect(), key=key)


def test_entity_sums_do_not_repeat_the_rows_of_a_shared_name(spark, monkeypatch):
    """Rows that meet entities grow with the entities, not with their square."""
    met = {}
    for n in (40, 80):
        keys, rows = _shared_name(spark, n)
        seen, union = Observation(), type(rows).unionByName

        def counted(self, *args, **kwargs):
            return union(self, *args, **kwargs).observe(seen, F.count(F.lit(1)).alias("n"))

        with monkeypatch.context() as patched:
            patched.setattr(type(rows), "unionByName", counted)
            dd.entity_sums(rows, keys, "dealer", "code", "name", ["g"], ["v"]).collect()
        met[n] = seen.get["n"]
    assert met[80] < 2.2 * met[40]


def test_lost_rows_are_counted_by_short_keys(spark):
    make = lambda rows: spark.createDataFrame(rows, "a string, m map<string,int>")
    one, two = ("x" * 5000, {"k": 1}), ("y" * 5000, None)
    before, back = make([one, one, two]), make([one, two, two])
    assert Q._lost(before, back).collect() == [(1,)]
    assert Q._lost(before, before).collect() == [(0,)] and Q._lost(before, make([])).collect() == [(3,)]
    assert {len(r.row) for r in Q._row_keys(before, before.columns).collect()} == {32}


def test_metrics_are_computed_once_for_all_their_writers(spark):
    rep = Report(spark, mp.CONFIG, mp.contract_documents(spark, SF), mp.claim_documents(spark, SF))
    plan = rep.metrics.where("horizon <> 'month'")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    assert rep.metrics.count() == 32


def _payment_lines(spark):
    rng = random.Random(3)
    rows, order = [], list(range(300))
    rng.shuffle(order)
    for i in order:
        key = rng.choice(["hot", "hot", "a", "b", "", None])
        rows.append((key, f"s{i}", i, datetime(2001, 1, 1 + rng.randrange(4)), i * 7 % 11))
    return spark.createDataFrame(rows, "payment_key string, source_id string, ingest_ord bigint, snapshot_ts timestamp, v int")


def test_payments_are_the_same_however_their_keys_are_numbered(spark):
    lines = _payment_lines(spark)
    expected, seen = {}, {}
    for r in sorted(lines.collect(), key=lambda r: r.ingest_ord):
        key = r.payment_key or r.source_id
        n = seen[(key, r.snapshot_ts)] = seen.get((key, r.snapshot_ts), 0) + 1
        last, place = expected.get((key, n), (r, r.ingest_ord))
        expected[(key, n)] = max(last, r, key=lambda x: (x.snapshot_ts, x.ingest_ord)), place
    expected = sorted((r.source_id, r.v, n, place) for (_, n), (r, place) in expected.items())
    for width in (1, 20, 1_000_000):
        found = dd.dedupe_claims(lines, width).select("source_id", "v", "occurrence", "place")
        assert sorted(map(tuple, found.collect())) == expected


def test_payment_lines_are_shuffled_once(spark, tmp_path):
    """One exchange moves the lines; none is left of what is done for hot shares, as there are none."""
    _payment_lines(spark).write.parquet(f"{tmp_path}/lines")
    found = dd.dedupe_claims(spark.read.parquet(f"{tmp_path}/lines"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    moved = [x for x in final.splitlines() if "Exchange hashpartitioning(" in x]
    assert len(moved) == 1 and "_key" in moved[0]


def test_base_tables_are_written_once_and_read_by_columns(spark, tmp_path):
    rep = Report(spark, mp.CONFIG, mp.contract_documents(spark, SF), mp.claim_documents(spark, SF))
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.iterdir()}
    rep.transactions, rep.claims
    made = [p for p in shared.iterdir() if p.name not in before]
    assert sorted(p.name.rsplit("-", 1)[0] for p in made) == ["claim-documents", "claims", "contract-documents", "ledger"]
    assert all(f.name.endswith(".zstd.parquet") for p in made for f in _files(p))
    days = rep.transactions.select("activity_date")._jdf.queryExecution().executedPlan().toString()
    assert "activity_date" in days and "earning_schedule" not in days and "components" not in days


def test_a_task_of_compressed_rows_is_bounded(spark):
    get = lambda k: spark.conf.get(k)
    assert get("spark.sql.files.maxPartitionBytes") == "16m" and get("spark.sql.files.openCostInBytes") == "512k"
    assert int(get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 400


def test_an_unused_document_with_an_amount_too_large_is_no_error(spark):
    """Undated and test documents give no rows, so their amounts and curves are not read."""
    huge = "map('ADMIN', map('BASEADMIN', '123456789012345'))"
    docs = mp.contract_documents(spark, SF).limit(2).withColumn("written", F.expr(huge)).withColumn("cancelled", F.expr(huge))
    undated = docs.withColumn("activation", F.lit("")).withColumn("cancel_bill", F.lit(""))
    test = docs.withColumn("agent_text", F.lit("Test Agent"))
    for some in (undated, test):
        assert nz.normalize_contracts(nz.evaluate_contracts(some), mp.CONFIG).count() == 0
        assert nz.parsed_contracts(nz.evaluate_contracts(some), mp.CONFIG).select("source_id", "own").collect()


def test_a_text_of_a_document_is_looked_up_once(spark, tmp_path):
    """Unwrapping looks at a text several times; the document is asked for it once."""
    rows = mp.contract_documents(spark, SF).where("feed = 0").limit(5)
    documents.write_contract_documents(rows, f"{tmp_path}/contracts")
    back = readers.read_contracts(spark, f"{tmp_path}/contracts")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert plan.count("$.metadata.DealerName") == 1
    curves = {r["source_id"]: r["earning_curve"] for r in back.collect()}
    assert curves == {r["source_id"]: r["earning_curve"] for r in rows.collect()}


def test_curves_with_other_spellings_are_read_whole(spark, tmp_path):
    curve = (
        '{"CalculatedFields": {"EarningCurve": {"schedule": {"1": {"cumulativeFactor": 0.25},'
        ' "x": {"cumulativeFactor": 1}, "02": {"cumulativeFactor": "50 %"}, "3": {"cumulativeFactor": true}, "4": 7,'
        ' "5": {"cumulativeFactor": {"$numberDouble": "0.7"}}}}}}'
    )
    (tmp_path / "odd.json").write_text(curve)
    read = readers.read_contracts(spark, str(tmp_path)).first()["earning_curve"]
    assert read == {1: 0.25, 2: 50.0, 3: 0.0, 4: 0.0, 5: 0.7}


def test_sample_curves_are_constants(spark):
    plan = mp.contract_documents(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(1" not in plan


def _entity_feeds(spark, n, seed):
    """Keys of ``n`` dealers of few names, a ledger whose sides may stand under other dealers, and claims on it."""
    pick = random.Random(seed).choice
    names = ["SHARED", "OTHER"]
    keys = {(f"D{i}", k) for i in range(n) for k in (f"D{i}", names[i % 2])}
    keys |= {(x.title(), k) for i, x in enumerate(names) for k in (x, f"D{i}")}
    some = lambda: pick([f"d{pick(range(n))}", pick(names), "nobody", ""])
    side = lambda kind: (some(), pick(names + [""]), pick("PQR") if pick([1, 1, 0]) else "", kind)
    ledger = [
        (pick(["", f"C{i}"]), side("NewBusiness") if pick([1, 1, 0]) else None, side("Cancellation") if pick([1, 0]) else None,
         i, pick([i - 1, i + 1]))
        for i in range(4 * n)
    ]
    claims = [
        (f"C{pick(range(5 * n))}" if pick([1, 1, 0]) else "", some(), pick(names + [""]), pick(["P", "S", ""]), pick([5, 7, -5, 0]))
        for _ in range(12 * n)
    ]
    one = "struct<dealer_number:string,dealer_name:string,product:string,transaction_type:string>"
    sides = f"contract_number string, w {one}, k {one}, w_place bigint, k_place bigint"
    lines = "contract_number string, dealer string, dealer_name string, product string, paid_amount decimal(18,4)"
    return (
        spark.createDataFrame([("dealer", *k) for k in sorted(keys)], "dim string, entity string, key string"),
        spark.createDataFrame(ledger, sides),
        spark.createDataFrame([(*c[:4], Decimal(c[4])) for c in claims], lines),
    )


@pytest.mark.parametrize("skip", [True, False])
def test_claim_products_by_sums_equal_those_of_entity_rows(spark, skip):
    keys, ledger, claims = _entity_feeds(spark, 6, 3)
    rows = ledger.selectExpr("contract_number", "inline(filter(array("
        "if(w IS NULL, NULL, struct(w.*, w_place AS place)), if(k IS NULL, NULL, struct(k.*, k_place AS place))),"
        " x -> x IS NOT NULL))")
    mine = dd.entity_rows(rows, keys, "dealer", "dealer_number", "dealer_name")
    lines = dd.entity_rows(claims, keys, "dealer", "dealer", "dealer_name")
    expected = dm.claim_products(lines, mine, ["entity"], skip).groupBy(
        "entity", F.col("claim_product").alias("product")
    ).agg(F.sum("paid_amount").alias("claims_paid"))
    found = dd.entity_claim_products(
        claims, ledger, keys, "dealer", "dealer", "dealer_name", "dealer_number", skip
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_product_figures_do_not_repeat_the_rows_of_a_shared_name(spark, monkeypatch):
    monkeypatch.setattr(dd, "entity_rows", None)
    for name in ("product_buckets", "target_summary"):
        assert Q.QUERIES[name](spark, SF).count()
