"""Small document feeds and a report over them."""

from __future__ import annotations

import json
import uuid
from datetime import date
from pathlib import Path

from pactlens.config import ReportConfig
from pactlens.plans.report import Report
from pactlens.sources import readers

TYPE = "Status(NewBusiness,Cancellation,Upgrade,Adjustment)"
WRITTEN = {
    "ADMIN": {"BASEADMIN": 100, "DEALERCOMM": 900, "PACK": 400},
    "RESERVE": {"BASERESERVE": 500, "DEALERRESERVE": 100},
}
CANCELLED = {"ADMIN": {"BASEADMIN": 100, "DEALERCOMM": 900}, "RESERVE": {"BASERESERVE": 500}}


def contract(_id, number, day, *, kind="NewBusiness", status="A", written=None, curve=None, **meta):
    doc = {
        "_id": _id,
        "metadata": {
            "Contract#": number, TYPE: kind, "ContractStatus": status, "ActivationDate": day,
            "Agent": "Agent One", "DealerName": "Dealer One", "DealerNumber": "D1",
            "ProductType": "VSC", "CoverageCode": "VSC-A", "VIN": "1HGCM82633A004352",
            "CustomerEmail": "someone@example.org",
        } | meta,
        "WrittenAmount": WRITTEN if written is None else written,
    }
    if curve:
        schedule = {str(m): {"cumulativeFactor": f} for m, f in curve.items()}
        doc["CalculatedFields"] = {"EarningCurve": {"schedule": schedule}}
    return doc


def cancellation(_id, number, activated, cancelled, *, amounts=None, **meta):
    doc = contract(_id, number, activated, kind="Cancellation", status="C", **meta)
    doc["metadata"]["CancelBillDate"] = cancelled
    doc["CancelledAmount"] = CANCELLED if amounts is None else amounts
    return doc


def claim(_id, number, contract_number, day, paid, **fields):
    return {
        "_id": _id, "Activity": "", "Claim Status": "Paid", "Claim Number": number,
        "Contract Number": contract_number, "Agent Number": "Agent One",
        "Selling Dealer Number": "D1", "Selling Dealer Name": "Dealer One",
        "Coverage Name": "Gold", "Make": "bmw", "Loss Code": "el016",
        "Loss Code Description": "Electrical", "Date Paid": day, "Total Paid Amount": paid,
        "Customer First Name": "Someone",
    } | fields


def write_lines(folder: Path, name: str, docs: list[dict]) -> str:
    path = folder / f"{name}-{uuid.uuid4().hex}.json"
    numbered = [d | {"ingest_ord": i} for i, d in enumerate(docs)]
    path.write_text("".join(json.dumps(d) + "\n" for d in numbered))
    return str(path)


def report(spark, folder, contracts, cancellations=(), claims=(), as_of=date(2026, 8, 1), **cfg):
    # a feed without documents still has a file
    filler = [contract("none", "", "", Agent="test")]
    feeds = readers.read_contract_feeds(
        spark,
        write_lines(folder, "contracts", list(contracts) or filler),
        write_lines(folder, "cancellations", list(cancellations) or filler),
    )
    lines = readers.read_claims(
        spark,
        write_lines(folder, "claims", list(claims) or [claim("none", "", "", "", "0")]),
    )
    return Report(spark, ReportConfig(as_of=as_of, **cfg), feeds, lines, materialise=False)


def period(rep, period_id="current_month"):
    return rep.metrics.where(f"period_id = '{period_id}'").first().asDict()
