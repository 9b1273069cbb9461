"""From filings (archive tables and XML) and cached prices to documents, in one plan."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from tallyglass.plans import batch
from tallyglass.sources import filings as R
from tallyglass.sources import prices as P
from tests.test_archive import made
from tests.test_filings import FILING, FILL

TODAY = dt.date(2024, 6, 28)
DAYS = [d for d in (dt.date(2018, 1, 1) + dt.timedelta(days=i) for i in range(2371)) if d.weekday() < 5]


def series(first, last, start, growth, volume):
    return [(d, round(start * growth**i, 4), volume) for i, d in enumerate(d for d in DAYS if first <= d <= last)]


PRICES = {
    "SPY": series(DAYS[0], TODAY, 100, 1, 1e6), "IWM": series(DAYS[0], TODAY, 50, 1, 1e6),
    "OLDC": series(dt.date(2019, 6, 3), dt.date(2021, 6, 30), 100, 1.001, 2e5), "LIVE": series(dt.date(2023, 1, 2), TODAY, 50, 1.0005, 1e6),
    "REUS": series(dt.date(2019, 1, 1), TODAY, 10, 1, 1e6),
}


def at(ticker, day):
    return round([p for d, p, _ in PRICES[ticker] if d <= day][-1], 2)


#: acc, filed, form, cik, ticker, box; owners by acc; fills: acc, day, code, shares, price, note
SUBMISSIONS = [
    ("A1", "05-FEB-2020", "4", 111, "OLDC", 0), ("A2", "13-FEB-2020", "4", 111, "OLDC", 0), ("A3", "05-MAR-2020", "4", 111, "OLDC", 0), ("A4", "05-MAR-2020", "4", 333, "OTCX", 0),
    ("A5", "07-APR-2020", "4", 111, "OLDC", 0), ("A6", "08-MAY-2020", "4", 111, "OLDC", 0), ("A7", "12-JUN-2020", "4", 444, "REUS", 0), ("A8", "14-JUL-2020", "4", 111, "OLDC", 0),
]
PEOPLE = {
    "A1": [(900, "Doe Jane", "Officer, Director", "Chief Executive Officer")], "A2": [(901, "Roe Max", "Director", "")], "A4": [(901, "Roe Max", "Director", "")], "A5": [(900, "Doe Jane", "Officer", "CEO")],
    "A3": [(950, "Oak Advisors LP", "TenPercentOwner", ""), (951, "Elm Kim", "TenPercentOwner", ""), (952, "Elm Lee", "TenPercentOwner", "")], "A6": [(950, "Oak Advisors LP", "Officer", "CEO")],
    "A7": [(960, "Fir Ann", "Director", "")], "A8": [(950, "Oak Advisors LP", "Officer", "CEO"), (953, "Ash Joe", "TenPercentOwner", "")],
}
d = dt.date
FILLS = [
    ("A1", d(2020, 2, 3), "P", 1000, at("OLDC", d(2020, 2, 3)), ""), ("A2", d(2020, 2, 11), "P", 2000, at("OLDC", d(2020, 2, 11)), ""), ("A3", d(2020, 3, 3), "P", 100000, at("OLDC", d(2020, 3, 3)), "F1"),
    ("A4", d(2020, 3, 3), "P", 100, 1.0, ""), ("A5", d(2020, 4, 3), "P", 100, at("OLDC", d(2020, 4, 3)), "F2"), ("A6", d(2020, 5, 6), "P", 500, at("OLDC", d(2020, 5, 6)), ""), ("A6", d(2020, 5, 6), "S", 50, 90.0, ""),
    ("A7", d(2020, 6, 10), "P", 500, 10.0, ""), ("A8", d(2020, 7, 10), "P", 300, at("OLDC", d(2020, 7, 10)), ""),
]


def text(header, rows):
    return "\n".join("\t".join(map(str, r)) for r in (header, *rows)) + "\n"


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    at_ = tmp_path_factory.mktemp("batch")
    tables = {
        "SUBMISSION.tsv": text(("ACCESSION_NUMBER", "FILING_DATE", "DOCUMENT_TYPE", "ISSUERCIK", "ISSUERTRADINGSYMBOL", "AFF10B5ONE"), SUBMISSIONS),
        "REPORTINGOWNER.tsv": text(("ACCESSION_NUMBER", "RPTOWNERCIK", "RPTOWNERNAME", "RPTOWNER_RELATIONSHIP", "RPTOWNER_TITLE"), [(a, *o) for a, own in PEOPLE.items() for o in own]),
        "NONDERIV_TRANS.tsv": text(
            ("ACCESSION_NUMBER", "TRANS_DATE", "TRANS_CODE", "TRANS_SHARES", "TRANS_PRICEPERSHARE", "DIRECT_INDIRECT_OWNERSHIP", "SECURITY_TITLE", "TRANS_SHARES_FN"),
            [(a, t.strftime("%d-%b-%Y").upper(), c, n, p, "D", "Common", note) for a, t, c, n, p, note in FILLS],
        ),
        "FOOTNOTES.tsv": text(("ACCESSION_NUMBER", "FOOTNOTE_ID", "FOOTNOTE_TXT"), [("A3", "F1", "Bought in a private placement."), ("A5", "F2", "Under a Rule 10b5-1 trading plan.")]),
    }
    made(at_ / "2020q1.zip", tables)
    xml = lambda day, form, n, p: FILING.replace("<documentType>4<", f"<documentType>{form}<").replace("Under a trading plan.", "Bought for cash.").format(fills=FILL.format(d=day, c="P", n=n, p=p, o=9000, di="D", note=""))
    live = xml("2024-06-20", "4", 5000, at("LIVE", d(2024, 6, 20))).replace("0000445566", "222").replace(" tst ", "LIVE").replace("Oak &amp; Elm Trust", "Yew Sam").replace("rptOwnerCik>77", "rptOwnerCik>970")
    fixed = xml("2020-02-11", "4/A", 2000, at("OLDC", d(2020, 2, 11)) + 0.5).replace("0000445566", "111").replace(" tst ", "OLDC").replace("Oak &amp; Elm Trust", "Roe Max").replace("rptOwnerCik>77", "rptOwnerCik>901")
    texts = [("L1", "2024-06-21", live), ("A2R", "2020-02-25", fixed), ("A1", "2020-02-05", live), ("L9", "2024-06-21", "<XML><ownershipDocument><b>")]
    for name, rows in PRICES.items():
        (at_ / f"{name}.csv.gz").write_bytes(gzip.compress("\n".join(f"{t},{p},{p},{v}" for t, p, v in rows).encode()))
    spark.createDataFrame(texts, "acc string, fdate string, text string").write.parquet(str(at_ / "texts"))
    reference = spark.createDataFrame([(111, "OLDC", "NYSE", "Old Corp"), (222, "LIVE", "Nasdaq", "Live Inc"), (333, "OTCX", "OTC", "Shell")], "cik long, ticker string, exchange string, name string")
    intervals = spark.createDataFrame([("REUS", True, d(2015, 1, 1), d(2020, 12, 31)), ("REUS", True, d(2022, 1, 3), TODAY), ("LIVE", True, d(2022, 12, 1), TODAY)], "ticker string, listed boolean, start date, end date")
    raw = spark.read.parquet(str(at_ / "texts"))
    found = batch.job(R.read_quarters(spark, str(at_ / "*.zip"))[0], R.parse_filings(raw)[0], P.price_cache(spark, str(at_)), reference, F.lit(TODAY), None, intervals)
    batch.publish(found, str(at_ / "site"), F.lit(TODAY), states=R.filing_states(raw))
    return found, at_ / "site"


def read(at_, name):
    return [json.loads(x) for f in sorted(at_.glob(f"{name}/**/*.json")) for x in f.read_text().splitlines()]


def test_verdicts_of_parsed_filings(spark, done):
    rows = {r.acc: r for r in done[0].rows.collect()}
    assert set(rows) == {"A1", "A2R", "A3", "A5", "A6", "A7", "A8", "L1"}  # the shell is not listed, the original was amended
    assert {a: r["drop"] for a, r in rows.items() if not r.ok} == {"A3": "offering", "A5": "planned", "A6": "fund", "A7": "reassigned"}
    assert rows["A1"].role == "C" and rows["A1"].owner == 900 and rows["A1"].name == "Old Corp" and rows["A1"].title == "Chief Executive Officer"
    assert rows["A2R"].px == at("OLDC", d(2020, 2, 11)) + 0.5 and rows["A2R"].versions == 2
    assert rows["A3"].owner == 951 and rows["A3"].fn_offering and not rows["A3"].fund_only  # the first person, not the fund
    assert rows["A8"].role == "T" and rows["A8"].owner == 953  # the chief executive is a firm: only persons have a role
    assert rows["A7"].close is None and rows["A7"].entry_day is None and rows["A7"].r3 is None and rows["A7"].category == "listed"
    assert rows["A3"].sync == 2  # its two persons file together and are one, the fund another


def test_returns_and_documents(spark, done):
    found, site = done
    first = next(r for r in found.rows.collect() if r.acc == "A1")
    assert first.s3 == "c" and first.e3 == pytest.approx(1.001**63 - 1, abs=2e-4) == first.x3 and first.bucket == "small" and first.s24 == "d"
    assert first.entry_day == d(2020, 2, 6) and first.cur == PRICES["OLDC"][-1][1] and first.chg > 0
    feed = read(site, "feed")
    assert [(x["ticker"], x["role"], x["in_set"]) for x in feed] == [("LIVE", "C", True)] and feed[0]["d1"] is not None and "m6" not in feed[0]
    cards = {x["ticker"]: x for x in read(site, "tickers")}
    assert (cards["OLDC"]["trades"], cards["OLDC"]["passed"]) == (7, 3) and len(cards["OLDC"]["weekly"]) > 50 and cards["REUS"]["passed"] == 0
    lines = read(site, "trades/ticker=OLDC")
    assert len(lines) == 7 and [x["tdate"] for x in lines] == sorted((x["tdate"] for x in lines), reverse=True) and sum(x["code"] == "S" for x in lines) == 1
    meta = read(site, "meta")[0]
    assert (meta["rows"], meta["passed"], meta["reassigned"], meta["lost"], meta["recovered"]) == (8, 4, 1, 1, 0)
    assert {x["acc"] for x in read(site, "backtest/year=2020")} == {"A1", "A2R", "A3", "A5", "A6", "A7", "A8"}
