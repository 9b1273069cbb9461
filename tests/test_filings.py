import datetime as dt
import json
import zipfile

from pyspark.sql import functions as F

from tallyglass.sources import filings as R
from tallyglass.sources import prices as P

SUB = """ACCESSION_NUMBER\tFILING_DATE\tDOCUMENT_TYPE\tISSUERCIK\tISSUERNAME\tISSUERTRADINGSYMBOL\tAFF10B5ONE\tDATE_OF_ORIG_SUB\tREMARKS
A1\t05-FEB-2020\t4\t111\tFirst Co\tfrst\t0\t\t
A2\t10-FEB-2020\t4/A\t111\tFirst Co\tFRST\t1\t05-FEB-2020\t
A3\t11-FEB-2020\t3\t111\tFirst Co\tFRST\t0\t\t\r

A4\t12-FEB-2020\t4\t111\tFirst Co\tFRST\t0\t\tunder a trading plan"""
OWN = """ACCESSION_NUMBER\tRPTOWNERCIK\tRPTOWNERNAME\tRPTOWNER_RELATIONSHIP\tRPTOWNER_TITLE
A1\t900\tDoe Jane\tOfficer, Director\tChief Executive Officer
A2\t901\tRoe Max\tDirector\t
A4\t902\tPoe Kim\tOfficer\tChief Financial Officer"""
TRANS = """ACCESSION_NUMBER\tTRANS_DATE\tTRANS_CODE\tEQUITY_SWAP_INVOLVED\tTRANS_SHARES\tTRANS_PRICEPERSHARE\tSHRS_OWND_FOLWNG_TRANS\tDIRECT_INDIRECT_OWNERSHIP\tTRANS_PRICEPERSHARE_FN
A1\t03-FEB-2020\tP\t0\t1000\t10.00\t5000\tD\t
A1\t03-FEB-2020\tP\t0\t1000\t12.00\t6000\tD\t
A1\t03-FEB-2020\tA\t0\t500\t0\t6500\tD\t
A2\t07-FEB-2020\tS\t0\t200\t15.00\t4000\tD\t
A2\t08-FEB-2020\tP\t1\t100\t10.00\t4100\tD\t
A4\t11-FEB-2020\tP\t0\t500\t9.00\t1500\tD\tF1"""
NOTES = "ACCESSION_NUMBER\tFOOTNOTE_ID\tFOOTNOTE_TXT\nA4\tF1\tBought in a private placement."


def test_quarterly_archive(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "q.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for n, t in (("SUBMISSION", SUB), ("REPORTINGOWNER", OWN), ("NONDERIV_TRANS", TRANS), ("FOOTNOTES", NOTES)):
            z.writestr(f"{n}.tsv", t)
    trades, marks = R.read_quarters(spark, str(tmp_path / "*.zip"))
    rows = {(r.acc, r.code): r for r in trades.collect()}
    assert set(rows) == {("A1", "P"), ("A2", "S"), ("A4", "P")}
    a = rows["A1", "P"]
    assert (a.sh, a.px, a.val, a.own, a.di, a.t, a.fdate) == (2000, 11.0, 22000, 6000, "D", "FRST", dt.date(2020, 2, 5))
    assert a.owners[0].rel == "DOC" and not a.b5 and rows["A2", "S"].b5
    b = rows["A4", "P"]
    assert b.fn.offering and not b.fn.b5 and b.owners[0].rel == "OF"  # its own note hides the remark
    assert [(m.acc, m.orig, m.rows, m.owners) for m in marks.collect()] == [("A2", dt.date(2020, 2, 5), 2, [901])]


FILING = """head <XML>
<ownershipDocument><documentType>4</documentType><issuer><issuerCik>0000445566</issuerCik><issuerTradingSymbol> tst </issuerTradingSymbol></issuer>
<reportingOwner><reportingOwnerId><rptOwnerCik>77</rptOwnerCik><rptOwnerName>Oak &amp; Elm Trust</rptOwnerName></reportingOwnerId>
<reportingOwnerRelationship><isDirector>1</isDirector><officerTitle>President</officerTitle></reportingOwnerRelationship></reportingOwner>
<nonDerivativeTable>{fills}</nonDerivativeTable>
<footnotes><footnote id="F1">The weighted average price.</footnote><footnote id="F2">Under a trading plan.</footnote></footnotes></ownershipDocument>
</XML> tail"""
FILL = """<nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>{d}</value></transactionDate>
<transactionCoding><transactionCode>{c}</transactionCode><equitySwapInvolved>0</equitySwapInvolved></transactionCoding>
<transactionAmounts><transactionShares><value>{n}</value></transactionShares><transactionPricePerShare><value>{p}</value>{note}</transactionPricePerShare></transactionAmounts>
<postTransactionAmounts><sharesOwnedFollowingTransaction><value>{o}</value></sharesOwnedFollowingTransaction></postTransactionAmounts>
<ownershipNature><directOrIndirectOwnership><value>{di}</value></directOrIndirectOwnership></ownershipNature></nonDerivativeTransaction>"""


def fills(first):
    return (
        FILL.format(d=first, c="P", n=1000, p=8.0, o=11000, di="D", note='<footnoteId id="F1"/>')
        + FILL.format(d="2026-06-30", c="P", n=3000, p=10.0, o=14000, di="I", note="")
        + FILL.format(d="2026-06-30", c="F", n=50, p=9.0, o=1, di="D", note="")
    )


def test_single_filings(spark):
    texts = [("X1", FILING.format(fills=fills("2026-06-30"))), ("X2", FILING.format(fills=fills("2026-06-31"))), ("X3", "no envelope"), ("X4", "<XML><a></XML>"), ("X5", None)]
    df = spark.createDataFrame([(a, "2026-07-01", t) for a, t in texts], "acc string, fdate string, text string")
    rows = {r.acc: r for r in R.parse_filings(df)[0].collect()}
    assert set(rows) == {"X1", "X2"}
    r = rows["X1"]
    assert (r.cik, r.t, r.sh, r.px, r.di, r.own, r.own_d, r.sh_d) == (445566, "TST", 4000, 9.5, "M", None, 11000, 1000)
    assert r.owners[0].name == "Oak & Elm Trust" and r.owners[0].rel == "DC" and r.fn.wavg and not r.fn.b5
    assert rows["X2"].sh == 3000 and rows["X2"].di == "I" and rows["X2"].fn.b5  # no note of its own


def test_index_registry_reference_quarters(spark, tmp_path):
    lines = ["Form Type   Company", "4           First Co            111   2020-02-05   edgar/a.txt", "4/A         First Co            111   2020-02-06   edgar/b.txt", "8-K         x   1   d   p", "4   short"]
    got = R.index_entries(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [tuple(r) for r in got] == [("4", 111, "edgar/a.txt"), ("4/A", 111, "edgar/b.txt")]
    reg = [("AAA", "NYSE", "Stock", "USD", "2010-01-01", "2015-01-01"), ("AAA", "PINK", "Stock", "USD", "2014-01-01", "2020-01-01"), ("F", "NYSE", "Mutual Fund", "USD", "2010-01-01", "2020-01-01"), ("C", "NYSE", "Stock", "CNY", "2010-01-01", "2020-01-01"), ("D", "LSE", "Stock", "USD", "2010-01-01", "2020-01-01"), ("E", "NYSE", "Stock", "USD", "", "2020-01-01")]
    spans = R.registry(spark.createDataFrame(reg, "ticker string, exchange string, assetType string, priceCurrency string, startDate string, endDate string"))
    assert sorted((r.ticker, r.listed) for r in spans.collect()) == [("AAA", False), ("AAA", True)]
    (tmp_path / "ref.json").write_text(json.dumps({"fields": ["cik", "name", "ticker", "exchange"], "data": [[1, "One", "ONE", "NYSE"], [1, "One", "ONE-B", "OTC"], [2, "Two", "TWO", "OTC"]]}))
    ref = R.ticker_reference(spark, str(tmp_path / "ref.json"))
    assert sorted((r.cik, r.ticker) for r in ref.collect()) == [(1, "ONE"), (2, "TWO")]
    t = spark.createDataFrame([(1, "x", "2012-01-01"), (2, "x", "2012-01-01"), (3, "aaa", "2012-01-01"), (4, "aaa", "2016-01-01"), (5, "zz", "2016-01-01")], "cik long, t string, tdate string").withColumn("tdate", F.to_date("tdate"))
    assert {r.cik: (r.ticker, r.category) for r in R.issuer_category(t, ref, spans).collect()} == {1: ("ONE", "listed"), 2: ("TWO", "otc"), 3: ("AAA", "listed"), 4: ("AAA", "otc"), 5: ("ZZ", "unknown")}
    assert {r.category for r in R.issuer_category(t.where("cik > 2"), ref, None).collect()} == {"unknown"}
    assert [r.q for r in R.quarters(spark, 2019, 2020, 2).collect()] == ["2019q1", "2019q2", "2019q3", "2019q4", "2020q1", "2020q2"]


def test_price_sources(spark):
    body = {"chart": {"result": [{"meta": {"currency": "USD", "instrumentType": "EQUITY", "gmtoffset": -18000}, "timestamp": [1577975400, 1578061800, 1578065400, 1578321000],
        "indicators": {"quote": [{"close": [10.0, None, 12.0, 13.0], "volume": [5, 6, None, 8]}], "adjclose": [{"adjclose": [9.0, 9.5, 11.0, None]}]},
        "events": {"splits": {"1": {"date": 1578061800, "numerator": 1, "denominator": 150}}}}]}}
    other = json.dumps(body).replace("USD", "CNY")
    df = spark.createDataFrame([("A", json.dumps(body)), ("B", other), ("C", "broken"), ("D", None)], "ticker string, body string")
    assert [(r.ticker, str(r.d), r.close, r.adj, r.vol) for r in P.chart_bars(df).orderBy("d").collect()] == [("A", "2020-01-02", 10.0, 9.0, 5.0), ("A", "2020-01-03", 12.0, 11.0, 0.0)]
    assert [(str(r.d), r.ratio) for r in P.chart_splits(df).collect()] == [("2020-01-03", 0.0067)]
    csv = spark.createDataFrame([("B", "Date,O,H,L,Close,Volume\n2020-01-02,1,1,1,5,7\n2020-01-03,1,1,1,x,7\n"), ("A", "<html>")], "ticker string, body string")
    assert [(r.ticker, r.close, r.vol) for r in P.csv_bars(csv).collect()] == [("B", 5.0, 7.0)]
    assert {r.ticker for r in P.first_source(P.chart_bars(df), P.csv_bars(csv)).collect()} == {"A", "B"}
    rows = [("T", f"2020-01-0{i}", c, c, 10.0, 20.0, 2.0 if i == 3 else 1.0) for i, c in ((1, 100.0), (2, 102.0), (3, 52.0), (4, 53.0))]
    bars, splits = P.nominal_bars(spark.createDataFrame(rows, "ticker string, date string, close double, adjClose double, volume double, adjVolume double, splitFactor double"))
    assert [r.close for r in bars.orderBy("d").collect()] == [50, 51, 52, 53] and [(str(r.d), r.ratio) for r in splits.collect()] == [("2020-01-03", 2.0)]
    assert bars.first().vol == 20


def rows_of(spark, *texts):
    df = spark.createDataFrame([(f"X{i}", "2026-07-01", t) for i, t in enumerate(texts)], "acc string, fdate string, text string")
    return {r.acc: r for r in R.parse_filings(df)[0].collect()}, {r.acc: r.state for r in R.filing_states(df).collect()}


def test_broken_filings_are_read_as_far_as_they_go(spark):
    good = FILING.format(fills=fills("2026-06-30"))
    broken = [
        good.replace("Oak &amp; Elm", "Oak & Elm"),  # a bare ampersand
        good.replace("</issuerTradingSymbol>", "</issuerTradingSymbol></b>"),  # an end without a start
        good.replace('<footnoteId id="F1"/>', "<footnoteId id=F1>"),  # neither quoted nor closed
        good.replace("<securityTitle><value>Common</value></securityTitle>", "<securityTitle><value>Common</securityTitle>"),  # the value has no end: the title stands
        good.replace("<transactionCode>F</transactionCode>", "<transactionCode>F"),  # that fill has no code and counts no more than before
        good[: good.index("<footnotes>")],  # cut off: no notes
        good.replace("<documentType>4</documentType>", "<documentType>4 & more"),  # lost
        good.replace("&amp;", "&nbsp;"),  # an entity that XML does not know stays as it is
        good,
    ]
    rows, states = rows_of(spark, *broken, "no envelope", None, "<XML><edgarSubmission/></XML>", "<XML><a></XML>", "<XML><ownershipDocument", "<XML></XML>")
    assert [states[f"X{i}"] for i in range(15)] == [*["recovered"] * 6, "lost", "recovered", "ok", *["other"] * 4, "lost", "other"]
    assert set(rows) == {f"X{i}" for i in (0, 1, 2, 3, 4, 5, 7, 8)}
    plain = rows["X8"].asDict() | {"acc": None}
    for i in (0, 1, 2, 4):
        assert rows[f"X{i}"].asDict() | {"acc": None} == plain, i
    assert rows["X3"].asDict() | {"acc": None, "sec": None} == plain | {"sec": None} and rows["X3"].sec == ""
    assert rows["X5"].sh == 4000 and not rows["X5"].fn.wavg and rows["X7"].owners[0].name == "Oak &nbsp; Elm Trust"


def test_recovery_of_whole_markup_is_parsing():
    text = FILING.format(fills=fills("2026-06-30"))
    xml = text[text.index("<own") : text.index("</XML>")]
    shape = lambda e: (e.tag, dict(e.attrib), "".join(e.itertext()), [shape(x) for x in e])
    assert shape(R.recovered("<?xml version='1.0'?><!-- <b> -->" + xml)) == shape(R.ET.fromstring(xml))
    assert R.recovered("no tags & none") is None and R.recovered("</a>") is None
    e = R.recovered("<a>x<b>y<c>z</c>t</a>")
    assert shape(e) == ("a", {}, "xz", [("c", {}, "z", [])])  # b was never closed: its own text goes, what is in it stays
    assert shape(R.recovered('<a k="1&lt;2" m=3><![CDATA[<q>]]></a>')) == ("a", {"k": "1<2", "m": "3"}, "<q>", [])
