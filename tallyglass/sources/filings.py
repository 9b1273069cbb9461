"""Readers of filing datasets: zipped tables, daily indexes, single XML filings, registries.

Each reader gives raw rows; what is done with them (joins, folds, flags) is
DataFrame work shared by all.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.functions import scalars as S
from tallyglass.operators.filings import fold_fills, fold_ownership
from tallyglass.sources.archive import PARTITION_BYTES, zip_table

NOTE_FIELDS = (
    "TRANS_SHARES_FN", "TRANS_PRICEPERSHARE_FN", "SECURITY_TITLE_FN", "TRANS_ACQUIRED_DISP_CD_FN", "NATURE_OF_OWNERSHIP_FN", "DIRECT_INDIRECT_OWNERSHIP_FN",
    "SHRS_OWND_FOLWNG_TRANS_FN", "TRANS_DATE_FN",
)


def tsv_rows(texts: DataFrame, columns: Sequence[str], content: str = "content", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of tab-separated texts with a header, without quoting; a missing column or cell is empty, blank lines are left out."""
    lines = F.split(F.regexp_replace(content, "\r", ""), "\n")
    x = texts.select(*keep, F.split(F.get(lines, F.lit(0)), "\t").alias("__h"), F.explode(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))).alias("__l"))
    x = x.where(F.trim("__l") != "").withColumn("__c", F.split("__l", "\t"))
    cell = lambda name: F.coalesce(F.when(F.array_position("__h", name) > 0, F.get("__c", (F.array_position("__h", name) - 1).cast("int"))), F.lit(""))
    return x.select(*keep, *[cell(c).alias(c) for c in columns])


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A large tab-separated file with a header, split over tasks; missing columns are empty."""
    x = spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False)
    return x.select(*[(F.coalesce(F.col(c), F.lit("")) if c in x.columns else F.lit("")).alias(c) for c in columns])


def quarters(spark: SparkSession, first_year: int, last_year: int, last_quarter: int) -> DataFrame:
    """``q``: names of quarters, ``2016q1`` and on."""
    last = f"{last_year}-{last_quarter * 3 - 2:02d}-01"
    days = spark.sql(f"select explode(sequence(date'{first_year}-01-01', date'{last}', interval 3 months)) as d")
    return days.select(F.concat(F.year("d").cast("string"), F.lit("q"), F.quarter("d").cast("string")).alias("q"))


SUBMISSION = ("ACCESSION_NUMBER", "FILING_DATE", "DOCUMENT_TYPE", "ISSUERCIK", "ISSUERTRADINGSYMBOL", "AFF10B5ONE", "DATE_OF_ORIG_SUB", "REMARKS")
OWNER = ("ACCESSION_NUMBER", "RPTOWNERCIK", "RPTOWNERNAME", "RPTOWNER_RELATIONSHIP", "RPTOWNER_TITLE")
TRANSACTION = ("ACCESSION_NUMBER", "TRANS_DATE", "TRANS_CODE", "EQUITY_SWAP_INVOLVED", "TRANS_SHARES", "TRANS_PRICEPERSHARE", "SHRS_OWND_FOLWNG_TRANS", "DIRECT_INDIRECT_OWNERSHIP", "SECURITY_TITLE", *NOTE_FIELDS)
FOOTNOTE = ("ACCESSION_NUMBER", "FOOTNOTE_ID", "FOOTNOTE_TXT")


def assemble(filings: DataFrame, owners: DataFrame, fills: DataFrame, notes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trades and amendment markers from normalised tables.

    ``filings``: acc, form, fdate, cik, t, b5, orig, remarks; ``owners``: acc,
    pos, cik, name, rel, title; ``fills``: acc, code, swap, tdate, sh, px, own, di,
    sec, note_ids; ``notes``: acc, id, text. Only purchases and sales of forms 4
    and 4/A count; swaps are left out of trades but counted in ``rows``.
    """
    filings = filings.where(F.col("form").isin("4", "4/A"))
    dealt = fills.where(F.col("code").isin("P", "S")).join(filings.select("acc"), "acc", "left_semi")
    good = dealt.where(~F.col("swap") & F.col("tdate").isNotNull() & (F.col("sh") > 0))
    keys = ["acc", "code", "tdate", "sec"]
    trades = fold_fills(good, keys).drop("fills").join(fold_ownership(good, keys).drop("sh"), keys)
    ids = good.select(*keys, F.explode_outer("note_ids").alias("id")).distinct()
    own_notes = ids.join(notes, ["acc", "id"]).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("text")), " \n ").alias("own_text"))
    every = notes.select("acc", "text").unionByName(filings.where("remarks <> ''").select("acc", F.col("remarks").alias("text")))
    every = every.groupBy("acc").agg(F.array_join(F.array_sort(F.collect_list("text")), " \n ").alias("all_text"))
    people = owners.groupBy("acc").agg(F.array_sort(F.collect_list(F.struct("pos", "cik", "name", "rel", "title"))).alias("owners"))
    people = people.select("acc", F.transform("owners", lambda o: o.dropFields("pos")).alias("owners"))
    x = trades.join(filings, "acc").join(people, "acc", "left").join(own_notes, keys, "left").join(every, "acc", "left")
    flags = S.footnote_flags("own_text")
    flags["b5"] = flags["b5"] | (F.col("own_text").isNull() & S.footnote_flags("all_text")["b5"])
    fn = F.struct(*[c.alias(k) for k, c in flags.items()])
    none = F.array().cast("array<struct<cik:bigint,name:string,rel:string,title:string>>")
    shaped = x.select(
        "acc", "form", "fdate", "tdate", "cik", "t", F.coalesce("owners", none).alias("owners"), "code", "sh", "px", "val", "own", "di", "own_d", "sh_d", "b5", "orig",
        F.substring("sec", 1, 60).alias("sec"), fn.alias("fn"),
    )
    n = dealt.groupBy("acc").agg(F.count("*").alias("rows"))
    amended = filings.where("form = '4/A' and orig is not null").join(n, "acc", "left").join(people, "acc", "left")
    marks = amended.select("acc", "cik", "orig", F.transform(F.coalesce("owners", none), lambda o: o["cik"]).alias("owners"), F.coalesce("rows", F.lit(0)).alias("rows"))
    return shaped, marks


def normalise_quarter(submission: DataFrame, owner: DataFrame, transaction: DataFrame, footnote: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The bulk tables (all strings, see SUBMISSION and so on) as trades and amendment markers."""
    c = F.col
    filings = submission.select(
        c("ACCESSION_NUMBER").alias("acc"), c("DOCUMENT_TYPE").alias("form"), S.filing_date("FILING_DATE").alias("fdate"), c("ISSUERCIK").try_cast("long").alias("cik"),
        F.upper(F.trim("ISSUERTRADINGSYMBOL")).alias("t"), (c("AFF10B5ONE") == "1").alias("b5"), S.filing_date("DATE_OF_ORIG_SUB").alias("orig"), c("REMARKS").alias("remarks"),
    )
    owners = owner.select(
        c("ACCESSION_NUMBER").alias("acc"), F.monotonically_increasing_id().alias("pos"), c("RPTOWNERCIK").try_cast("long").alias("cik"), c("RPTOWNERNAME").alias("name"),
        S.role_letters("RPTOWNER_RELATIONSHIP", "RPTOWNER_TITLE").alias("rel"), c("RPTOWNER_TITLE").alias("title"),
    )
    fills = transaction.select(
        c("ACCESSION_NUMBER").alias("acc"), c("TRANS_CODE").alias("code"), c("EQUITY_SWAP_INVOLVED").isin("1", "true").alias("swap"), S.filing_date("TRANS_DATE").alias("tdate"),
        S.to_number("TRANS_SHARES").alias("sh"), S.to_number("TRANS_PRICEPERSHARE").alias("px"), S.to_number("SHRS_OWND_FOLWNG_TRANS").alias("own"),
        F.when(c("DIRECT_INDIRECT_OWNERSHIP") == "I", "I").otherwise("D").alias("di"), c("SECURITY_TITLE").alias("sec"), S.footnote_ids(*NOTE_FIELDS).alias("note_ids"),
    )
    notes = footnote.select(c("ACCESSION_NUMBER").alias("acc"), c("FOOTNOTE_ID").alias("id"), c("FOOTNOTE_TXT").alias("text")).where("text <> ''")
    return assemble(filings, owners, fills, notes)


def read_quarters(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES) -> tuple[DataFrame, DataFrame]:
    """Trades and markers of all quarterly zip archives under ``path``; the footnote table may be missing.

    A large table is read by several tasks, which make rows only of what counts.
    """
    table = lambda name, columns: zip_table(spark, path, f"{name}.tsv", columns, partition_bytes)
    submission = table("SUBMISSION", SUBMISSION).where(F.col("DOCUMENT_TYPE").isin("4", "4/A"))
    dealt = table("NONDERIV_TRANS", TRANSACTION).where(F.col("TRANS_CODE").isin("P", "S"))
    return normalise_quarter(submission, table("REPORTINGOWNER", OWNER), dealt, table("FOOTNOTES", FOOTNOTE))


def index_entries(lines: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``form, cik, path`` (and ``keep``) from lines of daily indexes: forms 4 and 4/A, columns two or more blanks apart."""
    x = lines.where(F.col(value).rlike(r"(?U)^(4|4/A)\s{2,}")).select(*keep, F.split(F.trim(value), r"(?U)\s{2,}").alias("p")).where(F.size("p") >= 5)
    return x.select(*keep, F.col("p")[0].alias("form"), F.col("p")[2].try_cast("long").alias("cik"), F.trim(F.col("p")[4]).alias("path"))


def unescape(s: Column | str) -> Column:
    """The five named entities and, as a blank, numeric ones; the ampersand last."""
    x = F.col(s) if isinstance(s, str) else s
    for pattern, to in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#\\d+;", " "), ("&amp;", "&")):
        x = F.regexp_replace(x, pattern, to)
    return x


_FILING = (
    "acc string, fdate date, kind string, form string, cik long, t string, b5 boolean, orig string, remarks string, pos long, name string, relationship string, title string, "
    "code string, swap boolean, tdate string, sh string, px string, own string, di string, sec string, note_ids array<string>, id string, text string"
)


_TAG = re.compile(r"<!--.*?-->|<\?.*?\?>|<!\[CDATA\[(.*?)\]\]>|<(/?)([A-Za-z][\w.:-]*)((?:\s[^<>]*?)?)(/?)>", re.S)
_ATTRIBUTE = re.compile(r"""([\w.:-]+)\s*=\s*["']?([^"'\s>]*)""")


def recovered(markup: str) -> ET.Element | None:
    """The elements that can be told from markup that is no XML; None if there are none.

    A tag closes the nearest element of its name. Elements within that were never
    closed count as missing: their children go to what is around them, their own
    text is dropped, as it has no end (with attributes they stay as empty ones). So do those that are open at the end; an end tag
    without a start is passed over. Unknown entities and bare ampersands are text.
    """
    top = ET.Element("")
    stack, at = [top], 0

    def text(s: str) -> None:
        e = stack[-1]
        if len(e):
            e[-1].tail = (e[-1].tail or "") + s
        else:
            e.text = (e.text or "") + s

    def abandon() -> None:
        """The innermost element has no end."""
        lost = stack.pop()
        stack[-1].remove(lost)
        if lost.attrib:
            ET.SubElement(stack[-1], lost.tag, lost.attrib)
        for child in lost:
            child.tail = None
            stack[-1].append(child)

    for m in _TAG.finditer(markup):
        text(_plain(markup[at : m.start()]))
        at = m.end()
        data, end, name, attributes, empty = m.groups()
        if data is not None:
            text(data)
        elif end:
            if any(e.tag == name for e in stack[1:]):
                while stack[-1].tag != name:
                    abandon()
                stack.pop()
        elif name:
            e = ET.SubElement(stack[-1], name, {k: _plain(v) for k, v in _ATTRIBUTE.findall(attributes)})
            if not empty:
                stack.append(e)
    document = next((e for e in stack if e.tag == "ownershipDocument"), None)  # the document itself may be cut off
    while stack[-1] is not top and stack[-1] is not document:
        abandon()
    return document if document is not None else next(iter(top), None)


def _plain(s: str) -> str:
    """``unescape`` for one string."""
    if "&" not in s:
        return s
    s = re.sub(r"&#\d+;", " ", s)
    for name, c in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        s = s.replace(f"&{name};", c)
    return s


def document(text: str | None) -> tuple[ET.Element | None, str]:
    """The ownership document of a filing and how it was read: ``ok``, ``recovered`` (no XML), ``lost`` (no document could be told) or ``other`` (of another kind, or without an envelope)."""
    envelope = re.search(r"<XML>(.*?)(?:</XML>|\Z)", text or "", re.S)
    if not envelope:
        return None, "other"
    state = "ok"
    try:  # numeric entities stand for a blank here
        root = ET.fromstring(re.sub(r"&#\d+;", " ", envelope[1].strip()))
    except ET.ParseError:
        root, state = recovered(envelope[1]), "recovered"
    if root is None or root.tag != "ownershipDocument":
        return None, "lost" if "<ownershipDocument" in envelope[1] else "other"
    form = (root.findtext("documentType") or "").strip()
    return (root, state) if form in ("4", "4/A") else (None, "other" if form else "lost")


def _filing_rows(acc: str, fdate, text: str) -> Iterator[dict]:
    """The parts of one filing, as rows of the normalised tables; nothing for other documents."""
    root, _ = document(text)
    if root is None:
        return
    value = lambda e, path: ("".join(x.itertext()).strip() if e is not None and (x := e.find(path)) is not None else None)
    true = lambda s: s in ("1", "true")
    form = value(root, "documentType")
    base, issuer, remarks = {"acc": acc, "fdate": fdate}, root.find("issuer"), value(root, "remarks") or ""
    cik = value(issuer, "issuerCik")
    yield base | {
        "kind": "filing", "form": form, "cik": int(cik) if cik and cik.isdigit() else None, "t": (value(issuer, "issuerTradingSymbol") or "").upper(),
        "b5": true(value(root, "aff10b5One")), "orig": value(root, "dateOfOriginalSubmission"), "remarks": remarks,
    }
    for i, o in enumerate(root.iter("reportingOwner")):
        rel, own = o.find("reportingOwnerRelationship"), value(o, "reportingOwnerId/rptOwnerCik")
        words = " ".join(w for w, tag in (("director", "isDirector"), ("officer", "isOfficer"), ("tenpercent", "isTenPercentOwner"), ("other", "isOther")) if true(value(rel, tag)))
        yield base | {"kind": "owner", "pos": i, "cik": int(own) if own and own.isdigit() else None, "name": value(o, "reportingOwnerId/rptOwnerName") or "", "relationship": words, "title": value(rel, "officerTitle") or "", "remarks": remarks}
    for n in root.iter("footnote"):
        yield base | {"kind": "note", "id": n.get("id"), "text": "".join(n.itertext())}
    for tr in root.iterfind("nonDerivativeTable/nonDerivativeTransaction"):
        yield base | {
            "kind": "fill", "code": value(tr, "transactionCoding/transactionCode"), "swap": true((tr.findtext("transactionCoding/equitySwapInvolved") or "").strip()),
            "tdate": value(tr, "transactionDate/value") or value(tr, "transactionDate"), "sh": value(tr, "transactionAmounts/transactionShares/value"),
            "px": value(tr, "transactionAmounts/transactionPricePerShare/value"), "own": value(tr, "postTransactionAmounts/sharesOwnedFollowingTransaction/value"),
            "di": value(tr, "ownershipNature/directOrIndirectOwnership/value"), "sec": value(tr, "securityTitle/value") or "", "note_ids": sorted({x.get("id") for x in tr.iter("footnoteId") if x.get("id")}),
        }


def parse_filings(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trades and markers of single filings: ``acc, fdate, text`` with the XML in its envelope."""
    kinds = {"string": pa.string(), "date": pa.date32(), "long": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in _FILING.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for a, f, t in zip(*(c.to_pylist() for c in batch.columns)) for r in _filing_rows(a, f, t)]
            yield from pa.Table.from_pylist(rows, schema=schema).to_batches()

    x = texts.select("acc", F.col("fdate").cast("date").alias("fdate"), "text").mapInArrow(run, _FILING)
    filings = x.where("kind = 'filing'").select("acc", "form", "fdate", "cik", "t", "b5", S.iso_date(F.substring("orig", 1, 10)).alias("orig"), "remarks")
    title = F.when(F.col("title") == "", F.col("remarks")).otherwise(F.col("title"))
    owners = x.where("kind = 'owner'").select("acc", "pos", "cik", "name", S.role_letters("relationship", title).alias("rel"), "title")
    fills = x.where("kind = 'fill'").select(
        "acc", "code", "swap", S.iso_date("tdate").alias("tdate"), S.to_number("sh").alias("sh"), S.to_number("px").alias("px"), S.to_number("own").alias("own"),
        F.when(F.col("di") == "I", "I").otherwise("D").alias("di"), "sec", "note_ids",
    )
    return assemble(filings, owners, fills, x.where("kind = 'note' and text <> ''").select("acc", "id", "text"))


def filing_states(texts: DataFrame) -> DataFrame:
    """``acc, state`` of single filings, see ``document``: what was read from broken markup, and what was lost, can be counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([document(t)[1] for t in batch.column(1).to_pylist()], pa.string())], names=["acc", "state"])

    return texts.select(F.col("acc").cast("string"), F.col("text").cast("string")).mapInArrow(run, "acc string, state string")


def ticker_reference(spark: SparkSession, path: str) -> DataFrame:
    """``cik, ticker, exchange, name`` from a columnar JSON ``{fields, data}``; the first listing of a CIK wins."""
    raw = spark.read.schema("fields array<string>, data array<array<string>>").json(path, multiLine=True)
    x = raw.select("fields", F.posexplode("data").alias("i", "row"))
    at = lambda n: F.get("row", (F.array_position("fields", n) - 1).cast("int"))
    x = x.select(at("cik").try_cast("long").alias("cik"), "i", F.struct(*[at(n).alias(n) for n in ("ticker", "exchange", "name")]).alias("v"))
    return x.groupBy("cik").agg(F.min_by("v", "i").alias("v")).select("cik", "v.*")


def registry(rows: DataFrame) -> DataFrame:
    """``ticker, listed, start, end`` of a registry ``ticker, exchange, assetType, priceCurrency, startDate, endDate``."""
    kind = S.exchange_kind(F.trim("exchange"))
    x = rows.where((F.trim("priceCurrency") == "USD") & F.trim("assetType").isin("Stock", "ETF") & kind.isNotNull() & (F.trim("ticker") != ""))
    x = x.select(F.upper(F.trim("ticker")).alias("ticker"), (kind == "listed").alias("listed"), S.iso_date(F.trim("startDate")).alias("start"), S.iso_date(F.trim("endDate")).alias("end"))
    return x.where("start is not null and end is not null")


def issuer_category(trades: DataFrame, reference: DataFrame, intervals: DataFrame | None) -> DataFrame:
    """``trades`` (cik, t, tdate) with ``ticker`` and ``category``: the reference's exchange, else the registry's at the day, else ``unknown``."""
    from tallyglass.operators.asof import interval_lookup

    ref = reference.select("cik", F.col("ticker").alias("__t"), F.col("exchange").alias("__e"))
    x = trades.join(ref, "cik", "left").withColumn("ticker", F.coalesce(F.upper("__t"), F.upper("t")))
    official = F.when(F.col("__e").isNull(), None).when(F.col("__e").isin("NYSE", "Nasdaq", "CBOE"), "listed").otherwise("otc")
    if intervals is None:
        return x.withColumn("category", F.coalesce(official, F.lit("unknown"))).drop("__t", "__e")
    for flag, name in ((True, "__l"), (False, "__o")):
        x = interval_lookup(x, intervals.where(F.col("listed") == flag), "tdate").withColumnRenamed("hits", name)
    at_day = F.when(F.col("__l") > 0, "listed").when(F.col("__o") > 0, "otc")
    return x.withColumn("category", F.coalesce(official, at_day, F.lit("unknown"))).drop("__t", "__e", "__l", "__o")
