"""Scalar expressions: rounding, parsing, classification. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names, patterns and thresholds that define the classes.
MAJOR_EXCHANGES = ("NYSE", "NASDAQ", "BATS", "NYSE ARCA", "AMEX", "NYSE MKT", "NYSE American")
OTC_EXCHANGES = ("PINK", "OTCMKTS", "OTCGREY", "OTCBB", "OTCQB", "OTCQX", "OTCCE", "OTCD", "EXPM")
NOT_TICKERS = ("NONE", "N/A", "NA")
TICKER_PATTERN = r"^[A-Z][A-Z0-9.-]{0,9}$"
NON_COMMON_PATTERN = r"(?i)preferred|warrant|debenture|\bnotes?\b|\bbonds?\b|\brights?\b|convertible"
ENTITY_PATTERN = (
    r"(?i)\b(L\.?P\.?|LLC|L\.L\.C\.|LLP|INC\.?|CORP\.?|CORPORATION|COMPANY|CO\.|LTD\.?|GMBH|PLC|N\.?V\.?|S\.?A\.?|TRUST|FUND[S]?|CAPITAL|"
    r"PARTNERS?|ADVISORS?|ADVISERS?|MANAGEMENT|HOLDINGS?|GROUP|ASSOCIATES|VENTURES?|EQUITY|INVESTMENTS?|ASSET|BANCORP|BANK|FOUNDATION|"
    r"ENDOWMENT|SOCIETY|LIMITED|MASTER|OFFSHORE|SPV)\b"
)
FOOTNOTE_PATTERNS = {
    "b5": r"10b5[\s-]?1|rule\s*10b5|trading\s+plan",
    "offering": r"rights\s+offering|private\s+placement|securities\s+purchase\s+agreement|subscription\s+agreement|registered\s+direct|"
    r"underwrit(?:ten|ing)\s+(?:public\s+)?(?:offering|agreement|discount)|\bPIPE\b|at[\s-]the[\s-]market\s+(?:offering|program|sales\s+agreement|facility)|"
    r"placement\s+agent|investment\s+agreement",
    "drip": r"dividend\s+reinvest|\bDRIP\b|automatic\s+(?:monthly|quarterly|periodic)?\s*(?:purchase|investment)\s+plan",
    "espp": r"employee\s+stock\s+purchase|\bESPP\b|401\s*\(\s*k\s*\)|deferred\s+compensation\s+plan",
    "forced": r"margin\s+call|foreclos|involuntar|divorce\s+decree|domestic\s+relations\s+order|court\s+order",
    "pledge": r"pledg",
    "wavg": r"weighted\s+average|ranging\s+from|range\s+of\s+prices|prices\s+ranging|various\s+prices",
    "gift": r"bona\s+fide\s+gift|no\s+consideration|charitable",
    "trust": r"\btrusts?\b|\bGRAT\b|by\s+(?:his|her|the)?\s*(?:spouse|wife|husband)|family\s+(?:partnership|limited)",
}
ROLE_ORDER = ("F", "C", "D", "O", "T", "X")
CEO_PATTERN, CFO_PATTERN = r"\bceo\b|chief\s+exec|\bpres(?:ident)?\b", r"\bcfo\b|chief\s+fin|principal\s+financial"
ADV_EDGES = ((3e6, "micro"), (3e7, "small"), (3e8, "mid"))
SIZE_EDGES = ((5e4, "<50k"), (2.5e5, "50k-250k"), (1e6, "250k-1m"))


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x: Column | str, digits: int = 4) -> Column:
    """Round half towards plus infinity, the rule of all published figures.

    ``floor`` gives a long, which ends at 9.2e18; a double of 2^52 or more has no fraction and is left as it is.
    """
    scale = float(10**digits)
    y = _col(x) * scale + 0.5
    return F.when(F.abs(y) < 2.0**52, F.floor(y)).otherwise(y) / scale


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is 0 or either is null."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def to_number(s: Column | str) -> Column:
    """Text as a double; null for empty, malformed or infinite text."""
    x = _col(s).try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def iso_date(s: Column | str) -> Column:
    """A strict yyyy-MM-dd date that exists in the calendar, else null."""
    s = _col(s)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd"))


def filing_date(s: Column | str) -> Column:
    """A dd-MMM-yyyy date in English, month in any case, else null."""
    return F.try_to_date(F.initcap(_col(s)), "dd-MMM-yyyy")


def plausible_ticker(t: Column | str) -> Column:
    t = _col(t)
    return F.coalesce(t.rlike(TICKER_PATTERN) & ~t.isin(*NOT_TICKERS), F.lit(False))


def exchange_kind(exchange: Column | str) -> Column:
    """``listed``, ``otc`` or null."""
    x = _col(exchange)
    return F.when(x.isin(*MAJOR_EXCHANGES), "listed").when(x.isin(*OTC_EXCHANGES), "otc")


def stepped(x: Column | str, edges, last: str, missing: str | None = None) -> Column:
    """The label of the first edge that ``x`` is below, else ``last``."""
    x = _col(x)
    out = F.when(x.isNull(), F.lit(missing))
    for edge, label in edges:
        out = out.when(x < edge, label)
    return out.otherwise(last)


def adv_bucket(x: Column | str) -> Column:
    return stepped(x, ADV_EDGES, "large", "н/д")


def size_bucket(x: Column | str) -> Column:
    return stepped(x, SIZE_EDGES, ">1m")


def drawdown_label(dd: Column | str) -> Column:
    """Depth below the high, tested in this order: missing, deep, middling, at the high, rest."""
    dd = _col(dd)
    return F.when(dd.isNull(), "none").when(dd <= -0.30, "deep").when(dd <= -0.15, "mid").when(dd >= -0.05, "high").otherwise("low")


def business_days(a: Column | str, b: Column | str) -> Column:
    """Weekdays in [a, b); 0 where a is not before b. In closed form, no list of days."""
    a, b = _col(a), _col(b)

    def until(d: Column) -> Column:  # weekdays from a fixed Monday to before d
        n = F.datediff(d, F.lit("1900-01-01").cast("date"))
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))

    return F.when(a < b, until(b) - until(a)).otherwise(0).cast("int")


def iso_week(d: Column | str) -> Column:
    """ISO year and week as ``YYYY-Www``."""
    d = _col(d)
    return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), d), F.weekofyear(d))


def footnote_flags(texts: Column | str) -> dict[str, Column]:
    """A boolean for each class of footnote; white space is Unicode's."""
    t = F.coalesce(_col(texts), F.lit(""))
    return {k: t.rlike("(?iU)" + p) for k, p in FOOTNOTE_PATTERNS.items()}


def footnote_ids(*fields: Column | str) -> Column:
    """Distinct ids listed in the fields, split at commas and white space."""
    split = [F.split(F.coalesce(_col(f), F.lit("")), r"(?U)[,\s]+") for f in fields]
    return F.array_distinct(F.filter(F.flatten(F.array(*split)), lambda x: x != ""))


def role_letters(relationship: Column | str, title: Column | str) -> Column:
    """D, O, T, X for the relationship (X if none), then C or F for the title."""
    r, t = F.lower(F.coalesce(_col(relationship), F.lit(""))), F.lower(F.coalesce(_col(title), F.lit("")))
    has = lambda *words: F.greatest(*[r.contains(w) for w in words]) if len(words) > 1 else r.contains(words[0])
    rel = F.concat(*[F.when(has(*w), x).otherwise("") for x, w in (("D", ("director",)), ("O", ("officer",)), ("T", ("tenpercent", "10%")), ("X", ("other",)))])
    top = F.when(t.rlike("(?U)" + CEO_PATTERN), "C").when(t.rlike("(?U)" + CFO_PATTERN), "F").otherwise("")
    return F.concat(F.when(rel == "", "X").otherwise(rel), top)


def is_entity(name: Column | str) -> Column:
    return F.coalesce(_col(name), F.lit("")).rlike(ENTITY_PATTERN)


def top_role(owners: Column | str) -> Column:
    """The first role in order of weight that any owner's ``rel`` has."""
    letters = F.array_join(F.transform(owners, lambda o: F.coalesce(o["rel"], F.lit(""))), "")
    return F.coalesce(*[F.when(letters.contains(c), c) for c in ROLE_ORDER], F.lit("X"))


def primary_owner(owners: Column | str) -> Column:
    """The first person among the owners, else the first owner."""
    people = F.filter(owners, lambda o: ~is_entity(o["name"]))
    return F.coalesce(F.get(people, F.lit(0)), F.get(_col(owners), F.lit(0)))


def fund_only(owners: Column | str) -> Column:
    """There are owners and all are entities."""
    return (F.size(owners) > 0) & F.forall(owners, lambda o: is_entity(o["name"]))


def ownership_growth(sh, own, mixed, sh_direct, own_direct) -> Column:
    """Shares against the holding before; 9.99 for a first holding, null where it can't be known."""
    s, o = F.when(_col(mixed), _col(sh_direct)).otherwise(_col(sh)), F.when(_col(mixed), _col(own_direct)).otherwise(_col(own))
    before = o - s
    return F.when(o.isNull() | s.isNull() | (s == 0) | (before < 0), None).when(before == 0, 9.99).otherwise(rnd(ratio(s, before)))


def quote_symbols(text: Column | str, most: int = 50) -> Column:
    """Requested symbols: split at commas, trimmed, plausible, distinct, sorted; those beyond ``most`` are kept apart by the caller."""
    parts = F.transform(F.split(F.upper(_col(text)), ","), lambda x: F.trim(x))
    return F.slice(F.array_sort(F.array_distinct(F.filter(parts, lambda x: x.rlike(r"^[A-Z][A-Z0-9./-]{0,9}$")))), 1, most)


def chart_symbol(t: Column | str) -> Column:
    return F.regexp_replace(_col(t), r"[./]", "-")


def csv_symbol(t: Column | str) -> Column:
    return F.concat(F.lower(F.regexp_replace(_col(t), r"\.", "-")), F.lit(".us"))


def file_name(t: Column | str) -> Column:
    return F.regexp_replace(_col(t), r"[^A-Za-z0-9.-]", "_")


def month(d: Column | str) -> Column:
    return F.date_format(_col(d), "yyyy-MM")
