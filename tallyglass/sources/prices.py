"""Readers of daily prices: chart JSON, CSV with an HTML fallback, nominal rows of delisted symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyglass.functions.scalars import iso_date, rnd, to_number
from tallyglass.operators.series import split_adjusted

_CHART = (
    "chart struct<result:array<struct<meta:struct<currency:string,instrumentType:string,gmtoffset:bigint,exchangeName:string>,timestamp:array<bigint>,"
    "indicators:struct<quote:array<struct<close:array<double>,volume:array<double>>>,adjclose:array<struct<adjclose:array<double>>>>,"
    "events:struct<splits:map<string,struct<date:bigint,numerator:double,denominator:double>>>>>>"
)
#: Seconds that exchange time lies behind UTC where the source does not say.
DEFAULT_OFFSET = -14400


def _result(charts: DataFrame) -> DataFrame:
    x = charts.select("ticker", F.from_json("body", _CHART)["chart"]["result"][0].alias("r")).where("size(r.timestamp) > 0")
    currency, kind = F.col("r.meta.currency"), F.col("r.meta.instrumentType")
    ok = (F.coalesce(currency, F.lit("")).isin("", "USD")) & (F.coalesce(kind, F.lit("")).isin("", "EQUITY", "ETF"))
    return x.where(ok).withColumn("off", F.coalesce("r.meta.gmtoffset", F.lit(DEFAULT_OFFSET)))


def chart_bars(charts: DataFrame) -> DataFrame:
    """Bars of ``ticker, body``: dollars and shares or funds only, exchange-local days, the last bar of a day, no bar without an adjusted price."""
    x = _result(charts)
    quote = F.col("r.indicators.quote")[0]
    adj = F.coalesce(F.get("r.indicators.adjclose", F.lit(0))["adjclose"], quote["close"])
    rows = x.select("ticker", "off", F.posexplode(F.arrays_zip(F.col("r.timestamp").alias("ts"), quote["close"].alias("c"), adj.alias("a"), quote["volume"].alias("v"))).alias("i", "b")).where("b.a > 0")
    day = F.to_date(F.timestamp_seconds(F.col("b.ts") + F.col("off")))
    close = F.when(F.col("b.c") > 0, F.col("b.c")).otherwise(F.col("b.a"))
    one = F.struct(rnd(close).alias("close"), rnd("b.a").alias("adj"), F.coalesce("b.v", F.lit(0.0)).alias("vol"))
    return rows.groupBy("ticker", day.alias("d")).agg(F.max_by(one, "i").alias("x")).select("ticker", "d", "x.*")


def chart_splits(charts: DataFrame) -> DataFrame:
    """``ticker, d, ratio`` of the same bodies; ratios carry four decimals."""
    x = _result(charts).select("ticker", "off", F.explode(F.map_values("r.events.splits")).alias("s")).where("s.numerator > 0 and s.denominator > 0")
    return x.select("ticker", F.to_date(F.timestamp_seconds(F.col("s.date") + F.col("off"))).alias("d"), rnd(F.col("s.numerator") / F.col("s.denominator")).alias("ratio"))


def csv_bars(bodies: DataFrame) -> DataFrame:
    """Bars of ``ticker, body`` in CSV (Date,Open,High,Low,Close,Volume); other bodies, such as pages, give none."""
    x = bodies.where(F.col("body").startswith("Date,")).select("ticker", F.explode(F.split("body", r"\r?\n")).alias("l"))
    x = x.select("ticker", F.split("l", ",").alias("c")).where(F.size("c") >= 5)
    close = to_number(F.col("c")[4])
    rows = x.select("ticker", iso_date(F.col("c")[0]).alias("d"), close.alias("close"), close.alias("adj"), F.coalesce(to_number(F.get("c", F.lit(5))), F.lit(0.0)).alias("vol"))
    return rows.where("d is not null and close > 0")


def first_source(*bars: DataFrame) -> DataFrame:
    """Each ticker's bars from the first source that has any."""
    rows = None
    for i, b in enumerate(bars):
        own = b.withColumn("__p", F.lit(i))
        rows = own if rows is None else rows.unionByName(own)
    best = rows.groupBy("ticker").agg(F.min("__p").alias("__p"))
    return rows.join(best, ["ticker", "__p"], "left_semi").drop("__p")


def nominal_bars(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars and splits of ``ticker, date, close, adjClose, volume, adjVolume, splitFactor`` with nominal closes."""
    factor = F.when((F.col("splitFactor") > 0) & (F.col("splitFactor") != 1), F.col("splitFactor").cast("double"))
    x = rows.select("ticker", iso_date(F.substring(F.col("date").cast("string"), 1, 10)).alias("d"), F.col("close").cast("double"), F.col("adjClose").cast("double").alias("adj"), F.coalesce("adjVolume", "volume").cast("double").alias("v"), factor.alias("factor"))
    done = split_adjusted(x.withColumn("vol", F.lit(0.0))).where("d is not null and close > 0 and adj > 0")
    bars = done.select("ticker", "d", rnd("close").alias("close"), rnd("adj").alias("adj"), F.when(F.col("v") > 0, rnd("v", 0)).otherwise(0.0).alias("vol"))
    return bars, x.where("factor is not null").select("ticker", "d", rnd("factor", 6).alias("ratio"))


_CACHED = "d string, close string, adj string, vol string"


def _cached_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.csv\.gz$", 1)


def price_cache(spark: SparkSession, path: str) -> DataFrame:
    """Bars of the cached series, a gzip CSV (day, close, adjusted, volume) for each ticker, named by it.

    Lines without a valid day or positive prices are left out. ``repair.repair`` makes
    series of them, and ``repair.counters`` tells once for each what that did.
    """
    x = spark.read.schema(_CACHED).csv(f"{path}/*.csv.gz").select(_cached_name(F.input_file_name()).alias("ticker"), iso_date("d").alias("d"), to_number("close").alias("close"), to_number("adj").alias("adj"), F.coalesce(to_number("vol"), F.lit(0.0)).alias("vol"))
    return x.where("d is not null and close > 0 and adj > 0")


def cached_tickers(spark: SparkSession, path: str) -> DataFrame:
    """``ticker`` of every cached series, from the listing alone: no file is opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.gz").load(path).select(_cached_name(F.col("path")).alias("ticker")).where("ticker <> ''").distinct()


def json_documents(spark: SparkSession, path: str, schema: str, fallback: dict | None = None) -> DataFrame:
    """The rows of documents, plain or gzip, one a file (an object, or an array of them).

    Each document that is no JSON gives the row ``fallback`` instead (nothing without one), whatever the others are.
    """
    bodies = spark.read.text(path, wholetext=True)
    one = StructType.fromDDL(schema)
    marked = f"{schema}, __broken string"
    options = {"columnNameOfCorruptRecord": "__broken"}
    rows = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", f"array<struct<{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in one)}>>"))
    single = F.from_json("value", marked, options)
    plain = F.when(single["__broken"].isNull(), F.array(F.struct(*[single[f.name].alias(f.name) for f in one])))
    found = bodies.select(F.coalesce(rows, plain).alias("rows"))
    if fallback is not None:
        spare = F.array(F.struct(*[F.lit(fallback.get(f.name)).cast(f.dataType).alias(f.name) for f in one]))
        found = found.select(F.coalesce("rows", spare).alias("rows"))
    return found.select(F.explode("rows").alias("row")).select("row.*")
