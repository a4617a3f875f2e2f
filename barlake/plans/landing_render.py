"""Render bars as landed provider payloads (raw DataFrame rows).

Derives a raw landing tier from the driver's tables so the raw-tier
operators run on data that grows with them. ``render_landing`` has
one payload per (provider, symbol, year), named ``<year>-12-31_daily``;
``render_histories`` has each symbol's whole history in its latest payload,
beside an older, shorter one, and ``land`` writes payloads as the files of a
landing tier. A payload holds one line per date at most.

Bar source -> provider: F -> yfinance, O -> stooq, P -> alpha_vantage.
yfinance headers vary by year: year % 4 picks ``Adj Close``, ``Adj. Close``,
``Adjusted Close`` or none; odd years use ``Datetime`` with offset stamps.
Alpha Vantage includes ``5. adjusted close`` in even years only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barlake.schema import SOURCE_ALPHA_VANTAGE, SOURCE_STOOQ, SOURCE_YFINANCE
from barlake.session import scratch_path
from barlake.sources import payloads as P

PROVIDER_OF = {"F": SOURCE_YFINANCE, "O": SOURCE_STOOQ, "P": SOURCE_ALPHA_VANTAGE}


def _q(v: str) -> str:
    return "'" + v.replace("'", "\\'") + "'"


# Expressions are SQL text: a few JVM calls per frame instead of hundreds.
_PROVIDER_SQL = "CASE source " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in PROVIDER_OF.items()) + " END"
_NUM = "CAST({} AS STRING)"
_YF_STAMPED = "pmod(year, 2) = 1"
_YF_ADJ_VARIANT = "pmod(year, 4) < 3"
_YF_HEADER = (
    f"concat_ws(',', CASE WHEN {_YF_STAMPED} THEN 'Datetime' ELSE 'Date' END, 'Open', 'High', 'Low', 'Close', "
    f"CASE WHEN {_YF_ADJ_VARIANT} THEN element_at(array('Adj Close', 'Adj. Close', 'Adjusted Close'), "
    "pmod(year, 4) + 1) END, 'Volume')"
)
_YF_LINE = (
    f"concat_ws(',', CASE WHEN {_YF_STAMPED} THEN concat(CAST(date AS STRING), ' 00:00:00-05:00') "
    "ELSE CAST(date AS STRING) END, "
    + ", ".join(_NUM.format(c) for c in ("open", "high", "low", "close"))
    + f", CASE WHEN {_YF_ADJ_VARIANT} THEN {_NUM.format('adjusted_close')} END, {_NUM.format('volume')})"
)
_STOOQ_LINE = (
    "concat_ws(',', CAST(date AS STRING), "
    + ", ".join(_NUM.format(c) for c in ("open", "high", "low", "close", "volume")) + ")"
)
_BODY = (
    "concat_ws('\\n', first(header), "
    "array_join(transform(array_sort(collect_list(struct(date, line))), s -> s.line), '\\n'))"
)


def _av_fields(with_adj: bool) -> str:
    kv = [(P.AV_OPEN, "open"), (P.AV_HIGH, "high"), (P.AV_LOW, "low"), (P.AV_CLOSE, "close")]
    if with_adj:
        kv.append((P.AV_ADJ_CLOSE, "adjusted_close"))
    kv.append((P.AV_VOLUME, "volume"))
    return "map(" + ", ".join(f"{_q(k)}, {_NUM.format(c)}" for k, c in kv) + ")"


_AV_SERIES = (
    "map_from_entries(array_sort(collect_list(struct(d, m)), "
    "(a, b) -> CASE WHEN a.d < b.d THEN -1 WHEN a.d > b.d THEN 1 ELSE 0 END))"
)


def _with_provider(bars: DataFrame) -> DataFrame:
    return bars.selectExpr("*", f"{_PROVIDER_SQL} AS provider").where("provider IS NOT NULL")


def render_landing(bars: DataFrame) -> DataFrame:
    """(source, symbol, file_name, body): a payload for each year of bars whose source maps to a provider."""
    return _render(_with_provider(bars).selectExpr("*", "year(date) AS year"), "year", "concat(CAST(year AS STRING), '-12-31')")


def render_histories(bars: DataFrame) -> DataFrame:
    """(source, symbol, file_name, body): two payloads for each (provider,
    symbol), the latest named by the last date, with all bars, and one named
    by the middle of the range, with the bars until then. ``year`` (the header
    variant) is the first digit of the symbol."""
    span = Window.partitionBy("provider", "symbol")
    b = _with_provider(bars).withColumn("last", F.max("date").over(span)).withColumn("begin", F.min("date").over(span))
    middle = "date_add(begin, CAST(datediff(last, begin) / 2 AS INT))"
    b = b.selectExpr("*", "CAST(substring(symbol, 1, 1) AS INT) AS year", f"explode(array(last, {middle})) AS stamp").where("date <= stamp")
    return _render(b, "stamp", "CAST(stamp AS STRING)")


def _render(b: DataFrame, by: str, stamp: str) -> DataFrame:
    """Payloads of bars (with provider and year), one for each (provider, symbol, by)."""
    if by != "year":
        b = b.drop("last", "begin")
    csv = (
        b.where(f"provider IN ({_q(SOURCE_YFINANCE)}, {_q(SOURCE_STOOQ)})")
        .selectExpr(
            "provider AS source", "symbol", by, "date", "'csv' AS ext",
            f"CASE WHEN provider = {_q(SOURCE_YFINANCE)} THEN {_YF_LINE} ELSE {_STOOQ_LINE} END AS line",
            f"CASE WHEN provider = {_q(SOURCE_YFINANCE)} THEN {_YF_HEADER} "
            "ELSE 'Date,Open,High,Low,Close,Volume' END AS header",
        )
        .groupBy("source", "symbol", by, "ext")
        .agg(F.expr(_BODY).alias("body"))
    )
    av = (
        b.where(f"provider = {_q(SOURCE_ALPHA_VANTAGE)}")
        .selectExpr(
            "provider AS source", "symbol", by, "CAST(date AS STRING) AS d",
            f"CASE WHEN pmod(year, 2) = 0 THEN {_av_fields(True)} ELSE {_av_fields(False)} END AS m",
        )
        .groupBy("source", "symbol", by)
        .agg(F.expr(_AV_SERIES).alias("series"))
        .selectExpr(
            "source", "symbol", by, "'json' AS ext",
            f"to_json(named_struct('Meta Data', map('2. Symbol', symbol), {_q(P.AV_DAILY_SERIES)}, series)) AS body",
        )
    )
    return csv.unionByName(av).selectExpr(
        "source", "symbol", f"concat({stamp}, '_daily.', ext) AS file_name", "body"
    )


def land(payloads: DataFrame, raw_dir: str) -> None:
    """Write payload rows as files ``<raw_dir>/<source>/<symbol>/<file_name>``.

    Spark writes the bodies, each into a folder of its own; the driver then
    gives the files their names. For the modest tiers of queries and tests.
    """
    spark = payloads.sparkSession
    staged = scratch_path(spark, "landing", unique=True)
    keys = ["source", "symbol", "file_name"]
    payloads.select(*keys, "body").repartition(*keys).write.partitionBy(*keys).text(staged)
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(Path(staged), True)
    while files.hasNext():
        file = files.next().getPath()
        if not file.getName().startswith("part-"):
            continue
        folder, parts = file.getParent(), []
        for _ in keys:
            value = folder.getName().split("=", 1)[1]
            parts.insert(0, jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(value))
            folder = folder.getParent()
        target = Path(Path(Path(raw_dir, parts[0]), parts[1]), parts[2])
        fs.mkdirs(target.getParent())
        if not fs.rename(file, target):
            raise OSError(f"could not land {target}")


def render_sidecars(landing: DataFrame) -> DataFrame:
    """A ``.meta.json`` sidecar row next to every CSV payload (file listing
    only: the body is the sidecar text)."""
    csv = landing.filter(F.col("file_name").endswith(".csv"))
    return csv.select(
        "source", "symbol",
        F.regexp_replace("file_name", r"\.csv$", ".meta.json").alias("file_name"),
        F.to_json(F.struct(F.col("source"), F.col("symbol"))).alias("body"),
    )


def render_log_sidecars(landing: DataFrame) -> DataFrame:
    """(source, symbol, file_name, body): a fetch sidecar, printed over several
    lines, for each CSV payload of ``render_histories``: source, symbol,
    stooq_symbol (stooq only), the dates of its first and last line, rows (data
    lines) and fetched_at (the file's date, 18:00 UTC)."""
    csv = landing.filter(F.col("file_name").endswith(".csv"))
    lines = "filter(slice(split(body, '\\n'), 2, greatest(size(split(body, '\\n')) - 1, 1)), x -> trim(x) != '')"
    fields = csv.selectExpr(
        "source", "symbol", "regexp_replace(file_name, '[.]csv$', '.meta.json') AS file_name",
        f"size({lines}) AS rows", f"substring(element_at({lines}, 1), 1, 10) AS start_date", f"substring(element_at({lines}, -1), 1, 10) AS end_date",
        "concat(substring(file_name, 1, 10), 'T18:00:00+00:00') AS fetched_at",
    )
    own = F.when(F.col("source") == SOURCE_STOOQ, F.concat(F.lit('  "stooq_symbol": "'), F.lower("symbol"), F.lit('.us",\n'))).otherwise(F.lit(""))
    body = F.concat(
        F.format_string('{\n  "source": "%s",\n  "symbol": "%s",\n', "source", "symbol"), own,
        F.format_string('  "start_date": "%s",\n  "end_date": "%s",\n  "rows": %d,\n  "fetched_at": "%s"\n}', "start_date", "end_date", "rows", "fetched_at"),
    )
    return fields.select("source", "symbol", "file_name", body.alias("body"))


def with_payload_errors(landing: DataFrame) -> DataFrame:
    """Replace some payloads by provider error responses (by year):
    stooq 1997 limit exceeded, stooq 1999 no data, alpha_vantage 1996 note,
    alpha_vantage 2000 error message, yfinance 1998 empty body."""
    year = F.substring("file_name", 1, 4).cast("int")
    src = F.col("source")
    body = (
        F.when((src == SOURCE_STOOQ) & (year == 1997), F.lit("Exceeded the daily hits limit"))
        .when((src == SOURCE_STOOQ) & (year == 1999), F.lit("No data"))
        .when((src == SOURCE_ALPHA_VANTAGE) & (year == 1996), F.lit('{"Note": "Thank you for using the API."}'))
        .when((src == SOURCE_ALPHA_VANTAGE) & (year == 2000), F.lit('{"Error Message": "Invalid API call."}'))
        .when((src == SOURCE_YFINANCE) & (year == 1998), F.lit(""))
        .otherwise(F.col("body"))
    )
    return landing.withColumn("body", body)


def quoted(landing: DataFrame) -> DataFrame:
    """CSV payloads with a byte order mark, and the first cell of every line in double quotes."""
    body = F.concat(F.lit("\ufeff"), F.regexp_replace("body", r"(?m)^([^,\r\n]+),", '"$1",'))
    return landing.withColumn("body", F.when(F.col("file_name").endswith(".csv"), body).otherwise(F.col("body")))


def with_bad_payloads(landing: DataFrame) -> DataFrame:
    """Damage the payloads of two symbols: stooq ``5-LOW`` answers ``No
    data``; every open of alpha_vantage ``4-NOT SPECIFIED`` is ``n/a``."""
    st = (F.col("source") == SOURCE_STOOQ) & (F.col("symbol") == "5-LOW")
    av = (F.col("source") == SOURCE_ALPHA_VANTAGE) & (F.col("symbol") == "4-NOT SPECIFIED")
    body = F.when(st, F.lit("No data")).when(
        av, F.regexp_replace("body", r'"1\. open":"[^"]*"', '"1. open":"n/a"')).otherwise(F.col("body"))
    return landing.withColumn("body", body)


def _by_first(a: Column, b: Column) -> Column:
    k1, k2 = a.getItem("k"), b.getItem("k")
    return F.when(k1 < k2, -1).when(k1 > k2, 1).otherwise(0)


def _sorted_entries(key: Column, value: Column) -> Column:
    """collect_list of (k, v) sorted by k (maps are not orderable)."""
    return F.array_sort(F.collect_list(F.struct(key.alias("k"), value.alias("v"))), _by_first)


def render_intraday(events: DataFrame) -> DataFrame:
    """Intraday payloads from events: per (event_type, user parity, day) a
    5-minute series. Even users -> alpha_vantage ``5min`` JSON and yfinance
    ``5m`` CSV; odd users -> interval ``1h`` (invalid for alpha_vantage,
    valid for yfinance); plus a stooq ``5m`` file (unsupported)."""
    e = events.select(
        F.col("event_type").alias("symbol"),
        F.when(F.col("user_id") % 2 == 0, F.lit("5")).otherwise(F.lit("1h")).alias("tok"),
        F.to_date("ts").alias("day"),
        F.date_format(F.window("ts", "5 minutes").start, "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.col("value"),
    )
    buckets = e.groupBy("symbol", "tok", "day", "stamp").agg(F.sum("value").alias("v"), F.count(F.lit(1)).alias("n"))
    day = F.col("day").cast("string")
    av_itv = F.when(F.col("tok") == "5", F.lit("5min")).otherwise(F.lit("1h"))
    av = (
        buckets.groupBy("symbol", "tok", "day")
        .agg(F.map_from_entries(_sorted_entries(F.col("stamp"), F.create_map(
            F.lit(P.AV_CLOSE), F.col("v").cast("string"), F.lit("5. volume"), F.col("n").cast("string")))).alias("series"))
        .select(
            F.lit(SOURCE_ALPHA_VANTAGE).alias("source"), "symbol",
            F.concat(day, F.lit("_"), av_itv, F.lit(".json")).alias("file_name"),
            F.to_json(F.create_map(F.format_string(P.AV_SERIES_FORMAT, av_itv), F.col("series"))).alias("body"),
        )
    )
    yf_itv = F.when(F.col("tok") == "5", F.lit("5m")).otherwise(F.lit("1h"))
    yf = (
        buckets.groupBy("symbol", "tok", "day")
        .agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(",", "stamp", F.col("v").cast("string"),
                                                                   F.col("n").cast("string")))), "\n").alias("lines"))
        .select(
            F.lit(SOURCE_YFINANCE).alias("source"), "symbol",
            F.concat(day, F.lit("_"), yf_itv, F.lit(".csv")).alias("file_name"),
            F.concat(F.lit("Datetime,Close,Volume\n"), F.col("lines")).alias("body"),
        )
    )
    st = (
        buckets.filter(F.col("tok") == "5").groupBy("symbol", "day").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(SOURCE_STOOQ).alias("source"), "symbol",
                F.concat(day, F.lit("_5m.csv")).alias("file_name"), F.lit("Date,Close\n").alias("body"))
    )
    return av.unionByName(yf).unionByName(st)
