"""The raw landing tier ``raw/<source>/<symbol>/<YYYY-MM-DD>_<kind>.<ext>``.

A landed payload is one provider response; it is read whole (one row per
file) because a CSV header or a JSON object spans the file. A payload's
size is bounded by the provider's response (one symbol's daily history),
not by the size of the landing tier, which only adds files (= rows, =
tasks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators._common import restrict_symbols, symbol_items

RAW_COLUMNS = ["source", "symbol", "file_name", "body"]
_TAIL = r"([^/]+)/([^/]+)/([^/]+)$"


def _decode(c: Column) -> Column:
    # _metadata.file_path is URI-encoded; keep a literal '+' as '+'.
    return F.url_decode(F.regexp_replace(c, r"\+", "%2B"))


def _path_parts(path: Column) -> list[Column]:
    return [
        F.regexp_extract(path, _TAIL, 1).alias("source"),
        F.regexp_extract(path, _TAIL, 2).alias("symbol"),
        F.regexp_extract(path, _TAIL, 3).alias("file_name"),
    ]


def with_kind(df: DataFrame) -> DataFrame:
    """Classify ``file_name``: ``meta`` (sidecar), ``daily`` (matches
    ``*_daily.*``), else ``intraday`` with its ``interval`` token."""
    name = F.col("file_name")
    kind = (
        F.when(name.endswith(".meta.json"), F.lit("meta"))
        .when(name.rlike(r"_daily\."), F.lit("daily"))
        .otherwise(F.lit("intraday"))
    )
    interval = F.regexp_extract(name, r"^[^_]*_([^.]+)\.", 1)
    return df.withColumn("kind", kind).withColumn(
        "interval", F.when(kind == "intraday", interval)
    ).withColumn("fetch_date", F.try_to_timestamp(F.substring(name, 1, 10), F.lit("yyyy-MM-dd")).cast("date"))


DAILY_FILES = "*_daily.*"


def _files(reader: DataFrameReader, pattern: str) -> DataFrameReader:
    """Options of a scan of the tier: directories are walked by Spark's file index, not expanded as a glob."""
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)


def read_landing(spark: SparkSession, raw_dir: str, pattern: str = "*") -> DataFrame:
    """(source, symbol, file_name, body, kind, interval, fetch_date): one row
    per landed file whose name matches ``pattern``, sidecars included (filter
    on ``kind``)."""
    df = _files(spark.read, pattern).text(raw_dir, wholetext=True)
    path = _decode(F.col("_metadata.file_path"))
    return with_kind(df.select(*_path_parts(path), F.col("value").alias("body")))


def list_landing(spark: SparkSession, raw_dir: str, pattern: str = "*") -> DataFrame:
    """File listing (source, symbol, file_name, kind, ...) without reading
    any content: the binaryFile source prunes its ``content`` column."""
    df = _files(spark.read.format("binaryFile"), pattern).load(raw_dir)
    return with_kind(df.select(*_path_parts(F.col("path"))))


#: Most bits of the file filter (1 MB): what passes through the driver for any number of chosen files.
FILTER_BITS = 1 << 23


def read_chosen(spark: SparkSession, raw_dir: str, keys: DataFrame, pattern: str = DAILY_FILES) -> DataFrame:
    """The landed rows of the files named by ``keys`` (source, symbol, file_name).

    Other files are dropped while the scan lists its files, before any of
    their content is read: a condition on ``_metadata.file_path`` alone prunes
    files. The condition looks the path's hash up in a bit array made from the
    keys by Spark, of 16 bits a file and at most ``FILTER_BITS``, so no list of
    paths passes through the driver. The few files that share a bit with a
    chosen one are read, and dropped by the semi-join.
    """
    names = ["source", "symbol", "file_name"]
    keys = keys.select(*names)
    bits = 1 << 10
    while bits < min(16 * keys.count(), FILTER_BITS):
        bits *= 2
    place = lambda parts: F.pmod(F.xxhash64(F.concat_ws("/", *parts)), F.lit(bits))
    ones = keys.select(place(names).alias("bit")).groupBy(F.expr("bit div 8").alias("byte")).agg(F.bit_or(F.expr("1 << CAST(bit % 8 AS int)")).alias("ones"))
    array = bytearray(bits // 8)
    for byte, value in ones.collect():  # at most bits / 8 rows
        array[byte] = value
    path = _decode(F.col("_metadata.file_path"))
    bit = place(_path_parts(path))
    byte = F.conv(F.hex(F.substring(F.lit(bytes(array)), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    chosen = F.getbit(byte, (bit % 8).cast("int")) == 1
    df = _files(spark.read, pattern).text(raw_dir, wholetext=True).where(chosen)
    rows = with_kind(df.select(*_path_parts(path), F.col("value").alias("body")))
    return rows.join(keys, names, "left_semi")


def latest_raw(listing: DataFrame, sources=None, symbols=None) -> DataFrame:
    """Latest daily payload per (source, symbol): the greatest file name among
    ``*_daily.*`` files that are not ``.meta.json`` sidecars (intraday files
    never qualify). An aggregate (``max``), so a symbol with many fetches is
    pre-aggregated per task.

    With ``sources`` and ``symbols`` given, every requested pair gets a row
    and ``file_name`` is NULL where nothing was landed.
    """
    daily = with_kind(listing) if "kind" not in listing.columns else listing
    daily = daily.filter(F.col("kind") == "daily")
    if sources is not None:
        daily = daily.filter(F.col("source").isin(list(sources)))
    daily = restrict_symbols(daily, symbols)
    latest = daily.groupBy("source", "symbol").agg(F.max("file_name").alias("file_name"))
    if sources is None or symbols is None:
        return latest.withColumn("found", F.lit(True))
    spark = listing.sparkSession
    if isinstance(symbols, DataFrame):
        grid = symbols.select("symbol").distinct()
    else:
        grid = spark.createDataFrame([(s,) for s in symbol_items(symbols)], "symbol string")
    grid = grid.select(F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"), "symbol")
    return grid.join(latest, ["source", "symbol"], "left").withColumn("found", F.col("file_name").isNotNull())


def select_latest(raw: DataFrame, sources=None, symbols=None, keys: DataFrame | None = None) -> DataFrame:
    """The payload rows of the latest daily file per (source, symbol), or of
    the ``keys`` that ``latest_raw`` found."""
    if keys is None:
        keys = latest_raw(raw.select("source", "symbol", "file_name"), sources, symbols)
    keys = keys.filter("found")
    return raw.join(keys.select("source", "symbol", "file_name"), ["source", "symbol", "file_name"], "left_semi")


INGEST_LOG_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("stooq_symbol", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("rows", T.LongType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)


def read_ingest_log(spark: SparkSession, raw_dir: str, pattern: str = "*.meta.json", multi_line: bool = True) -> DataFrame:
    """The fetch sidecars as one DataFrame (schema given, never inferred).

    Landed sidecars are one pretty-printed object per file (``multi_line``);
    a consolidated log written as JSON lines reads with ``multi_line=False``.
    A sidecar that is no such object gives a row with its text in ``bad`` and
    without fields; ``bad`` is NULL for the others. A field of another type is
    bad too, and the fields that could be read stay. ``file_name`` and the path's
    ``path_source`` and ``path_symbol`` say which file it is.
    """
    schema = T.StructType([*INGEST_LOG_SCHEMA.fields, T.StructField("bad", T.StringType())])
    log = (
        _files(spark.read, pattern)
        .schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "bad")
        .json(raw_dir)
    )
    source, symbol, file_name = _path_parts(_decode(F.col("_metadata.file_path")))
    return log.select(*log.columns, file_name, source.alias("path_source"), symbol.alias("path_symbol"))
