"""Hive-partitioned Parquet store ``<processed>/<dataset>/symbol=/source=/year=``.

Writing: ``year`` is derived from ``date``; rows are rebalanced on the
partition keys so each (symbol, source, year) directory normally gets one
file, while AQE splits an oversized key instead of funnelling it through
one task; only touched partitions are overwritten (dynamic overwrite),
zstd-compressed, partition columns live in the paths only.

Reading: the schema is always passed (inference would type symbol=7203 as
INT), so ``symbol``/``source``/``year`` filters become partition filters.
"""

from __future__ import annotations

import functools
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.schema import DEFAULT_DATASET, FILE_SCHEMA, PARTITION_COLUMNS, PARTITION_SCHEMA, STORE_SCHEMA
from barlake.session import scratch_path

HIVE, BUCKETED = "hive", "bucketed"
BUCKET_COLUMNS = ["source", "year", "bucket"]
#: Default number of symbol buckets in each (source, year) of the bucketed layout.
BUCKETS = 64
#: (symbol, source, year) slices of a write that are broadcast at most (about 100 bytes each); more are joined by a shuffle.
SLICES_BROADCAST = 1_000_000


def dataset_path(processed_dir: str, dataset: str = DEFAULT_DATASET) -> str:
    return f"{processed_dir.rstrip('/')}/{dataset}"


def _store_frame(df: DataFrame) -> DataFrame:
    if "year" not in df.columns:
        df = df.withColumn("year", F.year("date"))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORE_SCHEMA.fields])


def _bucket(buckets: int) -> Column:
    return F.expr(f"CAST(pmod(xxhash64(symbol), {buckets}) AS INT)")


# ---------------------------------------------------------------- layout descriptor

#: A small JSON file in the dataset's folder; Spark's readers skip names that begin with an underscore.
DESCRIPTOR = "_layout.json"


def layout_of(spark: SparkSession, processed_dir: str, dataset: str = DEFAULT_DATASET) -> dict | None:
    """{"layout", "buckets"} of a dataset: as committed, else as its
    directories show (buckets unknown: None); None where nothing is stored."""
    fs, root = _fs(spark, dataset_path(processed_dir, dataset))
    file = spark._jvm.org.apache.hadoop.fs.Path(root, DESCRIPTOR)
    if fs.exists(file):
        stream = fs.open(file)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
    if not fs.exists(root):
        return None
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    if any(n.startswith("symbol=") for n in names):
        return {"layout": HIVE, "buckets": None}
    if any(n.startswith("source=") for n in names):
        return {"layout": BUCKETED, "buckets": None}
    return None


def _commit_layout(spark: SparkSession, processed_dir: str, dataset: str, layout: str | None, buckets: int | None) -> dict:
    """The layout to write by: the stored one, with which a given one must
    agree; for a new dataset the given one, which is committed first."""
    if layout not in (None, HIVE, BUCKETED):
        raise ValueError(f"Unknown layout '{layout}'. Available: {[HIVE, BUCKETED]}")
    path = dataset_path(processed_dir, dataset)
    stored = layout_of(spark, processed_dir, dataset)
    if stored is None:
        new = {"layout": layout or HIVE, "buckets": (buckets or BUCKETS) if layout == BUCKETED else None}
        fs, root = _fs(spark, path)
        fs.mkdirs(root)
        try:
            out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(root, DESCRIPTOR), False)
        except Exception:  # noqa: BLE001 - another writer was first: its layout counts
            stored = layout_of(spark, processed_dir, dataset)
            if stored is None:
                raise
        else:
            try:
                out.write(bytearray(json.dumps(new).encode()))
            finally:
                out.close()
            return new
    _require_layout(stored, path, layout, buckets)
    if stored["layout"] == BUCKETED and stored["buckets"] is None:
        raise ValueError(f"{path} is bucketed but has no {DESCRIPTOR}: its bucket count is not known, so it cannot be written to")
    return stored


def _require_layout(stored: dict, path: str, layout: str | None, buckets: int | None) -> None:
    if layout is not None and layout != stored["layout"]:
        raise ValueError(f"{path} has the layout '{stored['layout']}', not '{layout}'")
    if buckets is not None and stored["layout"] == BUCKETED and buckets != stored["buckets"]:
        raise ValueError(f"{path} has {stored['buckets']} buckets, not {buckets}")


def write_bars(
    df: DataFrame, processed_dir: str, dataset: str = DEFAULT_DATASET, layout: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Write normalized bars; return (symbol, source, year, rows) of the
    partitions this write replaced, counted from the rows it wrote.

    The input is computed once: its rows are staged in the shared folder, and
    the store's files and the returned counts both come from the stage. A
    re-fetch that is shorter than what is stored replaces the whole (symbol,
    source, year) slice, in either layout:

    * ``hive`` (a new dataset's default): one directory for each (symbol, source, year);
    * ``bucketed``: one directory for each (source, year, bucket of symbols),
      rows sorted by (symbol, date). Untouched symbols of a touched directory
      are read back and written again beside the new rows. For universes of
      very many symbols, where the other layout makes too many small files.

    The first write commits the layout and its bucket count (64 unless given)
    in a descriptor beside the data. Later writes follow it, and raise if they
    name another layout or count.
    """
    spark, path = df.sparkSession, dataset_path(processed_dir, dataset)
    stored = _commit_layout(spark, processed_dir, dataset, layout, buckets)
    stage = scratch_path(spark, "stage", unique=True)
    _store_frame(df).write.option("compression", "zstd").parquet(stage)
    staged = spark.read.schema(STORE_SCHEMA).parquet(stage)
    rows, columns, order = staged, PARTITION_COLUMNS, ["date"]
    if stored["layout"] == BUCKETED:
        columns, order = BUCKET_COLUMNS, ["symbol", "date"]
        rows = staged.withColumn("bucket", _bucket(stored["buckets"]))
        if has_parquet(spark, path):
            old = _read(spark, path, BUCKETED)
            # Directories, which the commit of the write lists in any case: broadcast, so that rows of others aren't shuffled.
            touched = F.broadcast(rows.select(*BUCKET_COLUMNS).distinct())
            slices = rows.select(*PARTITION_COLUMNS).distinct()
            if slices.limit(SLICES_BROADCAST + 1).count() <= SLICES_BROADCAST:
                slices = F.broadcast(slices)
            kept = old.join(touched, BUCKET_COLUMNS, "left_semi").join(slices, PARTITION_COLUMNS, "left_anti")
            again = scratch_path(spark, "stage", unique=True)
            kept.select(*rows.columns).write.option("compression", "zstd").parquet(again)  # the store's own files are about to be replaced
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(again))
    (
        rows.hint("rebalance", *columns)
        .sortWithinPartitions(*columns, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*columns)
        .parquet(path)
    )
    forget_files(spark, path)
    return _counts(staged)


def _read(spark: SparkSession, path: str, layout: str, schema=STORE_SCHEMA) -> DataFrame:
    if layout == BUCKETED:
        schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_store(
    spark: SparkSession, processed_dir: str, dataset: str = DEFAULT_DATASET, schema=STORE_SCHEMA, layout: str | None = None
) -> DataFrame:
    """The stored bars, by the dataset's own layout; a ``layout`` that isn't the stored one raises."""
    path = dataset_path(processed_dir, dataset)
    stored = layout_of(spark, processed_dir, dataset) or {"layout": layout or HIVE, "buckets": None}
    _require_layout(stored, path, layout, None)
    return _read(spark, path, stored["layout"], schema).select(*schema.fieldNames())


def _counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("rows"))


def partition_counts(spark: SparkSession, processed_dir: str, dataset: str = DEFAULT_DATASET, layout: str | None = None) -> DataFrame:
    """(symbol, source, year, rows) for every stored partition."""
    return _counts(read_store(spark, processed_dir, dataset, layout=layout))


# ---------------------------------------------------------------- views


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def has_parquet(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet file stands under the path; the walk ends at the first."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and _has_parquet(fs, p)


def _has_parquet(fs, path) -> bool:
    it = fs.listFiles(path, True)
    while it.hasNext():
        if it.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def dataset_schema(spark: SparkSession, path: str, dataset: str) -> T.StructType:
    """The canonical schema for the bar dataset; for any other dataset the
    file schema with the pinned partition columns appended."""
    if dataset == DEFAULT_DATASET:
        return STORE_SCHEMA
    inferred = spark.read.option("basePath", path).parquet(path).schema
    pinned = {f.name for f in PARTITION_SCHEMA.fields}
    fields = [f for f in inferred.fields if f.name not in pinned]
    present = {f.name for f in inferred.fields}
    return T.StructType(fields + [f for f in PARTITION_SCHEMA.fields if f.name in present])


class _Catalog:
    """What register_views knows: the frame of every dataset folder whose files
    were listed, and which folder each view of a session reads."""

    def __init__(self):
        self.frames: dict[tuple[str, str], DataFrame] = {}
        self.shown: dict[tuple[str, str], str] = {}


_CATALOG = _Catalog()


def _session(spark: SparkSession) -> str:
    return f"{spark.sparkContext.applicationId}/{spark._jsparkSession.sessionUUID()}"


def _qualified(fs, path) -> str:
    """One spelling of a path: with scheme, without doubled or trailing slashes."""
    return path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def forget_files(spark: SparkSession, path: str) -> None:
    """Drop what is known of the files below a path, however it is spelled; the next use lists them anew."""
    fs, p = _fs(spark, path)
    changed = _qualified(fs, p)
    for session, known in list(_CATALOG.frames):
        if known == changed or known.startswith(changed + "/"):
            del _CATALOG.frames[session, known]
    spark.catalog.refreshByPath(changed)


def register_views(spark: SparkSession, processed_dir: str, refresh: bool = False) -> list[str]:
    """One temp view per dataset directory holding Parquet files.

    Non-directories and directories without Parquet are skipped; a missing
    root gives []. Every call points the views at this store: names that an
    earlier call took from another store are dropped if this one doesn't have
    them. A dataset's files are listed once for each session, and again after
    ``write_bars`` wrote to it; ``refresh`` lists them anew for files that
    others wrote. Either layout can be read: partition columns are found from
    the directories, their types are fixed.
    """
    session = _session(spark)
    fs, root = _fs(spark, processed_dir)
    if refresh:
        forget_files(spark, processed_dir)
    found = {}
    if fs.exists(root):
        for st in sorted(fs.listStatus(root), key=lambda s: s.getPath().getName()):
            name = st.getPath().getName()
            if st.isDirectory() and not name.startswith(("_", ".")) and _has_parquet(fs, st.getPath()):
                found[name] = _qualified(fs, st.getPath())
    for (owner, name), path in list(_CATALOG.shown.items()):
        if owner == session and name not in found:
            _drop_own(spark, session, name, path)
    for name, path in found.items():
        frame = _CATALOG.frames.get((session, path))
        if frame is None:
            schema = dataset_schema(spark, path, name)
            frame = _CATALOG.frames[session, path] = spark.read.schema(schema).option("basePath", path).parquet(path)
        frame.createOrReplaceTempView(name)
        _CATALOG.shown[session, name] = path
    return list(found)


def _drop_own(spark: SparkSession, session: str, name: str, path: str) -> None:
    """Drop a view made here for another store, unless its user has put something else under the name."""
    del _CATALOG.shown[session, name]
    frame = _CATALOG.frames.get((session, path))
    if spark.catalog.tableExists(name) and (frame is None or spark.table(name).sameSemantics(frame)):
        spark.catalog.dropTempView(name)


def views_info(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """(name, rows, columns, column_names, error) per view.

    The counts are one plan, a union of one aggregate for each view. A view
    that cannot be resolved, or whose first row cannot be read, reports its
    error instead, and the others still report.
    """
    if names is None:
        names = [t.name for t in spark.catalog.listTables() if t.isTemporary]
    ddl = "name string, rows bigint, columns int, column_names string, error string"
    parts = [spark.createDataFrame([], ddl)]
    for n in names:
        try:
            df = spark.table(n)
            df.limit(1).collect()
        except Exception as e:  # noqa: BLE001 - reported per view
            msg = (str(e).strip().splitlines() or [type(e).__name__])[0]
            parts.append(spark.createDataFrame([(n, None, None, None, msg)], ddl))
            continue
        parts.append(
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(n).alias("name"), "rows", F.lit(len(df.columns)).alias("columns"),
                F.lit(", ".join(df.columns)).alias("column_names"), F.lit(None).cast("string").alias("error"),
            )
        )
    return functools.reduce(DataFrame.union, parts)


# ---------------------------------------------------------------- CSV export


def export_csv(df: DataFrame, path: str) -> int:
    """Write a query result as a CSV directory with a header; return the row
    count, observed in the same job as the write."""
    from pyspark.sql import Observation

    obs = Observation("export")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).csv(path)
    return int(obs.get["rows"])
