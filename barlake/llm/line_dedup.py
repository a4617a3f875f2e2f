"""Line dedup by levelled sorted runs of line hashes (DataFrame operations only).

A run is a table of (key, n_docs, last), bucketed and sorted by key, the 128-bit
hash of a line. Documents come in batches, newest first. A batch is reduced to
one row for each of its keys and merge-anti-joined with the runs, one after the
other: a key that no run holds is fresh, its newest document is the holder, and
only fresh keys carry one (``last``). The batch is then written as a run of level
0. When a level holds ``fanout`` runs, they are merged into one run of the next
level, so a key is rewritten about log(batches) times. Runs meet batches and
each other bucket by bucket: they are never shuffled again.
"""

from __future__ import annotations

import functools
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.session import scratch_path

from .names import quoted

#: Lines of the first four batches; each doubling beyond them adds one batch.
BATCH_LINES = 1 << 18
#: Documents of a key from which its lines are not joined in the key's own task.
HOT_DOCS = 1000
#: Hot keys that are broadcast at most (24 bytes each).
HOT_BROADCAST = 1_000_000
#: [\x20\x09-\x0D]
SPACES = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def line_key(line: Column) -> Column:
    """128 bits of the line, stripped and with A-Z lower-cased."""
    return F.unhex(F.md5(F.translate(stripped(line), _UPPER, _LOWER)))


class LineRuns:
    """The runs of one deduplication, in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.path = scratch_path(spark, "line_runs", unique=True)
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.made = 0

    def _write(self, rows: DataFrame) -> str:
        """rows, which an aggregate or joins have already dealt by key, as a run: one file for each bucket."""
        name = f"{self.name}_{self.made}"
        self.made += 1
        rows.write.bucketBy(self.parts, "key").sortBy("key").option("path", f"{self.path}/{name}").saveAsTable(name)
        return name

    def runs(self) -> list[str]:
        """Names of the runs, the smallest first."""
        return [name for level in self.levels for name in level]

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (key, doc) rows; documents must be older than those before.

        A key that the runs already hold adds to its count only; the fresh
        ones carry their newest document.
        """
        batch = keys.groupBy("key", "doc").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc").alias("last"))
        for name in self.runs():
            held = self.spark.table(name).select("key", F.lit(True).alias("held"))
            batch = batch.join(held.hint("merge"), "key", "left").select("key", "n_docs", F.when(F.col("held").isNull(), F.col("last")).alias("last"))
        name = self._write(batch)
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(name)
            if len(self.levels[level]) < self.fanout:
                return
            name, self.levels[level] = functools.reduce(self._merge, self.levels[level]), []
            level += 1

    def _merge(self, a: str, b: str) -> str:
        """One run of two: counts add up; one of them at most carries a key's holder, so holders add up too."""
        new, old = self.spark.table(a), self.spark.table(b).select("key", F.col("n_docs").alias("n"), F.col("last").alias("l"))
        total = lambda x, y: F.when(F.col(y).isNull(), F.col(x)).otherwise(F.col(y) + F.coalesce(x, F.lit(0)))
        merged = new.join(old.hint("merge"), "key", "full").select("key", total("n_docs", "n").alias("n_docs"), total("last", "l").alias("last"))
        name = self._write(merged)
        for done in (a, b):
            self.spark.sql(f"DROP TABLE {done}")
        return name

    def totals(self) -> DataFrame:
        """(key, n_docs, last) over all batches: all runs compacted to one, the smallest first."""
        self.levels = [[functools.reduce(self._merge, self.runs())]]
        return self.spark.table(self.runs()[0])

    def close(self) -> None:
        """Take the runs out of the catalog; their files stay for plans that read them."""
        for name in self.runs():
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, pos, key) of every line long enough to be compared."""
    lines = docs.select("doc", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    return lines.where(F.length(stripped(F.col("line"))) >= min_chars).select("doc", "pos", line_key(F.col("line")).alias("key"))


def _drops(lines: DataFrame, repeated: DataFrame, max_docs: int, hot_docs: int, hot_broadcast: int) -> DataFrame:
    """(doc, pos) of the lines whose key is repeated and held by another document.

    Keys of at least hot_docs documents meet their lines where those are: they are
    broadcast, hot_broadcast of them at most. If there are more, each is copied
    once for every hot_docs documents of the commonest key, and lines are
    salted over the copies. All other keys meet fewer than hot_docs documents.
    """
    hot, cold = repeated.where(F.col("n_docs") >= hot_docs).select("key", "last"), repeated.where(F.col("n_docs") < hot_docs).select("key", "last")
    if max_docs < hot_docs:
        return lines.join(cold, "key").where("doc <> last").select("doc", "pos")
    if hot.limit(hot_broadcast + 1).count() <= hot_broadcast:
        few = F.broadcast(hot)
        own = lines.join(few, "key").where("doc <> last")
        rest = lines.join(few.select("key"), "key", "left_anti").join(cold, "key").where("doc <> last")
        return own.select("doc", "pos").union(rest.select("doc", "pos"))
    salts = -(-max_docs // hot_docs)
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int"))
    return salted.join(repeated.select("key", "last", copies), ["key", "salt"]).where("doc <> last").select("doc", "pos")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int | None = None,
    fanout: int = 2,
    hot_docs: int = HOT_DOCS,
    hot_broadcast: int = HOT_BROADCAST,
) -> DataFrame:
    """docs with __kept (the text without its dropped lines), __n_lines, __n_dropped.

    A key of at least min_chars code points found in at least min_docs
    documents loses all its lines except in the largest id holding it. Null
    and empty texts are one empty line; a null id takes no part and keeps
    its lines; rows that repeat an id are one document. A text's lines are
    held as one array in the task that reads it, however long it is. Batches are equal
    ranges of the id, the largest first; their number changes no result. By
    default it grows with the logarithm of the lines, as every batch reads the runs.
    All columns of docs stay; their names may hold dots but not begin with two underscores.
    """
    spark = docs.sparkSession
    own_id, own_text = F.col(quoted(id_col)).cast("long"), F.col(quoted(text_col)).cast("string")
    base = docs.select(own_id.alias("doc"), own_text.alias("text")).where("doc IS NOT NULL")
    # The lines are cut and hashed once: (doc, pos, key) is what all further steps read.
    path = scratch_path(spark, "line_keys", unique=True)
    _lines(base, min_chars).write.parquet(path)
    lines = spark.read.schema("doc long, pos int, key binary").parquet(path)
    low, high, n = lines.agg(F.min("doc"), F.max("doc"), F.count("*")).first()
    runs = LineRuns(spark, fanout)
    low, high = (0, 0) if low is None else (low, high)
    if batches is None:
        batches = 4 + max(0, math.ceil(math.log2(max(n, 1) / (4 * BATCH_LINES))))
    step = -(-(high - low + 1) // batches)
    for top in range(high, low - 1, -step):
        runs.add(lines.where((F.col("doc") > max(top - step, low - 1)) & (F.col("doc") <= top)).select("key", "doc"))
    # The keys that lose lines, of all runs.
    path = scratch_path(spark, "line_repeats", unique=True)
    runs.totals().where(F.col("n_docs") >= min_docs).write.parquet(path)
    runs.close()
    repeated = spark.read.schema("key binary, n_docs long, last long").parquet(path)
    most = repeated.agg(F.max("n_docs")).first()[0] or 0
    drops = (
        _drops(lines, repeated, most, hot_docs, hot_broadcast)
        .groupBy(F.col("doc").alias("__doc"))
        .agg(F.sort_array(F.collect_set("pos")).alias("__drop"))
    )
    columns = [F.col(quoted(c)) for c in docs.columns]
    out = docs.select("*", own_id.alias("__id"), F.coalesce(own_text, F.lit("")).alias("__text")).join(drops, F.col("__id") == F.col("__doc"), "left")
    # Ends around the dropped positions; the kept lines are the slices between.
    out = out.withColumn("__lines", F.split("__text", "\n", -1)).withColumn("__ends", F.expr("concat(array(-1), __drop, array(size(__lines)))"))
    kept = F.expr("flatten(transform(sequence(1, size(__ends) - 1), k -> slice(__lines, __ends[k - 1] + 2, __ends[k] - __ends[k - 1] - 1)))")
    return out.select(
        *columns,
        F.when(F.col("__drop").isNull(), F.col("__text")).otherwise(F.array_join(kept, "\n")).alias("__kept"),
        F.size("__lines").cast("long").alias("__n_lines"),
        F.coalesce(F.when(F.col("__drop").isNotNull(), F.size("__drop")), F.lit(0)).cast("long").alias("__n_dropped"),
    )
