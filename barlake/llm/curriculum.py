"""Mixing sources by a time-varying curriculum (DataFrame operations only).

Training time runs from 0 to 1. Every source has a schedule, a weight that
changes piecewise linearly over that time. The integral of its schedule is the
source's weight in the whole mix, which sets how many words it is to give; the
integral up to t says how many of these are due by t. A source's documents
stand in a fixed shuffled order, repeated as often as its target needs, so
that each copy begins at a known word of the source's demand. Inverting the
cumulative demand at that word gives the copy's training position, and sorting
all copies by position (a range partitioning) gives the training order.

No source is gathered anywhere: its documents are cut into buckets of their
order by a hash, bucket sums give each bucket's start and a running sum inside
the bucket the rest.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .lookups import HOT_SHARE, look_up

#: [\x20\x09-\x0D]
SPACES = " \t\n\x0b\f\r"
#: Documents of a bucket, about.
BUCKET_ROWS = 2_000
#: Equal rows (id, source and size) that are handled as one.
CHUNK = 1000
#: Longest source name, in characters, that may be broadcast.
NAME_CHARS = 1000

KNOTS = "array<struct<t: double, w: double>>"


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for null."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner != "", F.size(F.split(inner, "[\\x20\\x09-\\x0D]+"))).otherwise(0).cast("long")


def repeating(sources: DataFrame, cycle: tuple = (5, 2, 1), swing: float = 0.5) -> DataFrame:
    """(source, knots): the sources in code point order, null last, weigh ``cycle``, repeating.

    In its turn of the cycle the first weight falls over the time (from 1 +
    swing of itself to 1 - swing), the last one rises, and those between peak
    in the middle; every schedule's integral is the weight itself. Sources
    are ranked inside the ranges of a range partitioning.
    """
    ranged = sources.select("source").distinct().repartitionByRange(F.col("source").asc_nulls_last())
    ranged = ranged.withColumn("part", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each partition
    starts = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    turn = (F.col("start") + F.col("inside") - 1) % len(cycle)
    knot = lambda t, w: F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w"))
    shapes = []
    for k, weight in enumerate(cycle):
        up, down = weight * (1 + swing), weight * (1 - swing)
        if k == 0:
            shape = [knot(0, up), knot(1, down)]
        elif k == len(cycle) - 1:
            shape = [knot(0, down), knot(1, up)]
        else:
            shape = [knot(0, down), knot(0.5, up), knot(1, down)]
        shapes.append(F.array(*shape))
    ranked = ranged.withColumn("inside", inside).join(starts, "part")
    return ranked.select("source", F.element_at(F.array(*shapes), (turn + 1).cast("int")).alias("knots"))


def _with_areas(knots: str) -> Column:
    """Knots (t, w, area): area is the integral up to the knot. Sorted by t."""
    return F.expr(
        f"""aggregate(array_sort({knots}), CAST(array() AS array<struct<t: double, w: double, area: double>>),
            (done, x) -> array_append(done, struct(x.t AS t, x.w AS w,
                CASE WHEN size(done) = 0 THEN 0D
                     ELSE element_at(done, -1).area + (element_at(done, -1).w + x.w) * (x.t - element_at(done, -1).t) / 2 END AS area)))"""
    )


def invert(knots: str, area: str) -> str:
    """SQL for the time by which a schedule's integral reaches ``area`` (both SQL expressions).

    In the segment from a knot with weight w and slope s, an area y is
    reached after 2y / (w + sqrt(w^2 + 2sy)).
    """
    at = f"greatest(size(filter({knots}, x -> x.area <= {area})), 1)"
    return f"""transform(array(named_struct('a', {knots}[{at} - 1], 'b', coalesce(get({knots}, {at}), {knots}[{at} - 1]), 'y', {area} - {knots}[{at} - 1].area)),
        z -> CASE WHEN z.b.t = z.a.t OR z.y <= 0 THEN z.a.t
                  ELSE z.a.t + 2 * z.y / (z.a.w + sqrt(greatest(z.a.w * z.a.w + 2 * (z.b.w - z.a.w) / (z.b.t - z.a.t) * z.y, 0D))) END)[0]"""


def targets(sources: DataFrame, most: int = 3) -> DataFrame:
    """sources (source_size, weight decimal) with target, in words.

    The targets share the sum of all sizes by weight. One above ``most`` times
    its source's size stops there and the excess is shared again by weight,
    until none is above. Each sharing is one sum over the sources. Sources
    without weight get 0, and so do all where there is no word.
    """
    size, weight = F.col("source_size").cast("decimal(38,0)"), F.col("weight")
    every = sources.agg(F.sum(size)).first()[0] or Decimal(0)
    shared, heavy, stopped = every, None, -1
    while True:
        # Above: shared * weight / heavy > most * size, without a division.
        if heavy is None:
            over = F.lit(False)
        elif heavy == 0:
            over = weight > 0
        else:
            over = F.lit(float(shared)) * weight.cast("double") > F.lit(float(heavy * most)) * size.cast("double")
        n, held, heavy = sources.agg(F.count(F.when(over, 1)), F.sum(F.when(over, size * most)), F.sum(F.when(~over, weight))).first()
        shared, heavy = every - (held or 0), heavy or Decimal(0)
        if n == stopped:
            break
        stopped = n
    own = F.when(over, (size * most).cast("double"))
    if heavy > 0:
        own = own.otherwise(F.lit(float(shared)) * weight.cast("double") / F.lit(float(heavy)))
    return sources.withColumn("target", F.coalesce(own, F.lit(0.0)))


def plan(
    docs: DataFrame,
    schedules: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most: int = 3,
    seed: str = "",
) -> DataFrame:
    """One row per document: (id, source, size, source_size, target, taken, copies).

    ``schedules`` has (source, knots), knots as ``KNOTS`` over t from 0 to 1
    with weights >= 0; a source without one gets nothing. ``taken`` is the
    number of words the mix takes, at most ``most`` times the size; copies
    lists (epoch, words, position) of each time the document comes. Every
    copy is whole but the one in which a source's demand ends, which gives its
    first words: a source's taken words are its rounded target.

    Null and empty texts have no words and are never taken; a null source is
    a source; a null id is an id like another. Repeated rows are documents of
    their own; equal ones (id, source, size) are interchangeable. The order
    inside a source follows md5 of seed, id and size, so reruns agree. Other
    columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col).cast("string")).alias("size"))
    # Equal rows as chunks of at most CHUNK: however many, they spread over the buckets.
    equal = rows.groupBy("id", "source", "size").agg(F.count("*").alias("m"))
    equal = equal.select("id", "source", "size", "m", F.explode(F.expr(f"sequence(0, (m - 1) div {CHUNK})")).alias("chunk"))
    order = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("/"), F.col("size").cast("string"), F.lit("/"), F.col("chunk").cast("string")))
    slim = equal.select(
        "id", "source", "size", F.least(F.lit(CHUNK), F.col("m") - F.col("chunk") * CHUNK).alias("m"), order.alias("key")
    ).checkpoint()

    sources = slim.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("n"))
    lines = schedules.select(F.col("source").alias("__source"), _with_areas("knots").alias("knots"))
    sources = sources.join(lines, sources["source"].eqNullSafe(lines["__source"]), "left").drop("__source")
    total = F.coalesce(F.element_at("knots", -1)["area"], F.lit(0.0))
    sources = sources.withColumn("weight", total.cast("decimal(20,6)")).withColumn("sid", F.monotonically_increasing_id()).checkpoint()
    every = sources.agg(F.sum("n")).first()[0] or 0
    sources = targets(sources, most).withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS))
    hot = (F.col("n") * HOT_SHARE > every) & (F.coalesce(F.length("source"), F.lit(0)) <= NAME_CHARS) & (F.coalesce(F.size("knots"), F.lit(0)) <= NAME_CHARS)

    placed = look_up(slim, sources, ["source"], hot, F.xxhash64("key"))
    placed = placed.withColumn("bucket", F.expr("CAST(conv(substring(key, 1, 8), 16, 10) AS bigint) * buckets div 4294967296"))
    sums = placed.groupBy("sid", "bucket").agg(F.sum(F.col("size") * F.col("m")).alias("words"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over a source's buckets
    starts = sums.select("sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("sid", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("inside", F.coalesce(F.sum(F.col("size") * F.col("m")).over(inside), F.lit(0)))
    running = running.join(starts, ["sid", "bucket"]).withColumn("begin", F.col("start") + F.col("inside"))

    one = running.withColumn("begin", F.explode(F.expr("transform(sequence(0L, m - 1), j -> begin + j * size)")))
    one = one.withColumn("due", F.round("target").cast("long"))
    times = F.expr(
        f"""filter(transform(sequence(0, {most - 1}), e -> struct(e AS epoch,
            least(greatest(due - e * source_size - begin, 0L), size) AS words, e * source_size + begin AS word)), c -> c.words > 0)"""
    )
    one = one.withColumn("times", times)
    area = "(c.word * element_at(knots, -1).area / target)"
    copies = f"transform(times, c -> struct(c.epoch AS epoch, c.words AS words, {invert('knots', area)} AS position))"
    return one.select(
        "id",
        "source",
        "size",
        "source_size",
        "target",
        F.expr("aggregate(times, 0L, (n, c) -> n + c.words)").alias("taken"),
        F.expr(copies).alias("copies"),
    )


def training_order(planned: DataFrame) -> DataFrame:
    """(id, epoch, words, position) of every copy, range-sorted by position."""
    copies = planned.select("id", F.explode("copies").alias("c")).select("id", "c.*")
    return copies.orderBy("position", "id", "epoch")
