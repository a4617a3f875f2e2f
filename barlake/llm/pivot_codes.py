"""Product quantisation of vectors, assigned through LAESA pivots.

Vectors become integers and are cut into equal parts; every part position has
a codebook, refined by rounds of nearest-entry assignment and componentwise
means. A few entries of each first codebook are its pivots for good. The
distances of every part to its pivots are computed once and stored beside the
integers. In each round only the distances between pivots and the new entries
are computed; by the triangle inequality |d(part, pivot) - d(pivot, entry)|
bounds the distance of part and entry from below. The entries are tried in
order of that bound, with exact integer distances, until the bound of the next
exceeds the best found.

A round is one pass over the stored parts: every task sums its parts by entry,
Spark sums those sums, and the driver sees the codebook only (entries x
dimensions numbers, whatever the number of vectors).
"""

from __future__ import annotations

import dataclasses
import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.session import scratch_path

from .lookups import HOT_SHARE, look_up

#: Numbers of one block of vectors that are compared at once.
BLOCK = 1 << 20
#: Stored pivot distances are 32-bit: bounds are lowered by this share of the two distances.
SLACK = 1e-6


@dataclasses.dataclass(frozen=True)
class Model:
    """Codebooks (parts, entries, width) and pivots (parts, pivots, width), integers."""

    codebooks: np.ndarray
    pivots: np.ndarray

    def sha256(self) -> str:
        """Of all entries' decimal components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def component_limit(dims: int) -> int:
    """The largest integer component with which every squared distance fits 63 bits."""
    return math.isqrt((2**63 - 1) // max(dims, 1)) // 2


def quantise(vectors: list, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; shorter vectors end with zeros."""
    out = np.zeros((len(vectors), dims))
    lengths = np.array([len(v) for v in vectors], np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = np.concatenate([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else []
    limit = component_limit(dims)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * scale), -limit, limit).astype(np.int64)


def choose_pivots(codebook: np.ndarray, count: int) -> np.ndarray:
    """Entries far from each other: the first, then always the farthest from those chosen."""
    chosen = [0]
    while len(chosen) < min(count, len(codebook)):
        gaps = ((codebook[:, None, :] - codebook[None, chosen, :]) ** 2).sum(-1).min(1)
        chosen.append(int(gaps.argmax()))
    return codebook[chosen]


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, parts, pivots) distances, 32-bit."""
    near = [_root(((parts[:, :, :] - pivots[None, :, q, :]) ** 2).sum(-1)) for q in range(pivots.shape[1])]
    return np.stack(near, axis=-1).astype(np.float32)


def assign(parts: np.ndarray, distances: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry, its squared distance) of every part, and how many exact distances it took.

    Ties go to the lower entry. An entry is skipped only if its bound exceeds
    the best exact distance, so the result is that of trying all of them.
    """
    n, count, _ = parts.shape
    index, best = np.zeros((n, count), np.int64), np.zeros((n, count), np.int64)
    tried = 0
    for p in range(count):
        x, entries = parts[:, p], model.codebooks[p]
        to_entries = _root(((model.pivots[p][:, None, :] - entries[None, :, :]) ** 2).sum(-1))
        bound = np.zeros((n, len(entries)))
        for q in range(len(to_entries)):
            own, other = distances[:, p, q].astype(np.float64)[:, None], to_entries[q][None, :]
            np.maximum(bound, np.abs(own - other) - SLACK * (own + other), out=bound)
        bound *= bound * (1 - SLACK)
        order = np.argsort(bound, axis=1, kind="stable")
        least = np.full(n, np.iinfo(np.int64).max)
        live = np.arange(n)
        for step in range(len(entries)):
            e = order[live, step]
            go = bound[live, e] <= least[live]
            live, e = live[go], e[go]  # the bounds of a row only grow: it is settled
            if not len(live):
                break
            tried += len(live)
            d = ((x[live] - entries[e]) ** 2).sum(-1)
            closer = (d < least[live]) | ((d == least[live]) & (e < index[live, p]))
            least[live[closer]], index[live[closer], p] = d[closer], e[closer]
        best[:, p] = least
    return index, best, tried


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, BLOCK // max(dims, 1))
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def _preparer(dims: int, scale: int, pivots: np.ndarray) -> Callable:
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, dims):
            ints = quantise(block.column(2).to_pylist(), dims, scale)
            near = pivot_distances(ints.reshape(len(ints), len(pivots), -1), pivots)
            rows = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (ints.astype("<i4"), near.astype("<f4"))]
            yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), *rows], names=["id", "label", "ints", "near"])

    return prepare


def _read(block: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray]:
    n, (count, _, width) = block.num_rows, model.codebooks.shape
    column = lambda name, kind: np.frombuffer(b"".join(block.column(block.schema.get_field_index(name)).to_pylist()), kind)
    return column("ints", "<i4").reshape(n, count, width).astype(np.int64), column("near", "<f4").reshape(n, count, -1)


def _summer(model: Model) -> Callable:
    """Sums and counts of the parts by entry: one row for each component of a used entry, once a task."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, entries, width = model.codebooks.shape
        sums, used = np.zeros((count, entries, width), np.int64), np.zeros((count, entries), np.int64)
        for block in _blocks(batches, count * width):
            parts, near = _read(block, model)
            index, _, _ = assign(parts, near, model)
            for p in range(count):
                np.add.at(sums[p], index[:, p], parts[:, p])
                used[p] += np.bincount(index[:, p], minlength=entries)
        cells = np.flatnonzero(np.repeat(used.ravel() > 0, width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(sums.ravel()[cells]), pa.array(np.repeat(used.ravel(), width)[cells])],
            names=["cell", "total", "used"],
        )

    return add_up


def _coder(model: Model) -> Callable:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, _, width = model.codebooks.shape
        for block in _blocks(batches, count * width):
            parts, near = _read(block, model)
            index, best, _ = assign(parts, near, model)
            codes = pa.array([bytes(r).hex() for r in index.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), codes, pa.array(best.sum(1), pa.int64())], names=["id", "label", "code", "error"]
            )

    return code


def usable(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds finite components only."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(vector_col).isNotNull() & finite)


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    pivots: int = 4,
    scale: int = 4096,
) -> tuple[DataFrame, Model]:
    """(id, label, code, error) of every usable vector, and the final model.

    Rows whose vector is null or holds a null or non-finite component go. The
    first codebooks are the parts of the ``entries`` (at most 256) rows of
    smallest id (nulls last; rows of one id by their vector), fewer if there are
    fewer rows. Each round assigns every part to its nearest entry and moves
    each used entry to floor(sum / count). Rows that repeat an id are vectors of
    their own. Dimensions are those of the longest vector, rounded up to whole
    parts; shorter vectors, empty ones too, end with zeros. Components beyond
    ``component_limit`` (2**27 at 64 dimensions) are held there so that every
    distance fits a long. No usable rows give no rows. Other columns are not
    read. Parts and pivot distances are written to the shared folder once.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: entries must be 1 to 256")
    spark = vectors.sparkSession
    rows = usable(vectors, vector_col).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    )
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 1
    width = max(1, -(-longest // parts))
    dims = parts * width
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    seeds = quantise([r.v for r in first], dims, scale).reshape(len(first), parts, width)
    books = np.ascontiguousarray(seeds.transpose(1, 0, 2))
    if not len(first):
        model = Model(books, books)
        return rows.limit(0).select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), model
    model = Model(books, np.stack([choose_pivots(b, pivots) for b in books]))

    path = scratch_path(spark, "pivot_codes", unique=True)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    head = f"id {kinds['id']}, label {kinds['label']}"
    rows.mapInArrow(_preparer(dims, scale, model.pivots), f"{head}, ints binary, near binary").write.parquet(path)
    stored = spark.read.parquet(path)
    for _ in range(rounds):
        sums = (
            stored.select("ints", "near")
            .mapInArrow(_summer(model), "cell long, total long, used long")
            .groupBy("cell")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("used").alias("used"))
        )
        books = model.codebooks.copy().ravel()
        for cell, total, used in sums.collect():  # parts x entries x width rows
            books[cell] = int(total) // used
        model = Model(books.reshape(model.codebooks.shape), model.pivots)
    return stored.mapInArrow(_coder(model), f"{head}, code string, error long"), model


def label_errors(coded: DataFrame) -> DataFrame:
    """coded with label_error, the errors summed over equal labels (nulls together).

    A sum beyond a long is null. A label may hold any share of the rows: sums
    are made before the shuffle, and the rows of the at most ``HOT_SHARE`` labels
    that hold more than that share are joined by broadcast.
    """
    spark = coded.sparkSession
    path = scratch_path(spark, "pivot_codes", unique=True)
    coded.write.parquet(path)
    coded = spark.read.parquet(path)
    totals = coded.groupBy("label").agg(F.count("*").alias("rows"), F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error")).checkpoint()
    every = totals.agg(F.sum("rows")).first()[0] or 0
    totals = totals.select("label", "rows", F.expr("try_cast(label_error AS bigint)").alias("label_error"))
    return look_up(coded, totals, ["label"], F.col("rows") * HOT_SHARE > every, F.xxhash64("id", "code")).drop("rows")
