"""Benchmark decontamination: size-partitioned MinHash containment search.

Benchmark items are partitioned by their number of five-word shingles into
classes (u/2, u] for u = 8, 16, 32, ... A document is searched once per
class through windows of two neighbouring blocks of u shingles: any passage
of at most u shingles lies inside one window, so the containment threshold t
of an item in the long document becomes a Jaccard threshold of at least
t*q / (2u + (1-t)*q) >= 0.19 between item and window, which ``hashes``
single-value MinHash bands meet with probability 1 - (1-0.19)**hashes. Items
of fewer than DIRECT distinct shingles would be too small a part of the
smallest window; their shingles are looked up themselves, all of them. Block
minima of class 2u are the pairwise minima of class u, so all classes cost
one pass. Every (document, item) candidate is then verified exactly: the
share of the item's distinct shingles found anywhere in the document.

The items are handled in blocks of ``block_items`` rows (a bound on what is
broadcast); a larger benchmark takes further passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import chunks, hash_functions, shingles, split

SMALLEST = 8
#: Items of fewer distinct shingles are found by each of them: with 48 hashes, 1 and 2 of 16 would be missed in 5% and 0.2% of cases.
DIRECT = 4
#: Items in one broadcast, and bytes of their texts: another block begins beyond either.
BLOCK_ITEMS = 5_000
BLOCK_BYTES = 16 << 20


class ItemIndex:
    """MinHash bands of one block of items, by size class, and the shingles of the smallest items."""

    def __init__(self, ids: list[int], texts: list[str | None], hashes: int):
        sets = split(*shingles(texts)) if ids else []
        kept = [k for k, s in enumerate(sets) if len(s)]
        self.ids = [ids[k] for k in kept]
        self.sets = [sets[k] for k in kept]
        self.factor, self.offset = hash_functions(hashes, seed=7)
        self.classes: dict[int, tuple[np.ndarray, list]] = {}
        of = [max(SMALLEST, 1 << (len(s) - 1).bit_length()) for s in self.sets]
        small = [k for k, s in enumerate(self.sets) if len(s) < DIRECT]
        keys = np.concatenate([self.sets[k] for k in small]) if small else np.zeros(0, np.uint64)
        owners = np.repeat(np.array(small, np.int64), [len(self.sets[k]) for k in small])
        order = np.argsort(keys, kind="stable")
        self.direct = keys[order], owners[order]
        large = [k for k, s in enumerate(self.sets) if len(s) >= DIRECT]
        for u in sorted({of[k] for k in large}):
            own = np.array([k for k in large if of[k] == u])
            bands = []
            for a, b in zip(self.factor, self.offset, strict=True):
                low = np.array([((self.sets[k] * a + b) >> np.uint64(32)).min() for k in own])
                order = np.argsort(low, kind="stable")
                bands.append((low[order], own[order]))
            self.classes[u] = (own, bands)

    def search(self, hashes: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        """Candidate (text, item) pairs: some window shares a band with the item, or the text a shingle with a smallest item."""
        found: set[tuple[int, int]] = set()
        some = np.flatnonzero(counts > 0)
        if not len(some):
            return found
        keys, owners = self.direct
        if len(keys):
            lo, hi = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, "right")
            text = np.repeat(np.arange(len(counts)), counts)
            for k in np.flatnonzero(hi > lo):
                found.update((int(text[k]), int(i)) for i in owners[lo[k] : hi[k]])
        if not self.classes:
            return found
        starts = (np.cumsum(counts) - counts)[some]
        top = max(self.classes)
        for h, (a, b) in enumerate(zip(self.factor, self.offset, strict=True)):
            values = (hashes * a + b) >> np.uint64(32)
            u, blocks = SMALLEST, -(-counts[some] // SMALLEST)
            text = np.repeat(np.arange(len(some)), blocks)
            within = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            low = np.minimum.reduceat(values, starts[text] + within * u)
            while True:
                if u in self.classes:
                    after = np.append(low[1:], low[-1:])
                    last = np.append(text[1:] != text[:-1], True)
                    window = np.where(last, low, np.minimum(low, after))
                    keys, items = self.classes[u][1][h]
                    lo, hi = np.searchsorted(keys, window), np.searchsorted(keys, window, "right")
                    for k in np.flatnonzero(hi > lo):
                        found.update((int(some[text[k]]), int(i)) for i in items[lo[k] : hi[k]])
                if u >= top:
                    break
                u, even = u * 2, within % 2 == 0
                low = np.minimum.reduceat(low, np.flatnonzero(even))
                text, within = text[even], within[even] // 2
        return found


def _matcher(index, threshold: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index.value
        for batch in batches:
            for part, texts in chunks(batch):
                hashes, counts = shingles(texts)
                pairs = sorted(items.search(hashes, counts))
                ends, ids, rows, last, own = np.cumsum(counts), part.column(0), [], -1, None
                for t, i in pairs:
                    if t != last:
                        last, own = t, np.unique(hashes[ends[t] - counts[t] : ends[t]])
                    want = items.sets[i]
                    hit = len(np.intersect1d(own, want, assume_unique=True))
                    if hit >= threshold * len(want) - 1e-9:
                        rows.append((ids[t].as_py(), items.ids[i], hit, len(want)))
                cols = list(zip(*rows, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)],
                    names=["id", "item_id", "n_found", "n_shingles"],
                )

    return match


def _blocks(items: DataFrame) -> Iterator[list]:
    """Item rows in id order, one bounded block at a time."""
    block, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or size + len(row.text) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row.text)
    yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    hashes: int = 48,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id_col, item_id, containment, n_found, n_shingles) of every match.

    containment is the exact share of the item's distinct shingles that the
    document holds, at least ``threshold``. An item of one to four words has
    one shingle of all its words, which only a document of the same words
    holds; an item without a word (null, empty) matches nothing, nor does a
    null or empty document. Rows with a null id are left out; repeated rows
    of an id give one row for each item (the best). Empty tables give no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "id IS NOT NULL AND text IS NOT NULL"
    )
    found = None
    for block in _blocks(items):
        index = spark.sparkContext.broadcast(ItemIndex([r.item_id for r in block], [r.text for r in block], hashes))
        part = base.mapInArrow(_matcher(index, threshold), "id long, item_id long, n_found int, n_shingles int")
        found = part if found is None else found.union(part)
    best = found.groupBy("id", "item_id").agg(F.max(F.struct(F.expr("n_found / n_shingles").alias("containment"), "n_found", "n_shingles")).alias("m"))
    return best.select(F.col("id").alias(id_col), "item_id", "m.containment", "m.n_found", "m.n_shingles")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs without the documents that hold a benchmark item; rows with a null id stay."""
    gone = contaminated(docs, benchmark, id_col=id_col, **options).select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
