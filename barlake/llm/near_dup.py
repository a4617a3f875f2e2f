"""N-gram Jaccard join: banded MinHash LSH, verified exactly.

Every text is its set of five-word shingles. Each of ``trees`` labels holds,
for every distinct set, ``depth`` MinHash values. The longest prefix length d
at which the expected share of pairs at the threshold that meet,
1 - (1 - s**d)**trees, reaches the target recall is found once from the
parameters; two sets are candidates if they share such a prefix in any tree.
No trie is sorted or descended (the README says why).

Equal sets are collapsed first, so thousands of copies are one entry. Every
trie node gives its entries one edge each to its smallest entry (never all
pairs), and the components of these edges are the candidate groups. A group
is verified exactly, in blocks of bounded size: each pair of blocks is one
unit of work, which counts links by set intersection and gives link counts
and a spanning forest, never the pairs themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shingles import chunks, hash_functions, shingles, split

#: Shingles of a group that one block holds, about (8 bytes each).
BLOCK_SHINGLES = 1_000_000
#: Texts that one block holds, about.
BLOCK_TEXTS = 512


def prefix_depth(trees: int, depth: int, threshold: float, recall: float) -> int:
    """The longest prefix with which the forest still reaches the recall."""
    for d in range(depth, 1, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


def _key(grams: np.ndarray) -> bytes:
    """128 bits that only equal sets share."""
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _signer(trees: int, depth: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, offset = hash_functions(trees * depth)
        for batch in batches:
            for part, texts in chunks(batch):
                hashes, counts = shingles(texts)
                some = counts > 0
                starts = (np.cumsum(counts) - counts)[some]
                ids = np.array(part.column(0))[some]
                if not len(starts):
                    continue
                sig = np.empty((len(starts), trees * depth), ">u4")
                for i in range(trees * depth):
                    sig[:, i] = np.minimum.reduceat((hashes * factor[i] + offset[i]) >> np.uint64(32), starts)
                sets = [np.unique(x) for x in np.split(hashes, starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([_key(s) for s in sets], pa.binary()),
                        pa.array([row.tobytes() for row in sig], pa.binary()),
                    ],
                    names=["id", "n", "key", "labels"],
                )

    return sign


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, component, blocks, block, copies) -> their sorted sets as bytes."""
    for batch in batches:
        for part, texts in chunks(batch):
            sets = split(*shingles(texts))
            rest = [part.column(i) for i, f in enumerate(part.schema) if f.name != "text"]
            names = [f.name for f in part.schema if f.name != "text"]
            grams = [pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([_key(s) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*rest, *grams], names=[*names, "grams", "key"])


def _intersections(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of all intersections between two lists of sets (None: the same), in column strips."""
    every = left + (right or [])
    sizes = [len(s) for s in every]
    _, column, shared = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    keep = shared[column] > 1  # a shingle of one set is in no intersection
    row, column = row[keep], column[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], np.unique(column[order], return_inverse=True)[1]
    split_at = 0 if right is None else len(left)
    out = np.zeros((len(left), len(sizes) - split_at), np.float32)
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (c, c + 4096))
        dense = np.zeros((len(sizes), 4096), np.float32)
        dense[row[a:b], column[a:b] - c] = 1
        out += dense[: len(left)] @ dense[split_at:].T
    return out


def _verify_block(rows: dict, threshold: float) -> tuple[list, list, list]:
    """Links of one pair of blocks: (ids, links added to each, a neighbour in its tree)."""
    ids, copies, side = np.array(rows["id"]), np.array(rows["copies"]), np.array(rows["block"])
    grams = [np.frombuffer(g, np.uint64) for g in rows["grams"]]
    same = rows["i"] == rows["j"]
    at = [np.arange(len(ids))] * 2 if same else [np.flatnonzero(side == rows["i"]), np.flatnonzero(side == rows["j"])]
    if not len(at[0]) or not len(at[1]):
        return [], [], []
    sizes = np.array([len(g) for g in grams], np.float64)
    if same and len(ids) == 2:
        inner = np.zeros((2, 2))
        inner[0, 1] = inner[1, 0] = len(np.intersect1d(*grams, assume_unique=True))
    else:
        inner = _intersections([grams[k] for k in at[0]], None if same else [grams[k] for k in at[1]]).astype(np.float64)
    union = sizes[at[0]][:, None] + sizes[at[1]][None, :] - inner
    linked = inner >= threshold * union - 1e-9
    if same:
        np.fill_diagonal(linked, False)
    links = np.zeros(len(ids), np.int64)
    np.add.at(links, at[0], linked @ copies[at[1]])
    if not same:
        np.add.at(links, at[1], linked.T @ copies[at[0]])
    root = np.arange(len(ids))  # the smallest index of each local component
    while True:
        low = root.copy()
        for r, c, mask in ((at[0], at[1], linked), (at[1], at[0], linked.T)):
            best = np.where(mask, low[c][None, :], len(ids)).min(axis=1)
            low[r] = np.minimum(low[r], best)
        low = np.minimum(low, low[low])
        if (low == root).all():
            break
        root = low
    some = np.flatnonzero(links > 0)
    return ids[some].tolist(), links[some].tolist(), ids[root[some]].tolist()


def _verifier(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of block pairs; one pair is held at a time."""
        out: tuple[list, list, list] = ([], [], [])
        held: dict | None = None

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["id", "links", "root"])

        for batch in batches:
            rows = batch.to_pydict()
            for k in range(batch.num_rows):
                key = (rows["component"][k], rows["i"][k], rows["j"][k])
                if held is None or held["key"] != key:
                    if held is not None:
                        for x, y in zip(out, _verify_block(held, threshold), strict=True):
                            x.extend(y)
                    held = {"key": key, "i": key[1], "j": key[2], "id": [], "copies": [], "block": [], "grams": []}
                for name in ("id", "copies", "block", "grams"):
                    held[name].append(rows[name][k])
            if len(out[0]) > 50_000:
                yield flush()
                out = ([], [], [])
        if held is not None:
            for x, y in zip(out, _verify_block(held, threshold), strict=True):
                x.extend(y)
        yield flush()

    return verify


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    trees: int = 16,
    depth: int = 6,
    recall: float = 0.999,
) -> DataFrame:
    """One row per document: (id_col, class_id, n_links, n_copies).

    class_id is the smallest id among the documents reachable over links of
    shingle Jaccard similarity >= threshold; n_links counts the linked
    documents (equal copies included), n_copies those with an equal set.
    A null id is left out, repeated rows of an id count once (the
    largest text), null and empty texts and texts without a word have no
    link and are their own class; an empty table gives no rows. Other
    columns of docs are not read.
    """
    d = prefix_depth(trees, depth, threshold, recall)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL")
    signed = base.mapInArrow(_signer(trees, depth), "id long, n int, key binary, labels binary")
    signed = signed.groupBy("id").agg(F.max(F.struct("n", "key", "labels")).alias("s")).select("id", "s.*").checkpoint()
    reps = signed.groupBy("key", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("labels").alias("labels")).checkpoint()

    width = 4 * depth
    nodes = reps.select(
        F.col("rep").alias("id"),
        F.expr(f"posexplode(transform(sequence(0, {trees - 1}), t -> substring(labels, t * {width} + 1, {4 * d})))").alias("tree", "prefix"),
    ).select("id", F.xxhash64("tree", "prefix").alias("node"))
    lows = nodes.groupBy("node").agg(F.min("id").alias("low"), F.count("*").alias("m")).where("m > 1")
    edges = nodes.join(lows, "node").where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    groups = connected_components(edges)

    members = groups.join(reps.select(F.col("rep").alias("id"), "copies", "n"), "id")
    sizes = members.groupBy("component").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_TEXTS)).cast("int").alias("blocks")
    )
    members = members.join(sizes, "component").select(
        "id", "component", "copies", "blocks", F.expr("CAST(pmod(xxhash64(id), blocks) AS int)").alias("block")
    )
    texts = base.join(members, "id").select("id", "text", "component", "copies", "blocks", "block")
    sets = texts.mapInArrow(_sets, "id long, component long, copies long, blocks int, block int, grams binary, key binary")
    if _repeats(base):  # an id with several texts keeps the one that was signed
        sets = sets.groupBy("id", "component", "copies", "blocks", "block").agg(
            F.max_by("grams", F.struct(F.length("grams"), "key")).alias("grams")
        )
    units = sets.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    units = units.select(
        "id", "component", "copies", "block", "grams", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    checked = (
        units.repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j", "id")
        .mapInArrow(_verifier(threshold), "id long, links long, root long")
    ).checkpoint()
    classes = connected_components(checked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("id").agg(F.sum("links").alias("links"))

    whole = (
        reps.select(F.col("rep").alias("id"), "key", "n", "copies")
        .join(classes, "id", "left")
        .join(links, "id", "left")
        .select("key", "n", "copies", F.coalesce("component", "id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    linked = signed.select("id", "key", "n").join(whole, ["key", "n"])
    every = base.select("id").distinct()
    return every.join(linked, "id", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_copies"),
    )


def _repeats(base: DataFrame) -> bool:
    """Whether some id stands in several rows."""
    return base.groupBy("id").count().where("count > 1").limit(1).count() > 0


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs without the documents that are not the smallest id of their class.

    Rows with a null id stay: they have no class. Repeated rows of a kept id
    all stay. Columns are those of docs.
    """
    found = near_duplicates(docs, id_col, **options)
    gone = found.where(F.col("class_id") != F.col(id_col)).select(F.col(id_col).alias("__gone"))
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
