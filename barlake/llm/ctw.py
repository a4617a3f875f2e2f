"""LM scoring by context-tree weighting over bytes.

A text is its tokens (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) joined by
single spaces and closed by a newline, the end. Each byte is eight binary
decisions, from the high bit down; each decision has a context tree over the
``depth`` bytes before it. Every node keeps a Krichevsky-Trofimov estimate,
and its weighted probability halves between that estimate and the product of
its children's. After training the tree is fixed: a bit's probability mixes
the estimates of all depths along its context path by the posterior weight
of stopping at each node, and a byte's is the product over its bits.

Spark does the work in four steps:

1. texts are packed into batches of about ``BATCH_BYTES``; each writes its
   text and, for every shard, its distinct (context, byte) grams and word
   hashes with training counts to the shared folder (counts are thus summed
   within a batch before any shuffle);
2. a shard holds all contexts of its two last bytes; it sums the counts of
   all batches, builds its subtrees and gives the sums that the two topmost
   levels need: 256 * 255 nodes at most, whatever the input;
3. with these each shard answers every batch with one number for each gram
   it asked for, in the batch's order; word shards answer with counts;
4. each batch meets its answers and sums them by document.

No table of the corpus is broadcast or collected.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.session import scratch_path

from .packing import expand, grouped, pack, pack_planes, squeeze, unpack, unpack_planes
from .shingles import CHUNK_BYTES, words

BATCH_BYTES = 8 << 20
BATCH_TEXTS = 1 << 16
DEPTH = 5
SCHEMA = "kind string, batch long, shard int, a binary, b binary"
_LOG_TABLE = 1 << 12


def canonical(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split()) + b"\n"


def gram_keys(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, text number) of every byte: last context byte first, then the earlier ones, then the byte."""
    pad = b"\n" * depth
    data = np.frombuffer(pad + pad.join(texts), np.uint8)
    keys = data[depth:].astype(np.uint64)
    for k in range(1, depth + 1):
        context = data[depth - k : len(data) - k].astype(np.uint64)
        context <<= np.uint64(8 * (depth + 1 - k))
        keys |= context
    sizes = np.array([len(t) for t in texts])
    inside = np.ones(len(keys), bool)  # the padding before each further text has no key
    for k in range(depth):
        inside[(np.cumsum(sizes + depth) - depth)[:-1] + k] = False
    return keys[inside], np.repeat(np.arange(len(texts), dtype=np.uint16), sizes)


def gram_shards(keys: np.ndarray, depth: int, shards: int) -> np.ndarray:
    two = keys >> np.uint64(8 * (depth - 1))
    return ((two * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


def word_shards(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % shards


def counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each stands in training texts. Keys have 63 bits at most; they are overwritten."""
    keys <<= np.uint64(1)
    keys |= train
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] ^ keys[:-1]) > 1))) if len(keys) else np.zeros(0, int)
    counts = np.add.reduceat(keys & np.uint64(1), first, dtype=np.int64) if len(keys) else np.zeros(0, np.int64)
    return keys[first] >> np.uint64(1), counts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(63-bit word hashes, words of each text), a piece of the batch at a time."""
    parts, counts, piece, size = [], [], [], 0
    for k, text in enumerate(texts):
        piece.append(text.decode("utf-8", "surrogatepass"))
        size += len(text)
        if size >= CHUNK_BYTES or k == len(texts) - 1:
            h, n = words(piece)
            parts.append(h >> np.uint64(1))
            counts.append(n)
            piece, size = [], 0
    return np.concatenate(parts), np.concatenate(counts)


def _by_shard(kind: str, batch: int, keys: np.ndarray, counts: np.ndarray, shard: np.ndarray):
    for s in np.unique(shard):
        own = shard == s
        yield kind, batch, int(s), pack(keys[own]), pack_planes(counts[own].astype(np.uint32))


def _ask(depth: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held: list = []
        size = 0
        for batch in batches:
            for i, text, train in zip(*(batch.column(k) for k in range(3)), strict=True):
                text = canonical(text.as_py())
                held.append((i.as_py(), text, bool(train.as_py())))
                size += len(text)
                if size >= BATCH_BYTES or len(held) == BATCH_TEXTS:
                    yield _asked(next(number), held, depth, shards)
                    held, size = [], 0
        if held:
            yield _asked(next(number), held, depth, shards)

    return run


def _asked(batch: int, held: list, depth: int, shards: int) -> pa.RecordBatch:
    ids, texts, train = zip(*held, strict=True)
    train = np.array(train, bool)
    keys, of = gram_keys(texts, depth)
    distinct, counts = counted(keys, train[of])
    rows = list(_by_shard("gram", batch, distinct, counts, gram_shards(distinct, depth, shards)))
    del keys, of
    hashes, n = word_hashes(texts)
    distinct, counts = counted(hashes, np.repeat(train, n))
    rows += _by_shard("word", batch, distinct, counts, word_shards(distinct, shards))
    body = b"".join(texts)
    meta = pa.array(ids, pa.int64())
    sink = pa.BufferOutputStream()
    table = pa.RecordBatch.from_arrays([meta, pa.array(train)], names=["id", "train"])
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_batch(table)
    rows.append(("text", batch, -1, squeeze(body), sink.getvalue().to_pybytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
        names=["kind", "batch", "shard", "a", "b"],
    )


_small = np.array([math.lgamma(n / 2 + 0.5) for n in range(2 * _LOG_TABLE)])


def _lgamma_half(n2: np.ndarray) -> np.ndarray:
    """ln Gamma((n2 + 1) / 2) of whole numbers n2, by table and Stirling's series."""
    x = (np.maximum(n2, 2 * _LOG_TABLE) + 1) / 2
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n2 < 2 * _LOG_TABLE, _small[np.minimum(n2, 2 * _LOG_TABLE - 1)], series)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _lgamma_half(2 * zeros) + _lgamma_half(2 * ones) - _lgamma_half(2 * (zeros + ones) + 1) - math.log(math.pi)


class Subtrees:
    """The nodes of depth 2 and more whose contexts lie in one shard."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, top: int = 2):
        self.depth, self.top = depth, top
        # Level d: sorted (context of d bytes, byte) rows, their counts, and the row of each gram.
        levels = {depth: (keys, counts, np.arange(len(keys)))}
        for d in range(depth - 1, top - 2, -1):
            upper, n, row = levels[d + 1]
            short = (upper >> np.uint64(16)) << np.uint64(8) | (upper & np.uint64(255))
            distinct, at = np.unique(short, return_inverse=True)
            levels[d] = (distinct, np.bincount(at, weights=n, minlength=len(distinct)).astype(np.int64), at[row])
        self.levels = levels
        self.nodes: dict[tuple[int, int], tuple] = {}
        for d in range(depth, top - 2, -1):
            rows, n, _ = levels[d]
            for b in range(8):
                node = rows >> np.uint64(8 - b)
                first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))) if len(node) else np.zeros(0, int)
                bit = (rows >> np.uint64(7 - b)) & np.uint64(1)
                ones = np.add.reduceat(n * bit.astype(np.int64), first) if len(node) else np.zeros(0, np.int64)
                zeros = (np.add.reduceat(n, first) if len(node) else np.zeros(0, np.int64)) - ones
                keys_b = node[first]
                own = log_kt(zeros, ones)
                below = np.zeros(len(keys_b))
                if d < depth:
                    child, child_weighted = self.nodes[d + 1, b][0], self.nodes[d + 1, b][4]
                    mask = np.uint64((1 << b) - 1)
                    parent = (child >> np.uint64(b + 8)) << np.uint64(b) | (child & mask)
                    below = np.bincount(np.searchsorted(keys_b, parent), weights=child_weighted, minlength=len(keys_b))
                weighted = own if d == depth else np.logaddexp(own, below) - math.log(2)
                group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(rows))))
                self.nodes[d, b] = (keys_b, zeros, ones, own, weighted, below, group)

    def upward(self) -> Iterator[tuple[int, int, int, int, int, float]]:
        """(last byte, bit, prefix, zeros, ones, log product of the children) of the nodes of depth 1 here."""
        for b in range(8):
            keys, zeros, ones, _, _, below, _ = self.nodes[self.top - 1, b]
            for k, z, o, s in zip(keys, zeros, ones, below, strict=True):
                yield int(k) >> b, b, int(k) & ((1 << b) - 1), int(z), int(o), float(s)

    def log_probability(self, head: HeadLevels) -> np.ndarray:
        """log10 probability of each gram's byte after its context."""
        keys = self.levels[self.depth][0]
        total = np.zeros(len(keys))
        last = (keys >> np.uint64(8 * self.depth)).astype(np.int64)
        for b in range(8):
            one = ((keys >> np.uint64(7 - b)) & np.uint64(1)).astype(bool)
            p = None
            for d in range(self.depth, self.top - 1, -1):
                _, zeros, ones, own, weighted, _, group = self.nodes[d, b]
                at = group[self.levels[d][2]]
                kt = ((ones + 0.5) / (zeros + ones + 1))[at]
                if p is None:
                    p = kt
                else:
                    stop = np.exp(own - math.log(2) - weighted)[at]
                    p = stop * kt + (1 - stop) * p
            prefix = ((keys & np.uint64(255)) >> np.uint64(8 - b)).astype(np.int64) + (1 << b)
            for stop, kt in ((head.stop1[last, prefix], head.kt1[last, prefix]), (head.stop0[prefix], head.kt0[prefix])):
                p = stop * kt + (1 - stop) * p
            total += np.log10(np.where(one, p, 1 - p))
        return total


class HeadLevels:
    """Depths 0 and 1 of all eight trees, from the shards' sums (256 * 255 nodes at most)."""

    def __init__(self, rows):
        zeros, ones, below = np.zeros((256, 256), np.int64), np.zeros((256, 256), np.int64), np.zeros((256, 256))
        for c, b, prefix, z, o, s in rows:
            at = (c, (1 << b) + prefix)
            zeros[at] += z
            ones[at] += o
            below[at] += s
        own = log_kt(zeros, ones)
        weighted = np.logaddexp(own, below) - math.log(2)
        self.stop1, self.kt1 = np.exp(own - math.log(2) - weighted), (ones + 0.5) / (zeros + ones + 1)
        zeros, ones, below = zeros.sum(0), ones.sum(0), weighted.sum(0)
        own = log_kt(zeros, ones)
        weighted = np.logaddexp(own, below) - math.log(2)
        self.stop0, self.kt0 = np.exp(own - math.log(2) - weighted), (ones + 0.5) / (zeros + ones + 1)


def _shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """(shard, its (batch, keys, counts)) of rows sorted by shard."""
    for shard, rows in grouped(batches, "shard"):
        yield shard, [(r["batch"], unpack(r["a"]), unpack_planes(r["b"], np.uint32)) for r in rows]


def _summed(asked: list) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate([k for _, k, _ in asked]), return_inverse=True)
    return distinct, np.bincount(at, weights=np.concatenate([n for *_, n in asked]), minlength=len(distinct)).astype(np.int64)


def _climb(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, asked in _shards_of(batches):
            rows = list(Subtrees(*_summed(asked), depth).upward())
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=["c", "bit", "prefix", "zeros", "ones", "below"])

    return run


def _answer_grams(depth: int, head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, asked in _shards_of(batches):
            keys, counts = _summed(asked)
            log_p = Subtrees(keys, counts, depth).log_probability(head.value).astype(np.float32)
            yield _answers("gram", shard, [(b, log_p[np.searchsorted(keys, k)]) for b, k, _ in asked])

    return run


def _answer_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, asked in _shards_of(batches):
        keys, counts = _summed(asked)
        yield _answers("word", shard, [(b, counts[np.searchsorted(keys, k)]) for b, k, _ in asked])


def _answers(kind: str, shard: int, rows: list) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * n),
            pa.array([b for b, _ in rows], pa.int64()),
            pa.array([shard] * n, pa.int32()),
            pa.array([pack_planes(x) for _, x in rows], pa.binary()),
            pa.array([b""] * n, pa.binary()),
        ],
        names=["kind", "batch", "shard", "a", "b"],
    )


def _tally(depth: int, shards: int, n_train: int, n_types: int, n_ends: int):
    def finish(rows: list) -> pa.RecordBatch:
        text = next(r for r in rows if r["kind"] == "text")
        got = {(r["kind"], r["shard"]): r["a"] for r in rows if r["kind"] != "text"}
        body = expand(text["a"])
        meta = pa.ipc.open_stream(text["b"]).read_all()
        texts = [t + b"\n" for t in body.split(b"\n")[:-1]]
        n = len(texts)

        def numbers(kind, distinct, shard, dtype):
            """The answers for the batch's distinct keys, put back from the shards' order."""
            out = np.empty(len(distinct), dtype)
            for s in np.unique(shard):
                out[shard == s] = unpack_planes(got[kind, int(s)], dtype)
            return out

        keys, of = gram_keys(texts, depth)
        if depth <= 5:  # six bytes and a text number fit one word, and sorting is all it takes
            keys <<= np.uint64(16)
            keys |= of
            keys.sort()
            of = (keys & np.uint64(0xFFFF)).astype(np.uint16)
            keys >>= np.uint64(16)
            new = np.concatenate(([True], keys[1:] != keys[:-1]))
            distinct, at = keys[new], np.cumsum(new, dtype=np.int32) - 1
        else:
            distinct, at = np.unique(keys, return_inverse=True)
        del keys
        log_p = numbers("gram", distinct, gram_shards(distinct, depth, shards), np.float32)
        score = np.zeros(n)
        for k in range(0, len(at), 1 << 20):
            score += np.bincount(of[k : k + (1 << 20)], weights=log_p[at[k : k + (1 << 20)]], minlength=n)
        hashes, n_words = word_hashes(texts)
        distinct, at = np.unique(hashes, return_inverse=True)
        c = numbers("word", distinct, word_shards(distinct, shards), np.int64)[at]
        of = np.repeat(np.arange(n), n_words)
        scale = n_train + 0.5 * (n_types + 1)
        base = np.bincount(of, weights=np.log10((c + 0.5) / scale), minlength=n) + math.log10((n_ends + 0.5) / scale)
        known = np.bincount(of, weights=c > 0, minlength=n).astype(np.int64) + (n_ends > 0)
        sizes = np.array([len(t) for t in texts], np.int64)
        return pa.RecordBatch.from_arrays(
            [meta["id"].combine_chunks(), *[pa.array(x) for x in (n_words + 1, known, np.full(n, n_train, np.int64), base, score, sizes, -score * math.log2(10) / sizes)]],
            names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "batch"):
            yield finish(rows)

    return run


def score(docs: DataFrame, train: Column, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every document: (id_col, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte).

    ``train`` marks the rows it learns from. score is log10 of the tree's
    probability of the canonical text, bits_per_byte its code length;
    base_score is the smoothed unigram model over tokens (the end included)
    that it is compared with. Null and empty texts are the end alone; null
    ids and repeated rows are scored row by row; other columns are not read;
    an empty table gives no rows, and without training rows every bit has
    probability 1/2.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6: a context and its byte are one 56-bit key")
    spark = docs.sparkSession
    shards = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train")
    )
    path = scratch_path(spark, "ctw", unique=True)
    base.mapInArrow(_ask(depth, shards), SCHEMA).write.partitionBy("kind").option("compression", "none").parquet(path)
    asked = spark.read.schema(SCHEMA).parquet(path)

    def by_shard(kind: str) -> DataFrame:
        return asked.where(F.col("kind") == kind).select("batch", "shard", "a", "b").repartition(shards, "shard").sortWithinPartitions("shard", "batch")

    sums = by_shard("gram").mapInArrow(_climb(depth), "c int, bit int, prefix int, zeros long, ones long, below double")
    head = HeadLevels(
        tuple(r) for r in sums.groupBy("c", "bit", "prefix").agg(F.sum("zeros"), F.sum("ones"), F.sum("below")).toLocalIterator()
    )
    answers = by_shard("gram").mapInArrow(_answer_grams(depth, spark.sparkContext.broadcast(head)), SCHEMA)
    stats = by_shard("word").mapInArrow(_word_totals, "tokens long, types long").agg(F.sum("tokens"), F.sum("types")).first()
    ends = base.where("train").count()
    n_train, n_types = (stats[0] or 0) + ends, (stats[1] or 0) + (ends > 0)
    answers = answers.union(by_shard("word").mapInArrow(_answer_words, SCHEMA)).union(asked.where("kind = 'text'").select("kind", "batch", "shard", "a", "b"))
    done = (
        answers.repartition(shards, "batch")
        .sortWithinPartitions("batch")
        .mapInArrow(
            _tally(depth, shards, n_train, n_types, ends),
            "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double",
        )
    )
    return done.withColumnRenamed("id", id_col)


def _word_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, asked in _shards_of(batches):
        _, counts = _summed(asked)
        yield pa.RecordBatch.from_arrays([pa.array([int(counts.sum())]), pa.array([int((counts > 0).sum())])], names=["tokens", "types"])
