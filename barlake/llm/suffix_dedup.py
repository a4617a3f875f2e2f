"""Suffix-array dedup: repeated 100-byte strings, by a distributed merge sort of suffixes.

Every byte covered by a ``LENGTH``-byte string that also starts earlier
(smaller id, or the same document at an earlier byte) is to go. Not all
suffixes are sorted, but a sample that no repeat escapes: of the ``GRAM``-byte
grams inside a string of LENGTH bytes, the one with the smallest hash (the
leftmost of equals) is its anchor, and equal strings have equal anchors at
equal offsets. Neighbouring strings with one anchor form a span.

1. Texts are packed into batches, written once to the shared folder with the
   hashes of their anchors. Hash shards answer whether an anchor stands
   anywhere else; most text ends here.
2. Each batch sorts the suffixes that start at its repeated anchors (the left
   context rides along), keeps the earliest of equal spans (later ones are
   cut at once, so a run has a span once however many copies there are) and
   sends them front-coded, in sorted runs, to the shard of their anchor.
3. A shard merges its runs with a loser tree that carries common-prefix
   lengths: heads with different known lengths are ordered without touching
   a byte, equal ones are compared beyond them only. Suffixes that share
   their anchor are neighbours; strings are equal where the merge's common
   prefixes and the common suffixes of the left contexts, sorted once more,
   reach far enough, and the earliest one stays.
4. Each batch meets its cuts and gives its documents.

An anchor with very many different surroundings would make one shard too
large: from HOT spans on, as step 1 counts them, a batch sends the digests
(128 bits) of the span's strings, each once, to shards of their own, which
keep the earliest place of each. Both ways give the same cuts.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.session import scratch_path

from .packing import expand, grouped, pack, pack_planes, squeeze, unpack, unpack_planes
from .shingles import _BASE, _INVERSE, _power, mix

LENGTH = 100
GRAM = 40
BATCH_BYTES = 4 << 20
SEGMENT = 1 << 19  # bytes whose anchors are found at once, with about 100 bytes of arrays for each: a batch takes several
HOT = 10_000  # spans of one anchor, each counted once in a batch
HOT_SHARDS = 16  # shards of hot strings for each shard of anchors
HELD = 1 << 20  # places of hot strings that a shard reduces at once
SCHEMA = "kind string, batch long, shard int, a binary, b binary"
_PLACE = np.uint64((1 << 28) - 1)  # a segment's bytes are numbered with 28 bits


class Spans:
    """The spans of a batch of texts: first and last start, anchor, anchor hash, and hash of all bytes.

    Found a segment at a time; a span that crosses segments counts as two.
    """

    def __init__(self, texts: list[bytes], segment: int = SEGMENT):
        self.data = b"".join(texts)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        parts = [self._segment(s, min(s + segment, len(self.data) - LENGTH + 1)) for s in range(0, len(self.data) - LENGTH + 1, segment)]
        none = (*[np.zeros(0, np.int64)] * 3, *[np.zeros(0, np.uint64)] * 2)
        self.first, self.last, self.anchor, self.hash, self.content = (np.concatenate(c) for c in zip(none, *parts, strict=True))

    def _segment(self, start: int, stop: int) -> tuple[np.ndarray, ...]:
        """Spans of the strings that start in [start, stop)."""
        data = np.frombuffer(self.data, np.uint8)[start : stop + LENGTH - 1]
        n, windows, width = len(data), stop - start, LENGTH - GRAM + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=total[1:])
        back = _power(_INVERSE, n)
        grams = mix((total[GRAM:] - total[:-GRAM]) * back[: n - GRAM + 1])
        m = len(grams)
        low = np.full(-(-m // width) * width, np.iinfo(np.uint64).max, np.uint64)
        low[:m] = (grams & ~_PLACE) | np.arange(m, dtype=np.uint64)
        # Smallest of each window: the rest of its block from the left, and the block after from the right.
        blocks = low.reshape(-1, width)
        up = np.minimum.accumulate(blocks, axis=1).ravel()
        down = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
        anchor = (np.minimum(down[:windows], up[width - 1 : width - 1 + windows]) & _PLACE).astype(np.int64)
        inside = np.zeros(windows + 1, np.int8)
        has = self.sizes >= LENGTH
        np.add.at(inside, np.clip((self.ends - self.sizes)[has], start, stop) - start, 1)
        np.add.at(inside, np.clip((self.ends - LENGTH + 1)[has], start, stop) - start, -1)
        valid = np.flatnonzero(np.cumsum(inside)[:windows])
        at = anchor[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
        begins = np.flatnonzero(new)
        first, at = valid[begins], at[begins]
        last = valid[np.append(begins[1:], len(valid))[: len(begins)] - 1]
        content = mix((total[last + LENGTH] - total[first]) * back[first])
        # 48 bits of an anchor's hash: equal hashes of different grams cost work only.
        return first + start, last + start, at + start, grams[at] >> np.uint64(16), content

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted anchor hashes, and the different spans of each: at least 2 if it stands twice."""
        hashes, which, n = np.unique(self.hash, return_inverse=True, return_counts=True)
        many = np.flatnonzero(n[which] > 1)
        _, one = np.unique(mix(self.hash[many] ^ mix(self.content[many])), return_index=True)
        spans = np.bincount(which[many[one]], minlength=len(hashes))
        return hashes, np.where(n > 1, np.maximum(spans, 2), 1).astype(np.uint32)

    def documents(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right")


def _read(row: dict) -> tuple[list, list[bytes]]:
    body, sizes = expand(row["a"]), pa.ipc.open_stream(row["b"]).read_all()
    ends = np.cumsum(sizes["size"].to_numpy())
    return sizes["id"].to_pylist(), [body[e - s : e] for e, s in zip(ends.tolist(), sizes["size"].to_pylist(), strict=True)]


def _ask(shards: int):
    def asked(batch: int, held: list) -> pa.RecordBatch:
        ids, texts = zip(*held, strict=True)
        spans = Spans(list(texts))
        hashes, n = spans.anchors()
        shard = _shard(hashes, shards)
        rows = [("anchor", batch, int(s), pack(hashes[shard == s]), pack_planes(n[shard == s])) for s in np.unique(shard)]
        sink = pa.BufferOutputStream()
        table = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spans.sizes)], names=["id", "size"])
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_batch(table)
        rows.append(("text", batch, -1, squeeze(spans.data), sink.getvalue().to_pybytes()))
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held: list = []
        size = 0
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if held and size + len(data) > BATCH_BYTES:
                    yield asked(next(number), held)
                    held, size = [], 0
                held.append((i.as_py(), data))
                size += len(data)
        if held:
            yield asked(next(number), held)

    return run


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes >> np.uint64(16)).astype(np.int64) % shards


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["kind", "batch", "shard", "a", "b"])


def _repeated(hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each batch's anchors of a shard, one bit: it stands more than once; and if any is hot, one for that."""
        for shard, rows in grouped(batches, "shard"):
            asked = [unpack(r["a"]) for r in rows]
            hashes, which = np.unique(np.concatenate(asked), return_inverse=True)
            n = np.bincount(which, np.concatenate([unpack_planes(r["b"], np.uint32) for r in rows]))
            out = []
            for r, own in zip(rows, asked, strict=True):
                spans = n[np.searchsorted(hashes, own)]
                much = spans >= hot
                out.append(("bits", r["batch"], shard, np.packbits(spans > 1).tobytes(), np.packbits(much).tobytes() if much.any() else b""))
            yield _batch(out)

    return run


def front_code(records: list[tuple]) -> bytes:
    """A sorted run of (right, left, id, first) as common-prefix lengths, tails and numbers."""
    lengths, tails, lefts, before = [], [], [], b""
    for right, left, _, _ in records:
        n = common(before, right, 0)
        lengths.append((n, len(right) - n, len(left)))
        tails.append(right[n:])
        lefts.append(left)
        before = right
    numbers = np.array(lengths, np.uint8).T.tobytes()
    ids = np.array([r[2] for r in records], np.int64).tobytes()
    first = np.array([r[3] for r in records], np.int64).tobytes()
    return squeeze(len(records).to_bytes(8, "big") + numbers + ids + first + b"".join(tails) + b"".join(lefts))


def front_decode(data: bytes) -> Iterator[tuple]:
    """(common prefix with the record before, right, left, id, first) of a run, in order."""
    data = expand(data)
    n = int.from_bytes(data[:8], "big")
    lcp, tail, left = np.frombuffer(data, np.uint8, 3 * n, 8).reshape(3, n)
    at = 8 + 3 * n
    ids = np.frombuffer(data[at : at + 8 * n], np.int64).tolist()
    first = np.frombuffer(data[at + 8 * n : at + 16 * n], np.int64).tolist()
    at += 16 * n
    to = at + int(tail.sum(dtype=np.int64))
    right = b""
    for k, (c, t, w) in enumerate(zip(lcp.tolist(), tail.tolist(), left.tolist(), strict=True)):
        right = right[:c] + data[at : at + t]
        yield c, right, data[to : to + w], ids[k], first[k]
        at, to = at + t, to + w


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8


def merge_runs(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """(common prefix with the record before, run, record) of all runs in sorted order.

    A loser tree over the runs' heads. Each head carries the length of its
    common prefix with the last record put out; of two heads, the one with
    the longer length comes first, and only equal lengths are compared, from
    there on. The loser remembers its common prefix with the winner.
    """
    k = 1 << max(0, len(runs) - 1).bit_length()
    heads: list[tuple | None] = [next(r, None) for r in runs] + [None] * (k - len(runs))
    known = [0] * k  # with the last record put out, or with the winner it lost to
    losers = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes the one with the winner."""
        if heads[a] is None:
            return b, a
        if heads[b] is None:
            return a, b
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y = heads[a][1], heads[b][1]
        n = common(x, y, known[a])
        if x[n : n + 1] > y[n : n + 1] or x == y and b < a:
            a, b = b, a
        known[b] = n
        return a, b

    winners = list(range(k))
    size = k
    while size > 1:
        half = []
        for j in range(0, size, 2):
            w, lost = play(winners[j], winners[j + 1])
            losers[(size + j) // 2] = lost
            half.append(w)
        winners, size = half, size // 2
    top = winners[0]
    while heads[top] is not None:
        record = heads[top]
        yield known[top], top, record[1:]
        heads[top] = next(runs[top], None) if top < len(runs) else None
        if heads[top] is not None:
            known[top] = heads[top][0]  # front coding: its common prefix with the record just put out
        node = (k + top) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


def resolve(group: list[tuple]) -> Iterator[tuple[int, int, int]]:
    """Cuts among records of one anchor: (run, first byte, end) for every later string.

    group: (run, common prefix with the one before, right, left, id, first), sorted by right.
    """
    place: dict[tuple[bytes, bytes], tuple] = {}
    near: list[int] = []  # common prefix of each different record with the next one: the least on the way
    low = LENGTH
    for run, lcp, right, left, doc, first in group:
        low = min(low, lcp)
        new = (doc, first + len(left), run)
        held = place.get((right, left))
        if held is None:
            if place:
                near.append(low)
            place[right, left], low = new, LENGTH
            continue
        if new < held:
            place[right, left], new = new, held
        yield new[2], new[1] - len(left), new[1] + len(right)
    if not near:
        return
    records = [(len(right), len(left), at) for (right, left), at in place.items()]
    lefts = [left[::-1] for _, left in place]
    order = sorted(range(len(lefts)), key=lefts.__getitem__)
    beside = [common(lefts[a], lefts[b], 0) for a, b in itertools.pairwise(order)]
    # A string with o bytes before the anchor is shared by neighbours with o of them and LENGTH - o after in common.
    for o in range(max(0, LENGTH - max(near)), max(beside) + 1):
        right_class = list(itertools.accumulate((n < LENGTH - o for n in near), initial=0))
        left_class = list(itertools.accumulate((n < o for n in beside), initial=0))
        earliest: dict[tuple[int, int], tuple] = {}
        for k, c in zip(order, left_class, strict=True):
            after, before, at = records[k]
            if before < o or after < LENGTH - o:
                continue
            key = right_class[k], c
            held = earliest.setdefault(key, at)
            if held is not at:
                if at < held:
                    earliest[key], at = at, held
                yield at[2], at[1] - o, at[1] - o + LENGTH


def _first_places(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the earliest row of each string, the other rows) of rows (digest, digest, id, first byte, batch)."""
    high, low, doc, at, _ = table.T
    order = np.lexsort((at, doc, low, high))
    again = np.zeros(len(order), bool)
    again[1:] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
    return table[order[~again]], table[order[again]]


def _places(digests: bytes | bytearray, doc: np.ndarray, at: np.ndarray, batch: int) -> np.ndarray:
    return np.column_stack([np.frombuffer(digests, np.int64).reshape(-1, 2), doc, at, np.full(len(at), batch)])


def _strings(batch: int, spans: dict[tuple, tuple], shards: int, cuts: list[tuple[int, int]]) -> list[tuple]:
    """Rows of the strings of hot spans, each at its earliest place; the other places are cut."""
    digests, docs, at, sizes = bytearray(), [], [], []
    for (right, left), (doc, first) in spans.items():
        both = left + right
        sizes.append(len(both) - LENGTH + 1)
        docs.append(doc)
        at.append(np.arange(first, first + sizes[-1]))
        digests += b"".join(hashlib.blake2b(both[k : k + LENGTH], digest_size=16).digest() for k in range(sizes[-1]))
    if not sizes:
        return []
    table, late = _first_places(_places(digests, np.repeat(np.array(docs, np.int64), sizes), np.concatenate(at), batch))
    cuts.extend((a, a + LENGTH) for a in late[:, 3].tolist())
    shard = shards + table[:, 0] % (HOT_SHARDS * shards)
    table = table[np.argsort(shard, kind="stable")]
    return [
        ("hot", batch, int(s), own[:, :2].tobytes(), pack_planes(own[:, 2:4].ravel()))
        for s, own in zip(np.unique(shard), np.split(table, np.flatnonzero(np.diff(np.sort(shard))) + 1), strict=True)
    ]


def _earliest(rows: Iterator[dict], held: int) -> Iterator[pa.RecordBatch]:
    """Cuts of all but the earliest place of each hot string: each string once and ``held`` new places are in memory."""

    def reduced() -> Iterator[pa.RecordBatch]:
        first, late = _first_places(np.concatenate(tables))
        tables[:] = [first]
        late = late[np.argsort(late[:, 4], kind="stable")]
        parts = np.split(late, np.flatnonzero(np.diff(late[:, 4])) + 1) if len(late) else []
        yield _batch([_cut_row(int(p[0, 4]), [(a, a + LENGTH) for a in p[:, 3].tolist()]) for p in parts])

    tables: list[np.ndarray] = []
    new = 0
    for r in rows:
        at = unpack_planes(r["b"], np.int64).reshape(-1, 2)
        tables.append(_places(r["a"], at[:, 0], at[:, 1], r["batch"]))
        new += len(at)
        if new >= held:
            yield from reduced()
            new = 0
    yield from reduced()


def _send(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in grouped(batches, "batch"):
            text = next(r for r in rows if r["kind"] == "text")
            ids, texts = _read(text)
            spans = Spans(texts)
            hashes = np.unique(spans.hash)
            shard = _shard(hashes, shards)
            again, hot = np.zeros((2, len(hashes)), bool)
            for r in rows:
                if r["kind"] == "bits":
                    own = np.flatnonzero(shard == r["shard"])
                    again[own] = np.unpackbits(np.frombuffer(r["a"], np.uint8), count=len(own))
                    if r["b"]:
                        hot[own] = np.unpackbits(np.frombuffer(r["b"], np.uint8), count=len(own))
            which = np.searchsorted(hashes, spans.hash)
            take = np.flatnonzero(again[which])
            data = spans.data
            docs = [ids[d] for d in spans.documents(spans.first[take])]
            by: dict[int, dict] = {}
            cuts: list[tuple[int, int]] = []
            to = np.where(hot[which[take]], -1, _shard(spans.hash[take], shards)).tolist()
            for doc, s, f, a, z in zip(docs, to, spans.first[take].tolist(), spans.anchor[take].tolist(), (spans.last[take] + LENGTH).tolist(), strict=True):
                run = by.setdefault(s, {})
                key, order = (data[a:z], data[f:a]), (doc, f)
                held = run.get(key)
                if held is None or order < held:
                    run[key] = order
                    if held is None:
                        continue
                    order = held
                cuts.append((order[1], order[1] + z - f))
            out = _strings(batch, by.pop(-1, {}), shards, cuts)
            out += [
                ("run", batch, s, front_code(sorted((right, left, *order) for (right, left), order in run.items())), b"")
                for s, run in by.items()
            ]
            # The batch's own cuts pass through a shard unread, on their way back.
            out.append(_cut_row(batch, cuts, batch % shards))
            yield _batch(out)

    return run


def _cut_row(batch: int, cuts: list[tuple[int, int]], shard: int = -1) -> tuple:
    merged: list[list[int]] = []
    for a, b in sorted(cuts):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    flat = np.array(merged, np.uint64).ravel()
    return ("cut", batch, shard, pack(flat), b"")


def _merge(shards: int, held: int):
    def merged(rows: list[dict]) -> pa.RecordBatch:
        passing = [tuple(r[c] for c in ("kind", "batch", "shard", "a", "b")) for r in rows if r["kind"] == "cut"]
        rows = [r for r in rows if r["kind"] == "run"]
        cuts: dict[int, list] = {}
        group: list[tuple] = []
        for lcp, run, (right, left, doc, first) in itertools.chain(merge_runs([front_decode(r["a"]) for r in rows]), [(0, 0, (b"", b"", 0, 0))]):
            if lcp < GRAM and group:
                if len(group) > 1:
                    for r, a, b in resolve(group):
                        cuts.setdefault(rows[r]["batch"], []).append((a, b))
                group = []
            group.append((run, lcp, right, left, doc, first))
        return _batch(passing + [_cut_row(batch, own) for batch, own in cuts.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        for shard, own in itertools.groupby(rows, key=lambda r: r["shard"]):
            if shard < shards:
                yield merged(list(own))
            else:
                yield from _earliest(own, held)

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in grouped(batches, "batch"):
        ids, texts = _read(next(r for r in rows if r["kind"] == "text"))
        sizes = [len(t) for t in texts]
        starts = np.cumsum([0, *sizes])
        _, _, _, flat, _ = _cut_row(0, [(int(a), int(b)) for r in rows if r["kind"] == "cut" for a, b in unpack(r["a"]).reshape(-1, 2)])
        cuts = unpack(flat).astype(np.int64).reshape(-1, 2)
        out = []
        # A merged cut may run on from one document's end into the next one's start: it is split there.
        for k, text in enumerate(texts):
            a0, z0 = int(starts[k]), int(starts[k + 1])
            lo, hi = np.searchsorted(cuts[:, 1], a0, side="right"), np.searchsorted(cuts[:, 0], z0, side="left")
            own = [(max(int(a), a0) - a0, min(int(b), z0) - a0) for a, b in cuts[lo:hi]] if text else []
            kept, at = [], 0
            for a, b in own:
                kept.append(text[at:a])
                at = b
            out.append((ids[k], len(text), sum(b - a for a, b in own), len(own), b"".join([*kept, text[at:]]), [x for c in own for x in c]))
        cols = list(zip(*out, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, held: int = HELD) -> DataFrame:
    """One row of every document: (id_col, n_bytes, n_removed, n_spans, kept, spans).

    kept holds the remaining bytes, spans the start and end of each removed
    run (maximal within the document). Texts are taken as UTF-8 bytes, null
    as empty. A null id gives no row. Rows that repeat an id are one
    document, the one with the greatest text. Texts of fewer than LENGTH
    bytes stay whole; an empty table gives no rows; other columns are not read.
    A text longer than a batch is a batch of its own, its anchors found in
    segments: a task holds a few copies of its bytes. Anchors of ``hot``
    spans or more go by their strings, ``held`` places at a time; neither
    number changes a result.
    """
    spark = docs.sparkSession
    shards = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("id IS NOT NULL")
    if base.groupBy("id").count().where("count > 1").limit(1).count():
        base = base.groupBy("id").agg(F.max("text").alias("text"))
    path = scratch_path(spark, "suffix_dedup", unique=True)
    base.mapInArrow(_ask(shards), SCHEMA).write.partitionBy("kind").option("compression", "none").parquet(path)
    asked = spark.read.schema(SCHEMA).parquet(path)
    texts = asked.where("kind = 'text'").select("kind", "batch", "shard", "a", "b")

    def by(rows: DataFrame, column: str) -> DataFrame:
        return rows.repartition(shards, column).sortWithinPartitions(column, "batch")

    bits = by(asked.where("kind = 'anchor'").select("batch", "shard", "a", "b"), "shard").mapInArrow(_repeated(hot), SCHEMA)
    sent = by(texts.union(bits), "batch").mapInArrow(_send(shards), SCHEMA)
    cuts = by(sent, "shard").mapInArrow(_merge(shards, held), SCHEMA)
    done = by(texts.union(cuts), "batch").mapInArrow(
        _finish, "id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<long>"
    )
    return done.withColumnRenamed("id", id_col)
