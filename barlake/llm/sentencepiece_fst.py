"""SentencePiece encoding and decoding as weighted finite-state transducers.

A model compiles into three transducers: the normaliser (dummy prefix, space
escape, optional squeeze of spaces), the pieces (a trie whose accepting arcs
carry tropical weights) and byte fallback (a character that no piece holds
becomes its UTF-8 byte pieces). A text is composed with them and the
shortest path in the (min, +) semiring is its encoding.

* unigram models: the arc weight of a piece is its negated score, and the
  shortest path is the Viterbi segmentation.
* BPE models: a sequence of pieces is the encoding exactly if every two
  neighbours would be left as they are by the merge rules on their own. The
  state is the last piece; the arc from a to b weighs 0 if (a, b) is such a
  pair and infinity otherwise. Exactly one path into each position is
  finite, so the composition with a text is deterministic, and its states
  are shared by all texts that lead to them.

No path crosses a space that follows a non-space (checked when compiling: no
piece holds one inside), nor a character outside all pieces, so a text is
composed word by word and the paths of words are kept in a bounded cache.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shingles import chunks

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Words whose path is kept by one worker, in each of two generations: when the newer one is
#: full, it becomes the older one, and words that are met again move up.
CACHE_WORDS = 100_000
#: Composed states kept by one worker; beyond, they are made afresh.
STATES = 400_000
#: Verdicts on pairs of pieces kept by one worker.
PAIRS = 1_000_000
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


class Composed:
    """A state of the composition of pieces and merge rules, made when a text first reaches it.

    It holds the last piece of the finite path into this place (None: no path
    ends here) and the pieces that are still open (number of the trie node,
    piece before it, in turn; the earliest first) as one tuple, by which it is
    also found, and its arcs by character.
    """

    __slots__ = ("arcs", "ids", "key", "last", "size")

    def __init__(self, key: tuple, ids: tuple[int, ...]):
        last = key[0]
        self.last, self.key, self.arcs = last, key, {}
        self.ids, self.size = ids, len(last or "")


class Transducer:
    """One compiled model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, self.bpe = proto.normalizer_spec, proto.trainer_spec.model_type == 2
        if norm.precompiled_charsmap or norm.normalization_rule_tsv:
            raise ValueError("only models with the identity character map are compiled")
        if proto.trainer_spec.model_type not in (1, 2) or not norm.escape_whitespaces:
            raise ValueError("only unigram and BPE models with escaped spaces are compiled")
        if any(p.type == USER for p in proto.pieces):
            raise ValueError("models with user-defined pieces are not compiled")
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.unknown = self.kinds.index(UNKNOWN)
        raw = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.bytes = [raw[b] for b in range(256)] if len(raw) == 256 else None
        self.value = {i: bytes([b]) for b, i in raw.items()}
        self.characters = set("".join(self.id))
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece holds a space after a non-space: words are no units")
        self.trie: dict = {None: 0}  # of the pieces; a node's piece stands under "", its number under None
        self.nodes = [self.trie]
        for p in self.id:
            node = self.trie
            for c in p:
                if c not in node:
                    node[c] = {None: len(self.nodes)}
                    self.nodes.append(node[c])
                node = node[c]
            node[""] = p
        self.single = {p: (i,) for p, i in self.id.items()}  # one tuple for all states of a piece
        self.unit = re.compile(f"[\n]|{SPACE}*[^{SPACE}\n]+|{SPACE}+") if "\n" not in self.characters else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.rank = {p: -x for p, x in self.score.items()}
        self.outside = 10.0 - min(self.score.values(), default=0.0)
        self.pairs: dict[tuple[str, str], bool] = {}
        self._forget()
        self.spines: dict[tuple[str, bool], list] = {}
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if self.prefix and text:
            text = " " + text
        return text.replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """The merge rules run on a short string: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = -math.inf, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and s > best:
                    best, at = s, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def spine(self, piece: str, right: bool) -> list[tuple[str, float]]:
        """Outermost parts of ``piece`` while it is merged, at its right or left end.

        (part, rank of the merge that takes it up), in order; the whole piece
        is taken up by none. Empty if the rules don't make the piece.
        """
        key = (piece, right)
        if key not in self.spines:
            out = []
            parts = list(piece)
            while len(parts) > 1:
                ranks = [self.rank.get(x + y, math.inf) for x, y in zip(parts, parts[1:], strict=False)]
                at = ranks.index(min(ranks))
                if ranks[at] == math.inf:
                    break
                if at == (len(parts) - 2 if right else 0):
                    out.append((parts[-1 if right else 0], ranks[at]))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.spines[key] = [*out, (piece, math.inf)] if len(parts) == 1 else []
        return self.spines[key]

    def _pair(self, a: str, b: str) -> float:
        """Tropical weight of piece b after piece a: 0, or infinity if a merge would cross.

        At any time one part of a and one of b touch. If both make a piece
        whose rank comes before the merge that takes up either, it is merged
        (with equal ranks the left one goes first), and (a, b) is no path.
        """
        if SPACE * 2 in a + b:  # runs of spaces share one rank, so that parts have no order
            return 0.0 if self.merged(a + b) == [a, b] else math.inf
        left, right = self.spine(a, True), self.spine(b, False)
        if not left or not right:
            return math.inf
        i = j = 0
        while True:
            (x, x_end), (y, y_end) = left[i], right[j]
            r = self.rank.get(x + y, math.inf)
            if r < x_end and r <= y_end and r < math.inf:
                return math.inf
            if x_end == y_end == math.inf:
                return 0.0
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    def arc(self, before: str, piece: str) -> float:
        """Tropical weight of the arc that reads ``piece`` after ``before``."""
        if not self.bpe:
            return -self.score[piece]
        if before:
            return self._pair(before, piece)
        return 0.0 if self.spine(piece, True) or self.merged(piece) == [piece] else math.inf

    def _step(self, state: Composed, c: str) -> Composed:
        """The arc of the composed machine that reads c; made once, then kept at its state."""
        last, open_ = None, []
        held = state.key
        for k in range(1, len(held), 2):  # longest piece first
            node = self.nodes[held[k]].get(c)
            if node is None:
                continue
            before, piece = held[k + 1], node.get("")
            if piece is not None and last is None and self._finite(before, piece):
                last = piece
            if len(node) > 1 + (piece is not None):
                open_ += (node[None], before)
        if last is None and c not in self.id and state.last is not None:
            last = c  # a character that is no piece
        if last is not None:
            open_ += (0, last)
        key = (last, *open_)
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = Composed(key, self.output(last or ""))
        state.arcs[c] = to
        return to

    def _finite(self, before: str, piece: str) -> bool:
        got = self.pairs.get((before, piece))
        if got is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            got = self.pairs[before, piece] = self.arc(before, piece) == 0.0
        return got

    def shortest_path(self, unit: str) -> list[str]:
        """Pieces of the best path through one unit; single characters may be outside."""
        last = [state.last for state in self._bpe_trail(unit)] if self.bpe else self._viterbi(unit)
        out, end = [], len(unit)
        while end:
            out.append(last[end - 1])
            end -= len(last[end - 1])
        return out[::-1]

    def _bpe_trail(self, unit: str) -> list[Composed]:
        """The states that a unit leads through; the last piece of each is that of the finite path."""
        if len(self.states) > STATES:
            self._forget()
        state, trail = self.start, []
        for c in unit:
            to = state.arcs.get(c)
            if to is None:
                to = self._step(state, c)
            trail.append(to)
            state = to
        return trail

    def _viterbi(self, unit: str) -> list[str]:
        """The last piece of the cheapest path into each place. A character that is no piece
        and has no other path is read by its own arc, dearer than any piece."""
        n = len(unit)
        cost, last = [0.0] + [math.inf] * n, [""] * (n + 1)
        for start in range(n + 1):
            if cost[start] == math.inf:
                cost[start], last[start] = cost[start - 1] + self.outside, unit[start - 1]
            node, end = self.trie, start
            while end < n:
                node = node.get(unit[end])
                if node is None:
                    break
                end += 1
                piece = node.get("")
                if piece is not None and cost[start] - self.score[piece] < cost[end]:
                    cost[end], last[end] = cost[start] - self.score[piece], piece
        return last[1:]

    def _forget(self) -> None:
        """A machine without composed states."""
        self.states: dict[tuple, Composed] = {}
        self.start = Composed(("", 0, ""), ())

    def output(self, piece: str) -> tuple[int, ...]:
        """Ids of a piece, or of the bytes of a character that is none."""
        one = self.single.get(piece)
        if one is not None:
            return one
        return tuple(self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")) if self.bytes else (self.unknown,)

    def path_ids(self, unit: str) -> tuple[int, ...]:
        """Output of the best path."""
        if not self.bpe:
            return tuple(i for piece in self.shortest_path(unit) for i in self.output(piece))
        trail, parts, end = self._bpe_trail(unit), [], len(unit)
        while end:
            state = trail[end - 1]
            parts.append(state.ids)
            end -= state.size
        return tuple(i for ids in reversed(parts) for i in ids)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        cache = self.cache
        for unit in self.unit.findall(self.normalise(text)):
            ids = cache.get(unit)
            if ids is None:
                ids = self.older.get(unit)
                if ids is None:
                    ids = self.path_ids(unit)
                if len(unit) <= 64:
                    if len(cache) >= CACHE_WORDS:
                        self.older, self.cache = cache, {}
                        cache = self.cache
                    cache[unit] = ids
            out.extend(ids)
        return out

    @property
    def _surface(self) -> list[bytes]:
        if not hasattr(self, "_bytes_of"):
            control = {CONTROL: b"", UNKNOWN: " ⁇ ".encode()}
            self._bytes_of = [
                self.value[i] if k == BYTE else control[k] if k in control else p.replace(SPACE, " ").encode("utf-8", "surrogatepass")
                for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True))
            ]
        return self._bytes_of

    def decode(self, ids) -> str:
        """The text of ids: bytes are joined, and the dummy prefix goes."""
        text = b"".join(map(self._surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


_compiled: dict[bytes, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    """One transducer for each worker and model."""
    if model not in _compiled:
        _compiled.clear()
        _compiled[model] = Transducer(model)
    return _compiled[model]


def _model(spark: SparkSession, path: str):
    """The model file, read through Spark so that any store serves, as a broadcast (its size is that of a vocabulary)."""
    row = spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").select("content").first()
    return spark.sparkContext.broadcast(bytes(row.content))


def encode(docs: DataFrame, model_path: str = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>, n_ids, n_bytes, round_trip) of every row.

    n_bytes counts byte pieces. round_trip tells whether decoding gives the
    normalised text back. Null texts count as empty and have no ids; null
    ids and repeated rows give their rows; other columns are not read.
    """
    model = _model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model.value)
        is_byte = np.array([k == BYTE for k in fst.kinds])
        for batch in batches:
            for part, texts in chunks(batch):
                ids, n_bytes, same = [], [], []
                for text in texts:
                    got = fst.encode(text or "")
                    arr = np.array(got, np.int32)
                    ids.append(arr)
                    n_bytes.append(int(is_byte[arr].sum()))
                    norm = fst.normalise(text or "").replace(SPACE, " ")
                    same.append(fst.decode(got) == (norm[1:] if fst.prefix else norm))
                sizes = np.cumsum([0] + [len(a) for a in ids])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(ids), pa.int32())),
                        pa.array(np.diff(sizes), pa.int64()),
                        pa.array(n_bytes, pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["id", "ids", "n_ids", "n_bytes", "round_trip"],
                )

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = base.mapInArrow(run, "id long, ids array<int>, n_ids long, n_bytes long, round_trip boolean")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str = DEFAULT_MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of every row of ids; null ids give an empty text, ids outside the model raise."""
    model = _model(encoded.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model.value)
        for batch in batches:
            texts = [fst.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    base = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return base.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
