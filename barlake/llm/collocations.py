"""Phrase collocations by best-first branch-and-bound growth.

Phrases are prefixes that grow by one word. A phrase with count a, whose first
k words have count f_k, can only grow into phrases of count a or less, so no
phrase that begins with it scores above

    bound = min over k < length of  floor(scale * a / (f_k + a)),

which is an admissible bound (a score's r is never below its a). Words have no
bound but the least count: the pairs of words that reach it are all counted. From
then on only the frontier is expanded: the phrases of highest bound are looked up in the
texts in one pass, which counts the phrases that extend them by a word to the
right (their children) and, where a phrase is itself a contender, to the left.
The two counts settle whether a contender is swallowed by a longer phrase. A
language is settled when no phrase outside reaches the score of its
``limit``-th surviving phrase so far, ties included. Frontiers double in size, so
that few passes are made; phrases below the bound are never counted.

Nothing of the corpus is collected. A pass tests phrases against a bit array
of fixed size, made from the frontier's hashes by Spark; false hits only count
phrases that nobody asked for. Counts are by phrase, not by hash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barlake.session import scratch_path

from .lookups import HOT_SHARE, look_up
from .shingles import _BASE, _INVERSE, _power, mix

LONGEST = 4
#: Bytes of text whose phrases are counted at once.
SLICE_BYTES = 1 << 20
#: log2 of the bits of the frontier's array (8 MB).
FILTER_BITS = 26
#: Frontier of the first expansion, as a multiple of the limit.
FIRST_FRONTIER = 4
#: Longest phrase, in characters, that may be broadcast.
PHRASE_CHARS = 1000
#: Rows of a language that are ranked in one group.
RANK_ROWS = 100_000

_RIGHT, _LEFT, _EXACT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: A-Z lower-cased, tabs as spaces, ends of pieces as newlines.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_GAP = re.compile(rb"[ \n]")
COUNTS = "lang string, n int, phrase string, a long"


# ------------------------------------------------------------ texts to words


class _Words:
    """Words of translated bytes: their edges, 64-bit hashes, and whether the next stands in the same piece.

    Two different words, or phrases, share a hash with probability 2**-64.
    """

    def __init__(self, data: bytes, seed: int):
        self.data = data
        self.raw = raw = np.frombuffer(data, np.uint8)
        line = raw == 10
        gap = line | (raw == 32)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
        self.begin, self.end = edge[::2], edge[1::2]
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(raw)), out=total[1:])
        own = (total[self.end] - total[self.begin]) * _power(_INVERSE, len(raw) + 1)[self.begin]
        self.hashes = mix(own + np.uint64(seed))
        lines = np.cumsum(line, dtype=np.int32)
        self.joined = lines[self.end[:-1] - 1] == lines[self.begin[1:]]

    def __len__(self) -> int:
        return len(self.begin)

    def starts(self, n: int, limit: int) -> np.ndarray:
        """Words below ``limit`` at which n words stand in one piece."""
        last = len(self) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(last, bool)
        for j in range(n - 1):
            ok &= self.joined[j : last + j]
        return np.flatnonzero(ok[:limit])

    def chain(self, at: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the n words from each position."""
        out = self.hashes[at]
        for j in range(1, n):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + self.hashes[at + j])
        return out

    def count(self, at: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
        """The distinct phrases of n words at the positions, and how often each stands there."""
        _, first, counts = np.unique(self.chain(at, n), return_index=True, return_counts=True)
        at = at[first]
        begin, end = self.begin[at], self.end[at + n - 1]
        wide = np.zeros(len(at), bool)  # more than one space between two words
        for j in range(n - 1):
            wide |= self.begin[at + j + 1] - self.end[at + j] > 1
        sizes = (end - begin)[~wide]
        ends = np.cumsum(sizes)
        index = np.repeat(begin[~wide] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        plain = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(self.raw[index])])
        rest = [re.sub(b" +", b" ", self.data[b:e]).decode() for b, e in zip(begin[wide].tolist(), end[wide].tolist(), strict=True)]
        return pa.concat_arrays([plain, pa.array(rest, pa.string())]), np.concatenate([counts[~wide], counts[wide]])


def _seed(lang: str) -> int:
    return zlib.crc32(lang.encode()) * 0x9E3779B97F4A7C15 % 2**64


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(lang, translated texts of it), about SLICE_BYTES at a time; a longer text comes alone."""
    for batch in batches:
        groups: dict[str, list[int]] = {}
        for i, lang in enumerate(batch.column(0).to_pylist()):
            groups.setdefault(lang, []).append(i)
        texts = batch.column(1).cast(pa.binary())
        sizes = np.asarray(pc.binary_length(texts), np.int64)
        for lang, rows in groups.items():
            part = (np.cumsum(sizes[rows]) - 1) // SLICE_BYTES
            for some in np.split(np.array(rows), np.flatnonzero(np.diff(part)) + 1):
                yield lang, b"\n".join(texts.take(pa.array(some)).to_pylist()).translate(_PLAIN)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Words, int]]:
    """(lang, words, number of them that are new starts) of all texts, joined.

    Texts are cut between words, whatever their length. The words that a
    slice's last starts may need come again as the next one's first.
    """
    for lang, data in _joined(batches):
        begin, size = 0, 3 * SLICE_BYTES // 2
        while begin < len(data):
            gap = _GAP.search(data, min(begin + size, len(data)))
            stop = gap.start() if gap else len(data)
            words = _Words(data[begin:stop], _seed(lang))
            starts = len(words) if stop == len(data) else len(words) - LONGEST + 1
            if starts <= 0 and stop < len(data):
                size *= 2  # very long words
                continue
            if len(words):
                yield lang, words, starts
            begin = stop if starts == len(words) else begin + int(words.begin[starts])
            size = 3 * SLICE_BYTES // 2


def _rows(lang: str, n: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    langs = pa.array(np.zeros(len(phrases), np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.DictionaryArray.from_arrays(langs, pa.array([lang])).cast(pa.string()), pa.array(np.full(len(phrases), n, np.int32)), phrases, pa.array(counts, pa.int64())],
        names=["lang", "n", "phrase", "a"],
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of every slice, counted; n = 0 is their number."""
    for lang, words, limit in _slices(batches):
        yield _rows(lang, 0, pa.array([""]), np.array([limit]))
        yield _rows(lang, 1, *words.count(np.arange(limit), 1))


def _asked(bits: np.ndarray, hashes: np.ndarray, role: np.uint64) -> np.ndarray:
    bit = _bit(hashes, role)
    return (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def _pair_hashes(bits: np.ndarray) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes of pairs of two words of the frontier, counted by slice."""
        for _, words, limit in _slices(batches):
            at = words.starts(2, limit)
            at = at[_asked(bits, words.hashes[at], _RIGHT) & _asked(bits, words.hashes[at + 1], _LEFT)]
            hashes, counts = np.unique(words.chain(at, 2), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts, pa.int64())], names=["hash", "a"])

    return count


def _count_extensions(bits: np.ndarray, lengths: tuple[int, ...]) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases that were asked for, or extend one of the frontier by a word, counted by slice."""
        for lang, words, limit in _slices(batches):
            for n in lengths:
                at = words.starts(n, limit)
                hit = _asked(bits, words.chain(at, n), _EXACT) if n < LONGEST else np.zeros(len(at), bool)
                if n > 2:
                    hit |= _asked(bits, words.chain(at, n - 1), _RIGHT) | _asked(bits, words.chain(at + 1, n - 1), _LEFT)
                if hit.any():
                    yield _rows(lang, n, *words.count(at[hit], n))

    return count


def _bit(hashes: np.ndarray, role: np.uint64) -> np.ndarray:
    return mix(hashes * role) >> np.uint64(64 - FILTER_BITS)


def _bit_rows(bit: np.ndarray) -> pa.RecordBatch:
    at, inverse = np.unique(bit >> np.uint64(6), return_inverse=True)
    value = np.zeros(len(at), np.uint64)
    np.bitwise_or.at(value, inverse, np.uint64(1) << (bit & np.uint64(63)))
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(value.view(np.int64))], names=["word", "bits"])


def _bits_of_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _bit_rows(_bit(np.asarray(batch.column(0)).view(np.uint64), _EXACT))


def _bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, phrase, role) as (word of the bit array, its bits)."""
    for batch in batches:
        groups: dict[tuple[str, int], list[str]] = {}
        for lang, phrase, role in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            groups.setdefault((lang, role), []).append(phrase)
        for (lang, role), phrases in groups.items():
            words = _Words("\n".join(phrases).encode(), _seed(lang))
            first = np.flatnonzero(np.concatenate(([True], ~words.joined)))
            sizes = np.diff(np.append(first, len(words)))
            for n in range(1, LONGEST):
                yield _bit_rows(_bit(words.chain(first[sizes == n], n), [_RIGHT, _LEFT, _EXACT][role]))


# ------------------------------------------------------------ the search


def _first_words(phrase: str, k: str) -> str:
    return f"substring_index({phrase}, ' ', {k})"


class Search:
    """Known counts, frontier and thresholds of one search, in the shared folder."""

    def __init__(self, docs: DataFrame, lang_col: str, text_col: str, least: int, share: int, limit: int, scale: int):
        self.spark: SparkSession = docs.sparkSession
        self.least, self.share, self.limit, self.scale = least, share, limit, scale
        self.path = scratch_path(self.spark, "collocations", unique=True)
        self.made = 0
        self.texts = docs.select(
            F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
        )
        counts = self._counts(_count_words)
        counts = self._kept(counts.where((F.col("n") == 0) | (F.col("a") >= least)))
        self.sizes = counts.where("n = 0").select("lang", F.col("a").alias("n_words"))
        self.words = self.sizes.agg(F.sum("n_words")).first()[0] or 0
        self.known = counts.where("n > 0")
        ends = self.known.select("lang", "phrase", F.explode(F.array(F.lit(0), F.lit(1))).alias("role"))
        # Pairs are counted by their hashes first: a hash that reaches least is asked for, by its phrase.
        hashes = self.texts.mapInArrow(_pair_hashes(self._bit_array(ends)), "hash long, a long").groupBy("hash").agg(F.sum("a").alias("a"))
        heavy = hashes.where(F.col("a") >= least).select("hash").mapInArrow(_bits_of_hashes, "word long, bits long")
        pairs = self._counts(_count_extensions(self._bit_numbers(heavy), (2,))).where(F.col("a") >= least)
        self.known = self._kept(self.known.union(pairs))
        #: Scored phrases: all pairs, and the children of expanded phrases.
        self.scored = self._kept(self._scores(self.known.where("n = 2")))
        #: Phrases whose longer neighbours to the right (and, if left, to the left) are all in known.
        self.expanded = self._kept(self.scored.limit(0).select("lang", "phrase", F.lit(False).alias("left")))

    def _counts(self, counting: Callable) -> DataFrame:
        return self.texts.mapInArrow(counting, COUNTS).groupBy("lang", "n", "phrase").agg(F.sum("a").alias("a"))

    def _kept(self, rows: DataFrame) -> DataFrame:
        """rows, written to the shared folder and read again."""
        name = f"{self.path}/{self.made}"
        self.made += 1
        rows.write.parquet(name)
        return self.spark.read.schema(rows.schema).parquet(name)

    def _counted(self, rows: DataFrame, phrase: str, name: str) -> DataFrame:
        """rows with the known count of the phrase in a column (null: below least).

        A word may begin any share of the phrases: the counts of short
        phrases that hold over 1 in ``HOT_SHARE`` of all words are broadcast (at
        most ``LONGEST * HOT_SHARE`` rows of at most PHRASE_CHARS characters).
        """
        table = self.known.select("lang", F.col("phrase").alias(phrase), F.col("a").alias(name))
        hot = (F.col(name) * HOT_SHARE > self.words) & (F.length(phrase) <= PHRASE_CHARS) & (F.length("lang") <= PHRASE_CHARS)
        return look_up(rows, table, ["lang", phrase], hot, F.xxhash64("phrase"))

    def _scores(self, phrases: DataFrame) -> DataFrame:
        """(lang, n, phrase, a, l, r, score, bound, asks) of phrases (lang, n, phrase, a).

        score is exact where all counts are known; until then it is an upper
        bound and asks is the rest whose count it waits for.
        """
        cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
        cuts = cuts.withColumn("first", F.expr(_first_words("phrase", "k"))).withColumn("rest", F.expr(_first_words("phrase", "k - n")))
        cuts = self._counted(self._counted(cuts, "first", "l"), "rest", "r")
        ratio = lambda r: f"CAST(CAST({self.scale} * CAST(a AS decimal(20,0)) AS decimal(38,0)) div (CAST(l AS decimal(20,0)) + {r}) AS bigint)"
        cuts = cuts.select("lang", "n", "phrase", "a", "k", "l", "r", "rest", F.expr(ratio("coalesce(r, a)")).alias("score"), F.expr(ratio("a")).alias("bound"))
        return cuts.groupBy("lang", "n", "phrase", "a").agg(
            F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.min("bound").alias("bound"), F.max(F.when(F.col("r").isNull(), F.col("rest"))).alias("asks")
        ).select("lang", "n", "phrase", "a", "cut.l", "cut.r", "cut.score", "bound", "asks")

    def _surviving(self) -> DataFrame:
        """Scored phrases with alive (no known longer one swallows them), expanded, and settled (alive is final)."""
        parts = F.array(F.expr(_first_words("phrase", "n - 1")), F.expr(_first_words("phrase", "1 - n")))
        longer = self.known.where("n >= 3").select("lang", F.explode(parts).alias("phrase"), F.col("a").alias("longer"))
        longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        out = self.scored.join(longer, ["lang", "phrase"], "left").join(self.expanded, ["lang", "phrase"], "left")
        gone = F.expr(f"longer IS NOT NULL AND 100 * CAST(longer AS decimal(20,0)) >= {self.share} * CAST(a AS decimal(20,0))")
        return out.select(
            "lang", "n", "phrase", "a", "l", "r", "score", "bound", "asks",
            F.coalesce(~gone, F.lit(True)).alias("alive"),
            F.col("left").isNotNull().alias("expanded"),
            ((F.col("n") == LONGEST) | F.coalesce("left", F.lit(False)) | gone).alias("settled"),
        )

    def _cutoffs(self, rows: DataFrame, value: str, limit: int, name: str) -> DataFrame:
        """(lang, name): the greatest value that at least ``limit`` rows of a language reach.

        Found from the histogram of values, whose rows are at most scale / 2 + 1
        for each language, however many phrases there are.
        """
        steps = rows.groupBy("lang", value).agg(F.count("*").alias("m"))
        total = F.sum("m").over(Window.partitionBy("lang").orderBy(F.col(value).desc()))
        return steps.withColumn("total", total).where(F.col("total") >= limit).groupBy("lang").agg(F.max(value).alias(name))

    def _with_cutoff(self, rows: DataFrame, cutoffs: DataFrame, name: str) -> DataFrame:
        table = cutoffs.join(self.sizes, "lang")
        hot = (F.col("n_words") * HOT_SHARE > self.words) & (F.length("lang") <= PHRASE_CHARS)
        return look_up(rows, table, ["lang"], hot, F.xxhash64("phrase")).drop("n_words").withColumn(name, F.coalesce(name, F.lit(0)))

    def step(self, width: int) -> DataFrame | None:
        """Expand the best ``width`` phrases (with ties) of every open language.

        The result's rows, with everything that ties with the last, if none is open.
        """
        state = self._kept(self._surviving())
        sure = F.col("settled") & F.col("alive") & F.col("asks").isNull()
        state = self._kept(self._with_cutoff(state, self._cutoffs(state.where(sure), "score", self.limit, "tau"), "tau"))
        # What could still change the result: counts that a score waits for, and phrases not yet extended.
        asked = state.where("asks IS NOT NULL AND score >= tau").select("lang", F.col("asks").alias("phrase")).distinct()
        open_ = state.where(f"n < {LONGEST} AND NOT expanded AND bound >= tau")
        best = self._with_cutoff(open_, self._cutoffs(open_, "bound", width, "beta"), "beta").where("bound >= beta")
        batch, asked = self._kept(best.select("lang", "phrase", (F.col("score") >= F.col("tau")).alias("left"))), self._kept(asked)
        if batch.isEmpty() and asked.isEmpty():
            return state.where(sure & (F.col("score") >= F.col("tau")))
        roles = batch.select("lang", "phrase", F.lit(0).alias("role"))
        roles = roles.union(batch.where("left").select("lang", "phrase", F.lit(1))).union(asked.select("lang", "phrase", F.lit(2)))
        counting = _count_extensions(self._bit_array(roles), tuple(range(3, LONGEST + 1)))
        found = self._counts(counting).where(F.col("a") >= self.least)
        # A pass counts a phrase everywhere or not at all: every count is exact, those of false hits too.
        found = self._kept(found.join(self.known, ["lang", "n", "phrase"], "left_anti"))
        self.known = self._kept(self.known.union(found))
        self.expanded = self._kept(self.expanded.union(batch))
        longer = self.known.where("n >= 3").withColumn("prefix", F.expr(_first_words("phrase", "n - 1")))
        children = longer.join(batch.select("lang", F.col("phrase").alias("prefix")), ["lang", "prefix"], "left_semi").drop("prefix")
        came = found.where("n = 3").select("lang", F.col("phrase").alias("asks"))
        waiting = self.scored.where("asks IS NOT NULL")
        again = waiting.join(came, ["lang", "asks"], "left_semi").select("lang", "n", "phrase", "a")
        old = self.scored.where("asks IS NULL").union(waiting.join(came, ["lang", "asks"], "left_anti").select(*self.scored.columns))
        self.scored = self._kept(old.unionByName(self._scores(children.select("lang", "n", "phrase", "a").union(again))))
        return None

    def _bit_array(self, roles: DataFrame) -> np.ndarray:
        """The bits of (lang, phrase, role) rows."""
        return self._bit_numbers(roles.mapInArrow(_bits_of, "word long, bits long"))

    def _bit_numbers(self, rows: DataFrame) -> np.ndarray:
        """The array of (word, bits) rows: at most 2**(FILTER_BITS - 6) numbers, whatever the frontier."""
        table = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
        return out.view(np.uint64)


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = 30,
    share: int = 80,
    limit: int = 2000,
    scale: int = 2_000_000,
) -> DataFrame:
    """Each language's ``limit`` best phrases: (lang, rank, phrase, a, l, r, n, score).

    Texts have A-Z lower-cased and are split at ``[.,;:!?\\x0A-\\x0D]`` into
    pieces, these into words ``[^\\x20\\x09]+``. Candidates are phrases of 2 to 4
    words that stand at least ``least`` times inside pieces, overlaps included.
    Cut after k words, a candidate of count a has l and r, the counts of its two
    parts; its score is the least floor(scale * a / (l + r)), ties to the
    smallest k. Candidates that a longer candidate holds go if it has ``share``
    percent of their count or more: one word longer is enough to look at, as
    whatever holds a phrase holds such a one of no smaller count. n counts all
    words of the language. Order: score and a descending, phrase by its UTF-8 bytes.

    A null language is ``und``, together with rows that say so; null and empty
    texts have no words; repeated rows count again; a language without a
    candidate, and an empty table, give no rows. Texts of any length are counted
    in slices. Other columns are not read.
    """
    search = Search(docs, lang_col, text_col, least, share, limit, scale)
    width, best = FIRST_FRONTIER * limit, None
    while best is None:
        best, width = search.step(width), 2 * width
    # Beyond the limit there are only ties with the last score; they are ranked in groups.
    groups = best.count() // RANK_ROWS + 1
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    spread = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
    first = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= limit)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= limit)
    return ranked.join(search.sizes.withColumnRenamed("n_words", "total"), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
