"""Quality rules: hashed n-gram log-likelihood ratios (DataFrame operations only).

Unigrams and bigrams of whole texts are hashed into ``buckets`` slots. Two
multinomials over the slots are estimated with add-``alpha`` smoothing: the
target from trusted documents, the raw one from all documents. A document's
score is the sum of ln(target / raw) over its n-grams, divided by their
number; it is kept if no base rule fails and the score is at least
``threshold``. The slot table has ``buckets`` rows whatever the input, and
goes into the scoring plan as one literal array of that size.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .names import quoted

BUCKETS = 1 << 14
ALPHA = 0.5
THRESHOLD = -0.04
#: Trusted ids that are broadcast at most (16 bytes each).
MARKS_BROADCAST = 2_000_000

# The six spaces of [\x20\x09-\x0D] and the symbols that are counted.
_SPACES = ("\t", "\n", "\x0b", "\f", "\r", " ")
_SYMBOLS = "#*$%&|<>"


def _quoted(c: str) -> str:
    return f"decode(unhex('{c.encode().hex()}'), 'UTF-8')" if ord(c) < 32 else f"'{c}'"


def _replaced(text: str, chars, to: str) -> str:
    for c in chars:
        text = f"replace({text}, {_quoted(c)}, '{to}')"
    return text


def _let(name: str, value: str, body: str) -> str:
    """body with the lambda variable ``name`` bound to value, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _text(column: str) -> str:
    return f"coalesce(CAST({column} AS string), '')"


def _words(text: str) -> str:
    return f"filter(split({_replaced(text, _SPACES[:5], ' ')}, ' ', -1), w -> w <> '')"


def _grams(buckets: int) -> str:
    """Slots of all unigrams and bigrams of the words array ws."""
    one = f"transform(ws, w -> CAST(pmod(xxhash64(w), {buckets}) AS int))"
    two = f"transform(ws, (w, i) -> CAST(pmod(xxhash64(w, get(ws, i + 1)), {buckets}) AS int))"
    return f"concat({one}, slice({two}, 1, greatest(size(ws) - 1, 0)))"


# Words in windows of five found twice or more: windows are compared by their 64-bit hash; if
# any repeats, they are sorted with their places, and each repeated window adds the words up to
# the next one, five at most.
_HASHES = "transform(sequence(1, size(ws) - 4), i -> xxhash64(ws[i - 1], ws[i], ws[i + 1], ws[i + 2], ws[i + 3]))"
_REPEATED = _let(
    "s",
    "sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))",
    "sort_array(transform(filter(s, (e, k) -> (k > 0 AND e.x = s[k - 1].x) OR (k < size(s) - 1 AND e.x = s[k + 1].x)), e -> e.i))",
)
_COVERED = _let(
    "p",
    _REPEATED,
    "aggregate(sequence(0, size(p) - 1), 0L, (a, k) -> a + CASE WHEN k = size(p) - 1 THEN 5L ELSE least(5, p[k + 1] - p[k]) END)",
)
_REPEAT_WORDS = (
    "CASE WHEN size(ws) < 6 THEN 0L ELSE "
    + _let("h", _HASHES, f"CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE {_COVERED} END")
    + " END"
)


def fit_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, alpha: float = ALPHA) -> list[float]:
    """ln(target / raw) of each slot, from all documents and the trusted ids.

    ``trusted`` has the column id_col; ids without a document are ignored.
    Without a trusted n-gram (or without documents) every ratio is 0.
    """
    marks = trusted.select(F.col(quoted(id_col)).cast("long").alias("__id"), F.lit(1).alias("__t")).where("__id IS NOT NULL").distinct()
    own = docs.select(F.col(quoted(id_col)).cast("long").alias("__id"), F.col(quoted(text_col)).alias("text"))
    # One pass: each n-gram counts for the raw side and, in a marked text, for the target too. Up to
    # MARKS_BROADCAST marks go to the texts; beyond that, texts and marks are shuffled by id.
    if marks.limit(MARKS_BROADCAST + 1).count() <= MARKS_BROADCAST:
        marks = F.broadcast(marks)
    grams = _let("ws", _words(_text("text")), _grams(buckets))
    slots = own.join(marks, "__id", "left").select("__t", F.explode(F.expr(grams)).alias("slot"))
    counts = slots.groupBy("slot").agg(F.count("*").alias("r"), F.count("__t").alias("t"))
    raw_n, good_n = [0] * buckets, [0] * buckets
    for slot, r, t in counts.collect():  # at most ``buckets`` rows
        raw_n[slot], good_n[slot] = r, t
    total, trust = sum(raw_n), sum(good_n)
    if not trust:
        return [0.0] * buckets
    p = lambda n, of: math.log((n + alpha) / (of + alpha * buckets))
    return [p(t, trust) - p(r, total) for r, t in zip(raw_n, good_n, strict=True)]


def score_rules(docs: DataFrame, ratios: list[float], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with __n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words,
    __base_failed, __score and __kept.

    Every row gets a result, repeated rows and null ids included. Null and
    empty texts have no word: they fail the base rule, with score 0. All
    columns of docs stay.
    """
    buckets = len(ratios)
    # Folded to one literal array by the optimizer.
    table = "CAST(split('" + ",".join(map(repr, ratios)) + "', ',') AS array<double>)"
    lines = "filter(split(t, '\\n', -1), l -> btrim(l, ' \\t\\n\\u000b\\f\\r') <> '')"
    counts = f"""named_struct(
        'n_words', CAST(size(ws) AS bigint),
        'word_chars', CAST(length({_replaced('t', _SPACES, '')}) AS bigint),
        'n_symbols', CAST(length(t) - length({_replaced('t', _SYMBOLS, '')}) AS bigint),
        'n_dup_lines', {_let("l", lines, "CAST(size(l) - size(array_distinct(l)) AS bigint)")},
        'n_repeat_words', {_REPEAT_WORDS},
        'score', aggregate({_grams(buckets)}, 0D, (a, b) -> a + {table}[b]) / greatest(2 * size(ws) - 1, 1))"""
    failed = "(m.n_words < 10 OR 100 * m.n_repeat_words > 20 * m.n_words)"
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
    result = f"""named_struct({", ".join(f"'{n}', m.{n}" for n in names)}, 'base_failed', {failed},
        'kept', NOT {failed} AND m.score >= {threshold!r}D)"""
    # One expression whose parts are bound inside it: a filter on the verdict that is pushed below
    # the projection takes all of it along once, and splits the text once.
    row = _let("t", _text(quoted(text_col)), _let("ws", _words("t"), _let("m", counts, result)))
    out = docs.select("*", F.expr(row).alias("__r"))
    return out.select(*map(quoted, docs.columns), *[F.col(f"__r.{n}").alias(f"__{n}") for n in [*names, "base_failed", "kept"]])
