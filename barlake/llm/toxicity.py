"""Toxicity: a weighted finite-state pattern grammar over clauses.

Words become symbols: insult, threat verb, intent, target, negation, report
(reported speech), quote, boundary or other. Five small weighted transducers
read the symbols of a clause: insults and threats emit weight, a target
beside them raises it, a negation shortly before and reported speech or
quotes lower it. An insult without a target is a match too, of its plain
weight. A threat verb needs an intent before it ("I'll hurt ...") or
begins the clause as a command; the target may stand before or after it, and
the verb's negation and report hold until then. They are composed once; the
composition is deterministic, so each clause has one path, whose matches' weights
add up. A document's score is a logistic function of its matched clauses.

The grammar's shape is fixed. Learned from labelled rows are the weights of
the insult words and the logistic function; both are fitted on at most
``MAX_LABELLED`` training rows, chosen by a hash of the id.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import chunks

MAX_LABELLED = 20_000
#: A learned insult marks at least this share of the toxic training rows, and is this much likelier there.
MIN_SHARE, MIN_RATIO = 0.01, 12.0

INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT, QUOTE, BOUNDARY, OWNER, FILL = range(10)
_LISTS = {
    INSULT: "idiot idiots moron morons stupid pathetic worthless loser losers clown clowns scum trash disgusting dumb imbecile fool filth "
    "vermin garbage idiota estúpido imbécil basura crétin débile ordure dummkopf abschaum trottel",
    THREAT: "kill hurt destroy beat stab shoot murder burn crush punch strangle matar tuer töten",
    INTENT: "will shall gonna going must should deserve deserves want voy vais werde",
    TARGET: "you yours yourself u he she him her they them everyone people tú usted vous toi du dich sie",
    # A target too, but no object of a command ("beat those eggs").
    OWNER: "your their those these",
    # Stand before a command or inside it without ending it.
    FILL: "go just please now then and so all of every",
    NEGATION: "not no never isn't aren't wasn't don't doesn't didn't won't without hardly kein nicht nie pas jamais nunca",
    REPORT: "said says say claimed claims reported quoted wrote called alleged allegedly according shouted tweeted dijo dit sagte",
}
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n\"“”«»]")
#: A closing quote belongs to the clause that the sign before it ends.
_CLOSING = re.compile(r"([.!?]+)([\"”»])")
BASE_WEIGHT = 1.0
FEATURES = 6


def lexicon(learned: dict[str, float]) -> dict[str, tuple[int, float]]:
    """word -> (symbol, weight); a learned weight replaces the listed one."""
    out = {w: (s, BASE_WEIGHT) for s, words in _LISTS.items() for w in words.split()}
    out |= {w: (INSULT, x) for w, x in learned.items()}
    out |= {c: (BOUNDARY, 0.0) for c in ".!?;:\n"} | {c: (QUOTE, 0.0) for c in "\"“”«»"}
    return out


def tokens(text: str | None) -> list[str]:
    """Lower-case words and signs of a text, with one form of apostrophe."""
    return TOKEN.findall(_CLOSING.sub(r"\2\1", (text or "").lower().replace("’", "'")))


def _symbols(place: int, token: str, words: dict[str, tuple[int, float]]) -> list[tuple[int, int, float]]:
    """(place, symbol, weight) of a token; a contracted will is an intent after its own word."""
    if token.endswith("'ll") and token not in words:
        return [(place, *words[w]) for w in (token[:-3], "will") if w in words]
    return [(place, *words[token])] if token in words else []


#: No threat waits for its target. Else 2 * negated + (reported or quoted), so that the least is the heaviest.
NONE = 4
REACH = 3


def _negation(ago: int, symbol: int | None) -> tuple[int, int]:
    """Words since a negation (0 none, 1-3 ago, capped); negated."""
    ago = 1 if symbol == NEGATION else (ago + 1) % (REACH + 2) if ago else 0
    return ago, int(ago > 0)


def _report(state: int, symbol: int | None) -> tuple[int, int]:
    """1 after a report word, 2 inside quotes; reported."""
    state = state ^ 2 if symbol == QUOTE else state | int(symbol == REPORT)
    return state, int(state > 0)


def _target(seen: int, symbol: int | None) -> tuple[int, int]:
    """Whether a target came; and whether one came before this symbol."""
    return seen or int(symbol in (TARGET, OWNER)), seen


def _intent(state: int, symbol: int | None) -> tuple[int, int]:
    """0 at the begin of the clause, 1 within it, 2 after an intent; what it was before this symbol."""
    if symbol == INTENT:
        return 2, state
    return state or int(symbol not in (FILL, NEGATION, QUOTE)), state


def _match(state: tuple[int, int], symbol: int | None, lowered: int, target: int, intent: int) -> tuple[tuple[int, int], str, int]:
    """(threats after an intent, commands) that wait for a target; output symbol; how it is lowered."""
    waiting, command = state
    if symbol == INSULT or symbol == THREAT and intent == 2 and target:
        return (waiting, NONE), "I" if symbol == INSULT else "T", lowered
    if symbol == THREAT and intent == 2:
        return (min(waiting, lowered), NONE), "p", NONE
    if symbol == THREAT and intent == 0:
        return (waiting, lowered), "p", NONE
    if symbol == TARGET and min(state) < NONE or symbol == OWNER and waiting < NONE:
        return (NONE, NONE), "T", min(state) if symbol == TARGET else waiting
    return (waiting, command if symbol in (FILL, OWNER, QUOTE) else NONE), "", NONE


class Composed:
    """The composition of the five transducers, its arcs made as they are first read.

    A state is one state of each: negation, report, target, intent, match.
    """

    BEGIN = (0, 0, 0, 0, (NONE, NONE))

    def __init__(self):
        self.arcs: dict[tuple, tuple[tuple, str, float]] = {}

    def arc(self, state: tuple, symbol: int | None) -> tuple[tuple, str, float]:
        """(next state, output symbol, log weight factor) for an input symbol.

        The output is I or T for an insult or threat, small if it is lowered,
        p for a threat verb whose target has yet to come.
        """
        key = (state, symbol)
        if key not in self.arcs:
            ago, negated = _negation(state[0], symbol)
            report, reported = _report(state[1], symbol)
            target, aimed = _target(state[2], symbol)
            intent, before = _intent(state[3], symbol)
            match, out, lowered = _match(state[4], symbol, 2 * negated + reported, aimed, before)
            factor = 0.0
            if out in ("I", "T"):
                factor += math.log(1.25) if aimed or symbol in (TARGET, OWNER) else 0.0
                factor += (math.log(0.3) if lowered & 2 else 0.0) + (math.log(0.5) if lowered & 1 else 0.0)
                out = out.lower() if lowered else out
            self.arcs[key] = ((ago, report, target, intent, match), out, factor)
        return self.arcs[key]

    def clause(self, symbols: list[tuple[int, int, float]]) -> tuple[float, float, int]:
        """(total weight, heaviest match, matches that are neither negated nor reported).

        symbols: (word number in the clause, symbol, weight); plain words between them only age a negation and end a command.
        """
        state, at, total, best, plain, pending = self.BEGIN, 0, 0.0, 0.0, 0, 0.0
        for place, symbol, weight in symbols:
            for _ in range(min(place - at, REACH + 1)):
                state = self.arc(state, None)[0]
            state, out, factor = self.arc(state, symbol)
            at = place + 1
            got = 0.0
            if out == "p":
                pending = max(pending, weight)
            elif out:
                if symbol in (TARGET, OWNER):
                    weight, pending = pending, 0.0
                got = weight * math.exp(factor)
                plain += out.isupper()
            total, best = total + got, max(best, got)
        return total, best, plain


_grammar = Composed()


def features(text: str | None, words: dict[str, tuple[int, float]]) -> list[float]:
    """Clause counts and weights of one whole text."""
    own = tokens(text)
    hits = [h for k, w in enumerate(own) if w in words or w.endswith("'ll") for h in _symbols(k, w, words)]
    total = best = 0.0
    matched = plain = 0
    if any(h[1] in (INSULT, THREAT) for h in hits):
        clause: list[tuple[int, int, float]] = []
        begin = 0
        for k, symbol, weight in itertools.chain(hits, [(len(own), BOUNDARY, 0.0)]):
            if symbol != BOUNDARY:
                clause.append((k - begin, symbol, weight))
                continue
            if any(c[1] in (INSULT, THREAT) for c in clause):
                t, b, p = _grammar.clause(clause)
                total, best, plain, matched = total + t, max(best, b), plain + p, matched + (t > 0)
            clause, begin = [], k + 1
    n = max(len(own), 1)
    return [min(total, 12.0), best, min(plain, 8), min(matched, 8), math.log1p(200.0 * total / n), float(total > 0)]


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, y) as (digest of the text, y, word) for each distinct word; a null word stands for the text itself."""
    for batch in batches:
        for part, texts in chunks(batch):
            keys, labels, words = [], [], []
            for text, y in zip(texts, part.column(1).to_pylist(), strict=True):
                own = [None, *sorted({w for w in tokens(text) if w[0].isalpha()})]
                keys += [hashlib.blake2b((text or "").encode(), digest_size=16).digest()] * len(own)
                labels += [y] * len(own)
                words += own
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(labels, pa.int32()), pa.array(words, pa.string())], names=["key", "y", "word"])


def learn_words(rows: DataFrame) -> dict[str, float]:
    """Insult words and weights from labelled texts (text, y); equal texts count once.

    Words are counted on the executors. A word must stand in at least 3 and in
    MIN_SHARE of the toxic texts, so the words that come back are at most
    1 / MIN_SHARE times those of a toxic text.
    """
    counts = rows.mapInArrow(_words_of, "key binary, y int, word string").distinct().groupBy("word").agg(
        F.count_if(F.col("y") == 1).alias("bad"), F.count_if(F.col("y") == 0).alias("fine")
    ).checkpoint()
    texts = counts.where("word IS NULL").first()
    if texts is None:
        return {}
    ratio = (F.col("bad") + 0.5) / (texts.bad + 1) / ((F.col("fine") + 0.5) / (texts.fine + 1))
    often = counts.where(F.col("word").isNotNull() & (F.col("bad") >= max(3, MIN_SHARE * texts.bad)))
    found = often.withColumn("ratio", ratio).where(F.col("ratio") >= MIN_RATIO).orderBy("word").collect()
    return {r.word: min(math.log(r.ratio) / 3.0, 2.0) for r in found}


def _measure(words: dict[str, tuple[int, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch):
                x = [features(t, words) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights (the last is the constant) by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([l2] * (x.shape[1] - 1) + [1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """The model from the given labelled rows (the caller leaves out what it holds out).

    At most MAX_LABELLED rows, those with the smallest hash of the id, are
    read; words are counted and texts measured on the executors, and the driver
    fits a few numbers of each row. Null labels and ids without a document are ignored. Without rows
    of both kinds the listed words and a cautious fixed function are used.
    """
    own = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
    own = own.where("id IS NOT NULL").groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(MAX_LABELLED)
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # A bounded side: at most MAX_LABELLED pairs of numbers. Their texts stay on the executors.
    rows = text.join(F.broadcast(own), "id").select("text", "y").checkpoint()
    learned = learn_words(rows)
    words = lexicon(learned)
    measured = sorted((r.y, *r.x) for r in rows.mapInArrow(_measure(words), "y int, x array<double>").collect())
    y = np.array([r[0] for r in measured], float)
    if len(measured) and 0 < y.sum() < len(y):
        weights = fit_logistic(np.array([r[1:] for r in measured]), y)
    else:
        weights = np.array([0.5, 0.5, 0.5, 0.5, 0.2, 0.0, -3.0])
    return {"learned": learned, "weights": weights.tolist()}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score, n_clauses, weight) of every row: score in 0..1, matched clauses, their weight.

    Null and empty texts match nothing and get the score of a clean text;
    null ids and repeated rows give their rows; other columns are not read.
    """
    weights = np.array(model["weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = lexicon(model["learned"])
        for batch in batches:
            for part, texts in chunks(batch):
                x = np.array([features(t, words) for t in texts])
                p = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p, pa.float64()), pa.array(x[:, 3], pa.float64()).cast(pa.int64()), pa.array(x[:, 0], pa.float64())],
                    names=["id", "score", "n_clauses", "weight"],
                )

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(run, "id long, score double, n_clauses long, weight double").withColumnRenamed("id", id_col)
