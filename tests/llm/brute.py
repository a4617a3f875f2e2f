"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROW = "doc_id long, text string, id long, word string, score string, kept string, component string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def frame(spark, rows, partitions=3):
    """(id, text) rows as documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, -7, "w", "s", "k", "c") for i, t in rows], ROW).repartition(partitions)


def shingle_set(text):
    words = [lower(w) for w in WORD.findall(text or "")]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_groups(rows, threshold=0.8):
    """id -> (smallest linked id, number of linked documents)."""
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    links = defaultdict(set)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    out = {}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (min(seen), len(links[i]))
    return out


def contained(rows, items, threshold=0.8):
    """(doc, item) -> (shingles found, shingles of the item)."""
    out = {}
    for item, text in items:
        want = shingle_set(text)
        for i, t in rows:
            hit = len(want & shingle_set(t))
            if want and i is not None and hit >= threshold * len(want) - 1e-9:
                out[i, item] = max(out.get((i, item), (0, 0)), (hit, len(want)))
    return out


def line_dedup(rows, min_chars=40, min_docs=5):
    """id -> (lines, dropped, kept text)."""
    key = lambda line: lower(line.strip("\x20\t\n\x0b\f\r"))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def cut_repeats(rows, length=100):
    """id -> (bytes, removed, runs, digest of the rest)."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def base_quality(text):
    """(words, characters in words, symbols, repeated lines, words in repeated windows of five)."""
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for k in range(len(words) - 4):
        windows[tuple(words[k : k + 5])].append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def slots(text, buckets):
    """Hashed unigrams and bigrams as Spark's xxhash64 gives them (seed 42, one string's hash seeds the next)."""
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    one = lambda w, seed=42: xxhash.xxh64_intdigest(w.encode(), seed)
    words = WORD.findall(text or "")
    grams = [one(w) for w in words] + [one(b, one(a)) for a, b in zip(words, words[1:], strict=False)]
    return [signed(h) % buckets for h in grams]


def quality_scores(rows, trusted, buckets, alpha):
    raw, good = Counter(), Counter()
    for i, t in rows:
        s = slots(t, buckets)
        raw.update(s)
        if i in trusted:
            good.update(s)
    p = lambda c, b: (c[b] + alpha) / (sum(c.values()) + alpha * buckets)
    ratio = {b: math.log(p(good, b) / p(raw, b)) for b in raw}
    out = []
    for _, t in rows:
        s = slots(t, buckets)
        out.append(sum(ratio[b] for b in s) / max(len(s), 1))
    return out


class ContextTree:
    """Context-tree weighting over dictionaries."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.below, self.memory = depth, defaultdict(lambda: [0, 0]), defaultdict(set), {}
        for t in texts:
            for context, node, bit in self.steps(t):
                for d in range(depth + 1):
                    self.counts[context[:d], node][bit] += 1
                    if d:
                        self.below[context[: d - 1], node].add(context[:d])

    def steps(self, data):
        for k, byte in enumerate(data):
            context = tuple(data[k - j] if k >= j else 10 for j in range(1, self.depth + 1))
            for b in range(8):
                yield context, (b, byte >> (8 - b)), byte >> (7 - b) & 1

    def kt(self, key):
        a, b = self.counts[key] if key in self.counts else (0, 0)
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, context, node):
        key = (context, node)
        if key not in self.memory:
            own = self.kt(key)
            if len(context) < self.depth:
                rest = sum(self.weighted(c, node) for c in self.below[key])
                top = max(own, rest)
                own = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(rest - top))
            self.memory[key] = own
        return self.memory[key]

    def log10(self, data):
        total = 0.0
        for context, node, bit in self.steps(data):
            p = None
            for d in range(self.depth, -1, -1):
                key = (context[:d], node)
                a, b = self.counts[key] if key in self.counts else (0, 0)
                own = (b + 0.5) / (a + b + 1)
                stop = 1.0 if p is None else math.exp(math.log(0.5) + self.kt(key) - self.weighted(*key))
                p = stop * own + (1 - stop) * (p or 0.0)
            total += math.log10(p if bit else 1 - p)
        return total


def corpus(seed=5, n=60):
    """Own documents with copies, near copies, shared lines and passages, nulls and odd texts."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("aeioubdgklmnrst") for _ in range(rnd.randrange(2, 8))) for _ in range(120)]
    words = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    line, passage = words(14), words(45)
    texts = [words(rnd.randrange(30, 90)) for _ in range(n)]
    for k in range(0, n, 4):
        texts[k] += "\n" + (line.upper() if k % 8 else f"  {line}\t")
    for k in range(1, n, 9):
        texts[k] = f"{words(12)} {passage} {words(12)}"
    first = texts[2]
    for k in range(3, n, 6):  # one word changed: near copies; every other one an exact copy
        part = first.split(" ")
        part[len(part) // 2] = part[len(part) // 2] if k % 4 else f"other{k}"
        texts[k] = " ".join(part)
    odd = ["", None, "one", "two words", " \t\n ", "é" * 300, "ab" * 400, (words(3) + " ") * 500, words(5000)]
    rows = list(enumerate(texts)) + [(1000 + k, t) for k, t in enumerate(odd)]
    return rows, passage, vocabulary
