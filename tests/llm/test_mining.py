"""Vector codes, phrase collocations and source mixing against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import collocations, curriculum, lookups, pivot_codes

# ------------------------------------------------------------ vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(id, code, error) of every usable row and the digest of the codebooks, trying every entry."""
    kept = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = -(-max((len(v) for _, v in kept), default=1) // parts) * parts
    w = dims // parts
    kept = [(i, v + [0] * (dims - len(v))) for i, v in kept]
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * w : (p + 1) * w] for _, v in seeds] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = defaultdict(list)
            for _, v in kept:
                x = v[p * w : (p + 1) * w]
                groups[near(x, book)[1]].append(x)
            for k, xs in groups.items():
                book[k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = []
    for i, v in kept:
        found = [near(v[p * w : (p + 1) * w], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    flat = ",".join(str(x) for book in books for c in book for x in c)
    return out, hashlib.sha256(flat.encode()).hexdigest()


def vectors(spark, rows):
    data = [(i, v, k % 3 if k % 5 else None, "x") for k, (i, v) in enumerate(rows)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, id string").repartition(3)


def vector_rows(n=150, dims=24, seed=4):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.2) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [round(c + rnd.gauss(0, 0.05), 3) for c in rnd.choice(centres)]) for i in range(n)]
    rows += [(500 + k, rows[3][1]) for k in range(40)]  # one very common vector
    return rows


def test_codes_are_those_of_trying_every_entry(spark):
    odd = [(900, None), (901, [1.0, None] * 12), (902, [float("nan")] * 24), (903, [float("inf")] * 24), (4, [0.25] * 24), (None, [0.5] * 24)]
    rows = vector_rows() + odd
    coded, model = pivot_codes.compress(vectors(spark, rows))
    out = pivot_codes.label_errors(coded).collect()
    want, digest = plain_codes(rows)
    assert sorted((str(r.id), r.code, r.error) for r in out) == sorted((str(i), c, e) for i, c, e in want)
    assert model.sha256() == digest
    sums = Counter()
    for r in out:
        sums[r.label] += r.error
    assert all(r.label_error == sums[r.label] for r in out) and None in sums


def test_pivots_spare_exact_distances():
    rnd = np.random.default_rng(5)
    centres = rnd.integers(-2000, 2000, (16, 8))
    x = (centres[rnd.integers(0, 16, 5000)] + rnd.integers(-150, 150, (5000, 8)))[:, None, :]
    model = pivot_codes.Model(centres[None], pivot_codes.choose_pivots(centres, 4)[None])
    index, best, tried = pivot_codes.assign(x, pivot_codes.pivot_distances(x, model.pivots), model)
    every = ((x - centres[None]) ** 2).sum(-1)
    assert (index[:, 0] == every.argmin(1)).all() and (best[:, 0] == every.min(1)).all()
    assert tried < 5000 * 16 / 3


def test_ties_go_to_the_lower_entry():
    entries = np.array([[0, 0], [4, 0], [0, 0], [2, 0]])
    model = pivot_codes.Model(entries[None], entries[None, [1]])
    x = np.array([[[0, 0]], [[1, 0]], [[3, 0]], [[2, 7]]])
    index, best, _ = pivot_codes.assign(x, pivot_codes.pivot_distances(x, model.pivots), model)
    assert index[:, 0].tolist() == [0, 0, 1, 3] and best[:, 0].tolist() == [0, 1, 1, 49]


def test_odd_vector_tables(spark):
    few = [(2, [1.0, 2.0, 3.0]), (1, []), (2, [1.0, 2.0, 3.0]), (3, [-0.0001] * 9)]
    coded, model = pivot_codes.compress(vectors(spark, few))
    want, digest = plain_codes(few)
    assert sorted((r.id, r.code, r.error) for r in coded.collect()) == sorted(want) and model.sha256() == digest
    none, model = pivot_codes.compress(vectors(spark, [(1, None)]))
    assert pivot_codes.label_errors(none).count() == 0 and model.sha256() == hashlib.sha256(b"").hexdigest()
    huge, _ = pivot_codes.compress(vectors(spark, [(1, [1e300] * 8), (2, [-1e300] * 8), (3, [0.0] * 8)]), entries=2)
    assert all(r.error >= 0 for r in huge.collect())


def test_look_up_serves_hot_cold_and_missing_keys(spark):
    rows = spark.createDataFrame([(k % 4 if k % 7 else None, k) for k in range(200)], "key int, id long")
    table = spark.createDataFrame([(0, "hot", 150), (1, "cold", 3), (None, "none", 29)], "key int, name string, n long")
    got = lookups.look_up(rows, table, ["key"], F.col("n") > 100, F.xxhash64("id")).collect()
    want = {0: "hot", 1: "cold", None: "none", 2: None, 3: None}
    assert len(got) == 200 and all(r.name == want[r.key] for r in got)


# ------------------------------------------------------------ phrase collocations


def plain_phrases(rows, least, limit, share=80):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + n]
            for p, a in kept.items()
            for n in range(2, len(p))
            for i in range(len(p) - n + 1)
            if 100 * a >= share * kept.get(p[i : i + n], 10**9)
        }
        scored = []
        for p, a in kept.items():
            if p in gone:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def phrase_rows(n=220, seed=6):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(25)] + ["É", "naïve", "B c", "日本"]
    fixed = ["Alpha beta GAMMA delta", "one two", "one  two\tthree", "of the of the of the", "w1 w2 w3 w4 w5"]
    rows = []
    for k in range(n):
        words = []
        for _ in range(rnd.randrange(1, 40)):
            words.append(rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(vocabulary))
            if rnd.random() < 0.2:
                words[-1] += rnd.choice(".,;:!?\n\r\x0b")
        rows.append((rnd.choice(["en", "en", "en", "de", None, "und"]), " ".join(words)))
    return rows + [("en", None), ("de", ""), ("xx", "only once here"), ("en", " \t\n"), ("en", "a b " * 3000)]


def phrase_table(spark, rows):
    data = [(k, t, lang, "p", "n", 1) for k, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, phrase string, n string, a int").repartition(3)


@pytest.mark.parametrize(("limit", "first", "slice_bytes"), [(2000, 4, 1 << 20), (5, 1, 1 << 20), (3, 1, 300)])
def test_phrases_are_those_of_counting_everything(spark, monkeypatch, limit, first, slice_bytes):
    monkeypatch.setattr(collocations, "FIRST_FRONTIER", first)
    monkeypatch.setattr(collocations, "SLICE_BYTES", slice_bytes)
    rows = phrase_rows()
    got = sorted(tuple(r) for r in collocations.collocations(phrase_table(spark, rows), least=12, limit=limit).collect())
    assert got == plain_phrases(rows, 12, limit) and len(got) > 3


def test_slices_hold_every_start_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(collocations, "SLICE_BYTES", 40)
    rnd = random.Random(7)
    text = " ".join("x" * rnd.choice([1, 3, 90]) + str(k) + rnd.choice(["", "", "."]) for k in range(200))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array([text, "", "a b c"])], names=["lang", "text"])
    seen = Counter()
    for _, words, limit in collocations._slices(iter([batch])):
        for n in (1, 2, 4):
            phrases, counts = words.count(words.starts(n, limit), n)
            seen.update(dict(zip(phrases.to_pylist(), counts.tolist(), strict=True)))
    want = Counter()
    for t in (text, "", "a b c"):
        for piece in t.split("."):
            words = piece.split()
            for n in (1, 2, 4):
                want.update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    assert seen == want


def test_bounds_keep_the_frontier_small(spark):
    rows = phrase_rows(400, 8)
    search = collocations.Search(phrase_table(spark, rows), "lang", "text", 12, 80, 1, 2_000_000)
    while search.step(1) is None:
        pass
    assert 0 < search.expanded.count() < search.scored.where("n < 4").count()


def test_no_phrases(spark):
    assert collocations.collocations(phrase_table(spark, [])).count() == 0
    assert collocations.collocations(phrase_table(spark, [(None, None), ("en", "a b")])).count() == 0


# ------------------------------------------------------------ source mixing


def mix_rows(seed=9):
    rnd = random.Random(seed)
    sizes = {"a": 60, "b": 5, "c": 4, "é": 3, "Z": 40, None: 20, "empty": 0}
    rows, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((k, " ".join("w" for _ in range(rnd.randrange(0, 60))), source))
            k += 1
    rows += [(k, None, "a"), (k + 1, "", "empty"), (None, "x y z", "a"), (5, "x\x0by z", "a")] + [(7, "same row here", "c")] * 30
    return rows


def mix_table(spark, rows):
    data = [(i, t, s, 1, "k", 0.5) for i, t, s in rows]
    return spark.createDataFrame(data, "doc_id long, text string, source string, size int, key string, target double").repartition(4)


def plain_targets(sizes, weights, most=3):
    total, capped = sum(sizes.values()), set()
    while True:
        shared = total - sum(most * sizes[s] for s in capped)
        heavy = sum(w for s, w in weights.items() if s not in capped)
        over = {s for s in sizes if s not in capped and shared * weights[s] > most * sizes[s] * heavy}
        if not over:
            return {s: most * sizes[s] if s in capped else shared * weights[s] / heavy for s in sizes}
        capped |= over


def test_mix_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 7)
    rows = mix_rows()
    docs = mix_table(spark, rows)
    planned = curriculum.plan(docs, curriculum.repeating(docs)).collect()
    words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += words(t)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = plain_targets(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    assert sorted((str(r.id), r.size, str(r.source)) for r in planned) == sorted((str(i), words(t), str(s)) for i, t, s in rows)
    taken = Counter()
    for r in planned:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(c.words for c in r.copies)
    assert all(taken[s] == round(want[s]) for s in sizes) and any(want[s] == 3 * sizes[s] > 0 for s in sizes)


def test_reruns_agree(spark):
    rows = mix_rows(10)
    runs = []
    for parts in (1, 5):
        docs = mix_table(spark, rows).repartition(parts)
        planned = curriculum.plan(docs, curriculum.repeating(docs))
        runs.append(sorted(map(str, planned.collect())))
    assert runs[0] == runs[1]


def test_positions_follow_the_schedules(spark):
    rows = [(k, " ".join(["w"] * 10), "early" if k % 2 else "late") for k in range(400)]
    docs = mix_table(spark, rows)
    lines = [("early", [(0.0, 3.0), (0.25, 1.0), (1.0, 0.0)]), ("late", [(0.5, 0.0), (1.0, 4.5)])]
    schedules = spark.createDataFrame(lines, f"source string, knots {curriculum.KNOTS}")
    planned = curriculum.plan(docs, schedules, seed="s").checkpoint()
    ordered = curriculum.training_order(planned).collect()
    assert [r.position for r in ordered] == sorted(r.position for r in ordered)
    area = {"early": lambda t: 3 * t - 4 * t * t if t <= 0.25 else 0.5 + (t - 0.25) - (t - 0.25) ** 2 / 1.5, "late": lambda t: 4.5 * (t - 0.5) ** 2}
    for r in planned.collect():
        for c in r.copies:
            word = area[r.source](c.position) * r.target / area[r.source](1.0)
            assert abs(word / 10 - round(word / 10)) < 1e-6  # copies begin at multiples of ten words
    by = defaultdict(list)
    for r in planned.collect():
        by[r.source] += [c.position for c in r.copies]
    assert min(by["late"]) >= 0.5 and sorted(by["early"])[len(by["early"]) // 2] < 0.25


def test_sources_without_weight_or_words(spark):
    docs = mix_table(spark, [(1, "a b", "x"), (2, "c", "y"), (3, None, "z")])
    none = spark.createDataFrame([("x", [(0.0, 0.0), (1.0, 0.0)])], f"source string, knots {curriculum.KNOTS}")
    assert all(r.taken == 0 and r.target == 0 and not r.copies for r in curriculum.plan(docs, none).collect())
    some = spark.createDataFrame([("y", [(0.0, 1.0), (1.0, 1.0)])], f"source string, knots {curriculum.KNOTS}")
    assert {r.id: r.taken for r in curriculum.plan(docs, some).collect()} == {1: 0, 2: 3, 3: 0}
    assert curriculum.plan(docs.limit(0), curriculum.repeating(docs.limit(0))).count() == 0
