"""The registered queries of the operators, and their DuckDB SQL where there is one.

Each query applies one operator with its production parameters to its whole
table and derives the agreed columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, ctw, curriculum, decontaminate, line_dedup, near_dup, pivot_codes, pseudonyms, pu_quality, quality_rules, sentencepiece_fst, suffix_dedup, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents whose quality is marked good."""
    return _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.encode(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ratios = quality_rules.fit_ratios(docs, trusted(spark, sf_dir))
    out = quality_rules.score_rules(docs.select("doc_id", "text"), ratios)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return out.select("doc_id", *[F.col(f"__{n}").alias(n) for n in names])


def _remainder(of: int) -> Column:
    """crc32 of the id as text, modulo ``of``: the split into training and held-out rows."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(_remainder(3) != 1))
    out = toxicity.score(docs, model)
    return out.select(
        "doc_id",
        (_remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "n_clauses",
        "weight",
    )


#: The demonstration key of the registered query; users pass their own.
PSEUDONYM_KEY = "barlake-demonstration-key"


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.cut_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ctw.score(_table(spark, sf_dir, "documents"), _remainder(5) != 1)
    return out.select(
        "doc_id", (_remainder(5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"
    )


def op10_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    positives = labels.where((_remainder(5) != 0) & (F.col("quality") == 1))
    held_out = docs.where(_remainder(5) == 0).select("doc_id")
    model = pu_quality.fit(docs, positives, held_out)
    out = pu_quality.score(docs, model)
    return out.select(
        "doc_id",
        (_remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2("__kept", 256).alias("kept_sha256"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, model = pivot_codes.compress(_table(spark, sf_dir, "embeddings"))
    out = pivot_codes.label_errors(coded)
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(model.sha256()).alias("codebooks_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


#: Weights of the sources in code point order, repeating.
SOURCE_WEIGHTS = (5, 2, 1)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    planned = curriculum.plan(docs, curriculum.repeating(docs, SOURCE_WEIGHTS))
    first = F.get("copies", F.lit(0))["position"].alias("position")
    out = planned.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", first)
    return out.orderBy("position", "doc_id")


OP5_SQL = """
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), sized AS (
    SELECT doc_id, x, length(x) // 2 AS n FROM bytes
), strings AS (
    SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS m
    FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS p FROM sized WHERE n >= 100)
), later AS (
    SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY m ORDER BY doc_id, p) AS r FROM strings) WHERE r > 1
), stepped AS (
    SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM later
), numbered AS (
    SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM stepped
), runs AS (
    SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, run
), ends AS (
    SELECT doc_id, b AS from_byte, a AS run_a, b - a AS removed FROM runs
    UNION ALL SELECT doc_id, 0, NULL, 0 FROM sized
), pieces AS (
    SELECT e.doc_id, e.from_byte, e.removed, e.run_a,
           lead(e.run_a) OVER (PARTITION BY e.doc_id ORDER BY e.from_byte, e.run_a NULLS FIRST) AS to_byte
    FROM ends e
)
SELECT s.doc_id, any_value(s.n) AS n_bytes, CAST(sum(p.removed) AS BIGINT) AS n_removed, count(p.run_a) AS n_spans,
       sha256(unhex(string_agg(substr(s.x, 2 * p.from_byte + 1, 2 * (coalesce(p.to_byte, s.n) - p.from_byte)), '' ORDER BY p.from_byte, p.run_a NULLS FIRST))) AS kept_sha256
FROM sized s JOIN pieces p USING (doc_id) GROUP BY s.doc_id
"""

OP8_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
    SELECT doc_id, pos, line,
           trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
    FROM lines
), lowered AS (
    SELECT doc_id, pos, line,
           CASE WHEN length(k) >= 40
                THEN translate(k, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS k
    FROM keyed
), repeated AS (
    SELECT k, max(doc_id) AS last FROM lowered WHERE k IS NOT NULL
    GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT l.doc_id, l.pos, l.line, coalesce(l.doc_id <> r.last, false) AS gone
    FROM lowered l LEFT JOIN repeated r USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""



def _op11_sql(rounds: int = 6) -> str:
    steps = [
        """
WITH v AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), components AS MATERIALIZED (
    SELECT r, p, i, e[p * w + i] AS x
    FROM v, (SELECT max(len(e)) // 8 AS w FROM v) AS s, range(8) AS a(p), range(1, 1025) AS b(i) WHERE i <= w
), c0 AS MATERIALIZED (SELECT p, r - 1 AS k, i, x AS c FROM components WHERE r <= 16)"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
    SELECT r, p, min(d * 16 + k) AS m
    FROM (SELECT r, p, k, CAST(sum((x - c) * (x - c)) AS HUGEINT) AS d FROM components JOIN c{n} USING (p, i) GROUP BY r, p, k)
    GROUP BY r, p
)""")
        if n < rounds:
            steps.append(f"""
u{n + 1} AS MATERIALIZED (
    SELECT p, m % 16 AS k, i, sum(x) AS s, count(*) AS n FROM components JOIN a{n} USING (r, p) GROUP BY p, m % 16, i
), c{n + 1} AS MATERIALIZED (
    SELECT p, k, i, CASE WHEN n IS NULL THEN c ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS c FROM c{n} LEFT JOIN u{n + 1} USING (p, k, i)
)""")
    end = f"""
, books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, k, i)) AS h FROM c{rounds}),
coded AS (
    SELECT r, string_agg(printf('%02x', CAST(m % 16 AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(m // 16) AS BIGINT) AS error FROM a{rounds} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN coded USING (r), books"""
    return ",".join(steps) + end


OP12_SQL = """
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), sizes AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang
), counts AS MATERIALIZED (
    SELECT lang, k, phrase, count(*) AS f
    FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
          FROM split, range(1, 5) AS r(k) WHERE len(w) >= k)
    GROUP BY lang, k, phrase HAVING count(*) >= 30
), candidates AS (
    SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2
), cuts AS (
    SELECT lang, phrase, f, c, array_to_string(w[1:c], ' ') AS x, array_to_string(w[c + 1:k], ' ') AS y
    FROM candidates, range(1, 4) AS r(c) WHERE c < k
), scored AS (
    SELECT s.lang, s.phrase, s.f AS a, s.c, x.f AS l, y.f AS r,
           CAST((CAST(2000000 AS HUGEINT) * s.f) // (x.f + y.f) AS BIGINT) AS score
    FROM cuts s JOIN counts x ON x.lang = s.lang AND x.phrase = s.x JOIN counts y ON y.lang = s.lang AND y.phrase = s.y
), best AS (
    SELECT lang, phrase, a, l, r, score FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), swallowed AS (
    SELECT DISTINCT c.lang, c.phrase
    FROM (SELECT lang, f, array_to_string(w[i : i + m - 1], ' ') AS part
          FROM candidates, range(2, 4) AS s(m), range(1, 4) AS t(i) WHERE m < k AND i + m - 1 <= k) AS longer
    JOIN candidates c ON c.lang = longer.lang AND c.phrase = longer.part
    WHERE 100 * longer.f >= 80 * c.f
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM best ANTI JOIN swallowed USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

OP13_SQL = """
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), ordered AS (
    SELECT doc_id, source, size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || size || '/'
               || ((row_number() OVER (PARTITION BY doc_id, source, size) - 1) // 1000)) AS k
    FROM sized
), begun AS (
    SELECT doc_id, source, size,
           coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS word
    FROM ordered
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
    FROM sized GROUP BY source
), shares AS (
    SELECT *, 3 * source_size AS most, sum(source_size) OVER () AS words,
           row_number() OVER (ORDER BY source_size / w, w, source NULLS LAST) AS j
    FROM sources
), sums AS (
    SELECT *, words - coalesce(sum(most) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shared,
           sum(w) OVER (ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy
    FROM shares
), settled AS (
    SELECT j AS stop, shared AS s, heavy AS h FROM sums WHERE shared * w <= most * heavy ORDER BY j LIMIT 1
), aims AS (
    SELECT source, source_size, w, CASE WHEN j < stop THEN CAST(most AS DOUBLE) ELSE CAST(s AS DOUBLE) * w / CAST(h AS DOUBLE) END AS target
    FROM sums, settled
), due AS (
    SELECT doc_id, size, source_size, w, target, CAST(word AS BIGINT) AS word, CAST(round(target) AS BIGINT) AS d
    FROM begun b JOIN aims a ON b.source IS NOT DISTINCT FROM a.source
), placed AS (
    SELECT *, least(greatest(d - word, 0), size) + least(greatest(d - source_size - word, 0), size)
              + least(greatest(d - 2 * source_size - word, 0), size) AS taken,
           CAST(word AS DOUBLE) * w / target AS y
    FROM due
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken = 0 THEN NULL
            WHEN y <= 0 THEN 0.0
            WHEN w = 5 THEN 0.0 + 2 * y / (7.5e0 + sqrt(greatest(7.5e0 * 7.5e0 + 2 * (2.5e0 - 7.5e0) / 1e0 * y, 0e0)))
            WHEN w = 1 THEN 0.0 + 2 * y / (0.5e0 + sqrt(greatest(0.5e0 * 0.5e0 + 2 * (1.5e0 - 0.5e0) / 1e0 * y, 0e0)))
            WHEN y < 1 THEN 0.0 + 2 * y / (1e0 + sqrt(greatest(1e0 + 2 * (3e0 - 1e0) / 0.5e0 * y, 0e0)))
            WHEN y = 1 THEN 0.5
            ELSE 0.5e0 + 2 * (y - 1) / (3e0 + sqrt(greatest(9e0 + 2 * (1e0 - 3e0) / 0.5e0 * (y - 1), 0e0))) END AS position
FROM placed
"""

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_decontaminate": op7_decontaminate,
    "op8_line_dedup": op8_line_dedup,
    "op9_ctw": op9_ctw,
    "op10_pu_quality": op10_pu_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_collocations": op12_collocations,
    "op13_source_mix": op13_source_mix,
}

ORACLES = {
    "op5_suffix_dedup": OP5_SQL,
    "op8_line_dedup": OP8_SQL,
    "op11_vector_codes": _op11_sql(),
    "op12_collocations": OP12_SQL,
    "op13_source_mix": OP13_SQL,
}
