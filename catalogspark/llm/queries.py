"""The registered queries of the subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.llm import alignment, embeddings, katz, licenses, lines, minhash, mixing, packing, quality, runs, shard, substring, suffix
from catalogspark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_bytes(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_substrings(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    col = lambda c: F.col(f"{quality.LEDGER}.{c}")
    base = col("failed_bits").bitwiseAND(F.lit(quality.BASE).cast("long")) != 0
    return rows.select("doc_id", *[col(c).alias(c) for c in quality.MEASURES[:5]], base.alias("base_failed"), quality.verdict().alias("kept"), col("n_lines").alias("n_lines"), col("failed_bits").alias("failed_bits"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_documents(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(table(spark, sf_dir, "documents"), runs.planted)


def op12_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_report(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.alignment_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_license_scan, op2_suffix_dedup, op3_line_dedup, op4_embedding_near_dedup, op5_source_mixing, op6_substring_dedup, op7_quality_rules, op8_packing, op9_sharding, op10_minhash_near_dedup, op11_periodic_runs, op12_katz_scores, op13_tokenizer_alignment)}

#: The copies of each document, by the closed form of the Poisson terms.
MIXING_SQL = """
WITH c AS (SELECT coalesce(source, chr(0) || 'none') AS s, count(*) AS n FROM documents GROUP BY 1), t AS (SELECT sum(n) AS total, sum(sqrt(n)) AS w FROM c),
r AS (SELECT s, sqrt(n) / w * total / n AS rate FROM c, t),
d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS text_md5, rate, coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM documents JOIN r ON coalesce(source, chr(0) || 'none') = s),
u AS (SELECT *, (CAST('0x' || substr(md5('mixture:' || k), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM d),
p AS (SELECT *, len(list_filter(range(0, 60), lambda i: list_sum(list_transform(range(0, i + 1), lambda j: exp(-rate + j * ln(rate) - lgamma(j + 1)))) < u)) AS n_copies FROM u),
e AS (SELECT *, unnest(range(0, n_copies)) AS copy FROM p)
SELECT doc_id, source, text_md5, CAST(copy AS INT) AS copy, CAST(n_copies AS INT) AS n_copies, (CAST('0x' || substr(md5('mixture:' || k || ':' || CAST(copy AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS shuffle_key FROM e"""

#: The measurements and rules, over one row a window and one a line.
QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS c FROM g),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM h, range(8) r(j) WHERE c > 1 GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END + CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END
  + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 16 ELSE 0 END AS failed_bits FROM m)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) > 0 AS base_failed, failed_bits = 0 AS kept, n_lines, failed_bits FROM b"""

#: Every byte of every document, as two hex digits; a removed string marks the 50 bytes from its start on.
SUFFIX_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, x, unnest(range(1, length(x) // 2 + 1)) AS i FROM d),
g AS (SELECT doc_id, i, CASE WHEN i + 49 <= length(x) // 2 THEN hash(substr(x, 2 * i - 1, 100)) END AS w, substr(x, 2 * i - 1, 2) AS b FROM p),
f AS (SELECT doc_id, i, b, w IS NOT NULL AND min(doc_id) OVER (PARTITION BY w) < doc_id AS early FROM g),
c AS (SELECT doc_id, i, b, bool_or(early) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
s AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS lead FROM c),
k AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (lead) AS n_spans, sha256(unhex(coalesce(string_agg(b, '' ORDER BY i) FILTER (NOT gone), ''))) AS kept_sha256 FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x FROM documents),
p AS (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, CASE WHEN i + 49 <= len(x) THEN array_to_string(x[i:i + 49], ' ') END AS w, x[i] AS b FROM p),
f AS (SELECT doc_id, i, b, w IS NOT NULL AND min(doc_id) OVER (PARTITION BY w) < doc_id AS early FROM g),
c AS (SELECT doc_id, i, b, bool_or(early) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(b, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM c GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

#: The smallest node that each node of `links` reaches.
COMPONENTS = """
r AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a),
m AS (SELECT a, least(a, min(b)) AS component FROM r GROUP BY a)"""

EMBEDDING_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),{COMPONENTS}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, vec_id = coalesce(component, vec_id) AS kept FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN m ON vec_id = m.a"""
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
MINHASH_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM p),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM o JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),{COMPONENTS}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id, doc_id = coalesce(component, doc_id) AS kept FROM d LEFT JOIN z USING (doc_id) LEFT JOIN m ON doc_id = m.a"""

def license_sql() -> str:
    """Every block of every document against every template, without filters; base phrases at every place."""
    rows = []
    for label, text in licenses.TEMPLATES.items():
        tokens = sorted(set(text.split()))
        rows.append(f"('{label}', {tokens}, {len(tokens)}, {licenses.need_of(text)}, {licenses.stride_of(text)}, '{text if licenses.is_short(text) else ""}')")
    starts = ", ".join("list_filter(range(0, len(w)), lambda i: " + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase, 1)) + f") AS s{n}" for n, phrase in enumerate(licenses.BASE.values()))
    base = ", ".join(f"CASE WHEN len(s{n}) > 0 THEN '{label}' END" for n, label in enumerate(licenses.BASE))
    every = "list_concat(list_concat(s0, s1), s2)"
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t(label, tokens, n, need, stride, phrase) AS (VALUES {", ".join(rows)}),
b AS (SELECT rid, w, stride, unnest(range(0, greatest(len(w), 1), stride)) AS b FROM d, (SELECT DISTINCT stride FROM t)),
x AS (SELECT rid, stride, list_distinct(w[b + 1:b + 2 * stride]) AS block, ' ' || array_to_string(w[b + 1:b + 2 * stride], ' ') || ' ' AS line FROM b),
m AS (SELECT rid, label, max(len(list_intersect(block, tokens))) / n AS c FROM x JOIN t USING (stride) WHERE phrase = '' OR contains(line, ' ' || phrase || ' ') GROUP BY rid, label, n, need HAVING max(len(list_intersect(block, tokens))) >= need),
f AS (SELECT rid, list(label) AS found, max(c) AS best FROM m GROUP BY rid),
s AS (SELECT rid, doc_id, len(w) AS n_words, {starts} FROM d),
p AS (SELECT rid, doc_id, n_words, {every} AS e, list_filter([{base}], lambda v: v IS NOT NULL) AS base FROM s)
SELECT doc_id, n_words, len(e) AS n_base, list_min(e) AS first_word, list_max(e) AS last_word, array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels, CASE WHEN len(base) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score FROM p LEFT JOIN f USING (rid)"""

#: CRC-32 of the decimal doc_id (none: no checksum), a step a bit.
ID_CRC = """
xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, 8 * length(CAST(doc_id AS VARCHAR))), lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS INT), 1))::BIGINT ELSE 0::BIGINT END)),
  lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))))"""

#: A run's words from its start on equal those one period later for 16 words or more, so pairs of equal 16-word strings show every run.
RUNS_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x, {ID_CRC} AS h FROM documents),
a AS (SELECT rid, doc_id, x, len(x) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(x) > 0 THEN (h // 10) % len(x) END AS a FROM d),
w AS (SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN x ELSE list_transform(range(0, n), lambda i: x[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM a),
g AS (SELECT rid, i, array_to_string(w[i + 1:i + 16], ' ') AS k FROM (SELECT rid, w, unnest(range(0, n - 15)) AS i FROM w WHERE n >= 24)),
s AS (SELECT l.rid, l.i, r.i - l.i AS q FROM g l JOIN g r ON l.rid = r.rid AND l.k = r.k AND r.i > l.i),
t AS (SELECT rid, q, min(i) AS s, max(i) - min(i) + q + 16 AS m FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS z FROM s) GROUP BY rid, q, z),
u AS (SELECT rid, s, m, min(q) AS q FROM t WHERE m >= greatest(24, 3 * q) GROUP BY rid, s, m),
b AS (SELECT rid, count(*) AS n_runs, sha256(string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q)) AS listed FROM u GROUP BY rid),
o AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY m / q DESC, s, q) AS place FROM u),
c AS (SELECT DISTINCT rid, unnest(range(s + q, s + m)) AS i FROM u),
k AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS kept FROM (SELECT rid, unnest(w) AS x, unnest(range(0, n)) AS i FROM w WHERE rid IN (SELECT rid FROM u)) ANTI JOIN c USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, m AS length, q AS period, 1000 * m // q AS exponent_milli, coalesce(listed, sha256('')) AS runs_sha256, sha256(coalesce(kept, array_to_string(w, ' '))) AS collapsed_sha256
FROM w LEFT JOIN b USING (rid) LEFT JOIN (SELECT rid, s, m, q FROM o WHERE place = 1) USING (rid) LEFT JOIN k USING (rid)"""

#: Bigram counts, Good-Turing discounts by the longest valid range, and the weights of all histories.
KATZ_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({ID_CRC} % 7 = 2, false) AS held, list_append(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), ' end') AS w FROM documents),
t AS (SELECT rid, held, x, coalesce(lag(x) OVER (PARTITION BY rid ORDER BY i), ' begin') AS h FROM (SELECT rid, held, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM d)),
one AS (SELECT x, count(*) AS c FROM t WHERE NOT held GROUP BY x), two AS (SELECT h, x, count(*) AS c FROM t WHERE NOT held GROUP BY h, x),
n AS (SELECT 1 AS o, [{", ".join(f"count(*) FILTER (c = {r})" for r in range(1, 7))}] AS n FROM one UNION ALL SELECT 2, [{", ".join(f"count(*) FILTER (c = {r})" for r in range(1, 7))}] FROM two),
k AS (SELECT o, k, list_transform(range(1, k + 1), lambda r: ((r + 1) * n[r + 1] / (r * n[r]) - (k + 1) * n[k + 1] / n[1]) / (1 - (k + 1) * n[k + 1] / n[1])) AS d
  FROM n, range(1, 6) q(k) WHERE list_min(n[1:k + 1]) > 0 AND (k + 1) * n[k + 1] < n[1]),
v AS (SELECT o, arg_max(d, k) AS d FROM k WHERE list_min(d) > 0 AND list_max(d) < 1 GROUP BY o),
r AS (SELECT n.o, c, CASE WHEN d IS NOT NULL THEN coalesce(d[c], 1.0) WHEN c = 1 THEN 0.5 ELSE 1.0 END AS d FROM n LEFT JOIN v USING (o), range(1, 6) q(c)),
a AS (SELECT x, one.c, coalesce(d, 1.0) * one.c AS kept FROM one LEFT JOIN r ON r.o = 1 AND r.c = one.c),
s AS (SELECT sum(c) AS n, count(*) AS v, CASE WHEN sum(c - kept) > 1e-9 THEN sum(c - kept) ELSE 1 END AS free, CASE WHEN sum(c - kept) > 1e-9 THEN sum(c) ELSE sum(c) + 1 END AS total FROM a),
b AS (SELECT h, x, coalesce(d, 1.0) * two.c AS kept, two.c - coalesce(d, 1.0) * two.c AS freed, two.c FROM two LEFT JOIN r ON r.o = 2 AND r.c = two.c),
g AS (SELECT h, sum(freed) AS freed, sum(b.c) AS total, sum(a.kept) AS lower FROM b JOIN a USING (x) GROUP BY h),
w AS (SELECT h, CASE WHEN freed > 1e-9 THEN g.total ELSE g.total + 1 END AS total, CASE WHEN freed > 1e-9 THEN freed / g.total ELSE 1 / (g.total + 1) END / (1 - lower / s.total) AS weight FROM g, s),
p AS (SELECT rid, a.c, CASE WHEN b.kept IS NOT NULL THEN b.kept / w.total ELSE coalesce(w.weight, 1.0) * coalesce(a.kept, s.free) / s.total END AS p FROM t LEFT JOIN a USING (x) LEFT JOIN w ON w.h = t.h LEFT JOIN b ON b.h = t.h AND b.x = t.x, s),
z AS (SELECT rid, count(*) AS n_tokens, count(c) AS n_known, sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) AS base_score, sum(log10(p)) AS score FROM p, s GROUP BY rid)
SELECT doc_id, held AS held_out, n_tokens, n_known, CAST((SELECT n FROM s) AS BIGINT) AS train_tokens, base_score, score FROM d JOIN z USING (rid)"""


ORACLE_SQL: dict[str, str] = {"op1_license_scan": license_sql(), "op2_suffix_dedup": SUFFIX_SQL, "op4_embedding_near_dedup": EMBEDDING_SQL, "op6_substring_dedup": SUBSTRING_SQL, "op10_minhash_near_dedup": MINHASH_SQL, "op7_quality_rules": QUALITY_SQL, "op5_source_mixing": MIXING_SQL, "op11_periodic_runs": RUNS_SQL, "op12_katz_scores": KATZ_SQL}
