"""The thin queries opN_<name> over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryset.llm import decontaminate, lines, mixing, quality_classifier, quality_rules, simhash, substrings, token_counts, token_files, tokens, url_filter
from queryset.llm.scratch import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_output(_table(spark, sf_dir, "documents"), tokens.default_path())


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two edits of every document: a passage replaced at a third of it, words put in at two thirds."""
    docs = _table(spark, sf_dir, "documents")
    size = F.coalesce(F.char_length("text"), F.lit(0))
    replaced = F.struct(F.lit(1).alias("seq"), F.floor(size / 3).alias("start"), (F.floor(size / 3) + 40).alias("end"), F.lit("an edited passage").alias("insert"))
    put_in = F.struct(F.lit(2).alias("seq"), F.floor(2 * size / 3).alias("start"), F.floor(2 * size / 3).alias("end"), F.lit(" and more words").alias("insert"))
    edits = docs.select("doc_id", F.explode(F.array(replaced, put_in)).alias("e")).select("doc_id", "e.*")
    vocabulary = tokens.default_path()
    trees = written(token_counts.build(docs, vocabulary), "trees")
    return token_counts.recount(docs, trees, edits, vocabulary)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_documents(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_repeats=3)
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(_table(spark, sf_dir, "documents"), size=20, with_text=False).drop("kept_text")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.without_boilerplate(_table(spark, sf_dir, "pages"), ratio=0.2, min_pages=5)
    return found.select("page_id", "host", "n_lines", "n_dropped", F.md5("kept_text").alias("kept_md5"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), radius=4, shingle_words=4)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=13, percent=5)
    items = F.array_join(F.array_sort("items"), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), "contaminated")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_classifier.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), least=0.7, sample=6000)
    return found.select("doc_id", F.round("expected_grade", 6).alias("expected_grade"), F.round("p_top", 6).alias("p_top"), "kept")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judged(_table(spark, sf_dir, "pages"), url_filter.RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(_table(spark, sf_dir, "documents"), min_words=50, max_repeat_percent=50)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))


def queries() -> dict:
    return {
        "op1_token_files": op1_token_files,
        "op2_token_counts": op2_token_counts,
        "op3_mixing": op3_mixing,
        "op4_substrings": op4_substrings,
        "op5_lines": op5_lines,
        "op6_simhash": op6_simhash,
        "op7_decontaminate": op7_decontaminate,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_url_filter": op9_url_filter,
        "op10_quality_rules": op10_quality_rules,
    }


#: Without SQL: op1 and op2 (tokenizer), op3 (flow and seeded order), op6 (XXH64 with a
#: seed), op8 (regression) and op9 (Viterbi and naive Bayes). Tests hold them against
#: brute force.
def oracle_sql() -> dict[str, str]:
    return {"op4_substrings": OP4_SQL, "op5_lines": OP5_SQL, "op7_decontaminate": OP7_SQL, "op10_quality_rules": _op10_sql()}


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM later)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (
    SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.j) FILTER (WHERE gone.j IS NULL) AS t, count(gone.j) AS n_removed
    FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.j = gone.j GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(kept.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP5_SQL = r"""
WITH p AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        list_filter(list_transform(string_split(
            regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', '', 'g'),
                '(?i)</?(p|div|br|li|ul|ol|h1|h2|h3|h4|h5|h6|title|table|tr|td|th|article|section|nav|header|footer|body|head|html|blockquote|pre)([ /][^>]*)?>', chr(10), 'g'),
                '<[^>]*>', '', 'g'), chr(10)),
            lambda x: regexp_replace(x, '^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$', '', 'g')), lambda x: x <> '') AS ls
    FROM pages),
total AS (SELECT host, count(*) AS n_pages FROM p GROUP BY host HAVING count(*) >= 5),
often AS (
    SELECT host, line FROM (SELECT host, unnest(list_distinct(ls)) AS line FROM p) JOIN total USING (host)
    GROUP BY host, line, n_pages HAVING count(*) > n_pages * 0.2),
boiler AS (SELECT host, list(line) AS b FROM often GROUP BY host),
k AS (SELECT page_id, p.host, ls, CASE WHEN b IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(b, x)) END AS kept FROM p LEFT JOIN boiler ON p.host = boiler.host)
SELECT page_id, host, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(kept) AS BIGINT) AS n_dropped, md5(coalesce(array_to_string(kept, chr(10)), '')) AS kept_md5 FROM k
"""

OP7_SQL = r"""
WITH lower_d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lower_d),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
    FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
    SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""


def _op10_sql() -> str:
    """The rules with the production limits; the common words are those of the documents that pass the base rules."""
    without = lambda pattern: f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"
    classes = ", ".join(map(without, ("[a-z]", r"[\x20\x09-\x0D]", "[A-Z]", r"[^\x00-\x7F]", "[0-9]")))

    def distance(p: str, q: str) -> str:
        a, b = f"({p}[i] / list_sum({p}))", f"({q}[i] / list_sum({q}))"
        half = lambda x: f"(CASE WHEN {x} > 0 THEN {x} * log2({x} / (({a} + {b}) / 2)) ELSE 0 END)"
        return f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), lambda i: {half(a)} + {half(b)})) / 2, 0)) END"

    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS language FROM documents),
s AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM s WHERE len(w) >= 3)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY doc_id),
b AS (
    SELECT s.*, coalesce(cov.n, 0) AS n_rep, len(w) < 50 OR 100 * coalesce(cov.n, 0) > 50 * len(w) AS base_failed
    FROM s LEFT JOIN cov ON s.doc_id = cov.doc_id),
cw AS (SELECT language, word, count(*) AS n FROM (SELECT language, lower(unnest(w)) AS word FROM b WHERE NOT base_failed) GROUP BY ALL),
top AS (
    SELECT language, list(word ORDER BY r) AS listed
    FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY n DESC, word) AS r FROM cw WHERE NOT regexp_matches(word, '[\x00-\x60\x7B-\x7F]'))
    WHERE r <= 32 GROUP BY language),
f AS (
    SELECT doc_id, language, base_failed, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST({without("[#*$%&|<>]")} AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(n_rep AS BIGINT) AS n_repeat_words,
        list_append(cs, length(t) - list_sum(cs)) AS chars, list_append(ws, len(w) - coalesce(list_sum(ws), 0)) AS common
    FROM (
        SELECT b.*, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls, [{classes}] AS cs,
            list_transform(coalesce(listed, []), lambda c: len(list_filter(w, lambda x: lower(x) = c))) AS ws
        FROM b LEFT JOIN top ON b.language = top.language)),
rc AS (SELECT language, list(v ORDER BY k) AS q FROM (SELECT language, k, sum(v) AS v FROM (SELECT language, unnest(chars) AS v, unnest(range(len(chars))) AS k FROM f WHERE NOT base_failed) GROUP BY ALL) GROUP BY language),
rw AS (SELECT language, list(v ORDER BY k) AS q FROM (SELECT language, k, sum(v) AS v FROM (SELECT language, unnest(common) AS v, unnest(range(len(common))) AS k FROM f WHERE NOT base_failed) GROUP BY ALL) GROUP BY language),
j AS (
    SELECT f.*, CASE WHEN word_chars >= 200 THEN {distance("chars", "rc.q")} END AS cd, CASE WHEN n_words >= 100 THEN {distance("common", "rw.q")} END AS wd
    FROM f LEFT JOIN rc ON f.language = rc.language LEFT JOIN rw ON f.language = rw.language)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (coalesce(cd, 0) > 0.28 OR coalesce(wd, 0) > 0.3) AS kept,
    round(cd, 6) AS char_distance, round(wd, 6) AS word_distance FROM j
"""
