"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm import (
    exact_dedup,
    interpolated_lm,
    language,
    licenses,
    merkle,
    packing,
    periodic_runs,
    pieces,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
)
from saldo.llm.common import documents, remainder


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classified(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(documents(spark, folder))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.deduplicated(documents(spark, folder))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(documents(spark, folder))


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.pieces(documents(spark, folder))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.clustered(documents(spark, folder))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicated(documents(spark, folder))


def op8_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return interpolated_lm.scored(documents(spark, folder))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identified(documents(spark, folder))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counted(documents(spark, folder))


def op11_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(documents(spark, folder))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of every text, some of which the contract makes periodic first; a null id counts as the empty text."""
    hash_ = "crc32(CAST(coalesce(CAST(doc_id AS STRING), '') AS BINARY))"
    words = r"filter(split(text, '[ \\x09-\\x0D]+'), w -> w <> '')"
    first = f"CAST({hash_} DIV 10 % size(words) AS INT)"
    period = f"(1 + (size(words) - {first}) DIV CAST(3 + {hash_} DIV 10 % 8 AS INT))"
    place = "CASE WHEN i < first THEN i ELSE first + (i - first) % period END"
    repeated = f"array_join(transform(sequence(0, size(words) - 1), i -> get(words, {place})), ' ')"
    docs = (
        documents(spark, folder)
        .selectExpr("doc_id", "text", f"CASE WHEN {hash_} % 10 = 0 THEN {words} END AS words")
        .selectExpr("doc_id", "text", "CASE WHEN size(words) > 0 THEN words END AS words")
        .selectExpr("*", f"{first} AS first", f"{period} AS period")
        .selectExpr("doc_id", f"CASE WHEN words IS NULL THEN text ELSE {repeated} END AS text")
    )
    earlier = "CASE WHEN a.start <> b.start THEN a.start - b.start ELSE a.period - b.period END"
    order = f"CASE WHEN a.length * b.period <> b.length * a.period THEN b.length * a.period - a.length * b.period ELSE {earlier} END"
    lines = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))"
    return (
        periodic_runs.searched(docs)
        .selectExpr("*", f"get(array_sort(runs, (a, b) -> CAST(signum({order}) AS INT)), 0) AS best")
        .selectExpr(
            "doc_id",
            "CAST(size(runs) AS LONG) AS n_runs",
            "best.start",
            "best.length",
            "best.period",
            "1000 * best.length DIV best.period AS exponent_milli",
            f"sha2(CAST(array_join({lines}, '') AS BINARY), 256) AS runs_sha256",
            "sha2(CAST(coalesce(collapsed, '') AS BINARY), 256) AS collapsed_sha256",
        )
    )


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of all documents, and each one's proof tried on a leaf that the contract may have tampered with."""
    docs = documents(spark, folder)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = [F.col(c).cast("decimal(20)") + 1 if c == "n_chars" else c for c in fields]
    tampered = F.when(remainder("doc_id", 7) == 0, merkle.leaf(changed)).alias("tampered")
    found = merkle.manifest(docs, "lang", "doc_id", fields, tampered).rows
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.hashed(merkle.proof("path")).alias("proof_sha256"),
        merkle.folded(F.coalesce("tampered", "leaf"), "path").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_pieces": op5_pieces,
    "op6_simhash": op6_simhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_model": op8_language_model,
    "op9_language": op9_language,
    "op10_token_counts": op10_token_counts,
    "op11_licenses": op11_licenses,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_manifest": op13_manifest,
}


def _values(pairs: Iterable[tuple[str, str]]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


#: SQL counterparts, where SQL can express the result.
SQL: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH norm AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
        ), first AS (
            SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY body
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM norm JOIN first USING (body)
    """,
    "op11_licenses": rf"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), words AS (
            SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM docs
        ), phrases(phrase, label) AS (
            VALUES {_values(licenses.PHRASES.items())}
        ), places AS (
            SELECT r, i, label FROM docs JOIN (SELECT r, i, w FROM words) USING (r)
            JOIN (SELECT string_split(phrase, ' ') AS p, label FROM phrases) ON p[1] = w
                AND words[i + 1 : i + len(p)] = p
        ), based AS (
            SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
            FROM places GROUP BY r
        ), templates AS (
            SELECT regexp_extract_all(lower(text), '[0-9a-z]+') AS t, label FROM (VALUES {_values(licenses.TEMPLATES)}) x(text, label)
        ), blocks AS (
            SELECT r, label, list_distinct(t) AS t, list_intersect(list_distinct(t), words[b * len(t) + 1 : (b + 2) * len(t)]) AS held
            FROM docs, templates, unnest(range((len(words) + len(t) - 1) // len(t))) x(b)
        ), shares AS (
            SELECT r, label, len(held) / len(t) AS share FROM blocks
            WHERE {licenses.THRESHOLD.denominator} * len(held) >= {licenses.THRESHOLD.numerator} * len(t)
        ), own AS (
            SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM shares GROUP BY r
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
            array_to_string(list_sort(coalesce(based.labels, [])), ',') AS base_labels,
            array_to_string(list_sort(list_distinct(coalesce(based.labels, []) || coalesce(own.labels, []))), ',') AS labels,
            CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0) END AS score
        FROM docs LEFT JOIN based USING (r) LEFT JOIN own USING (r)
    """,
    "op13_manifest": r"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, lang, source, text, n_chars, coalesce(CAST(doc_id AS VARCHAR), '') AS key FROM documents
        ), hashed AS (
            SELECT *, list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: CAST(ord(key[i]) AS BIGINT))),
                lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda x, none: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
            FROM docs
        ), fields AS (
            SELECT doc_id, lang, xor(crc, 4294967295) % 7 = 0 AS changed, n_chars,
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                    || coalesce(strlen(lang) || ':' || lang, '-') AS before,
                coalesce(strlen(text) || ':' || text, '-') AS after
            FROM hashed
        ), leaves AS (
            SELECT doc_id, lang, sha256(before || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || after) AS leaf,
                sha256(before || coalesce(strlen((n_chars + changed::INT)::VARCHAR) || ':' || (n_chars + changed::INT), '-') || after) AS tried
            FROM fields
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
            FROM leaves
        ), levels(lang, level, pos, n, h) AS (
            SELECT lang, 0, pos, n, leaf FROM ranked
            UNION ALL
            SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
            FROM levels WHERE n > 1 GROUP BY lang, level, n, pos // 2
        ), subroots AS (
            SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM levels WHERE n = 1
        ), tops(level, pos, n, h) AS (
            SELECT 0, pos, n, subroot FROM subroots
            UNION ALL
            SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, n, pos // 2
        ), steps AS (
            SELECT a.lang, a.pos, 0 AS tree, b.level, xor(a.pos >> b.level, 1) AS sibling, a.pos >> b.level AS own
            FROM ranked a JOIN (SELECT DISTINCT lang, level FROM levels WHERE n > 1) b ON a.lang IS NOT DISTINCT FROM b.lang
        ), siblings AS (
            SELECT s.lang, s.pos, s.tree, s.level, CASE WHEN sibling < own THEN coalesce(h, '') || '|' ELSE '|' || coalesce(h, '') END AS step
            FROM steps s LEFT JOIN levels l ON l.lang IS NOT DISTINCT FROM s.lang AND l.level = s.level AND l.pos = s.sibling
            UNION ALL
            SELECT r.lang, r.pos, 1, t.level,
                CASE WHEN xor(s.pos >> t.level, 1) < s.pos >> t.level THEN coalesce(h, '') || '|' ELSE '|' || coalesce(h, '') END
            FROM ranked r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) t
            LEFT JOIN tops o ON o.level = t.level AND o.pos = xor(s.pos >> t.level, 1)
        ), paths AS (
            SELECT lang, pos, list(step ORDER BY tree, level) AS path FROM siblings GROUP BY lang, pos
        ), found AS (
            SELECT r.doc_id, r.leaf, s.subroot, (SELECT h FROM tops WHERE n = 1) AS root,
                sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
                list_reduce(list_prepend(r.tried, coalesce(path, [])),
                    lambda x, step: sha256(split_part(step, '|', 1) || x || split_part(step, '|', 2))) AS folded_root
            FROM ranked r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang
            LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM r.lang AND p.pos = r.pos
        )
        SELECT *, folded_root = root AS verified FROM found
    """,
}
