"""The operators of this package as registered queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curiota.llm import codec, fingerprint, lines, packing, quality, secrets, simhash, substring, token_count, toxicity

#: Documents, chosen by a hash, whose labelled strings train the models of operator 1.
TRAIN_ROWS = 500


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = secrets.train(secrets.labelled_samples(spark, docs, TRAIN_ROWS))
    return secrets.digest(secrets.scan(docs, model))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.round_trip_digest(_documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), shingle=3, distance=3)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the rule that is named first depends on the order estimated on the sample, which SQL does not know
    return quality.cascade(_documents(spark, sf_dir)).drop("rejected_by")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.against_next(_documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.dedup_substrings(_documents(spark, sf_dir), window=20))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"), limit=512)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(_documents(spark, sf_dir), min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


#: DuckDB; a three-word window is its words joined by a space, and the verdict is that of all rules in any order.
OP4_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text,
           translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS dense,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: translate(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') <> '') AS lines
    FROM documents
), placed AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts
), windows AS (
    SELECT doc_id, pos, word, lead(word, 1) OVER w AS second, lead(word, 2) OVER w AS third
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), counted AS (
    SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, word, second, third) AS n FROM windows WHERE third IS NOT NULL
), repeated AS (
    SELECT doc_id, count(DISTINCT word) AS n
    FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS word FROM counted WHERE n > 1) GROUP BY doc_id
), measured AS (
    SELECT t.doc_id, len(words) AS n_words, length(dense) AS word_chars,
           length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
           len(lines) AS n_lines, len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) AS n_lettered
    FROM texts t LEFT JOIN repeated r ON t.doc_id = r.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR 100 * n_dup_lines > 50 * greatest(n_lines, 1) OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_lettered < 70 * n_words) AS kept
FROM measured
"""

#: DuckDB; a window is its 20 words joined by a space, and all but its first start are removed.
OP8_SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, pos, array_to_string(words[pos : pos + 19], ' ') AS key
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM texts)
), later AS (
    SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) > 1
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later
), placed AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts
), kept AS (
    SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p.pos) AS text
    FROM placed p ANTI JOIN covered c ON p.doc_id = c.doc_id AND p.pos = c.pos GROUP BY p.doc_id
)
SELECT t.doc_id, len(words) AS n_words, len(words) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

#: DuckDB; white space is [\x20\x09-\x0D] and only A-Z are folded, as in the operator.
OP10_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND c.keeper <> k.doc_id AS gone
    FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scans": op1_secret_scans,
        "op2_bpe_codec": op2_bpe_codec,
        "op3_simhash": op3_simhash,
        "op4_quality_rules": op4_quality_rules,
        "op5_fingerprints": op5_fingerprints,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_toxicity": op7_toxicity,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_token_counts": op9_token_counts,
        "op10_line_dedup": op10_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": OP4_SQL, "op8_substring_dedup": OP8_SQL, "op10_line_dedup": OP10_SQL}
