"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabloom.catalog import Registry, load
from tabloom.llm import bpe, fingerprints, host_rules, importance, jaccard_join, language, licenses, main_text, merkle, mixing, shards, token_files, vectors

registry = Registry()

# The unsigned crc32 of a text's UTF-8 bytes, bit by bit, in SQL that has no such function.
CRC32 = """xor(4294967295::UBIGINT, list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(range(1, octet_length(encode({0})) + 1), lambda i: ('0x' || substr(hex(encode({0})), (2 * i - 1)::INT, 2))::UBIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))))"""


@registry.add("op1_fingerprints")
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(load(spark, sf_dir, "documents"))


@registry.add("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(load(spark, sf_dir, "documents"))


@registry.add("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(load(spark, sf_dir, "documents"))


@registry.add("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.index_documents(load(spark, sf_dir, "documents"), path=public_tokenizers.path("byte_bpe_50k.json"))


@registry.add("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(load(spark, sf_dir, "documents"))


@registry.add("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(load(spark, sf_dir, "documents"), path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN)
    return bpe.token_digests(encoded)


@registry.add("op7_kd_shards")
def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(load(spark, sf_dir, "documents"))


@registry.add("op8_mix")
def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(load(spark, sf_dir, "documents"))


@registry.add("op9_main_text")
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_pages(load(spark, sf_dir, "pages"))


@registry.add("op10_near_vectors")
def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(load(spark, sf_dir, "embeddings"))


FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR END"
LEAF = "sha256(" + " || ".join(FIELD.format(x) for x in ("doc_id", "source", "lang", "{0}", "text")) + ")"


@registry.add(
    "op11_merkle",
    sql=f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, coalesce('=' || lang, '-') AS tree, {LEAF.format("n_chars")} AS leaf,
            CASE WHEN n_chars IS NOT NULL AND {CRC32.format("doc_id::VARCHAR")} % 7 = 0 THEN {LEAF.format("(n_chars + 1)")} END AS tampered
        FROM documents),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
    node(tree, level, pos, n, digest) AS (
        SELECT tree, 0, pos, n, leaf FROM placed
        UNION ALL
        SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY tree, level, pos // 2, n),
    subroots AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
    crown(level, pos, n, digest) AS (
        SELECT 0, pos, n, subroot FROM subroots
        UNION ALL
        SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM crown WHERE n > 1 GROUP BY level, pos // 2, n),
    walk(doc_id, leaf, tree, level, pos, n, proof, folded) AS (
        SELECT doc_id, leaf, tree, 0, pos, n, '', coalesce(tampered, leaf) FROM placed
        UNION ALL
        SELECT doc_id, leaf, w.tree, w.level + 1, w.pos // 2, (w.n + 1) // 2, proof || coalesce(s.digest, ''),
            sha256(CASE WHEN s.pos < w.pos THEN s.digest || folded ELSE folded || coalesce(s.digest, '') END)
        FROM walk w LEFT JOIN node s ON s.tree = w.tree AND s.level = w.level AND s.pos = xor(w.pos, 1) WHERE w.n > 1),
    climb(doc_id, leaf, subroot, level, pos, n, proof, folded) AS (
        SELECT doc_id, leaf, subroot, 0, s.pos, s.n, proof, folded FROM walk w JOIN subroots s ON s.tree = w.tree WHERE w.n = 1
        UNION ALL
        SELECT doc_id, leaf, subroot, c.level + 1, c.pos // 2, (c.n + 1) // 2, proof || coalesce(s.digest, ''),
            sha256(CASE WHEN s.pos < c.pos THEN s.digest || folded ELSE folded || coalesce(s.digest, '') END)
        FROM climb c LEFT JOIN crown s ON s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.n > 1)
    SELECT doc_id, leaf, subroot, root.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.digest AS verified
    FROM climb, (SELECT digest FROM crown WHERE n = 1) root WHERE n = 1
    """,
)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(load(spark, sf_dir, "documents"))


RUN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@registry.add(
    "op12_importance",
    sql=f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({LOWER}, '{RUN}') AS words FROM documents),
    runs AS (SELECT row, unnest(words) AS word FROM docs),
    target AS (SELECT unnest(regexp_extract_all({LOWER}, '{RUN}')) AS word FROM benchmark),
    hashed AS (SELECT word, {CRC32.format("word")} % 10000 AS bucket FROM (SELECT word FROM runs UNION SELECT word FROM target)),
    s AS (SELECT bucket, count(*) AS s FROM runs JOIN hashed USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM target JOIN hashed USING (word) GROUP BY bucket),
    gains AS (
        SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM runs) + 10000)::DOUBLE
            / ((s + 1.0::DOUBLE) * ((SELECT count(*) FROM target) + 10000)::DOUBLE)))::BIGINT AS gain
        FROM s LEFT JOIN t USING (bucket)),
    weights AS (SELECT row, sum(gain)::BIGINT AS weight FROM runs JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row),
    scored AS (
        SELECT row, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
            (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
        FROM docs LEFT JOIN weights USING (row)),
    ordered AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN ordered USING (row)
    """,
)
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


WHITE_RUN = "[^\\x20\\x09-\\x0D]+"
PRIOR = """CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 1), n) ELSE n END"""


@registry.add(
    "op13_host_rules",
    sql=f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WHITE_RUN}') AS words FROM documents),
    windows AS (SELECT row, k, list_slice(words, k, k + 7) AS win FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS k FROM docs)),
    twice AS (SELECT row, k FROM (SELECT row, k, count(*) OVER (PARTITION BY row, win) AS c FROM windows) WHERE c > 1),
    repeated AS (SELECT row, count(DISTINCT k + j)::BIGINT AS n FROM twice, range(8) r(j) GROUP BY row),
    lines AS (SELECT row, count(*) AS n_lines, count(DISTINCT line) AS kinds FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{WHITE_RUN}') GROUP BY row),
    measured AS (
        SELECT doc_id, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
            coalesce(n_lines - kinds, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
        FROM docs LEFT JOIN repeated USING (row) LEFT JOIN lines USING (row)),
    failed AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
            n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines AS any_failed FROM measured),
    hosts AS (SELECT source AS host, count(*)::DOUBLE AS n, sum(any_failed::INT)::DOUBLE AS k FROM failed GROUP BY source),
    moments AS (
        SELECT n, mean, (kkn - n * mean * mean - (hosts - 1) * mean * (1 - mean)) / nullif(greatest(n - nn / n - (hosts - 1), 0), 0) AS spread
        FROM (SELECT count(*) AS hosts, sum(n) AS n, sum(k) / sum(n) AS mean, sum(n * n) AS nn, sum(k * k / n) AS kkn FROM hosts)),
    prior AS (SELECT mean, {PRIOR} AS strength FROM moments),
    verdicts AS (SELECT host, (k + mean * strength) / (n + strength) > 0.5 AS refused FROM hosts, prior)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, refused AS host_refused, NOT base_failed AND NOT refused AS kept
    FROM failed JOIN verdicts ON source IS NOT DISTINCT FROM host
    """,
)
def op13_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(load(spark, sf_dir, "documents"))
