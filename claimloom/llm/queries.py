"""Registered queries of the training-text operators, and their SQL where SQL can say the same."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import (
    alignment,
    decontaminate,
    hosts,
    language,
    lines,
    minhash,
    owners,
    packing,
    passages,
    quality,
    resampling,
    secrets,
    suffixes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(spark, sf_dir)`` under ``name``."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_suffix_array")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents"), length=400)


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH given AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
numbered AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM given
),
keyed AS (
    SELECT doc_id, pos, line, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM numbered
),
repeated AS (
    SELECT line_key, max(doc_id) AS keeper FROM keyed
    WHERE length(line_key) >= 20
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
    SELECT k.doc_id, k.pos, k.line, r.keeper IS NULL OR r.keeper = k.doc_id AS stays
    FROM keyed k LEFT JOIN repeated r ON k.line_key = r.line_key
)
SELECT doc_id,
       CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE NOT stays) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op6_line_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(table(spark, sf_dir, "documents"))


URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@query("op8_url_filter")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(table(spark, sf_dir, "pages"), URL_RULES, whole=True, settled=hosts.SETTLED)


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary(), added_tokens=True)


@query("op10_substring_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


# The list in ``hashed`` holds fixed values: CRC-32 (IEEE, reflected) of each hexadecimal digit.
OP11_SQL = r"""
WITH texts AS (
    SELECT 'd' || row_number() OVER () AS row, doc_id, text FROM documents
    UNION ALL SELECT 't' || row_number() OVER (), NULL, text FROM benchmark
),
split AS (
    SELECT row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
    FROM texts
),
features AS (
    SELECT row, feature, count(*) AS n FROM (
        SELECT row, unnest(words) AS feature FROM split
        UNION ALL
        SELECT row, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM split
    ) GROUP BY row, feature
),
hashed AS (
    SELECT feature, xor(4294967295, list_reduce(
        list_transform(range(0, len(hex) // 2 * 2), lambda i: instr('123456789ABCDEF', substr(hex, (i + 2 - 2 * (i % 2))::INT, 1))::BIGINT),
        lambda crc, digit: xor(crc >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960,
            1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896,
            3183342108][(xor(crc, digit) & 15) + 1]),
        4294967295)) % 10000 AS bucket
    FROM (SELECT feature, hex(encode(feature)) AS hex FROM (SELECT DISTINCT feature FROM features))
),
totals AS (
    SELECT bucket, coalesce(sum(n) FILTER (WHERE row LIKE 'd%'), 0)::DOUBLE AS s,
           coalesce(sum(n) FILTER (WHERE row LIKE 't%'), 0)::DOUBLE AS t
    FROM features JOIN hashed USING (feature) GROUP BY bucket
),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
    FROM totals
),
summed AS (
    SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
    FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY row
),
weighed AS (
    SELECT row, doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
           coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
           ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h
    FROM split LEFT JOIN summed USING (row) WHERE row LIKE 'd%'
),
scored AS (
    SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed
),
drawn AS (
    SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS eligible
    FROM scored WHERE n_words >= 20 AND score IS NOT NULL
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * eligible // 100 THEN place END AS rank
FROM scored LEFT JOIN drawn USING (row)
"""


@query("op11_importance_resampling", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    return alignment.scored(table(spark, sf_dir, "documents"), vocabulary(), pieces)


OP13_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op13_exact_dedup", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = owners.owners(table(spark, sf_dir, "documents"), largest=True)
    return found.select("doc_id", *[F.col(c).alias(c.removeprefix("__")) for c in owners.ADDED])
