"""One query for each operator, over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.llm import (
    align,
    bpe,
    curriculum,
    hmm,
    minhash,
    neighbours,
    packing,
    periods,
    pii,
    quality,
    query,
    shipped,
    substring,
    table,
    urls,
    warc,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER, PIECE_TOKENIZER = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))

PHRASES = "|".join(quality.Rules().boilerplate)

QUALITY_SQL = rf"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text,
        [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words,
        [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, words[i:i + 4] AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5)
), again AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), repeats AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM again) GROUP BY doc_id
), lines AS (
    SELECT doc_id, len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
        regexp_matches(line, '[.!?…:;。！？]["''”’»)\]]*[\x20\x09-\x0D]*$')
            AND 100 * len(regexp_replace(line, '[^!?]', '', 'g')) <= 8 * len(line)
            AND len(regexp_replace(line, '[^|]', '', 'g')) <= 1
            AND 100 * len(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) <= 10 * len(line)
            AND NOT regexp_matches(line, '\b(?:{PHRASES})', 'i') AS good
    FROM (SELECT doc_id, unnest(lines) AS line FROM split)
), remaining AS (
    SELECT doc_id, sum(CASE WHEN good THEN chars ELSE 0 END) AS chars FROM lines GROUP BY doc_id
), counts AS (
    SELECT s.doc_id, len(words)::BIGINT AS n_words,
        len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(k.chars, 0) AS remaining
    FROM split s LEFT JOIN repeats r USING (doc_id) LEFT JOIN remaining k USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND remaining > 0 AND 100 * remaining >= 50 * word_chars AS kept
FROM counts
"""


@query("op1_hidden_markov_scoring")
def hidden_markov_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.scored(table(spark, folder, "documents"))


@query("op5_sequence_packing")
def sequence_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.packed(table(spark, folder, "documents"), TOKENIZER, length=4096, end=2)
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


#: Key of the registered query; a real run passes its own secret.
PII_KEY = b"key of the registered query"


@query("op6_pii_surrogates")
def pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.with_surrogates(docs, PII_KEY, count_col="n_entities")


@query("op7_warc_derivatives")
def warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    sources = warc.responses(table(spark, folder, "pages"), date="2024-01-01T00:00:00Z")
    return warc.derived(sources, keep=("page_id",))


@query("op8_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoded(table(spark, folder, "documents"), TOKENIZER, decoded_col="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = substring.without_repeats(docs, 35, counts=("n_words", "n_removed"))
    joined = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(joined, 256).alias("kept_sha256"))


URL_RULES = (
    urls.Rule.parse("block", "net/"),
    urls.Rule.parse("allow", "example.net/en/"),
    urls.Rule.parse("block", "example.com/de/"),
    urls.Rule.parse("allow", "org/fr/"),
)
#: Pages with one of these words put their URL on the list.
LISTED_WORDS = r"\b(idiot|moron|scum|loser|worthless|pathetic|stupid)\b"

URLS_SQL = rf"""
WITH parts AS (
    SELECT page_id, html, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 2) AS path,
        [p FOR p IN string_split(substr(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 3), 2), '&')
            IF p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$')] AS given
    FROM pages
), named AS (
    SELECT page_id, html, coalesce(host, '') AS host, coalesce(path, '') AS path,
        CASE WHEN regexp_replace(host, '^www\.', '') <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '')
            || CASE WHEN len(given) > 0 THEN '?' || array_to_string(list_sort(given), '&') ELSE '' END END AS url
    FROM parts
), listed AS (
    SELECT DISTINCT url FROM named WHERE regexp_matches(html, '{LISTED_WORDS}') AND url IS NOT NULL
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
    FROM named
)
SELECT page_id, host, path, rule, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block'
    WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
    ELSE CASE WHEN l.url IS NULL THEN 'allow' ELSE 'block' END END AS verdict
FROM ruled LEFT JOIN listed l USING (url)
"""


@query("op2_url_verdicts", URLS_SQL)
def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    listed = pages.filter(F.col("html").rlike(LISTED_WORDS)).select("url")
    return urls.judged(pages.select("page_id", "url"), URL_RULES, listed).drop("url")


@query("op3_line_quality", QUALITY_SQL)
def line_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judged(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op4_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), shingle=4, percent=80)


@query("op10_vector_near_dedup")
def vector_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, folder, "embeddings"), cosine=0.98)


def going_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids and texts; one text in ten, by its id, repeats a part of itself from some word on."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for i, number in enumerate(batch.column(0).to_pylist()):
            drawn = zlib.crc32(b"" if number is None else str(number).encode())
            own = (texts[i] or "").encode().split() if drawn % 10 == 0 else []
            if own:
                first = drawn // 10 % len(own)
                period = 1 + (len(own) - first) // (3 + drawn // 10 % 8)
                again = own[first : first + period] * (1 + (len(own) - first) // period)
                texts[i] = b" ".join(own[:first] + again[: len(own) - first]).decode()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


@query("op11_periodic_runs")
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(shipped(spark), folder, "documents").select(F.col("doc_id").cast("long"), "text")
    found = periods.collapsed(docs.mapInArrow(going_round, "doc_id long, text string"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("collapsed_sha256"),
    )


MIX_SQL = r"""
WITH docs AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN 'b' ELSE 'a' || source END AS source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')) AS key
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source) - 1 AS rank,
        [3, 1, 2][1 + (row_number() OVER (ORDER BY source) - 1) % 3] AS weight
    FROM docs GROUP BY source
), levels AS (
    SELECT *, row_number() OVER by_ratio AS place, sum(2 * source_size) OVER by_ratio AS held,
        sum(weight) OVER () - sum(weight) OVER by_ratio AS free, sum(source_size) OVER () AS whole
    FROM sources
    WINDOW by_ratio AS (ORDER BY source_size::DOUBLE / weight, source ROWS UNBOUNDED PRECEDING)
), stopped AS (
    -- a source stops when it does so at the level that those before it leave
    SELECT coalesce(max(place), 0) AS places FROM levels
    WHERE 2 * source_size * 100 * (free + weight) <= weight * (150 * whole - 100 * (held - 2 * source_size))
), shared AS (
    SELECT 150 * any_value(whole) - 100 * coalesce(sum(2 * source_size) FILTER (place <= places), 0) AS rest,
        100 * greatest(1, coalesce(sum(weight) FILTER (place > places), 0)) AS among
    FROM levels, stopped
), aims AS (
    SELECT source, source_size, rank, CASE WHEN place <= places THEN (2 * source_size)::DOUBLE
        ELSE weight::DOUBLE * rest::DOUBLE / among::DOUBLE END AS target
    FROM levels, stopped, shared
), placed AS (
    SELECT doc_id, size, source_size, target, round(target)::BIGINT AS aim, rank,
        sum(size) OVER (PARTITION BY source ORDER BY key, size, doc_id ROWS UNBOUNDED PRECEDING) - size AS begin
    FROM docs JOIN aims USING (source)
), takes AS (
    SELECT *, greatest(least(size, aim - begin), 0)::BIGINT AS first, greatest(least(size, aim - begin - source_size), 0)::BIGINT AS second
    FROM placed
), shares AS (
    SELECT *, CASE WHEN first > 0 THEN (begin::DOUBLE + first / 2.0::DOUBLE) / aim END AS share FROM takes
)
SELECT doc_id, size, source_size, target, first + second AS taken, round(CASE rank % 3
    WHEN 0 THEN 2 * (1.5 * share) / (2 + sqrt(4 - 2 * (1.5 * share)))
    WHEN 1 THEN share
    WHEN 2 THEN CASE WHEN share < 0.25 THEN CASE WHEN share > 0 THEN 2 * share / sqrt(4 * share) ELSE 0 END
        ELSE 0.5 + 2 * (share - 0.25) / (1 + sqrt(1 + 4 * (share - 0.25))) END END, 6) AS position
FROM shares
"""


@query("op12_curriculum_mix", MIX_SQL)
def curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = curriculum.mixed(table(spark, folder, "documents"), weights=(3, 1, 2), percent=150, most=2)
    first = F.round(F.get("takes", F.lit(0))["position"], 6).alias("position")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", first).orderBy("position", "doc_id")


@query("op13_token_alignment")
def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = align.aligned(table(spark, folder, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
