"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigprep.llm import collocations, decontaminate, exact_dedup, html_text, langid, mixing, near_dedup, packing, pii, quality, repeats, variants, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.personal_data(_table(spark, sf_dir, "documents")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents")).drop("text_hash", "keep_hash")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(_table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(_table(spark, sf_dir, "documents")).drop("text_hash")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "source", "mix_weight", "mix_repeats", "mix_epoch", "mix_block", "mix_rank")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op9_quality_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fertility_rules(_table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.top_collocations(collocations.collocations(_table(spark, sf_dir, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_groups(_table(spark, sf_dir, "documents"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def queries() -> dict:
    return {
        "op1_pii": op1_pii,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_packing": op4_packing,
        "op5_minhash_near_dedup": op5_minhash_near_dedup,
        "op6_html_text": op6_html_text,
        "op7_mixing": op7_mixing,
        "op8_warc": op8_warc,
        "op9_quality_fertility": op9_quality_fertility,
        "op10_langid": op10_langid,
        "op11_collocations": op11_collocations,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_decontamination": op13_decontamination,
    }


UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def oracle_sql() -> dict[str, str]:
    return {
        "op11_collocations": rf"""
            WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {UPPER}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
            w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
            g AS (SELECT lang, k, array_to_string(w[j + 1:j + k], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(0, len(w) - k + 1)) AS j FROM w, (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k)),
            f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS c FROM g GROUP BY ALL HAVING k = 1 OR count(*) >= 10),
            n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
            d AS (SELECT lang, k, phrase, c, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
            x AS (SELECT lang, part, max(c) AS c FROM (SELECT lang, c, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM d WHERE k = 3) GROUP BY ALL),
            t AS (SELECT lang, phrase, c, i, array_to_string(w[1:i], ' ') AS lp, array_to_string(w[i + 1:k], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS i FROM d)),
            s AS (SELECT t.lang, t.phrase, t.c AS a, l.c AS l, r.c AS r, CAST(1000000::HUGEINT * t.c * t.c // (l.c::HUGEINT * r.c) AS BIGINT) AS score
                  FROM t JOIN f l ON l.lang = t.lang AND l.phrase = lp JOIN f r ON r.lang = t.lang AND r.phrase = rp
                  QUALIFY row_number() OVER (PARTITION BY t.lang, t.phrase ORDER BY score, i) = 1)
            SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n.n, score
            FROM s JOIN n ON n.lang = s.lang LEFT JOIN x ON x.lang = s.lang AND x.part = s.phrase WHERE x.c IS NULL OR 100 * x.c < 50 * a QUALIFY rank <= 2000""",
        "op13_decontamination": rf"""
            WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
            b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
            g AS (SELECT DISTINCT item_id, k, array_to_string(w[j + 1:j + k], ' ') AS gram FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS j FROM b WHERE len(w) > 0)),
            o AS (SELECT doc_id, j, k, array_to_string(w[j + 1:j + k], ' ') AS gram FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS j FROM d, (SELECT DISTINCT k FROM g) s WHERE len(w) >= k)),
            m AS MATERIALIZED (SELECT doc_id, j, k, item_id FROM o JOIN g USING (k, gram)),
            h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS p FROM (SELECT DISTINCT doc_id, j, k FROM m)) GROUP BY doc_id),
            i AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
            SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
            FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)""",
        "op8_warc": """
            WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS h FROM pages),
            d AS (SELECT page_id, octet_length(payload) AS n, h,
                         list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([15, 10, 5, 0],
                             lambda s: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST((CAST('0x' || h[i * 5 + 1:i * 5 + 5] AS BIGINT) >> s) & 31 AS BIGINT) + 1]), 'string_agg', '')), 'string_agg', '') AS digest,
                         min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
            SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
                   CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
                   CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM d""",
        "op3_exact_dedup": r"""
            WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
            SELECT doc_id, min(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
                   doc_id = min(doc_id) OVER w AS kept, text_sha256
            FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    }
