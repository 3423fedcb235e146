"""The registered queries of this package and their SQL.

Every query applies its operator, with production parameters, to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline.llm import chat, divergence, embed_dedup, langid, line_rules, lm, mix, packing, repair, shard, simhash, topk, toxicity
from lapline.llm.common import ship_package


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_read(spark, sf_dir, "conversations"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_read(spark, sf_dir, "documents"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mixed_documents(_read(spark, sf_dir, "documents")) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op6_shard_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _, _ = shard.shard_documents(_read(spark, sf_dir, "documents"))
    return records.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(_read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, 5)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.assess(_read(spark, sf_dir, "documents"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_digests(_read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_chat_format, op2_lm_score, op3_simhash_dedup, op4_embedding_dedup, op5_mix_sources, op6_shard_slots,
        op7_language_id, op8_topk_search, op9_toxicity, op10_best_fit_pack, op11_source_divergence,
        op12_quality_rules, op13_structure_repair)
}

ORACLES: dict[str, str] = {
    "op4_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') = 0
              AND list_aggregate(list_transform(embedding, lambda x: abs(x)), 'max') > 0),
        link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
                 ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                 WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
        SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
               vec_id <= coalesce(least.b, vec_id) AS kept
        FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op5_mix_sources": """
        WITH d AS (
            SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                   md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS shuffled
            FROM documents),
        s AS (SELECT k, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY k) - 1 AS no FROM d GROUP BY k),
        w AS (SELECT *, CASE no % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s),
        r AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS caps, coalesce(sum(weight) OVER before, 0) AS weights,
                     sum(source_size) OVER () AS budget, sum(weight) OVER () AS all_weights
              FROM w WINDOW before AS (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        o AS (SELECT (budget - caps)::BIGINT AS lft, (all_weights - weights)::BIGINT AS ovr FROM r
              WHERE cap * (all_weights - weights) >= weight * (budget - caps) ORDER BY cap / weight, k LIMIT 1),
        t AS (SELECT k, source_size, least(cap::DOUBLE, (weight * lft)::DOUBLE / ovr::DOUBLE) AS target FROM w, o),
        q AS (SELECT doc_id, size, source_size, target,
                     coalesce(sum(size) OVER (PARTITION BY k ORDER BY shuffled, size, doc_id
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
              FROM d JOIN t USING (k))
        SELECT doc_id, size, source_size, target,
               (greatest(0, least(size, floor(target) - before)) + greatest(0, least(size, floor(target) - source_size - before))
                + greatest(0, least(size, floor(target) - 2 * source_size - before)))::BIGINT AS taken
        FROM q""",
    "op8_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
              AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_dot_product(a.e, b.e)::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
        r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_source_divergence": """
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
            FROM documents),
        t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
        kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
        cell AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        l AS (SELECT lang, coalesce(any_value(k.v), 0)::HUGEINT AS v, coalesce(any_value(k.n), 0)::HUGEINT AS n
              FROM d LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang) k USING (lang) GROUP BY lang),
        g AS (SELECT lang, source, coalesce(any_value(c.n), 0)::HUGEINT AS n
              FROM d LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cell GROUP BY ALL) c USING (lang, source) GROUP BY lang, source),
        p AS (SELECT g.lang, g.source, kept.term, coalesce(cell.n, 0) AS count,
                     1 + (1000000000::HUGEINT * (coalesce(cell.n, 0) + 2)) // (g.n + 2 * l.v) AS p,
                     1 + (1000000000::HUGEINT * (kept.n + 2)) // (l.n + 2 * l.v) AS q
              FROM g JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN cell USING (lang, source, term)),
        pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                 FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
        every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0)::BIGINT AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
                  UNION ALL
                  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE count > 0 AND p > q)
        SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM every
        QUALIFY part = 'pair' OR rank <= 10""",
    "op12_quality_rules": """
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS host FROM documents),
        w AS (
            SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
            FROM d),
        starts AS (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w),
        twice AS (SELECT r, i FROM starts
                  QUALIFY count(*) OVER (PARTITION BY r, array_to_string(list_slice(words, i, i + 7), ' ')) > 1),
        covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
        base AS (
            SELECT r, doc_id, host, text, lines, len(words)::BIGINT AS n_words,
                   coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
            FROM w LEFT JOIN covered c USING (r)),
        line AS (
            SELECT r, host, text, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS n,
                   regexp_replace(array_to_string(regexp_extract_all(
                       translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), ' '),
                       '[0-9]+', '0', 'g') AS line
            FROM (SELECT r, host, text, unnest(lines) AS x FROM base)),
        often AS (SELECT host, line FROM line GROUP BY host, line HAVING count(DISTINCT text) > 10),
        lost AS (SELECT r, sum(n)::BIGINT AS n FROM line JOIN often USING (host, line) GROUP BY r)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
                   AND (n_words - coalesce(lost.n, 0)) * 1000 >= n_words * 500 AS kept, coalesce(lost.n, 0)::BIGINT AS removed_words
        FROM base LEFT JOIN lost USING (r)""",
}
