"""The queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import ann, bond, bpe, minhash, mixing, packing, quality, sharding, spelling, substring_dedup, token_count, topk, toxicity
from churnlens.llm.labelled import held_out

SHARDS = 8
TOXIC = 0.3  # documents from this score on are toxic
GOOD = 0.7  # documents below this score are poor


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _classified(scored: DataFrame, least: float) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows, rows.filter("vec_id % 100 = 0"), 10)


def op4_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, rows.filter("vec_id % 20 = 0"), 20)


def op5_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _classified(toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))), TOXIC)


def op6_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs, [1.0] * SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _classified(quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"))), GOOD)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bond.hard_negatives(rows, F.col("vec_id") % 100 == 0, label)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, mixing.cyclic_weights(docs)).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_byte_bpe, op3_exact_topk, op4_hash_forest, op5_toxicity_grammar,
    op6_rendezvous_sharding, op7_token_counts, op8_minhash, op9_quality_nbsvm, op10_packing,
    op11_hard_negatives, op12_spelling_variants, op13_source_mix)}
ORACLE: dict[str, str] = {
    "op3_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
            WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
        FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 10""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
            WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
               p.positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
             AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
        QUALIFY row_number() OVER w <= 5""",
    "op12_spelling_variants": r"""
        WITH RECURSIVE tab AS (
            SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        r AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{6,}')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
        d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, run, count(*) AS c FROM r GROUP BY 1, 2),
        h AS (
            SELECT run, c, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(s, ''), lambda x:
                       CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))),
                       lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
            FROM d, tab),
        w AS (
            SELECT word, CAST(sum(c) AS BIGINT) AS n
            FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
        holes AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM holes a JOIN w b ON a.cut = b.word
            UNION SELECT b.word, a.word, a.n FROM holes a JOIN w b ON a.cut = b.word),
        best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
        first AS (SELECT near.word, min(other) AS other FROM near JOIN best ON near.word = best.word AND near.m = best.m GROUP BY near.word),
        f AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
            FROM w LEFT JOIN best ON w.word = best.word LEFT JOIN first ON w.word = first.word),
        up AS (
            SELECT word, word AS root, form AS next FROM f
            UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON f.word = up.next)
        SELECT f.word, form, up.root, n, n_near, form_n FROM f JOIN up ON up.word = f.word AND up.next IS NULL""",
    "op13_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS draw
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
            FROM d GROUP BY source),
        -- sources in the order in which they stop; the level if all before this one have stopped
        l AS (
            SELECT *, (sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER earlier, 0))::DOUBLE / sum(weight) OVER later AS level, row_number() OVER earlier AS place
            FROM s WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                          later AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        t AS (
            SELECT source, source_size, CASE WHEN least_level * weight >= 3 * source_size OR least_level IS NULL
                                             THEN (3 * source_size)::DOUBLE ELSE least_level * weight END AS target
            FROM l, (SELECT arg_min(level, place) FILTER (WHERE level * weight < 3 * source_size) AS least_level FROM l)),
        r AS (
            SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS copies FROM t),
        b AS (
            SELECT d.doc_id, d.size, r.source_size, r.target, r.copies, r.target - r.copies * r.source_size AS rest,
                   coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(size * (copies + CASE WHEN size > 0 AND 2 * (rest - before) >= size THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM b""",
}
