"""The operators as named queries over the driver tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontamination, language_model, manifest, mixing, near_duplicates, negatives, quality_model, quality_rules, sharding, substrings, toxicity, url_filter, warc
from shelfmark.llm.storage import remainder, table
from shelfmark.session import fresh_dir


def _scored(rows: DataFrame, score: str, held_out, threshold: float) -> DataFrame:
    return rows.select("doc_id", held_out.alias("held_out"), F.col(score).alias("score"), (F.col(score) >= threshold).cast("int").alias("predicted"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder(5) == 0
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return _scored(toxicity.score_toxicity(docs.select("doc_id", "text"), model), "toxicity", held_out, 0.5)


def op3_substring_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_spans(table(spark, sf_dir, "documents")).drop("text_key")


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.resolve(warc.read_archives(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(4) != 2)
    return _scored(scores, "score", remainder(4) == 2, 0.7)


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = language_model.score_texts(table(spark, sf_dir, "documents"), remainder(7) != 2)
    return scores.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label, vec_id = F.col("label").cast("long"), F.col("vec_id")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", moved, vec_id % 100 == 0)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = F.when(tampered, manifest.leaf_digest([*fields[:4], manifest.tampered_text(F.col("text"))]))
    return manifest.manifest(docs, "doc_id", "lang", manifest.leaf_digest(fields), changed)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.sharded(docs).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_toxicity, op3_substring_spans, op4_warc_revisits, op5_quality_model, op6_language_model, op7_source_mix, op8_near_duplicates, op9_quality_rules, op10_url_filter, op11_hard_negatives, op12_manifest, op13_sharding)}

ORACLE = {
    "op4_warc_revisits": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), q AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_page FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < last_page THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < last_page THEN last_page END AS refers_to
        FROM q
    """,
    "op8_near_duplicates": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
            FROM words
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
        ), links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
        ), steps AS (
            SELECT a, b FROM links UNION SELECT b, a FROM links
        ), reached AS (
            SELECT a, b FROM steps UNION SELECT r.a, s.b FROM reached r JOIN steps s ON r.b = s.a
        ), component AS (
            SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reached GROUP BY a
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
               d.doc_id = coalesce(component_id, d.doc_id) AS kept
        FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN component USING (doc_id)
    """,
    "op11_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY rank <= 5
    """,
    "op12_manifest": """
        WITH RECURSIVE tampers AS (
            SELECT doc_id, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT), lambda c, b:
                list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda d, one: xor(d >> 1, 3988292384 * (d & 1))), 4294967295) AS c
            FROM documents
        ), fields AS (
            SELECT d.doc_id, lang, concat(
                       coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                       coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS text,
                   coalesce(strlen(text) || ':' || CASE WHEN xor(c, 4294967295) % 3 = 0
                       THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-') AS changed
            FROM documents d JOIN tampers t ON t.doc_id = d.doc_id
        ), leaves AS (
            SELECT doc_id, coalesce(encode('1' || lang), encode('0')) AS tree, sha256(head || text) AS leaf, sha256(head || changed) AS changed,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS total
            FROM fields
        ), nodes AS (
            SELECT tree, 0 AS level, pos, total, leaf AS h FROM leaves
            UNION ALL
            SELECT tree, level + 1, pos // 8, any_value((total + 7) // 8), sha256(string_agg(h, '' ORDER BY pos))
            FROM nodes WHERE total > 1 GROUP BY tree, level, pos // 8
        ), subroots AS (
            SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS total FROM nodes WHERE total = 1
        ), upper AS (
            SELECT 0 AS level, pos, total, h FROM subroots
            UNION ALL
            SELECT level + 1, pos // 8, any_value((total + 7) // 8), sha256(string_agg(h, '' ORDER BY pos))
            FROM upper WHERE total > 1 GROUP BY level, pos // 8
        ), whole AS (
            SELECT n.tree, n.level, n.pos, n.total, n.h FROM nodes n
        ), fold AS (
            SELECT doc_id, tree, 0 AS level, pos, changed AS h, total, '' AS siblings FROM leaves
            UNION ALL
            SELECT f.doc_id, f.tree, f.level + 1, f.pos // 8, sha256(string_agg(CASE WHEN n.pos = f.pos THEN f.h ELSE n.h END, '' ORDER BY n.pos)),
                   (f.total + 7) // 8, f.siblings || coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> f.pos), '')
            FROM fold f JOIN whole n ON n.tree = f.tree AND n.level = f.level AND n.pos // 8 = f.pos // 8
            WHERE f.total > 1 GROUP BY f.doc_id, f.tree, f.level, f.pos, f.h, f.total, f.siblings
        ), top AS (
            SELECT f.doc_id, s.h AS subroot, 0 AS level, s.pos, f.h, s.total, f.siblings FROM fold f JOIN subroots s USING (tree) WHERE f.total = 1
            UNION ALL
            SELECT t.doc_id, t.subroot, t.level + 1, t.pos // 8, sha256(string_agg(CASE WHEN u.pos = t.pos THEN t.h ELSE u.h END, '' ORDER BY u.pos)),
                   (t.total + 7) // 8, t.siblings || coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos <> t.pos), '')
            FROM top t JOIN (SELECT * FROM upper) u ON u.level = t.level AND u.pos // 8 = t.pos // 8
            WHERE t.total > 1 GROUP BY t.doc_id, t.subroot, t.level, t.pos, t.h, t.total, t.siblings
        )
        SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, top.h AS folded_root, top.h = root AS verified
        FROM top JOIN leaves USING (doc_id), (SELECT h AS root FROM upper WHERE total = 1)
        WHERE top.total = 1
    """,
    "op13_sharding": """
        WITH table_ AS (
            SELECT list_transform(range(256), lambda b: list_reduce([b, 1, 1, 1, 1, 1, 1, 1, 1], lambda d, one: xor(d >> 1, 3988292384 * (d & 1)))) AS t
        ), sums AS (
            SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, xor(list_reduce(
                list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
            FROM documents, table_
        ), draws AS (
            SELECT doc_id, s, -ln((('0x' || substr(md5(coalesce('k' || doc_id, 'null') || '#' || s), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) AS draw
            FROM documents, range(17) r(s)
        ), held AS (
            SELECT doc_id, arg_min(s, draw) FILTER (s < 16) AS shard, arg_min(s, draw) AS grown FROM draws GROUP BY doc_id
        )
        SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
               grown::INT AS grown_shard
        FROM sums JOIN held USING (doc_id)
    """,
}
